"""A corpus pipeline: language, repeated lines, near duplicates, personal data, packing.

Every stage takes the documents its predecessor kept and all but the last return the
columns of ``documents``; n_chars follows the text where a stage changes it. Rows that repeat a
doc_id are one document and stay or go together; rows with a null doc_id pass the stages
that compare documents. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import jaccard, language, lines, packing, pii
from millrace.llm.tables import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Texts of no known language go, and texts whose best language has less than this share.
MIN_LANGUAGE_SCORE = 0.4


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; null texts and texts without a letter go."""
    net = language.train_on(docs, ~F.coalesce(language.held_out(), F.lit(False)))
    found = language.identify(docs, net)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line repeats; documents that lose their every line go."""
    found = lines.dedupe_lines(docs)
    return _counted(found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group that links of similarity join."""
    found = jaccard.jaccard_join(docs)
    gone = found.where("id <> class_id").select("id").distinct()
    return docs.join(gone, docs["doc_id"] == gone["id"], "left_anti").select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the kind of personal data in its place."""
    return _counted(pii.redact(pii.find_pii(docs, pii.train_on(docs))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    import public_tokenizers

    return packing.pack_ids(docs, packing.word_encoder(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language", keep_languages),
    ("lines", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

#: The trained stages and the byte-pair ids have no SQL; tests hold them against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
