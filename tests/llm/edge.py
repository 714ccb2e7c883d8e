"""A small table of awkward documents with columns whose names clash with the operators' own."""

import random

WORDS = "the of and red green stone river house paper light seven under walk quick north".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def awkward(spark):
    rng = random.Random(11)
    long = "\n".join(prose(rng, 60) for _ in range(300))
    plain = prose(rng, 120)
    rows = [
        (1, None, None, "s"),
        (2, "", "en", "s"),
        (3, " \n\t ", "en", None),
        (4, "one two three", "en", "s"),
        (5, "one two three", "de", "s"),
        (6, long, "en", "s"),
        (7, plain, "en", "hot"),
        (7, plain, "en", "hot"),
        (8, plain + " tail", "en", "hot"),
        (9, "日本語 é ñ ß", "xx", "hot"),
        (10, "12345 !!! ###", "en", "hot"),
        (None, plain, "en", "hot"),
    ]
    schema = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score string, "
        "lang_pred int, pii string, removed int, ids string, n_words string, n_lines string, component string, id string, k int"
    )
    return spark.createDataFrame([(*r, 0, "k", "s", 1, "p", 2, "i", "n", "l", "c", "x", 3) for r in rows], schema)


def empty(spark):
    return awkward(spark).limit(0)
