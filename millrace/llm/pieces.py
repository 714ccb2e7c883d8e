"""SentencePiece encoding and decoding with forward tables shared by common prefixes.

A text is cut into marked words: a piece never reaches over the start of a run of space
marks, nor over a line end if no piece holds one. The distinct words of a batch are sorted and
walked as a trie, depth first: a word keeps the forward table of the prefix it shares with the word
before, so each distinct prefix is worked on once.

For unigram models the table holds the best score and last piece of each prefix
(Viterbi). Models of merges (BPE) have no additive score: there the last piece of a prefix is the
one piece ending there that stays apart from the last piece before it when both are merged on
their own; the encoding of a text's prefix is a prefix of the text's encoding, so this gives the
merges' result exactly, again one entry per prefix.

Null and empty texts have no ids. Characters outside the vocabulary become byte
pieces. Decoding gives back every text that holds no space mark (U+2581) itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.buffers import text_chunks
from millrace.llm.registry import query, table
from millrace.llm.tables import extended

MARK = "▁"
#: Marks keys that take no space mark; no text holds a lone surrogate.
BARE = "\ud800"
CACHE_WORDS = 500_000
CACHE_PAIRS = 1_000_000
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
#: Unigram scores of characters outside the vocabulary lie this far below the lowest.
UNKNOWN_PENALTY = 10.0


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError("only models that keep the text as it is are supported")
        if train.model_type not in (UNIGRAM, BPE) or not train.byte_fallback:
            raise ValueError("only unigram and BPE models with byte pieces are supported")
        if any(p.type == USER for p in model.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        self.unigram = train.model_type == UNIGRAM
        self.prefix = norm.add_dummy_prefix
        kept = [(i, p) for i, p in enumerate(model.pieces) if p.type == NORMAL]
        self.ids = {p.piece: i for i, p in kept}
        self.scores = {p.piece: p.score for _, p in kept}
        #: Every beginning of a piece, and whether it is one.
        self.trie = {p.piece[:n]: False for _, p in kept for n in range(1, len(p.piece))}
        self.trie |= dict.fromkeys(self.ids, True)
        self.low = min(p.score for _, p in kept) - UNKNOWN_PENALTY
        self.byte_ids = [0] * 256
        self.raw = np.empty(len(model.pieces), object)
        for i, p in enumerate(model.pieces):
            self.raw[i] = p.piece.replace(MARK, " ").encode() if p.type == NORMAL else b""
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw[i] = bytes([value])
        inner = [p.piece for _, p in kept if len(p.piece) > 1]
        if any(MARK in p.lstrip(MARK) for p in inner):
            raise ValueError("pieces that hold a space mark after another character are not supported")
        self.packed: dict[str | int, bytes] = {k: np.array([i], "<u4").tobytes() for k, i in [*self.ids.items(), *enumerate(self.byte_ids)]}
        self.cuts_lines = not any("\n" in p for p in inner)
        self.apart: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}

    def stays_apart(self, left: str, right: str) -> bool:
        """Whether merging neighbours by score, leftmost first, ends with these two (or with the right one alone)."""
        found = self.apart.get((left, right))
        if found is None:
            if len(self.apart) >= CACHE_PAIRS:
                self.apart.clear()
            found = self.apart[left, right] = self.merges_to(left, right)
        return found

    def merges_to(self, left: str, right: str) -> bool:
        get, none = self.scores.get, -np.inf
        symbols, edge = list(left + right), len(left)
        pairs = [get(a + b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            at = pairs.index(best)
            if at == edge - 1:
                return False
            if at < edge:
                edge -= 1
            joined = symbols[at] = symbols[at] + symbols.pop(at + 1)
            del pairs[at]
            if at:
                pairs[at - 1] = get(symbols[at - 1] + joined, none)
            if at < len(pairs):
                pairs[at] = get(joined + symbols[at + 1], none)
        return len(symbols) == (2 if left else 1)

    def forward(self, words: list[str]) -> Iterator[list[str]]:
        """Pieces of each word; the words are sorted. Characters outside the vocabulary stand alone."""
        ids, scores, trie, apart = self.ids, self.scores, self.trie, self.apart
        last: list[str] = [""]
        best = [0.0]
        open_at: list[list[int]] = [[]]  # by prefix: where a piece that goes on may have started
        before = ""
        for word in words:
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], best[shared + 1 :], open_at[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                piece, value, found, going = word[end - 1], best[end - 1] + self.low, False, []
                for start in (*open_at[end - 1], end - 1):
                    part = word[start:end]
                    whole = trie.get(part)
                    if whole is None:
                        continue
                    going.append(start)
                    if not whole:
                        continue
                    if self.unigram:
                        if (total := best[start] + scores[part]) > value:
                            piece, value = part, total
                    elif not found:
                        previous = last[start]
                        if previous and previous not in ids:
                            previous = ""
                        found = apart.get((previous, part))
                        if found is None:
                            found = self.stays_apart(previous, part)
                        if found:
                            piece = part
                last.append(piece)
                best.append(value)
                open_at.append(going)
            out, end = [], len(word)
            while end:
                out.append(last[end])
                end -= len(last[end])
            out.reverse()
            yield out
            before = word

    def learn(self, keys: set[str]) -> None:
        """Encode new keys: a key without a leading line end is a word after a space mark."""
        marked = {}
        for key in keys:
            marked[key] = (key[0], key[1:]) if key[:1] == "\n" else ("", key if key[:1] == MARK else MARK + key)
        words = sorted({w for _, w in marked.values()})
        done: dict[str, bytes] = {}
        for word, pieces in zip(words, self.forward(words), strict=True):
            done[word] = self.to_ids(pieces)
        line_end = self.to_ids(["\n"])
        for key, (line, word) in marked.items():
            self.known[key] = (line_end if line else b"") + done[word]

    def to_ids(self, pieces: list[str]) -> bytes:
        """Bytes of the ids; a character outside the vocabulary gives its bytes' pieces."""
        known = self.packed
        return b"".join([known[p] if p in known else b"".join([known[b] for b in p.encode()]) for p in pieces])

    def keys(self, text: str) -> list[str]:
        """Marked words of a text, as ``learn`` takes them."""
        if not text:
            return []
        spaced = text.replace("\n", " \n") if self.cuts_lines else text
        if self.prefix and MARK not in text and "  " not in spaced and text[0] != " ":
            return spaced.split(" ")
        # Runs of marks: each word takes the marks before it.
        whole = (MARK if self.prefix else "") + text.replace(" ", MARK)
        out: list[str] = []
        for n, line in enumerate(whole.split("\n") if self.cuts_lines else [whole]):
            start = 0
            words = []
            for i in range(1, len(line)):
                if line[i] == MARK and line[i - 1] != MARK:
                    words.append(line[start:i])
                    start = i
            words.append(line[start:])
            for k, word in enumerate(words):
                if n and k == 0:
                    # The line end comes first; a word without marks follows it directly.
                    out += ["\n", word] if word[:1] == MARK else ["\n" + word]
                elif word:
                    out.append(word if word[0] == MARK else BARE + word)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        split = [self.keys(t) for t in texts]
        new = {k for keys in split for k in keys} - self.known.keys()
        bare = {k for k in new if k[:1] == BARE}
        self.learn(new - bare)
        for k, pieces in zip(order := sorted(bare), self.forward([k[1:] for k in order]), strict=True):
            self.known[k] = self.to_ids(pieces)
        return [b"".join(map(self.known.__getitem__, keys)) for keys in split]

    def decode(self, ids: bytes) -> str:
        out = b"".join(self.raw[np.frombuffer(ids, "<u4")].tolist())
        text = out.decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


def encode_table(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns, with ``ids`` (binary, little-endian unsigned 32 bit) appended or replaced."""
    base = df.drop("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            ids: list[bytes] = []
            for _, _, data, offsets in text_chunks(batch, text):
                ids += pieces.encode([data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:], strict=False)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], [*batch.schema.names, "ids"])

    return base.mapInArrow(run, extended(base, ("ids", "binary")))


def decode_table(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns, with the text of the ids appended or replaced; null ids give an empty text."""
    base = df.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            decoded = [pieces.decode(v.as_py() or b"") for v in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], [*batch.schema.names, text])

    return base.mapInArrow(run, extended(base, (text, "string")))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op2_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and CRC-32 of its ids, and whether decoding them gives the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode_table(encode_table(docs, model_path()), model_path())
    return both.selectExpr(
        "doc_id",
        "cast(octet_length(ids) / 4 as bigint) as n_ids",
        "crc32(ids) as ids_crc32",
        "coalesce(text, '') = decoded as round_trip",
    )

