"""Byte-level BPE encoding and decoding with the ranks of a given vocabulary.

The words of a task are looked up in a table of the distinct words seen so far; a word that is new is
split by the vocabulary's pattern, and the pieces are folded pair by pair in the order of their ranks.
Decoding concatenates the bytes of the ids. Neither needs a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import sys
import types

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from heronry.llm.batches import map_texts

# White space as Unicode has it (``str.isspace`` also counts four control characters).
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Runs of white space with the run of other characters that follows. No match of the pattern goes on
# from other characters into white space, so each such stretch is split by itself.
STRETCH = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")
# Distinct words, and distinct pieces of words, that each of two generations remembers; and the longest ones
# that are remembered. An entry takes some 200 bytes.
REMEMBERED = 160_000
REMEMBERED_CHARS = 48
# Longer pieces are folded with a heap, whose time is nearly linear in the length.
SHORT_PIECE = 48

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """A rank file: a base64 token and its rank on each line. The size is that of the vocabulary."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


def fold(piece: bytes, ranks: Ranks) -> list[int]:
    """Ids of one piece: the adjacent pair of lowest rank is merged until no pair has a rank."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    if len(piece) > SHORT_PIECE:
        return _fold_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    get = ranks.get
    pair = [get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
    while pair and (least := min(pair)) < 1 << 60:
        i = pair.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i:
            pair[i - 1] = get(parts[i - 1] + parts[i], 1 << 60)
        if i < len(pair):
            pair[i] = get(parts[i] + parts[i + 1], 1 << 60)
    return [ranks[p] for p in parts]


def _fold_long(piece: bytes, ranks: Ranks) -> list[int]:
    """The same with a heap of pairs: (rank, begin, end); a pair counts only while both of its parts
    are still as they were when it was noted."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n))
    alive = [True] * n
    heap = []

    def note(i: int) -> None:
        if i >= 0 and end[i] < n:
            last = end[end[i]]
            rank = ranks.get(piece[i:last])
            if rank is not None:
                heapq.heappush(heap, (rank, i, last))

    for i in range(n - 1):
        note(i)
    while heap:
        _, i, last = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != last:
            continue
        alive[end[i]] = False
        end[i] = last
        if last < n:
            before[last] = i
        note(before[i])
        note(i)
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class Remembered:
    """What was made of distinct strings, in two generations: what is asked for again moves on into the
    young one, and the old one is forgotten when the young one is full. So frequent strings stay."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def older(self, key: str) -> bytes | None:
        """A string that the young generation lacks."""
        made = self.old.get(key)
        return self.add(key, made) if made is not None else None

    def add(self, key: str, made: bytes) -> bytes:
        if len(key) <= REMEMBERED_CHARS:
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[key] = made
        return made


class Encoder:
    """Encodes texts; remembers distinct words and pieces in tables of bounded size."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.words, self.pieces = Remembered(), Remembered()

    def _word(self, word: str) -> bytes:
        if (made := self.words.older(word)) is not None:
            return made
        known, make = self.pieces.young.get, self._piece
        made = b"".join([known(p) or make(p) for p in self.split.findall(word)])
        return self.words.add(word, made)

    def _piece(self, piece: str) -> bytes:
        if (made := self.pieces.older(piece)) is not None:
            return made
        return self.pieces.add(piece, np.array(fold(piece.encode(), self.ranks), "<u4").tobytes())

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known, make = self.words.young.get, self._word
        return b"".join([known(w) or make(w) for w in STRETCH.findall(text)])


def process_table() -> dict:
    """A table that lives as long as the worker process. The functions of this package travel by value, so
    what they keep in their own module is lost with each task."""
    return sys.modules.setdefault("_heronry_process", types.ModuleType("_heronry_process")).__dict__


class Tokenizer:
    """Encoding and decoding of text columns with a rank file's vocabulary."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.pattern = pattern
        # Its size is that of the vocabulary, whatever the documents.
        self.sent = spark.sparkContext.broadcast(read_ranks(path))

    def __getstate__(self):
        return {"pattern": self.pattern, "sent": self.sent}

    def encoder(self) -> Encoder:
        """The process's encoder: the next task on the same worker goes on with its tables. Only the one used
        last is kept."""
        if "_encoder" not in self.__dict__:
            ranks = self.sent.value
            kept = process_table().get("encoder")
            if kept is None or kept.split.pattern != self.pattern or kept.ranks != ranks:
                kept = process_table()["encoder"] = Encoder(ranks, self.pattern)
            self._encoder = kept
        return self._encoder

    def pieces(self) -> np.ndarray:
        """The bytes of each id."""
        if "_pieces" not in self.__dict__:
            table = np.empty(max(self.sent.value.values(), default=-1) + 1, object)
            for token, rank in self.sent.value.items():
                table[rank] = token
            self._pieces = table
        return self._pieces

    def _ids(self, texts: pa.Array) -> list[bytes]:
        encode = self.encoder().encode
        return [encode(t or "") for t in texts.to_pylist()]

    def _bytes(self, ids: list[bytes | None]) -> list[bytes]:
        table = self.pieces()
        return [b"".join(table[np.frombuffer(v or b"", "<u4")].tolist()) for v in ids]

    def encode(self, docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """Columns ``keep`` and ``ids``: the ids of each text as little-endian 32-bit integers in one
        binary value. Null and empty texts have no ids. Repeated rows are each encoded."""

        def add(piece: pa.RecordBatch) -> dict[str, object]:
            return {"ids": pa.array(self._ids(piece.column(text)), pa.binary())}

        return map_texts(docs, add, keep, f"{_typed(docs, keep)}, ids binary", text)

    def decode(self, rows: DataFrame, keep: list[str], ids: str = "ids") -> DataFrame:
        """Columns ``keep`` and ``decoded``: the bytes of the ids. An id that the vocabulary lacks is an
        error; null counts as no ids."""

        def add(piece: pa.RecordBatch) -> dict[str, object]:
            return {"decoded": pa.array(self._bytes(piece.column(ids).to_pylist()), pa.binary())}

        return map_texts(rows, add, keep, f"{_typed(rows, keep)}, decoded binary", ids)

    def round_trip(self, docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """Columns ``keep``, ``ids`` and ``decoded``: :meth:`encode` and :meth:`decode` in one pass, so that
        a task needs one Python process and not two."""

        def add(piece: pa.RecordBatch) -> dict[str, object]:
            ids = self._ids(piece.column(text))
            return {"ids": pa.array(ids, pa.binary()), "decoded": pa.array(self._bytes(ids), pa.binary())}

        return map_texts(docs, add, keep, f"{_typed(docs, keep)}, ids binary, decoded binary", text)


def _typed(df: DataFrame, columns: list[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return ", ".join(f"`{c}` {kinds[c]}" for c in columns)


def round_trip_digests(docs: DataFrame, tokenizer: Tokenizer, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip) of each row: the text is encoded and
    the ids are decoded again. ``round_trip`` tells whether the bytes came back unchanged. Rows with
    a null id are kept; a null text counts as empty; an empty table gives no rows."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("text_sha256", F.sha2("text", 256))
    both = tokenizer.round_trip(rows, ["doc_id", "text_sha256"])
    digest = F.sha2("decoded", 256)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        digest.alias("decoded_sha256"),
        (digest == F.col("text_sha256")).alias("round_trip"),
    )
