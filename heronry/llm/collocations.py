"""Collocations of two to four words, counted by a multikey quicksort of suffix pointers.

A suffix is a place in a piece of text with the (at most four) words that begin there. Two passes read the
texts. The first counts single words and finds the word pairs and triples with so many suffixes that one task
should not hold them. The second routes every suffix by its leading words, so that all suffixes that share
them meet in one task, whatever document they are from. There the pointers are sorted by a three-way multikey
quicksort down to four words: the size of each equal partition is the count of a phrase, and a partition
with fewer suffixes than a phrase needs is abandoned unsorted.

What stays in memory is bounded: a task holds ``FLUSH_TOKENS`` words of text, a bucket of the second pass
about ``BUCKET_SUFFIXES`` suffixes, and the tables sent to the tasks have a fixed greatest size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from heronry.llm.batches import PIECE_BYTES, bounded_batches, pieces, utf8
from heronry.session import materialize

LONGEST = 4
LEAST = 30
# Percent of a phrase's occurrences that lie within a longer one, from which it is dropped.
COVERED = 80
TOP = 2000
SCALE = 2_000_000
# The language of rows without one.
UNKNOWN = "und"

# Words that a task holds before it hands on what it has, and distinct words that it remembers.
FLUSH_TOKENS = 4_000_000
REMEMBERED = 400_000
# Suffixes that a bucket should have. Leading words with more than half of that are routed by one more word.
BUCKET_SUFFIXES = 500_000
# Share of a task's suffixes that leading words must have to be reported as frequent. At most 1 / ``SHARE`` of
# them can have it, which bounds the set sent to all tasks.
SHARE = 1 / 65_536
# Bits of the table that tells which words may be frequent.
WORD_BITS = 24

# A-Z lower-cased, every character that ends a piece a full stop.
PIECES = bytes(
    b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256)
)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def slices(text: bytes) -> Iterator[bytes]:
    """A text, with the characters of :data:`PIECES`, in parts of about ``PIECE_BYTES`` that end where a word
    ends."""
    text = text.translate(PIECES)
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = max(text.rfind(b, at, at + PIECE_BYTES) for b in (b" ", b"."))
        if cut <= at:
            after = [p for p in (text.find(b, at + PIECE_BYTES) for b in (b" ", b".")) if p > 0]
            cut = min(after, default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


class Words:
    """The words of one language as numbers in the order of their first occurrence; 0 ends a piece."""

    def __init__(self, lang: str):
        self.lang, self.seed = lang, xxhash.xxh64_intdigest(lang.encode(), 42)
        self.parts: list[np.ndarray] = []
        self.held = 0
        # Words in front that were handed on already and only go on here.
        self.known = 0
        self._reset()

    def _reset(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[b"."]

    def add(self, text: bytes) -> None:
        for part in slices(text):
            self._append(part.replace(b".", b" . ").split())
        self._append([b"."])

    def _append(self, tokens: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)))
        self.held += len(tokens)

    def take(self, last: bool) -> tuple[np.ndarray, int, list[bytes]]:
        """All numbers held, how many of the first were handed on before, and the words. The last three go on
        into the next call, with which their suffixes are complete, unless this is the last one."""
        ends = [np.zeros(LONGEST - 1, np.int32)] if last else []
        numbers, known, words = np.concatenate([*self.parts, *ends]), self.known, list(self.numbers)
        self.parts, self.held, self.known = [], 0, 0
        if not last:
            tail = [words[i] for i in numbers[-(LONGEST - 1) :]]
            if len(self.numbers) > REMEMBERED:
                self._reset()
            self._append(tail)
            self.known, self.held = len(tail), 0
        return numbers, known, words

    def hashes(self, words: list[bytes]) -> np.ndarray:
        digest, seed = xxhash.xxh64_intdigest, self.seed
        return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def streams(batches, work) -> Iterator[pa.RecordBatch]:
    """Runs ``work(words, last)`` on the words of each language, whenever a task holds enough of them and at
    its end."""
    by_lang: dict[str, Words] = {}
    for batch in batches:
        for piece in pieces([batch], "text"):
            for lang, text in zip(piece.column("lang").to_pylist(), utf8(piece.column("text"))):
                if text:
                    if lang not in by_lang:
                        by_lang[lang] = Words(lang)
                    by_lang[lang].add(text)
            if sum(w.held for w in by_lang.values()) >= FLUSH_TOKENS:
                for words in by_lang.values():
                    if words.held:
                        yield from work(words, False)
    for words in by_lang.values():
        yield from work(words, True)


def suffixes(numbers: np.ndarray) -> list[np.ndarray]:
    """Four columns: the words of every suffix that has two at least, 0 behind the end of its piece."""
    n = len(numbers) - LONGEST + 1
    if n <= 0:
        return [numbers[:0]] * LONGEST
    places = np.flatnonzero((numbers[:n] != 0) & (numbers[1 : n + 1] != 0))
    columns = [numbers[places + i] for i in range(LONGEST)]
    for i in range(3, LONGEST):
        columns[i] = np.where(columns[i - 1] == 0, 0, columns[i])
    return columns


def _mixed(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * _ODD


def leading_hashes(columns: list[np.ndarray], hashes: np.ndarray) -> Iterator[np.ndarray]:
    """64-bit hashes of the first two, three, ... words of each suffix."""
    h = _mixed(hashes[columns[0]])
    for column in columns[1:]:
        h = _mixed(h + hashes[column])
        yield h


_FIRST = "lang string, kind int, word string, hash long, n long"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 1: words and their counts; of kind 2 and 3: hashes of so many leading words that have many
    suffixes, and how many; of kind 0: the number of suffixes."""
    # By language: counts of the words of the dictionary in use, and that dictionary.
    counted: dict[str, tuple[np.ndarray, list[bytes]]] = {}

    def rows(lang, kind, words, hashes, n):
        size = len(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * size, pa.string()),
                pa.array(np.full(size, kind, np.int32)),
                pa.array(words if words is not None else [""] * size, pa.binary()).cast(pa.string())
                if words is not None
                else pa.nulls(size, pa.string()),
                pa.array(hashes) if hashes is not None else pa.nulls(size, pa.int64()),
                pa.array(np.asarray(n, np.int64)),
            ],
            names=["lang", "kind", "word", "hash", "n"],
        )

    def emit(lang: str) -> Iterator[pa.RecordBatch]:
        n, words = counted.pop(lang)
        # The full stop that ends a piece is no word.
        found = np.flatnonzero(n[1:]) + 1
        for at in range(0, len(found), 50_000):
            part = found[at : at + 50_000]
            yield from rows(lang, 1, [words[i] for i in part.tolist()], None, n[part])

    def work(held: Words, last: bool) -> Iterator[pa.RecordBatch]:
        lang, before = held.lang, len(held.numbers)
        numbers, known, words = held.take(last)
        n = np.bincount(numbers[known:], minlength=len(words))
        if lang in counted:
            old = counted[lang][0]
            n[: len(old)] += old
        counted[lang] = (n, words)
        if last or len(held.numbers) < before:
            yield from emit(lang)
        columns = suffixes(numbers)
        size = len(columns[0])
        if not size:
            return
        yield from rows(lang, 0, None, None, [size])
        hashes = held.hashes(words)
        least = max(2, size * SHARE)
        many = None
        for kind, h in zip((2, 3), leading_hashes(columns, hashes)):
            if many is not None:
                h = h[many]
            order = np.sort(h)
            firsts = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
            lengths = np.diff(np.append(firsts, len(order)))
            kept = lengths >= least
            found = order[firsts[kept]]
            yield from rows(lang, kind, None, found.view(np.int64), lengths[kept])
            if not len(found):
                return
            # Three words are frequent only where the first two are.
            at = np.minimum(np.searchsorted(found, h), len(found) - 1)
            many = found[at] == h

    yield from streams(batches, work)


class Router:
    """Which bucket a suffix goes to, and how many of its leading words decide that."""

    def __init__(self, buckets: int, hot: dict[int, np.ndarray], frequent: np.ndarray):
        # Sorted hashes of two and of three leading words that are routed by one more.
        self.buckets, self.hot, self.frequent = buckets, hot, frequent

    def may_be_frequent(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64((1 << WORD_BITS) - 1)
        return (self.frequent[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7))) & 1 == 1

    def route(self, columns: list[np.ndarray], hashes: np.ndarray):
        """(bucket, depth, hash of all words) of each suffix."""
        by_two, by_three, by_four = leading_hashes(columns, hashes)
        depth = np.full(len(by_two), 2, np.int64)
        used = by_two
        for words, h, deeper in ((2, by_two, by_three), (3, by_three, by_four)):
            found = self.hot[words]
            if len(found) and len(h):
                at = np.minimum(np.searchsorted(found, h), len(found) - 1)
                more = (found[at] == h) & (depth == words)
                depth[more] = words + 1
                used = np.where(more, deeper, used)
        bucket = (used >> np.uint64(24)) % np.uint64(self.buckets)
        return bucket.astype(np.int64), depth, by_four


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


_ROUTED = "bucket int, lang string, depth int, words binary, ids binary, weights binary"


def _route(sent):
    """Sends the suffixes of each language on, equal ones of a task once with their number, packed by bucket:
    the words in use, four numbers of words for each suffix, and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = Router(*sent.value)

        def work(held: Words, last: bool) -> Iterator[pa.RecordBatch]:
            numbers, _, words = held.take(last)
            hashes = held.hashes(words)
            frequent = router.may_be_frequent(hashes)
            # A word that is surely infrequent ends phrases as the end of a piece does.
            frequent[0] = False
            columns = suffixes(np.where(frequent[numbers], numbers, 0))
            bucket, depth, h = router.route(columns, hashes)
            key = ((depth - 2) * router.buckets + bucket).astype(np.uint64) << np.uint64(38)
            order = np.argsort(key | (h >> np.uint64(26)))
            columns = [c[order] for c in columns]
            key = (key[order] >> np.uint64(38)).astype(np.int64)
            differ = key[1:] != key[:-1]
            for c in columns:
                differ |= c[1:] != c[:-1]
            firsts = np.flatnonzero(np.concatenate([[True], differ])) if len(key) else key
            weights = np.diff(np.append(firsts, len(key)))
            rows, key = np.stack([c[firsts] for c in columns], axis=1), key[firsts]
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
            seen, place = np.zeros(len(words), bool), np.zeros(len(words), np.int64)
            made: list[tuple] = []
            for first, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)]):
                ids, n = rows[first:end], weights[first:end]
                seen[ids] = True
                seen[0] = True
                used = np.flatnonzero(seen)
                seen[used] = False
                place[used] = np.arange(len(used))
                narrow = "<u2" if len(used) <= 1 << 16 else "<u4"
                made.append(
                    (
                        int(key[first]) % router.buckets,
                        held.lang,
                        int(key[first]) // router.buckets + 2,
                        _packed(b" ".join([words[i] for i in used[1:].tolist()])),
                        _packed(place[ids].astype(narrow).tobytes()),
                        b"" if (n == 1).all() else _packed(n.astype("<u4").tobytes()),
                    )
                )
                if len(made) >= 64:
                    yield _routed(made)
                    made = []
            if made:
                yield _routed(made)

        yield from streams(batches, work)

    return run


def _routed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "lang", "depth", "words", "ids", "weights"]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names
    )


def multikey_counts(
    columns: list[np.ndarray], weights: np.ndarray, least: int, depth: int
) -> Iterator[tuple[int, int, int]]:
    """(a suffix, words, count) of every phrase of two words or more that ``least`` suffixes begin with.

    A stack holds partitions of pointers that agree in their first words. Each is split by the next word into
    smaller, equal and greater than the median of three; the equal ones go on with the word after. Partitions
    that cannot reach ``least`` are abandoned, except where phrases of fewer than ``depth`` words are counted:
    other buckets have suffixes with the same leading words, so every count of those is given. A single word is
    no phrase, so with a ``depth`` of two nothing is excepted.
    """
    single = bool((weights == 1).all())
    stack = [(np.arange(len(weights)), 0)]
    while stack:
        pointers, at = stack.pop()
        needed = least if max(at + 1, 2) >= depth else 1
        keys = columns[at][pointers]
        n = len(keys)
        pivot = sorted((int(keys[0]), int(keys[n // 2]), int(keys[-1])))[1]
        smaller, equal = keys < pivot, keys == pivot
        for side in (smaller, ~(smaller | equal)):
            part = pointers[side]
            if len(part) and (len(part) if single else int(weights[part].sum())) >= needed:
                stack.append((part, at))
        part = pointers[equal]
        size = len(part) if single else int(weights[part].sum())
        # Word 0 is the end of a piece: no phrase goes on there.
        if pivot and size >= needed:
            if at:
                yield int(part[0]), at + 1, size
            if at + 1 < len(columns):
                stack.append((part, at + 1))


def _count_phrases(least: int):
    """Counts the phrases of each bucket; the rows come sorted by bucket, language and depth."""

    def bucket(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        numbers[b""]
        parts, weights = [], []
        for row in rows:
            words = _unpacked(row["words"]).split(b" ")
            known = np.fromiter(map(numbers.__getitem__, [b"", *words]), np.int32, len(words) + 1)
            ids = np.frombuffer(_unpacked(row["ids"]), "<u2" if len(known) <= 1 << 16 else "<u4")
            parts.append(known[ids].reshape(-1, LONGEST))
            n = np.frombuffer(_unpacked(row["weights"]), "<u4") if row["weights"] else None
            weights.append(np.ones(len(parts[-1]), np.int64) if n is None else n.astype(np.int64))
        columns = list(np.concatenate(parts).T.copy())
        words = list(numbers)
        phrases, sizes, counts = [], [], []
        for place, size, n in multikey_counts(columns, np.concatenate(weights), least, rows[0]["depth"]):
            phrases.append(b" ".join([words[c[place]] for c in columns[:size]]))
            sizes.append(size)
            counts.append(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[0]["lang"]] * len(phrases), pa.string()),
                pa.array(phrases, pa.binary()).cast(pa.string()),
                pa.array(sizes, pa.int32()),
                pa.array(counts, pa.int64()),
            ],
            names=["lang", "phrase", "words", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                same = ("bucket", "lang", "depth")
                if held and any(held[0][c] != row[c] for c in same):
                    yield from bucket(held)
                    held = []
                held.append(row)
        if held:
            yield from bucket(held)

    return run


def _frequent_words(words: DataFrame) -> np.ndarray:
    """A table of bits with a one for the hash of every word in ``words``; it has ``2 ** WORD_BITS`` bits however
    many words there are, and tells more words frequent than are where they are many."""
    words = words.select(F.expr(f"xxhash64(lang, word) & {(1 << WORD_BITS) - 1}").alias("at"))
    bits = (
        words.select(F.expr("at div 32").alias("place"), F.expr("shiftleft(1L, int(at % 32))").alias("bit"))
        .groupBy("place")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    made = np.zeros(1 << (WORD_BITS - 5), "<u4")
    made[bits["place"].to_numpy()] = bits["bits"].to_numpy().astype("<u4")
    return made.view(np.uint8)


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, lang: str = "lang", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of every phrase of one to four words that occurs ``least`` times in the
    texts of a language, and (lang, total): the number of words of each language.

    Rows without a language are one of their own, ``und``; null and empty texts have no words. Repeated rows
    are each counted. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = bounded_batches(docs).select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    first = materialize(
        rows.mapInArrow(_count_words, _FIRST)
        .groupBy("lang", "kind", "word", "hash")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    words = first.where((F.col("kind") == 1) & (F.col("n") >= least)).select("lang", "word", "n")
    total = first.where(F.col("kind") == 0).agg(F.sum("n")).first()[0] or 0
    many = max(BUCKET_SUFFIXES // 2, total * SHARE)
    # At most 2 / SHARE rows: each stands for a share of that size at least.
    hot = first.where(F.col("kind").isin(2, 3) & (F.col("n") >= many)).select("kind", "hash").toArrow()
    kinds, hashes = hot["kind"].to_numpy(), hot["hash"].to_numpy().view(np.uint64)
    by_words = {k: np.sort(hashes[kinds == k]) for k in (2, 3)}
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * width, -(-total // BUCKET_SUFFIXES))
    sent = spark.sparkContext.broadcast((buckets, by_words, _frequent_words(words)))
    counted = (
        rows.mapInArrow(_route(sent), _ROUTED)
        .repartition(width, "bucket")
        .sortWithinPartitions("bucket", "lang", "depth")
        .mapInArrow(_count_phrases(least), "lang string, phrase string, words int, n long")
        .groupBy("lang", "phrase", "words")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )
    phrases = materialize(
        counted.unionByName(words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")),
        "phrases",
    )
    totals = first.where(F.col("kind") == 1).groupBy("lang").agg(F.sum("n").alias("total"))
    return phrases, totals


def _slice(begin: Column, size: Column) -> Column:
    return F.array_join(F.slice("parts", begin, size), " ")


def _scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, score, l, r): each phrase of two words or more at its weakest cut."""
    cuts = (
        phrases.where(F.col("words") >= 2)
        .select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("parts"))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .select(
            "lang",
            "phrase",
            "words",
            "a",
            "k",
            _slice(F.lit(1), F.col("k")).alias("first"),
            _slice(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
        )
    )
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    # Products of 64-bit numbers need decimals.
    score = F.expr(f"cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0))")
    return (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumn("score", score.cast("long"))
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.score", "cut.l", "cut.r")
    )


def _covered(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longest): the largest count of a longer phrase that contains ``phrase``."""
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1), lambda begin: _slice(begin, size)
            ),
        )
    )
    return (
        phrases.where(F.col("words") >= 3)
        .withColumn("parts", F.split("phrase", " "))
        .select("lang", "n", F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longest"))
    )


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of each language.

    Candidates are the phrases of two to four words that occur ``a`` >= ``least`` times within pieces of text.
    Each is cut where its score, twice its count as a share of both parts' counts ``l`` and ``r`` together, in
    millionths and rounded down, is lowest (of equal ones, after the fewest words). Candidates
    that lie in a longer one at least ``COVERED`` percent of the time are dropped. Ranks go by score, count and
    then phrase in byte order, so there are no ties. ``n`` is the number of words of the language. Nulls, empty
    texts and repeated rows: see :func:`frequent_phrases`.
    """
    phrases, totals = frequent_phrases(docs, least, lang, text)
    covered = F.coalesce(100 * F.col("longest") >= COVERED * F.col("a"), F.lit(False))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        _scored(phrases)
        .join(_covered(phrases), ["lang", "phrase"], "left")
        .where(~covered)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select(
            "lang",
            F.col("rank").cast("long").alias("rank"),
            "phrase",
            "a",
            "l",
            "r",
            F.col("total").alias("n"),
            "score",
        )
    )
