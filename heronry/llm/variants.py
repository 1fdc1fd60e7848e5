"""Spelling variants: words at edit distance one, found with an index of variable-length grams.

A dictionary of grams is pruned by frequency: a gram of two or three characters that is frequent among the
words gives way to the longer ones that it begins. Each word, with marks at its ends, is decomposed into the
longest grams of the dictionary, leaving out those that lie within an earlier one. Which grams an edit can
change depends on the characters that decided on them, so each word has a bound of its own: the most grams that
any single edit affects. Two near words therefore share a gram among the rarest of each, one more than its
bound, at like places. The lists of these grams are merged by an equi-join; a pair in which either word
misses more grams of the other than its bound allows is dropped, and the rest is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from heronry.llm.batches import LOWER, PIECE_BYTES, bounded_batches, pieces, utf8
from heronry.session import materialize

# Words that take part have so many code points and occurrences.
LEAST_LENGTH, LEAST_COUNT = 5, 3
# One run in so many is misspelt on purpose, by the hash of its document and itself.
MISSPELT = 97
# A word's form occurs at least so many times as often.
FORM_RATIO = 2

SHORTEST, LONGEST = 2, 4
# Marks at each end: with them, an edit leaves the first or the last gram of a word of five characters.
MARKS = LONGEST - SHORTEST
# A gram is frequent above 1 / so many of all places in words, so at most so many of one length are.
FREQUENT = 32_768
# Buckets in which the occurrences of grams are added up, to order them by rarity.
RARITY_BITS = 18
# Distinct words and grams that a task counts before it hands them on.
COUNTED = 300_000

RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
GAP = re.compile("[^a-zÀ-ÿ]")


def lowered(text: bytes) -> Iterator[str]:
    """The text with A-Z lower-cased, in parts of about ``PIECE_BYTES`` that cut no run."""
    whole = text.translate(LOWER).decode()
    at = 0
    while len(whole) - at > PIECE_BYTES:
        gap = GAP.search(whole, at + PIECE_BYTES)
        cut = gap.start() if gap else len(whole)
        yield whole[at:cut]
        at = cut
    yield whole[at:]


def _counted(counts: Counter, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
        names=[name, "n"],
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()
    for piece in pieces(batches, "text"):
        for doc, text in zip(piece.column("doc_id").to_pylist(), utf8(piece.column("text"))):
            # The hash of ``<doc_id>:`` goes on with each run.
            start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for part in lowered(text):
                runs = RUN.findall(part)
                total.update(runs)
                for run in set(runs):
                    h = zlib.crc32(run.encode(), start)
                    if h % MISSPELT == 0:
                        at, n = h % len(run), runs.count(run)
                        total[run] -= n
                        if len(run) > LEAST_LENGTH:
                            total[run[:at] + run[at + 1 :]] += n
                if len(total) >= COUNTED:
                    yield _counted(total, "word")
                    total.clear()
    yield _counted(total, "word")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words that take part and their occurrences in all rows.

    A word is a run of letters with A-Z lower-cased. A run whose CRC-32, together with the id of its row, is
    divisible by ``MISSPELT`` has lost a code point. Null and empty texts have no words, a null id counts as an
    empty one, and repeated rows are each counted.
    """
    return (
        bounded_batches(docs)
        .select(F.col(id_col).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))
        .mapInArrow(_count_words, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


def marked(word: str) -> str:
    return "^" * MARKS + word + "$" * MARKS


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            s = marked(word)
            for size in range(SHORTEST, LONGEST + 1):
                total.update([s[i : i + size] for i in range(len(s) - size + 1)])
            if len(total) >= COUNTED:
                yield _counted(total, "gram")
                total.clear()
    yield _counted(total, "gram")


def gram_hash(gram: str) -> int:
    return xxhash.xxh64_intdigest(gram.encode(), 42)


class Grams:
    """The pruned dictionary: the grams that are extended, and how often the grams of a bucket occur."""

    def __init__(self, extended: frozenset[str], occurrences: np.ndarray):
        self.extended, self.occurrences = extended, occurrences

    def decompose(self, word: str) -> list[tuple[int, str]]:
        """(place, gram) of the marked word: at each place the longest gram of the dictionary, without those
        that end no later than an earlier one."""
        s, found, last = marked(word), [], 0
        for p in range(len(s) - SHORTEST + 1):
            size = SHORTEST
            while size < LONGEST and p + size < len(s) and s[p : p + size] in self.extended:
                size += 1
            if p + size > last:
                found.append((p, s[p : p + size]))
                last = p + size
        return found

    @staticmethod
    def affected(word: str, grams: list[tuple[int, str]]) -> int:
        """The most grams that one inserted, deleted or replaced character can change.

        A gram at p with so many characters was decided by these and, as an earlier gram could have covered it,
        by those from the place where the longest such gram begins. What lies wholly on one side of an edit
        stays as it is; an insertion changes no more than a replacement beside it.
        """
        spans = [(p + len(g) - LONGEST, p + len(g) - 1) for p, g in grams]
        changed = range(MARKS, MARKS + len(word))
        return max(sum(first <= i <= last for first, last in spans) for i in changed)


def gram_dictionary(words: DataFrame) -> Grams:
    """Counts of all words' grams; what comes to the driver has a fixed greatest size."""
    grams = materialize(
        words.mapInArrow(_count_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")),
        "grams",
    )
    short = grams.where(F.length("gram") < LONGEST)
    places = grams.where(F.length("gram") == SHORTEST).agg(F.sum("n")).first()[0] or 0
    frequent = short.where(F.col("n") * FREQUENT > places).select("gram").toArrow()["gram"].to_pylist()
    bucket = F.xxhash64("gram").bitwiseAND(F.lit((1 << RARITY_BITS) - 1))
    sums = grams.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).toArrow()
    occurrences = np.zeros(1 << RARITY_BITS, np.int64)
    occurrences[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return Grams(frozenset(frequent), occurrences)


def _decomposed(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(*sent.value)
        mask = (1 << RARITY_BITS) - 1
        known: defaultdict[str, tuple[int, int]] = defaultdict()

        def order(gram: str) -> tuple[int, int]:
            if gram not in known:
                if len(known) >= COUNTED:
                    known.clear()
                h = gram_hash(gram)
                known[gram] = (int(grams.occurrences[h & mask]), h)
            return known[gram]

        for batch in batches:
            lengths, bounds, signatures, prefixes = [], [], [], []
            for word in batch.column("word").to_pylist():
                found = grams.decompose(word)
                bound = grams.affected(word, found)
                ranks = {g: order(g) for _, g in found}
                # One gram more than an edit can change, the rarest first; any order common to all words is right.
                prefix = set(sorted(ranks, key=ranks.get)[: bound + 1])
                signature = 0
                for _, h in ranks.values():
                    signature |= 1 << (h >> 58)
                lengths.append(len(word))
                bounds.append(bound)
                signatures.append(signature - (1 << 64) if signature >> 63 else signature)
                prefixes.append(
                    [{"gram": _signed(ranks[g][1]), "place": p} for p, g in found if g in prefix]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word"),
                    batch.column("n"),
                    pa.array(lengths, pa.int32()),
                    pa.array(bounds, pa.int32()),
                    pa.array(signatures, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.struct([("gram", pa.int64()), ("place", pa.int32())]))),
                ],
                names=["word", "n", "length", "bound", "signature", "prefix"],
            )

    return run


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


_DECOMPOSED = (
    "word string, n long, length int, bound int, signature long, prefix array<struct<gram: long, place: int>>"
)


def _listed(rows: DataFrame, name: str, places: list[Column]) -> DataFrame:
    """Each row under the keys of its rarest grams: (gram, place, length of the word that is looked for)."""
    columns = ["word", "n", "length", "bound", "signature"]
    return (
        rows.withColumn("g", F.explode("prefix"))
        .withColumn("at", F.explode(F.array(*places)))
        .select(
            F.xxhash64("g.gram", "at.place", "at.length").alias("key"),
            *[F.col(c).alias(f"{name}_{c}") for c in columns],
        )
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): for each word of ``words`` (word, n), the others that differ from it by exactly one
    inserted, deleted or replaced code point; every pair in both directions. Words must be distinct and have
    ``LEAST_LENGTH`` code points at least."""
    grams = gram_dictionary(words)
    sent = words.sparkSession.sparkContext.broadcast((grams.extended, grams.occurrences))
    rows = materialize(bounded_batches(words).mapInArrow(_decomposed(sent), _DECOMPOSED), "decomposed")

    def at(shift: int, longer: int) -> Column:
        return F.struct(
            (F.col("g.place") + shift).alias("place"), (F.col("length") + longer).alias("length")
        )

    # Behind an edit that makes a word longer, its grams stand one place later.
    shorter = _listed(rows, "a", [at(0, 0), at(0, 1), at(1, 1)])
    longer = _listed(rows, "b", [at(0, 0)])
    # Each bit that one word has and the other lacks is a gram that it misses. The cheapest tests come first.
    bounded = (F.expr("bit_count(a_signature & ~b_signature)") <= F.col("a_bound")) & (
        F.expr("bit_count(b_signature & ~a_signature)") <= F.col("b_bound")
    )
    # One edit leaves the first or the second half of the shorter word as it is.
    half = F.expr("a_length div 2").cast("int")
    alike = F.startswith("b_word", F.substring("a_word", F.lit(1), half)) | F.endswith(
        "b_word", F.substring("a_word", half + 1, F.col("a_length"))
    )
    once = (F.col("a_length") < F.col("b_length")) | (F.col("a_word") < F.col("b_word"))
    pairs = (
        shorter.join(longer, "key")
        .where(bounded & alike & once & (F.levenshtein("a_word", "b_word", 1) == 1))
        .select("a_word", "a_n", "b_word", "b_n")
        .distinct()
    )
    both = F.explode(
        F.array(
            F.struct(F.col("a_word").alias("word"), F.col("b_word").alias("near"), F.col("b_n").alias("near_n")),
            F.struct(F.col("b_word").alias("word"), F.col("a_word").alias("near"), F.col("a_n").alias("near_n")),
        )
    )
    return pairs.select(both.alias("pair")).select("pair.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain word, form, form of the form, ... Each round doubles the steps that
    are followed; a form occurs twice as often as its word, so chains are short and end."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(
            now.join(further, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        now = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word with ``LEAST_COUNT`` occurrences in the texts.

    ``n_near`` counts the words at edit distance one. ``form`` is the commonest of them, of equally common ones
    the first in code-point order, if it occurs ``FORM_RATIO`` times as often as the word, else null; ``form_n``
    are its occurrences. ``root`` is the end of the chain of forms, the word itself where it has no form. What
    counts as a word, and nulls, empty texts and repeated rows: see :func:`word_counts`. Other columns are not
    read. An empty table gives no rows.
    """
    words = materialize(word_counts(docs, id_col, text), "words")
    nearest = (
        near_words(words)
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
        )
    )
    common = -F.col("best.less") >= FORM_RATIO * F.col("n")
    rows = materialize(
        words.join(nearest, "word", "left").select(
            "word",
            F.when(common, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
