"""Benchmark decontamination with suffix arrays over the training texts.

Each piece of documents that a task reads becomes a suffix array over its words. Every suffix of every
benchmark item is looked up in it by binary search; the range that agrees in a window's length gives
all places where the window occurs. From each of these places the words are followed in a suffix array
over the benchmark, which gives the longest verbatim matches. Documents are never shuffled. The benchmark is sent to the tasks in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heronry.llm.batches import WORDS, bounded_batches, map_texts, pieces, utf8

WINDOW_WORDS = 10
# Bytes of benchmark text in a broadcast block; a larger benchmark is sent in several.
BLOCK_BYTES = 8 << 20

SCHEMA = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
    "contaminated boolean, longest_words long, longest_item string, longest_at long"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def _numbers(texts: list[list[bytes]], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, each followed by a 0, and where each text begins."""
    numbers = []
    for found in texts:
        numbers.append(np.fromiter(map(vocabulary.get, found, (0,) * len(found)), np.int64, len(found)))
        numbers.append(np.zeros(1, np.int64))
    joined = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
    return joined, np.cumsum([0, *(len(found) + 1 for found in texts)])


class Queries:
    """The suffixes of a block of benchmark items, sorted, and which of them begin a window."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        # Items are numbered in the order of their names.
        items = sorted(items)
        texts = [words_of(t) for _, t in items]
        self.names, self.width = [name for name, _ in items], width
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.bits = max(1, len(self.vocabulary).bit_length())
        numbers, starts = _numbers(texts, self.vocabulary)
        self.array = SuffixArray(numbers, self.bits, max(map(len, texts), default=0))
        self.item_of = np.searchsorted(starts, self.array.order, side="right") - 1
        length = np.minimum(width, (np.diff(starts) - 1)[self.item_of])
        fits = self.array.order + length < starts[self.item_of + 1]
        # Windows in sorted order, so that equal ones, which are searched once, are neighbours.
        at, length, self.item = self.array.order[fits], length[fits], self.item_of[fits]
        new = np.ones(len(at), bool)
        new[1:] = np.diff(length) != 0
        for deep in range(0, width, self.array.per_key):
            new[1:] |= np.diff(self.array.prefix(at, deep, length)[0]) != 0
        first = np.flatnonzero(new)
        self.at, self.length = at[first], length[first]
        # The items of window k are ``item[begin[k] : begin[k + 1]]``.
        self.begin = np.append(first, len(at))


class Blocks:
    """Benchmark items in blocks, each a broadcast of bounded size."""

    def __init__(self, benchmark: DataFrame, item_col: str, text: str, width: int):
        context, self.width = benchmark.sparkSession.sparkContext, width
        rows = benchmark.select(
            F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        )
        self.sent, block, size = [], [], 0
        # One partition at a time comes to the driver, and one block at a time is held there.
        for row in rows.toLocalIterator():
            item = (row["item"], row["text"].encode())
            if block and size + len(item[1]) > BLOCK_BYTES:
                self.sent.append(context.broadcast(block))
                block, size = [], 0
            block.append(item)
            size += len(item[1])
        self.sent.append(context.broadcast(block))
        self._prepared: Queries | None = None

    def __getstate__(self):
        return {"sent": self.sent, "width": self.width, "_prepared": None}

    def __iter__(self) -> Iterator[Queries]:
        if len(self.sent) > 1:
            for block in self.sent:
                yield Queries(block.value, self.width)
                # Loaded again when needed, so that a task holds one block at a time.
                block.__dict__.pop("_value", None)
            return
        if self._prepared is None:
            self._prepared = Queries(self.sent[0].value, self.width)
        yield self._prepared


class SuffixArray:
    """Positions of a sequence of word numbers, sorted by the words that follow, at least up to a depth.

    0 stands for a word that no query has, or the end of a text, and starts no suffix; what comes behind a 0
    does not matter. Several words are packed into one integer key; suffixes that agree in it are sorted by
    the rank of what follows, twice as deep each time.
    """

    def __init__(self, numbers: np.ndarray, bits: int, depth: int):
        self.per_key = 62 // bits
        self.bits = bits
        self.keys = self._packed(numbers)
        self.n = len(numbers)
        order = np.flatnonzero(numbers)
        key = self.keys[order]
        sorted_by = np.argsort(key, kind="stable")
        order, key = order[sorted_by], key[sorted_by]
        group = np.concatenate([[0], np.cumsum(np.diff(key) != 0)]) if len(key) else key
        rank, deep = np.zeros(self.n + 1, np.int64), self.per_key
        while deep < depth:
            # Only suffixes that still agree with a neighbour are sorted further.
            edge = np.diff(group) == 0
            tied = np.flatnonzero(np.concatenate([edge, [False]]) | np.concatenate([[False], edge]))
            if not len(tied):
                break
            rank[order] = group + 1
            key = rank[np.minimum(order[tied] + deep, self.n)]
            sorted_by = np.lexsort((key, group[tied]))
            order[tied] = order[tied][sorted_by]
            key, old = key[sorted_by], group[tied]
            fresh = np.zeros(len(group), np.int64)
            fresh[tied[1:]] = (np.diff(key) != 0) & (np.diff(old) == 0)
            fresh[1:] |= np.diff(group) != 0
            group = np.cumsum(fresh)
            deep *= 2
        self.order = order

    def _packed(self, numbers: np.ndarray) -> np.ndarray:
        padded = np.concatenate([numbers, np.zeros(self.per_key, np.int64)])
        keys = np.zeros(len(numbers), np.int64)
        for i in range(self.per_key):
            keys <<= self.bits
            keys |= padded[i : i + len(numbers)]
        return keys

    def _key(self, at: np.ndarray, deep: int) -> np.ndarray:
        there = at + deep
        return np.where(there < self.n, self.keys[np.minimum(there, self.n - 1)], 0)

    def prefix(self, at: np.ndarray, deep: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The key ``deep`` words on, cut to what belongs to the first ``lengths`` words, and the first key
        above all that begin so."""
        left = self.bits * (self.per_key - np.clip(lengths - deep, 0, self.per_key))
        low = self._key(at, deep) >> left << left
        return low, low + (np.int64(1) << left)

    def find(
        self, other: SuffixArray, at: np.ndarray, lengths: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """First and end place in ``order`` of the suffixes that begin with each ``lengths`` words from ``at``
        in ``other``."""
        lo = np.zeros(len(at), np.int64)
        hi = np.full(len(at), len(self.order), np.int64)
        for deep in range(0, int(lengths.max(initial=0)), self.per_key):
            low, high = other.prefix(at, deep, lengths)
            live = lengths > deep
            new_lo = self._lower_bound(low, lo, hi, deep)
            new_hi = self._lower_bound(high, lo, hi, deep)
            lo, hi = np.where(live, new_lo, lo), np.where(live, new_hi, hi)
        return lo, hi

    def follow(
        self, other: SuffixArray, at: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many words from ``at`` in ``other`` are found here as well, and the first and end place in
        ``order`` of the suffixes that begin with them."""
        length = np.zeros(len(at), np.int64)
        lo, hi = length.copy(), np.full(len(at), len(self.order), np.int64)
        active, deep = np.arange(len(at)), 0
        while active.size:
            # Words up to the first 0 of the key.
            key = other._key(at[active], deep)
            words = np.zeros(len(active), np.int64)
            for i in range(self.per_key):
                word = key >> (self.bits * (self.per_key - 1 - i)) & ((1 << self.bits) - 1)
                words += (words == i) & (word != 0)
            going = []
            for n in range(self.per_key, 0, -1):
                # What does not agree in n words is looked up by one word less.
                now = np.flatnonzero(words == n)
                which = active[now]
                low, high = other.prefix(at[which], deep, np.full(len(which), deep + n))
                new_lo = self._lower_bound(low, lo[which], hi[which], deep)
                new_hi = self._lower_bound(high, lo[which], hi[which], deep)
                found = new_lo < new_hi
                lo[which[found]], hi[which[found]] = new_lo[found], new_hi[found]
                length[which[found]] = deep + n
                words[now[~found]] = n - 1
                if n == self.per_key:
                    going.append(which[found])
            active = np.concatenate(going)
            deep += self.per_key
        return length, lo, hi

    def _lower_bound(self, wanted, lo, hi, deep: int) -> np.ndarray:
        """The first place in lo..hi whose key ``deep`` words on is not below ``wanted``."""
        lo, hi = lo.copy(), hi.copy()
        while (active := np.flatnonzero(lo < hi)).size:
            mid = (lo[active] + hi[active]) // 2
            below = self._key(self.order[mid], deep) < wanted[active]
            lo[active[below]] = mid[below] + 1
            hi[active[~below]] = mid[~below]
        return lo


def _occurrences(array: SuffixArray, q: Queries) -> tuple[np.ndarray, np.ndarray]:
    """Every place at which a distinct window occurs: (place, number of the distinct window)."""
    lo, hi = array.find(q.array, q.at, q.length)
    n = hi - lo
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return array.order[at], np.repeat(np.arange(len(n)), n)


def _scan(texts: list[bytes], blocks: Blocks, report: bool = True) -> dict[str, object]:
    """The report's columns; without ``report`` only the counts of words and hits."""
    found = [words_of(t) for t in texts]
    starts = np.cumsum([0, *(len(f) + 1 for f in found)])
    hit = np.zeros(starts[-1], bool)
    names: list[set[str]] = [set() for _ in texts]
    longest = [(0, 0, "")] * len(texts)
    for q in blocks:
        numbers, _ = _numbers(found, q.vocabulary)
        if not len(q.at) or not numbers.any():
            continue
        array = SuffixArray(numbers, q.bits, q.width)
        place, window = _occurrences(array, q)
        if not len(place):
            continue
        change = np.bincount(place, minlength=len(numbers) + 1) - np.bincount(
            place + q.length[window], minlength=len(numbers) + 1
        )
        hit |= np.cumsum(change)[: len(numbers)] > 0
        if report:
            document = np.searchsorted(starts, place, side="right") - 1
            for doc, item in _items(document, window, q):
                names[doc].add(item)
            _matches(array, place, window, starts, q, longest)
    counts = np.concatenate([[0], np.cumsum(hit)])
    n_hit = counts[starts[1:]] - counts[starts[:-1]]
    made = {"n_words": np.diff(starts) - 1, "n_hit": n_hit}
    if not report:
        return made
    return made | {
        "n_items": np.array([len(x) for x in names], np.int64),
        "items_sha256": [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in names],
        "contaminated": n_hit > 0,
        "longest_words": np.array([n for n, _, _ in longest], np.int64),
        "longest_item": pa.array([item if n else None for n, _, item in longest], pa.string()),
        "longest_at": pa.array([-at if n else None for n, at, _ in longest], pa.int64()),
    }


def _items(document: np.ndarray, window: np.ndarray, q: Queries) -> list[tuple[int, str]]:
    """Distinct (document, item name) of the occurrences."""
    n_windows = len(q.at)
    seen = np.unique(document * n_windows + window)
    which = seen % n_windows
    n = q.begin[which + 1] - q.begin[which]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(q.begin[which], n)
    both = np.unique(np.repeat(seen // n_windows, n) * len(q.names) + q.item[at])
    return [(int(x) // len(q.names), q.names[int(x) % len(q.names)]) for x in both]


def _matches(array: SuffixArray, place, window, starts, q: Queries, longest: list) -> None:
    """Keeps the longest verbatim match of each document that has a window in it, as (words, minus the
    place, item): of equal lengths the first place, of all items there the smallest name."""
    # The longest window at each place: that of a short item counts where no long one is.
    order = np.lexsort((-q.length[window], place))
    place, window = place[order], window[order]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    place, window = place[first], window[first]
    length, lo, hi = q.array.follow(array, place)
    short = q.length[window] < q.width
    length = np.where(short, q.length[window], length)
    document = np.searchsorted(starts, place, side="right") - 1
    order = np.lexsort((place, -length, document))
    for k in order[np.flatnonzero(np.diff(document[order], prepend=-1))]:
        d, w = document[k], window[k]
        items = q.item[q.begin[w] : q.begin[w + 1]] if short[k] else q.item_of[lo[k] : hi[k]]
        new = (int(length[k]), int(starts[d] - place[k]), q.names[items.min()])
        old = longest[d]
        if new[:2] > old[:2] or new[:2] == old[:2] and new[2] < old[2]:
            longest[d] = new


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW_WORDS,
) -> DataFrame:
    """What each document has in common with the benchmark; one row for each row of ``docs``.

    ``n_hit`` counts document words inside an occurrence of any window of ``width`` item words (an
    item with fewer words is one window). ``items_sha256`` is over the sorted names of the items
    with occurring windows. ``longest_*`` tell the longest run of words that also stands in an item and
    begins with a window: its words, the item, and the word of the document at which it begins (null without
    a match); of equal runs the first one and the smallest item. Null and empty texts have
    no words; null items count as items without words; an item without an id is named by the
    empty string; items with one id are one item. An empty benchmark hits nothing, an empty table
    gives no rows, repeated rows are each returned, other columns are not read.
    """
    blocks = Blocks(benchmark, item_col, item_text, width)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return map_texts(rows, lambda p: _scan(utf8(p.column("text")), blocks), ["doc_id"], SCHEMA)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without any occurring window; all columns are kept, whatever their names. Null and
    empty texts stay, repeated rows are judged alike, an empty benchmark drops nothing, an empty table gives
    no rows."""
    blocks = Blocks(benchmark, "item_id", item_text, WINDOW_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            n_hit = _scan(utf8(piece.column(text)), blocks, report=False)["n_hit"]
            yield piece.filter(pa.array(n_hit == 0))

    return bounded_batches(docs).mapInArrow(run, docs.schema)
