"""Near-duplicates by SimHash: fingerprints linked by a self-join of their binary trie.

The trie is divided between tasks by its top: two fingerprints that differ in at most four bits agree
in at least one of five blocks of bits, so each fingerprint is sent to five subtrees, one for each
block turned to the front. Inside a subtree, pairs of nodes are followed down together with the number
of bits in which they differ so far, and dropped once it passes the allowed number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from heronry.llm.batches import LOWER, map_texts, utf8
from heronry.llm.components import component_roots
from heronry.session import materialize

SEED = 42
SHINGLE_WORDS = 4
MAX_DIFFERING = 4
# Fingerprints of one subtree that are joined in one task. Larger subtrees are dealt out in parts,
# and every two parts meet in a task.
PART_ROWS = 500_000
# Rows of small subtrees that a task joins at once.
BUFFER_ROWS = 100_000
# Node pairs with at most so many leaf pairs are compared leaf by leaf.
LEAF_PAIRS = 1024
# Node pairs that are followed down at once, and leaf pairs that are compared at once.
CHUNK = 1 << 18


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text as an unsigned number; 0 for a text without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(width))) if len(words) >= width else [words]
    ones, n, digest = np.zeros(64, np.int64), 0, xxhash.xxh64_digest
    hashes = b"".join([digest(b" ".join(s), SEED) for s in shingles])
    for at in range(0, len(hashes), 8 << 16):
        rows = np.frombuffer(hashes[at : at + (8 << 16)], np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
        n += len(rows)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, print) of every row. ``text_hash`` tells rows that share an id apart."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.col(text).cast("string").alias("text"),
    )

    def add(piece: pa.RecordBatch) -> dict[str, object]:
        values = np.array([fingerprint(t) for t in utf8(piece.column("text"))], np.uint64)
        return {"print": values.view(np.int64)}

    return map_texts(
        rows, add, ["doc_id", "text_hash"], "doc_id long, text_hash long, print long"
    )


def blocks(differing: int) -> list[tuple[int, int]]:
    """(bits to turn, bits in the block): one block more than the bits that may differ."""
    n = differing + 1
    wide, extra = divmod(64, n)
    sizes = [wide + (i < extra) for i in range(n)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(n)]


def _turned(value: Column, bits: int) -> Column:
    if bits == 0:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


class Forest:
    """Groups of equal numbers among 0..n-1, each named by its smallest member."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self._changes: np.ndarray | None = None

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            if (apart := ra != rb).sum() == 0:
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (nearer := self.root[self.root] != self.root).any():
                self.root[nearer] = self.root[self.root[nearer]]
            self._changes = None

    def one_group(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether all of lo..hi-1 are in one group."""
        if self._changes is None:
            self._changes = np.concatenate([[0], np.cumsum(np.diff(self.root) != 0)])
        return self._changes[lo] == self._changes[hi - 1]


def trie_links(keys: np.ndarray, top: int, differing: int) -> Forest:
    """Groups among sorted distinct 64-bit ``keys``: linked are those that agree in the ``top`` first
    bits and differ in at most ``differing`` others.

    A node of the trie is the range of keys with a common prefix. Pairs of nodes are kept on a stack
    in chunks of one depth, so memory is bounded by depth times ``CHUNK``. A pair of nodes whose keys
    are all in one group already can add nothing and is dropped, so a dense cluster is not expanded
    into all its pairs.
    """
    groups = Forest(len(keys))
    begins = np.concatenate([[0], np.flatnonzero(np.diff(keys >> np.uint64(64 - top))) + 1])
    ends = np.concatenate([begins[1:], [len(keys)]])
    zero = np.zeros(len(begins), np.int64)
    stack = [(top, begins, ends, begins, ends, zero)]
    while stack:
        depth, lo1, hi1, lo2, hi2, errors = stack.pop()
        if len(lo1) > CHUNK:
            parts = [x[:CHUNK] for x in (lo1, hi1, lo2, hi2, errors)]
            stack.append((depth, *(x[CHUNK:] for x in (lo1, hi1, lo2, hi2, errors))))
            lo1, hi1, lo2, hi2, errors = parts
        done = (
            groups.one_group(lo1, hi1)
            & groups.one_group(lo2, hi2)
            & (groups.root[lo1] == groups.root[lo2])
        )
        open_ = ~done & (errors <= differing)
        leaf = open_ & ((hi1 - lo1) * (hi2 - lo2) <= LEAF_PAIRS)
        _compare_leaves(keys, groups, lo1[leaf], hi1[leaf], lo2[leaf], hi2[leaf], differing)
        inner = open_ & ~leaf
        if not inner.any():
            continue
        lo1, hi1, lo2, hi2, errors = (x[inner] for x in (lo1, hi1, lo2, hi2, errors))
        mid1, mid2 = _middle(keys, lo1, depth), _middle(keys, lo2, depth)
        mid1, mid2 = np.clip(mid1, lo1, hi1), np.clip(mid2, lo2, hi2)
        # A node paired with itself has one pair of unlike children, two nodes have two.
        two = lo1 != lo2
        # The likest children are pushed last and followed first: what they link need not be followed again.
        children = (
            (lo1, mid1, mid2, hi2, errors + 1),
            (mid1[two], hi1[two], lo2[two], mid2[two], errors[two] + 1),
            (mid1, hi1, mid2, hi2, errors),
            (lo1, mid1, lo2, mid2, errors),
        )
        for child in children:
            begin1, end1, begin2, end2, differ = child
            real = (begin1 < end1) & (begin2 < end2) & (differ <= differing)
            if real.any():
                stack.append((depth + 1, *(x[real] for x in child)))
    return groups


def _middle(keys: np.ndarray, lo: np.ndarray, depth: int) -> np.ndarray:
    """Where in the node that begins at ``lo`` the keys with a one at ``depth`` begin."""
    shift = np.uint64(63 - depth)
    return np.searchsorted(keys, ((keys[lo] >> shift) | np.uint64(1)) << shift)


def _compare_leaves(keys, groups, lo1, hi1, lo2, hi2, differing: int) -> None:
    sizes = (hi1 - lo1) * (hi2 - lo2)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // CHUNK)) + 1
    for rows in np.split(np.arange(len(sizes)), cuts):
        if not len(rows):
            continue
        n, width = sizes[rows], (hi2 - lo2)[rows]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(width, n)
        a, b = np.repeat(lo1[rows], n) + at // width, np.repeat(lo2[rows], n) + at % width
        near = (a < b) & (np.bitwise_count(keys[a] ^ keys[b]) <= differing)
        groups.join(a[near], b[near])


def _join_parts(differing: int):
    """Joins the subtrees of a partition sorted by (turn, top, part_a, part_b)."""
    widths = [size for _, size in blocks(differing)]
    shifts = [turn for turn, _ in blocks(differing)]

    def join(turn: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = np.unique(keys)
        root = trie_links(keys, widths[turn], differing).root
        linked = np.flatnonzero(root != np.arange(len(keys)))
        back, s = [], shifts[turn]
        for value in (keys[linked], keys[root[linked]]):
            if s:
                value = (value >> np.uint64(s)) | (value << np.uint64(64 - s))
            back.append(pa.array(value.view(np.int64)))
        yield pa.RecordBatch.from_arrays(back, names=["a", "b"])

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held, axis=1)
        calls = rows[[0, 2, 3]]
        cuts = np.flatnonzero((np.diff(calls, axis=1) != 0).any(axis=0)) + 1
        for part in np.split(rows, cuts, axis=1):
            yield from join(int(part[0, 0]), part[4].copy().view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if held and sum(h.shape[1] for h in held) + rows.shape[1] > BUFFER_ROWS:
                # Only the last subtree may go on in this batch.
                all_rows = np.concatenate([*held, rows], axis=1)
                last = (all_rows[:4] == all_rows[:4, -1:]).all(axis=0)
                first = int(np.flatnonzero(last)[0])
                if first:
                    yield from flush([all_rows[:, :first]])
                held = [all_rows[:, first:]]
            elif rows.shape[1]:
                held.append(rows)
        if held:
            yield from flush(held)

    return run


def print_links(prints: DataFrame, differing: int = MAX_DIFFERING) -> DataFrame:
    """Links (a, b) that connect distinct 64-bit values ``print`` differing in at most ``differing``
    bits: of each group that a task finds, every member is linked to the smallest (in that task's
    order), not to each other member."""
    turns = [
        F.struct(
            F.lit(i).cast("long").alias("turn"),
            F.shiftrightunsigned(_turned(F.col("print"), turn), 64 - size).alias("top"),
            _turned(F.col("print"), turn).alias("key"),
        )
        for i, (turn, size) in enumerate(blocks(differing))
    ]
    sent = prints.select(F.explode(F.array(*turns)).alias("t")).select("t.*")
    # At most (differing + 1) * 2^block rows, however many fingerprints there are.
    large = (
        sent.groupBy("turn", "top")
        .count()
        .where(F.col("count") > PART_ROWS)
        .select("turn", "top", F.ceil(F.col("count") / PART_ROWS).alias("parts"))
    )
    parts = F.coalesce(F.col("parts"), F.lit(1))
    own = F.pmod(F.xxhash64("key"), F.col("parts"))
    dealt = (
        sent.join(F.broadcast(large), ["turn", "top"], "left")
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select(
            "turn",
            "top",
            F.least("own", "other").alias("part_a"),
            F.greatest("own", "other").alias("part_b"),
            "key",
        )
    )
    place = ["turn", "top", "part_a", "part_b"]
    # Sorted so that the calls of one turn stay together.
    return (
        dealt.repartition(*place)
        .sortWithinPartitions("turn", "part_a", "part_b", "top")
        .mapInArrow(_join_parts(differing), "a long, b long")
    )


def _grouped(docs: DataFrame, id_col: str, text: str, differing: int) -> DataFrame:
    """(doc_id, text_hash, print, root, component_id) of every row."""
    rows = materialize(fingerprints(docs, id_col, text), "prints")
    firsts = materialize(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = component_roots(print_links(firsts.select("print"), differing))
    named = materialize(
        firsts.join(roots, F.col("print") == F.col("node"), "left").select(
            "print", "first_id", F.coalesce("root", "print").alias("root")
        ),
        "roots",
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(smallest, "root").select(F.col("print").alias("of"), "root", "component_id")
    return rows.join(classes, F.col("print") == F.col("of")).drop("of")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", differing: int = MAX_DIFFERING
) -> DataFrame:
    """(doc_id, text_hash, print, component_id) of every row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached by links. Null and empty texts have
    fingerprint 0 and are linked like any other; rows without an id are linked too, and
    ``component_id`` is null only where no row of the component has an id. Repeated rows are all
    returned. Other columns are not read. An empty table gives no rows.
    """
    return _grouped(docs, id_col, text, differing).drop("root")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", differing: int = MAX_DIFFERING
) -> DataFrame:
    """The rows of ``docs`` with one of each group of near-duplicates: that with the smallest id (of
    equal ids, the smallest text hash; of equal rows, any one). Rows without an id come after all
    others. All columns are kept, whatever their names.
    """
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    kept = (
        _grouped(docs, id_col, text, differing)
        .groupBy("root")
        .agg(F.min(order).alias("kept"))
        .select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.text_hash").alias("_kept_hash"))
        .distinct()
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(F.col(text)).alias("_hash"),
    )
    found = rows.join(
        kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_hash") == F.col("_kept_hash"))
    )
    # Repeated rows share id and hash; one of them stays.
    one = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.lit(0)))
    return found.withColumn("_one", one).where(F.col("_one") == 1).select("_row.*")
