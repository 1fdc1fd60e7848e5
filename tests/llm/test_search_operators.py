"""Nearest vectors, collocations and spelling variants: SQL, brute force and odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from heronry.llm import collisions, collocations, queries, variants
from tests.compare import oracle_rows, spark_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    full = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")


# --- nearest vectors


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_nearest(rows, chosen, k=5):
    """(query, rank, id, cosine) by comparing everything; rows are distinct (id, vector)."""
    usable = [
        (i, np.array(v, np.float32).astype(np.float64))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    found = []
    for i, q in usable:
        if chosen(i):
            near = sorted(
                (-float((v * q).sum() / (np.sqrt((v * v).sum()) * np.sqrt((q * q).sum()))), j)
                for j, v in usable
                if j != i and len(v) == len(q)
            )[:k]
            found += [(i, r, j, -c) for r, (c, j) in enumerate(near, 1)]
    return sorted(found)


def test_recall_of_nearest(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "embeddings").collect()
    got = queries.op11_collision_counting(spark, sf_dir).collect()
    want = brute_nearest([(r.vec_id, r.embedding) for r in rows], lambda i: i % 50 == 0)
    pairs = {(q, j): c for q, _, j, c in want}
    found = {(r.query_id, r.vec_id): r.score for r in got}
    assert len(got) == len(want) and len(found.keys() & pairs.keys()) >= 0.9 * len(want)
    assert all(abs(found[p] - pairs[p]) < 1e-12 for p in found.keys() & pairs.keys())


@pytest.mark.parametrize("close", [0.05, 0.4, 1.0])
def test_recall_in_clusters(spark, monkeypatch, close):
    """Several blocks of rows and of queries; neighbours from close to indistinct."""
    monkeypatch.setattr(collisions, "BLOCK_ROWS", 300)
    monkeypatch.setattr(collisions, "QUERY_ROWS", 7)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 32))
    made = centres[rng.integers(0, 20, 3000)] + close * rng.standard_normal((3000, 32))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(made)]
    df = vectors(spark, [(i, v, 0) for i, v in rows])
    got = collisions.nearest(df, F.col("vec_id") % 50 == 0).collect()
    want = brute_nearest(rows, lambda i: i % 50 == 0)
    hits = {(q, j) for q, _, j, _ in want} & {(r.query_id, r.vec_id) for r in got}
    assert len(got) == len(want) and len(hits) >= 0.95 * len(want)


def test_copies_of_a_vector(spark):
    """A third of the rows are one vector: ties go to the smaller id, and scores are equal."""
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0, 0.5] if i % 3 == 0 else rng.standard_normal(4).tolist(), 0) for i in range(900)]
    got = collisions.nearest(vectors(spark, rows), F.col("vec_id") == 600).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 3, 6, 9, 12] and len({r.score for r in got}) == 1


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1),
        (0, [1.0, 0.0], 1),
        (50, [1.0, 1.0], 1),
        (1, [2.0, 0.0], 1),
        (2, None, 1),
        (3, [0.0, 0.0], 1),
        (4, [nan, 1.0], 1),
        (5, [inf, 1.0], 1),
        (6, [None, 1.0], 1),
        (7, [1.0, 0.0, 0.0], 1),
        (8, [], 1),
        (None, [1.0, 0.0], 1),
        (100, [3e38, 2e38], 1),
    ]
    df = vectors(spark, rows).withColumns({"rank": F.lit("x"), "hash": F.lit(1.0), "score": F.lit(None)})
    got = collisions.nearest(df, F.col("vec_id") % 50 == 0).collect()
    distinct = [(i, v) for i, v, _ in rows[1:]]
    want = brute_nearest(distinct, lambda i: i % 50 == 0)
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got)] == [w[:3] for w in want]
    assert np.allclose([r.score for r in sorted(got)], [w[3] for w in want], rtol=0, atol=1e-15)
    assert collisions.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_directions_follow_the_bound():
    few, many = collisions.directions_and_threshold(1000), collisions.directions_and_threshold(100_000)
    assert few[0] < many[0] and all(0 < t < m for m, t in (few, many))


# --- collocations


def sql_over(rows, least=collocations.LEAST, top=collocations.TOP):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    sql = queries.COLLOCATIONS_SQL.replace(f"c >= {collocations.LEAST}", f"c >= {least}")
    return oracle_rows(con, sql.replace(f"rank <= {collocations.TOP}", f"rank <= {top}"))


def prose(pick, n, words):
    return "".join(pick.choice(words) + pick.choice([" "] * 9 + [". ", "\n", "  ", "\t", "; "]) for _ in range(n))


def test_collocations_with_hot_words(spark, monkeypatch):
    """Small bounds: texts cut in parts, several hand-overs in a task, hot pairs and triples, many buckets."""
    monkeypatch.setattr(collocations, "PIECE_BYTES", 200)
    monkeypatch.setattr(collocations, "FLUSH_TOKENS", 500)
    monkeypatch.setattr(collocations, "REMEMBERED", 20)
    monkeypatch.setattr(collocations, "BUCKET_SUFFIXES", 100)
    monkeypatch.setattr(collocations, "SHARE", 1 / 1000)
    pick = random.Random(8)
    words = ["The", "of", "x", "YZ", "é", "Écu", "a-b", "1", " ", "end"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(60):
        text = prose(pick, 200, words)
        if i % 3 == 0:
            # One triple with many continuations, and a passage that repeats.
            text += "".join(f" hot pair here w{pick.randrange(30)}!" for _ in range(60)) + " same old words again" * 9
        rows.append((i, text, pick.choice(["en", "en", "fr", None])))
    got = spark_rows(collocations.collocations(docs(spark, rows), least=6, top=40))
    assert got == sql_over(rows, 6, 40) and len(got) > 40


def test_odd_texts_of_collocations(spark):
    line = "very common words, "
    rows = [(1, None, "en"), (2, "", "en"), (3, "...", "en"), (None, line * 20, "en"), (3, line * 20, "en")]
    rows += [(3, line * 20, "en"), (4, line * 40, None), (5, "one", "de"), (6, "long " * 2000, "es")]
    df = docs(spark, rows).withColumns({"n": F.lit("x"), "rank": F.lit(1), "phrase": F.lit(2.0), "words": F.lit(3)})
    got = spark_rows(collocations.collocations(df))
    assert got == sql_over(rows)
    assert {r[2] for r in got} == {"en", "und", "es"}
    assert collocations.collocations(df.limit(0)).count() == 0


def test_collocations_of_a_very_long_text(spark):
    """A text of several parts is one: no phrase is lost or cut where the parts meet."""
    n = 1_000_000
    assert 5 * n > collocations.PIECE_BYTES
    rows = collocations.collocations(docs(spark, [(1, "long " * n, "es")])).collect()
    score = 2_000_000 * (n - 3) // (2 * n - 2)
    assert [tuple(r) for r in rows] == [("es", 1, "long long long long", n - 3, n, n - 2, n, score)]


def test_scores_are_exact_beyond_64_bits(spark):
    """Counts whose product with the scale passes 64 bits."""
    big = 10**16
    rows = [("en", "a b", 2, big + 1), ("en", "a", 1, big + 1), ("en", "b", 1, 2 * big + 1)]
    phrases = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    row = collocations._scored(phrases).first()
    assert row.score == 2_000_000 * (big + 1) // (3 * big + 2)


def test_multikey_counts_are_those_of_a_dictionary():
    rng = np.random.default_rng(2)
    rows = np.minimum(rng.geometric(0.3, (5000, 4)) - 1, 9).astype(np.int32)
    rows[rows[:, 2] == 0, 3] = 0
    weights = rng.integers(1, 4, len(rows))
    want = Counter()
    for row, n in zip(rows.tolist(), weights.tolist()):
        for size in (2, 3, 4):
            if 0 not in row[:size]:
                want[tuple(row[:size])] += n
    for least, depth in ((1, 2), (50, 2), (50, 4)):
        made = collocations.multikey_counts(list(rows.T), weights, least, depth)
        got = {tuple(rows[p, :size].tolist()): n for p, size, n in made}
        assert got == {k: n for k, n in want.items() if n >= (least if len(k) >= depth else 1)}


def test_first_words_with_few_suffixes_are_abandoned():
    """All suffixes with the same two words are in the bucket, so a first word with too few of them is not split."""

    class Columns(list):
        read = 0

        def __getitem__(self, at):
            self.read += 1
            return super().__getitem__(at)

    rows = np.ones((1060, 4), np.int32)
    rows[60:, 0] = np.arange(2, 1002)
    columns = Columns(rows.T)
    made = sorted(collocations.multikey_counts(columns, np.ones(len(rows), np.int64), 30, 2))
    assert [(size, n) for _, size, n in made] == [(2, 60), (3, 60), (4, 60)]
    assert columns.read < 300


# --- spelling variants


def brute_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: {v for v in n if one_edit(w, v)} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    found = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        found.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(found)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants_query(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = queries.op13_variants(spark, sf_dir).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_variants(rows), key=str)


@pytest.mark.parametrize("frequent", [4, 64, 32_768])
def test_near_words_of_any_dictionary(spark, monkeypatch, frequent):
    """From a dictionary of pairs only to one of the longest grams, with words of few letters."""
    monkeypatch.setattr(variants, "FREQUENT", frequent)
    pick = random.Random(frequent)
    words = sorted({"".join(pick.choices("abÿ", k=pick.randint(5, 9))) for _ in range(700)})
    words += ["aaaaa", "aaaaaa", "abababab", "a" * 300, "a" * 301]
    df = spark.createDataFrame([(w, 3) for w in dict.fromkeys(words)], "word string, n long")
    got = sorted((r.word, r.near) for r in variants.near_words(df).collect())
    assert got == sorted((a, b) for a in set(words) for b in set(words) if one_edit(a, b))


def test_chains_of_forms_and_ties(spark):
    words = ["abcdef"] * 40 + ["abcdeg"] * 16 + ["abcdfg"] * 8 + ["abcffg"] * 3 + ["zbcdef"] * 40 + ["qqqqqq"] * 3
    rows = [(i, w) for i, w in enumerate(words)]
    want = brute_variants(rows)
    df = docs(spark, [(i, w, "en") for i, w in rows])
    assert sorted(map(tuple, variants.variants(df).select(*COLUMNS).collect()), key=str) == sorted(want, key=str)
    roots = {w: root for w, _, root, *_ in want}
    assert roots["abcffg"] == "abcdef" and roots["abcdef"] == "abcdef"


def test_odd_texts_of_variants(spark, monkeypatch):
    monkeypatch.setattr(variants, "PIECE_BYTES", 300)
    monkeypatch.setattr(variants, "COUNTED", 5)
    text = "Straße straße STRASSE Écoles Ècoles ecoles ×÷×÷× naïveté naivete, " * 30
    rows = [(1, None), (2, ""), (3, "... 123"), (None, text), (3, text), (3, text), (4, "a" * 5000), (5, "ab" * 9)]
    full = docs(spark, [(i, t, "en") for i, t in rows])
    df = full.withColumns({"word": F.lit(1), "n": F.lit("x"), "root": F.lit(2.0), "key": F.lit(None)})
    got = sorted(map(tuple, variants.variants(df).select(*COLUMNS).collect()), key=str)
    assert got == sorted(brute_variants(rows), key=str) and got
    assert variants.variants(df.limit(0)).count() == 0


def test_bound_counts_every_changed_gram():
    """No edit leaves fewer grams of a word than its bound says."""
    pick = random.Random(1)
    grams = variants.Grams(frozenset(["^^a", "^^", "aa", "aaa", "ab", "aba", "ba", "b$"]), np.zeros(1))
    for _ in range(400):
        word = "".join(pick.choices("abc", k=pick.randint(5, 10)))
        at, letter = pick.randrange(len(word) + 1), pick.choice("abc")
        edited = pick.choice([word[:at] + letter + word[at:], word[: at - 1] + letter + word[at:] if at else word])
        mine, other = grams.decompose(word), grams.decompose(edited)
        shift, there = len(edited) - len(word), defaultdict(set)
        for p, g in other:
            there[g].add(p)
        kept = sum(bool({p, p + shift} & there[g]) for p, g in mine)
        assert kept >= len(mine) - variants.Grams.affected(word, mine) and kept >= 1
