"""SimHash, decontamination, shards, WARC and the pipeline: small cases and brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from heronry.llm import components, decontaminate, queries, shards, simhash, toxicity, warc
from tests.compare import oracle_connection, oracle_rows, schemas, spark_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA
    )


ODD_ROWS = [(1, None), (2, ""), (2, ""), (None, "some words"), (3, "word " * 5000), (4, " \n\t ")]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf_dir, name):
    con = oracle_connection(sf_dir)
    df = queries.QUERIES[name](spark, sf_dir)
    ours, theirs = schemas(df, con, queries.ORACLES[name])
    assert ours == theirs
    assert spark_rows(df) == oracle_rows(con, queries.ORACLES[name])


# --- components


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    pick = random.Random(3)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(170)]
    links += [(i, i + 1) for i in range(200, 260)] + [(5, 5), (7, 8), (7, 8), (8, 7)]
    got = dict(components.component_roots(spark.createDataFrame(links, "a long, b long")).collect())
    expected = groups(300, links)
    assert got == {i: r for i, r in enumerate(expected) if r != i}
    assert components.component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


# --- SimHash


def brute_print(text, width=4):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    p = np.array(prints, np.uint64)
    near = np.argwhere(np.bitwise_count(p[:, None] ^ p[None, :]) <= 4)
    return groups(len(p), near.tolist())


def test_simhash_query(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in queries.op6_simhash(spark, sf_dir).collect()}
    prints = [brute_print(r.text) for r in rows]
    roots = brute_components(prints)
    for r, p, root in zip(rows, prints, roots):
        assert got[r.doc_id].fingerprint == f"{p:016x}"
        assert got[r.doc_id].component_id == rows[root].doc_id
    assert any(i != root for i, root in enumerate(roots))


def cluster(rng, n, flips):
    base = rng.integers(0, 2**63, dtype=np.uint64)
    bits = np.uint64(1) << rng.integers(0, 64, (n, flips)).astype(np.uint64)
    return base ^ np.bitwise_xor.reduce(bits, axis=1)


def test_trie_finds_all_links():
    rng = np.random.default_rng(2)
    for flips in (1, 2, 4, 6):
        keys = np.unique(np.concatenate([cluster(rng, 80, flips) for _ in range(6)]))
        same_top = (keys >> np.uint64(60))[:, None] == (keys >> np.uint64(60))[None, :]
        near = (np.bitwise_count(keys[:, None] ^ keys[None, :]) <= 4) & same_top
        got = simhash.trie_links(keys, 4, 4).root
        assert got.tolist() == groups(len(keys), np.argwhere(near).tolist())


def test_blocks_cover_all_bits():
    for differing in range(1, 9):
        made = simhash.blocks(differing)
        assert len(made) == differing + 1 and sum(size for _, size in made) == 64


@pytest.mark.parametrize("part_rows", [simhash.PART_ROWS, 40])
def test_links_of_hot_subtrees(spark, monkeypatch, part_rows):
    """The same components whether or not the subtrees are dealt out in parts."""
    monkeypatch.setattr(simhash, "PART_ROWS", part_rows)
    monkeypatch.setattr(simhash, "BUFFER_ROWS", 64)
    rng = np.random.default_rng(4)
    keys = np.unique(np.concatenate([cluster(rng, 300, 3), cluster(rng, 60, 5)]))
    rows = [(int(k),) for k in keys.view(np.int64)]
    links = simhash.print_links(spark.createDataFrame(rows, "print long"))
    place = {int(k): i for i, k in enumerate(keys.view(np.int64))}
    found = [(place[a], place[b]) for a, b in links.collect()]
    assert groups(len(keys), found) == brute_components(keys)
    # A spanning forest for each task, not all pairs.
    assert len(found) < 10 * len(keys) * (1 if part_rows > 1000 else 20)


def test_simhash_of_odd_rows(spark):
    rows = docs(spark, [*ODD_ROWS, (7, "word " * 4999), (None, "some words")])
    rows = rows.withColumn("print", F.lit("clash")).withColumn("root", F.lit(1))
    got = sorted(
        [(r.doc_id is None, r.doc_id, r.component_id) for r in simhash.near_duplicates(rows).collect()],
        key=str,
    )
    assert got == sorted(
        [
            *[(False, i, 1) for i in (1, 2, 2, 4)],
            (False, 3, 3),
            (False, 7, 3),
            *[(True, None, None)] * 2,
        ],
        key=str,
    )
    kept = simhash.drop_near_duplicates(rows)
    assert kept.columns == rows.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [1, 3, None]
    assert simhash.drop_near_duplicates(rows.limit(0)).count() == 0


def test_two_texts_with_one_id_both_stay(spark):
    rows = docs(spark, [(1, "one text of its own"), (1, "quite another thing here"), (1, "one text of its own")])
    assert simhash.drop_near_duplicates(rows).count() == 2


# --- decontamination


def brute_hits(text, items, width=10):
    words_of = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    words, hit, names = words_of(text), set(), set()
    for name, item in items:
        w = words_of(item)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == w[i : i + n]:
                    hit |= set(range(at, at + n))
                    names.add(name)
    return len(words), len(hit), sorted(names)


def brute_longest(text, items, width=10):
    """Words, item and place of the longest run of words that an item has too and that begins with a window."""
    words_of = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    words, best = words_of(text), (0, None, None)
    for name, item in sorted(items):
        w = words_of(item)
        least = min(width, len(w))
        for at, i in itertools.product(range(len(words)), range(len(w))):
            n = 0
            while at + n < len(words) and i + n < len(w) and words[at + n] == w[i + n]:
                n += 1
            if n >= least and (n > best[0] or n == best[0] and at < best[2]):
                best = (n, name, at)
    return best


def test_longest_match_over_shared_and_repeated_passages(spark, monkeypatch):
    """Items that share passages, hold one twice, or are the same; documents that go from one into another."""
    word = [f"w{i}" for i in range(200)]
    shared = word[:15]
    items = [
        ("a", [*shared, *word[20:23]]),
        ("b", [*word[30:40], *shared, *word[40:50]]),
        ("c", [*shared, *shared, *word[60:70], *shared]),
        ("d", [*word[30:40], *shared, *word[40:50]]),
        ("e", word[100:104]),
        ("f", [*word[90:110]]),
        ("b", [*word[150:162]]),
    ]
    items = [(name, " ".join(w)) for name, w in items]
    pick = random.Random(3)
    few = ["x", "y"]
    items += [(f"r{k}", " ".join(pick.choices(few, k=40))) for k in range(4)]
    texts = [items[1][1], "zz " + items[2][1] + " " + items[0][1], " ".join(shared[3:] + word[20:30])]
    texts += [" ".join(word[k : k + 30]) for k in range(0, 180, 7)] + ["w100 w101 w102 w103", "w95 w96"]
    texts += [" ".join(pick.choices(few, k=60)) for _ in range(10)] + [items[9][1] * 2, None, ""]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    want = {i: brute_longest(t, items) for i, t in enumerate(texts)}
    assert want[0] == (35, "b", 0)
    for block in (decontaminate.BLOCK_BYTES, 200):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.contamination(docs(spark, list(enumerate(texts))), benchmark).collect()
        assert {r.doc_id: (r.longest_words, r.longest_item, r.longest_at) for r in got} == want


def test_contamination_by_brute_force(spark, monkeypatch):
    pick = random.Random(8)
    vocabulary = ["ab", "Cd", "é", "x1", "yy"]
    items = [(str(i), " ".join(pick.choices(vocabulary, k=pick.choice([0, 1, 3, 9, 10, 11, 14, 30])))) for i in range(25)]
    texts = [" ".join(pick.choices(vocabulary, k=pick.randint(0, 60))) for _ in range(60)]
    texts += [f"zz {items[k][1]}. zz {items[k + 1][1]}" for k in range(20)] + [None, ""]
    table = docs(spark, list(enumerate(texts)))
    benchmark = spark.createDataFrame([*items, (None, None)], "item_id string, text string")
    expected = {i: brute_hits(t, items) for i, t in enumerate(texts)}
    # One block, and several.
    for block in (decontaminate.BLOCK_BYTES, 200):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.contamination(table, benchmark).collect()
        for r in got:
            n_words, n_hit, names = expected[r.doc_id]
            digest = hashlib.sha256(",".join(names).encode()).hexdigest()
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n_words, n_hit, len(names), digest)
            assert r.contaminated == (n_hit > 0)


def test_longest_match_and_its_place(spark):
    item = " ".join(f"w{i}" for i in range(40))
    text = "before it " + " ".join(f"W{i}" for i in range(5, 30)) + " and " + item[:60]
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    row = decontaminate.contamination(docs(spark, [(1, text)]), benchmark).first()
    assert (row.longest_words, row.longest_item, row.longest_at) == (25, "7", 2)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(6)
    numbers = rng.integers(0, 4, 500)
    for depth in (3, 10, 40):
        array = decontaminate.SuffixArray(numbers, 3, depth)
        deep = -(-depth // array.per_key) * array.per_key
        padded = np.concatenate([numbers, np.zeros(deep, int)])
        suffixes = [tuple(padded[i : i + deep]) for i in array.order]
        assert suffixes == sorted(suffixes) and len(suffixes) == (numbers > 0).sum()


def test_contamination_of_odd_rows(spark):
    rows = docs(spark, ODD_ROWS).withColumn("n_hit", F.lit("clash"))
    empty = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "word"), (1, "some words")], "item_id long, text string")
    assert decontaminate.contamination(rows, empty).where("contaminated").count() == 0
    got = sorted((str(r.doc_id), r.n_words, r.n_hit) for r in decontaminate.contamination(rows, one).collect())
    assert got == [("1", 0, 0), ("2", 0, 0), ("2", 0, 0), ("3", 5000, 5000), ("4", 0, 0), ("None", 2, 2)]
    kept = decontaminate.drop_contaminated(rows, one)
    assert kept.columns == rows.columns and kept.count() == 4
    assert decontaminate.drop_contaminated(rows.limit(0), one).count() == 0


# --- shards


def check_packing(got, n, shards_=8):
    assert len(got) == n
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(shards_))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_query(spark, sf_dir):
    texts = dict(queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect())
    got = queries.op3_vector_packing(spark, sf_dir).collect()
    check_packing(got, len(texts))
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 for r in got)
    by_text, sizes = {}, [0] * 8
    for r in got:
        by_text.setdefault(texts[r.doc_id], set()).add(r.shard)
        sizes[r.shard] += r.size
    assert all(len(s) == 1 for s in by_text.values())
    assert max(sizes) < 1.02 * sum(sizes) / 8


def test_placing_balances_all_three():
    rng = np.random.default_rng(9)
    items = rng.lognormal(3, 1, (4000, 1)) * rng.uniform(0.8, 1.2, (4000, 3))
    chosen = shards.place(items, 8)
    loads = np.array([items[chosen == s].sum(axis=0) for s in range(8)]) / items.sum(axis=0) * 8
    assert abs(loads - 1).max() < 0.01


def test_bundles_give_near_equal_sizes(spark, monkeypatch):
    """Few bundles, so that most groups are placed in one; a group with a third of all rows is cut."""
    monkeypatch.setattr(shards, "BUNDLES", 16)
    rows = [(i, f"text {i} " + "x" * (i % 50)) for i in range(4000)]
    rows += [(10_000 + i, "the same text in many rows, again and again") for i in range(2000)]
    got = shards.pack(docs(spark, rows)).collect()
    check_packing(got, 6000)
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) < 1.1 * sum(sizes) / 8


def test_shards_of_odd_rows(spark):
    rows = docs(spark, ODD_ROWS).withColumn("shard", F.lit("clash"))
    got = shards.pack(rows).collect()
    check_packing(got, 6)
    assert {(r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id in (1, 2)} == {(1, 1, 0), (2, 1, 0)}
    assert shards.pack(rows.limit(0)).count() == 0


# --- WARC

PAGES = [
    (5, "http://a/", "x" * 300),
    (3, "http://b/\r\nX: 1", "x" * 300),
    (4, None, "x" * 300),
    (1, "http://c/", "short"),
    (2, "http://d/", "short"),
    (6, "http://e/", None),
    (7, "http://f/", ""),
    (8, "http://g/", "é\r\n\r\nWARC/1.1\r\n" * 40),
    (None, "http://h/", "x" * 300),
    (9, "http://i/", "".join(chr(32 + i % 90) for i in range(5000))),
    (9, "http://i/", "".join(chr(32 + i % 90) for i in range(5000))),
]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))


@pytest.mark.parametrize("chunk_bytes", [64, warc.CHUNK_BYTES])
def test_archives_come_back(spark, chunk_bytes):
    from heronry.session import fresh_path

    path = fresh_path(spark, "warc-test")
    warc.write_archives(pages(spark, PAGES), path, chunk_bytes=chunk_bytes)
    table = spark.read.parquet(path)
    assert table.where(F.octet_length("content") > 2000 if chunk_bytes == 64 else F.lit(False)).count() == 0
    got = sorted((tuple(r) for r in warc.read_archives(table).collect()), key=str)
    expected = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        revisit = html == "x" * 300 and i in (4, 5)
        kind = ("revisit", 3) if revisit else ("response", None)
        expected.append((i, len(body), hashlib.sha256(body).hexdigest(), *kind))
    assert got == sorted(expected, key=str)
    # The chunks, one after another, are the bytes of WARC records.
    rows = table.orderBy("record_id", "chunk_no").collect()
    data = b"".join(r.content for r in rows)
    for _ in range(len(PAGES)):
        head, data = data.split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: re")
        n = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert data[n : n + 4] == b"\r\n\r\n"
        data = data[n + 4 :]
    assert data == b""


def test_damage_is_found(spark):
    from heronry.session import fresh_path

    path = fresh_path(spark, "warc-test")
    warc.write_archives(pages(spark, PAGES), path, chunk_bytes=64)
    table = spark.read.parquet(path)
    damaged = table.where("not (chunk_no = 3 and n_chunks > 3)")
    with pytest.raises(Exception, match="damaged record"):
        warc.read_archives(damaged).collect()


def test_a_revisit_needs_its_payload(spark):
    from heronry.session import fresh_path

    path = fresh_path(spark, "warc-test")
    warc.write_archives(pages(spark, PAGES), path)
    table = spark.read.parquet(path)
    for stored in (table.where("page_id IS NULL OR page_id <> 3"), table.where("page_id IN (4, 5)")):
        with pytest.raises(Exception, match="no stored payload for the revisit of page 3"):
            warc.read_archives(stored).collect()


def test_empty_archive(spark):
    assert warc.archived(pages(spark, PAGES).limit(0)).count() == 0


# --- pipeline


def test_pipeline(spark, sf_dir):
    """Each stage against brute force on what its predecessor kept."""
    before = queries.table(spark, sf_dir, "documents")
    columns = before.columns
    texts = {r.doc_id: r.text for r in before.collect()}
    model = queries.toxicity_model(spark, before, sf_dir)
    items = [(str(r.item_id), r.text) for r in queries.table(spark, sf_dir, "benchmark").collect()]

    docs_ = before
    for name, stage in corpus_pipeline.STAGES:
        docs_ = corpus_pipeline.materialize(stage(spark, docs_, sf_dir), f"test-{name}")
        if name == "toxicity":
            texts = {i: t for i, t in texts.items() if model.score(t.encode()) < 0.5}
        elif name == "near_duplicates":
            ids = sorted(texts)
            roots = brute_components([brute_print(texts[i]) for i in ids])
            texts = {i: texts[i] for k, i in enumerate(ids) if roots[k] == k}
        elif name == "decontamination":
            texts = {i: t for i, t in texts.items() if not brute_fast(t, items)}
        elif name == "personal_data":
            maker = corpus_pipeline.pseudonyms.Pseudonymiser(queries.pseudonym_key(spark))
            texts = {i: maker.replace(t)[0] for i, t in texts.items()}
        if name != "encoding":
            assert docs_.columns == columns
            assert {r.doc_id: r.text for r in docs_.collect()} == texts
    got = {r.doc_id: r.decoded_sha256 for r in docs_.collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}
    assert corpus_pipeline.run(spark, sf_dir).count() == len(texts)


def brute_fast(text, items, width=10):
    """Whether any window of any item occurs, by text search."""
    plain = lambda t: " " + " ".join(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.translate(LOWER))) + " "
    body = plain(text)
    for _, item in items:
        w = plain(item).split()
        n = min(width, len(w))
        if any(" " + " ".join(w[i : i + n]) + " " in body for i in range(len(w) - n + 1)):
            return True
    return False


def test_stages_of_odd_rows(spark, sf_dir):
    """Nulls, repeats and clashing columns go through every stage."""
    extra = {"score": F.lit("x"), "ids": F.lit(1), "print": F.lit(2.0), "_id": F.lit("y"), "n_words": F.lit(3)}
    rows = docs(spark, ODD_ROWS).withColumns(extra)
    for table in (rows, rows.limit(0)):
        docs_ = table
        for name, stage in corpus_pipeline.STAGES:
            docs_ = stage(spark, docs_, sf_dir)
            if name != "encoding":
                assert docs_.columns == rows.columns
        assert docs_.count() == (3 if table is rows else 0)


def test_near_duplicate_stage_is_op6(spark, sf_dir):
    """One row of each component that op6 names stays: that with the smallest id."""
    rows = queries.table(spark, sf_dir, "documents")
    kept = corpus_pipeline.drop_near_duplicates(spark, rows, sf_dir).select("doc_id").collect()
    named = queries.op6_simhash(spark, sf_dir).select("component_id").distinct().collect()
    assert sorted(kept) == sorted(named) and 0 < len(kept) < rows.count()


def test_toxic_rows_go_and_null_rows_stay(spark):
    model = toxicity.Model(np.sort(toxicity.hashes(b"vile")), np.array([9.0], np.float32), -3.0)
    rows = docs(spark, [(1, "a vile text"), (2, "a fine text"), (3, None)])
    assert sorted(r.doc_id for r in toxicity.drop_toxic(rows, model).collect()) == [2, 3]
