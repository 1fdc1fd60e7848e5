"""BPE, pseudonyms, licences, divergence, classifiers: small cases and brute force."""

import collections
import hashlib
import math
import random
import re
from datetime import date, timedelta
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from heronry.llm import bpe, divergence, labelled, licences, neighbours, pseudonyms, queries, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def docs(spark, rows, extra=""):
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD_ROWS = [(1, None), (2, ""), (2, ""), (None, "some words"), (3, "word " * 5000), (4, " \n\t ")]


def as_tuples(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


# --- byte-level BPE


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(PATH),
        special_tokens={},
    )


def test_bpe_is_that_of_the_library(reference):
    encoder = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    parts = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "ß", "中文", "12", "²", "'s"]
    parts += ["'ll", "!?", " ", "​", "　", "😀", "\r\n", "_", "x" * 70, "ab" * 60, "́"]
    pick = random.Random(5)
    texts = ["".join(pick.choices(parts, k=pick.randint(0, 30))) for _ in range(3000)]
    texts += ["<|endoftext|>", "q" * 20_000, "ab cd" * 5_000]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_bpe_remembers_a_bounded_number_of_words(monkeypatch, reference):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    text = " ".join(f"word{i}" for i in range(200))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference.encode_ordinary(text)
    for table in (encoder.words, encoder.pieces):
        assert len(table.young) <= 10 and len(table.old) <= 10


def test_bpe_keeps_what_is_asked_for_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    table = bpe.Remembered()
    for i in range(100):
        table.add(f"rare{i}", b"x")
        if table.young.get("often") is None and table.older("often") is None:
            assert i == 0
            table.add("often", b"y")
    assert (table.young.get("often") or table.older("often")) == b"y"


def test_bpe_query(spark, sf_dir, reference):
    texts = dict(queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect())
    got = queries.op1_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = np.array(reference.encode_ordinary(texts[row.doc_id]), "<u4")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_bpe_of_odd_rows(spark):
    tokenizer = queries.tokenizer(spark)
    rows = docs(spark, ODD_ROWS).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    got = bpe.round_trip_digests(rows, tokenizer).collect()
    assert sorted(r.n_tokens for r in got)[:3] == [0, 0, 0] and all(r.round_trip for r in got)
    assert bpe.round_trip_digests(rows.limit(0), tokenizer).count() == 0


# --- pseudonyms


def test_feistel_is_a_permutation():
    f = pseudonyms.Feistel(b"key")
    for size in (1, 2, 3, 10, 100, 1000, 4097):
        assert sorted(f.permute(v, size, "k") for v in range(size)) == list(range(size))
    assert [f.permute(v, 1000, "a") for v in range(9)] != [f.permute(v, 1000, "b") for v in range(9)]


CASES = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
    "ssn": ["123-45-6789"],
    "phone": ["+1 (017) 555-7713", "+49 30 1234567", "(555) 123-4567"],
    "ip": ["192.168.0.1", "233.254.104.120"],
    "date": ["2021-03-04", "04.03.2021", "12/31/1999", "1.2.2003"],
    "secret": ["b44e15e09fd311c3cf3163b66d5a9875b883d8ce"],
    "email": ["ann.lee42@mail.example.com"],
}


@pytest.mark.parametrize("kind", CASES)
def test_pseudonyms_keep_the_format(kind):
    maker = pseudonyms.Pseudonymiser(b"key")
    for value in CASES[kind]:
        text, counts = maker.replace(f"before {value}, after")
        new = text[len("before ") : -len(", after")]
        assert counts == {kind: 1} and new != value and len(new) == len(value)
        shape = lambda s: re.sub("[0-9]", "9", s) if kind != "secret" else len(s)
        if kind != "email" and kind != "iban":
            assert shape(new) == shape(value)
        # The new value is as valid as the old one, so it is found again.
        assert maker.replace(f"x {new} y")[1] == {kind: 1}
        # Equal values have equal pseudonyms in every document.
        assert new in maker.replace(f"other words {value}")[0]


def test_values_side_by_side_are_all_found():
    maker = pseudonyms.Pseudonymiser(b"key")
    text = "+1 (826) 555-4081 190.137.223.204 4111111111111111 42 DE89 3704 0044 0532 0130 00 4111 1111 1111 1111"
    new, counts = maker.replace(text)
    assert counts == {"phone": 1, "ip": 1, "card": 2, "iban": 1}
    for value in ("555-4081", "190.137", "4111111111111111", "0044 0532", "4111 1111 1111 1111"):
        assert value not in new


def test_a_form_that_is_not_valid_hides_no_other():
    counts = pseudonyms.Pseudonymiser(b"key").replace("AB12 4111 1111 1111 1111 and 2021-02-30 4.4.4.4")[1]
    assert counts == {"card": 1, "ip": 1}


def test_values_that_are_not_valid_stay():
    maker = pseudonyms.Pseudonymiser(b"key")
    text = "4111111111111112 2021-02-30 000-12-3456 999.1.1.1 DE00 3704 0044 0532 0130 00 version 4.0.1"
    assert maker.replace(text) == (text, {})


@pytest.mark.parametrize("value", ["25/12/2020", "31/01/1999", "12-31-1999", "12.31.1999"])
def test_dates_in_the_other_order(value):
    for key in (b"key", b"other", b"third"):
        maker = pseudonyms.Pseudonymiser(key)
        new, counts = maker.replace(f"le {value}, a")
        assert counts == {"date": 1} and value not in new and len(new) == len(value) + 6
        # It is read in the same order again, so no other date has the same pseudonym.
        parts = re.split("[-/.]", new[3:-3])
        assert int(parts[0 if value[:2] > "12" else 1]) > 12
    assert maker.replace("31/04/2020 31-31-1999 13/13/2000")[1] == {}


def test_other_orders_stay_one_to_one():
    maker = pseudonyms.Pseudonymiser(b"key")
    days = [f"{a:02d}/{b:02d}/2020" for a in range(1, 32) for b in range(1, 13) if a > 12]
    made = [maker.replace(d)[0] for d in days if maker.replace(d)[1]]
    assert len(made) > 200 and len(set(made)) == len(made)


def read_dates(text):
    """Independent reading of the forms: the day each stands for, by the order its separator implies."""
    a, b, c = re.split("[-/.]", text)
    if len(a) == 4:
        return {date(int(a), int(b), int(c))}
    orders = [(b, a), (a, b)] if "/" not in text else [(a, b), (b, a)]
    for month, day in orders:
        if 1 <= int(month) <= 12 and int(day) <= 31:
            return {date(int(c), int(month), int(day))}


@pytest.mark.parametrize("day", [date(2020, 12, 25), date(1999, 1, 31), date(2001, 2, 3), date(1950, 10, 11), date(2024, 2, 29), date(9999, 12, 31)])
def test_all_spellings_of_a_date_stay_linked(day):
    y, m, d = day.year, day.month, day.day
    spellings = {f"{y}-{m:02d}-{d:02d}", f"{y}/{m}/{d}", f"{d:02d}.{m:02d}.{y}", f"{d}.{m}.{y}", f"{d}-{m}-{y}", f"{m:02d}/{d:02d}/{y}", f"{m}/{d}/{y}"}
    if d > 12:
        spellings |= {f"{d:02d}/{m:02d}/{y}", f"{m:02d}-{d:02d}-{y}", f"{m}.{d}.{y}"}
    for key in (b"key", b"other"):
        maker = pseudonyms.Pseudonymiser(key)
        new = {s: maker.replace(s)[0] for s in spellings}
        assert len(set.union(*(read_dates(t) for t in new.values()))) == 1
        assert all(re.sub("[0-9]", "9", t) == re.sub("[0-9]", "9", s) for s, t in new.items())


def test_dates_are_moved_one_to_one():
    maker = pseudonyms.Pseudonymiser(b"key")
    days = [date(2000, 1, 1) + timedelta(days=k) for k in range(2000)]
    made = {maker.replace(d.isoformat())[0] for d in days}
    assert len(made) == len(days) and all(1900 <= date.fromisoformat(m).year < 2100 for m in made)


@pytest.mark.parametrize(
    "spellings",
    [
        ["+49 30 1234567", "+49301234567", "+49-30-1234567", "+49 (0)30 1234567"],
        ["+1 (555) 123-4567", "+1 555-123-4567", "+15551234567", "555-123-4567", "(555) 123-4567"],
        ["+352 621 123 456", "+352621123456"],
        ["+7 495 123-4567", "+74951234567"],
    ],
)
def test_all_spellings_of_a_telephone_number_stay_linked(spellings):
    maker = pseudonyms.Pseudonymiser(b"key")
    made = [maker.replace(f"call {s} now") for s in spellings]
    assert all(counts == {"phone": 1} for _, counts in made)
    national = len(re.sub("[^0-9]", "", spellings[-1])) if spellings[-1][0] != "+" else 9
    assert len({re.sub("[^0-9]", "", t)[-min(national, 9):] for t, _ in made}) == 1
    for s, (t, _) in zip(spellings, made):
        assert re.sub("[0-9]", "9", t[5:-4]) == re.sub("[0-9]", "9", s) and t[5:-4] != s
        assert s[0] != "+" or re.match(r"\+(49|1|352|7)", s).group() == re.match(r"\+(49|1|352|7)", t[5:-4]).group()


def test_long_secrets_are_replaced():
    maker = pseudonyms.Pseudonymiser(b"key")
    for n in (129, 1000, 100_001):
        value = ("0123456789abcdef" * (n // 16 + 1))[:n]
        new, counts = maker.replace(f"key {value}.")
        assert counts == {"secret": 1} and len(new) == n + 5 and value[:32] not in new


def test_very_long_addresses_are_replaced():
    maker = pseudonyms.Pseudonymiser(b"key")
    made = {n: maker.replace("ab" * n + "@mail.example.com") for n in (1, 200, 50_000)}
    for n, (new, counts) in made.items():
        assert counts == {"email": 1} and len(new) == 2 * n + 17 and new != "ab" * n + "@mail.example.com"


def test_an_address_of_single_digits_is_found_alone():
    maker = pseudonyms.Pseudonymiser(b"key")
    new, counts = maker.replace("at 8.8.8.8 now")
    assert counts == {"ip": 1} and maker.replace("at 8.8.8.8 now 2020")[0] == f"{new} 2020"


@pytest.mark.parametrize("after", ["2021", "BIC", "ABCD 1234", "DE89 3704 0044 0532 0130 00", "+34 912 345 678"])
def test_an_iban_before_other_words(after):
    maker = pseudonyms.Pseudonymiser(b"key")
    value = "ES91 2100 0418 4502 0005 1332"
    alone = maker.replace(value)[0]
    new, counts = maker.replace(f"{value} {after}")
    assert alone != value and new.startswith(f"{alone} ")
    assert counts["iban"] == (2 if after.startswith("DE89") else 1)
    assert maker.replace(f"AB12 {value}")[0] == f"AB12 {alone}"


def test_pseudonyms_of_odd_rows(spark):
    rows = docs(spark, [*ODD_ROWS, (9, "card 4111111111111111")]).withColumn("n_card", F.lit("clash"))
    report = pseudonyms.pseudonym_report(rows, b"k")
    assert report.count() == 7 and report.agg(F.sum("n_card")).first()[0] == 1
    stage = pseudonyms.pseudonymised(rows, b"k")
    assert stage.columns == rows.columns and stage.count() == 7
    assert stage.where("text is null").count() == 1
    unchanged = as_tuples(rows.where("doc_id < 9"), "doc_id", "text")
    assert as_tuples(stage.where("doc_id < 9"), "doc_id", "text") == unchanged
    assert pseudonyms.pseudonymised(rows.limit(0), b"k").count() == 0


def test_pseudonym_query(spark, sf_dir):
    texts = dict(queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect())
    maker = pseudonyms.Pseudonymiser(queries.pseudonym_key(spark))
    got = queries.op4_pseudonyms(spark, sf_dir).collect()
    assert {r.doc_id: r.text for r in got} == {i: maker.replace(t)[0] for i, t in texts.items()}
    assert all(len(r.text) == len(texts[r.doc_id]) for r in got)


# --- licences


def test_size_bounds_lose_no_match():
    for n in range(1, 60):
        lo, hi = licences.size_bounds(n, 80)
        for m in range(1, 120):
            if 200 * min(n, m) >= 80 * (n + m):
                assert lo <= m <= hi


def test_licences_of_odd_rows(spark):
    rows = docs(
        spark,
        [
            *ODD_ROWS,
            (10, "text\nReleased under the MIT licence.\nmore"),
            (11, "released *** UNDER the\nMIT License"),
            (12, licences.TEMPLATES["MIT-permission"].replace("sublicense", "lend")),
            (13, "Released under the MIT License. " * 3 + "\n" + "Licensed under CC BY-NC 4.0."),
        ],
    ).withColumn("licence", F.lit(1))
    got = {r.doc_id: (r.licence, r.dice, r.licences, r.n_passages) for r in licences.licences(rows).collect()}
    assert got[1] == got[2] == got[3] == (None, None, "", 0)
    assert got[10] == (None, None, "", 0)  # one word of five is another
    assert got[11] == ("MIT", 1.0, "MIT", 1)
    assert got[12][0] == "MIT-permission" and 0.9 < got[12][1] < 1
    assert got[13][2] == "CC-BY-NC-4.0,MIT"
    assert licences.licences(rows, templates={}).where("n_passages > 0").count() == 0
    assert licences.licences(rows.limit(0)).count() == 0


def test_licence_plan_has_no_python_and_no_shuffle(spark, sf_dir):
    plan = queries.op2_licences(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# --- divergence


def brute_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else set(windows)
    covered = {k for i, w in enumerate(windows) if w in often for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    symbols = len(re.findall("[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    chars = sum(map(len, words))
    return len(words), chars, symbols, len(lines) - len(set(lines)), len(covered), failed


def test_divergence_query(spark, sf_dir):
    texts = dict(queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect())
    got = queries.op7_divergence(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        mine = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert mine == brute_counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_divergence_keeps_clean_texts_and_drops_junk(spark, sf_dir):
    labels = queries.table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = queries.op7_divergence(spark, sf_dir).join(labels, "doc_id").where("not base_failed").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert all(clean) and junk.count(False) > 0


def test_distance_is_jensen_shannon(spark):
    p, q = [0.5, 0.25, 0.25, 0.0], [0.25, 0.25, 0.0, 0.5]
    kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b) if x)
    m = [(x + y) / 2 for x, y in zip(p, q)]
    expected = math.sqrt((kl(p, m) + kl(q, m)) / 2)
    literal = lambda v: F.array(*map(F.lit, v))
    got = spark.range(1).select(divergence.distance(literal(p), literal(q))).first()[0]
    assert got == pytest.approx(expected)


def test_each_distance_rejects_by_itself(spark):
    rng = random.Random(5)
    common, rare = divergence.COMMON_WORDS["en"], ["lorat", "mindel", "tasor", "quenit", "oblar", "firend"]

    def text(share, n=200, upper=False):
        words = [rng.choice(common) if rng.random() < share else rng.choice(rare) + rng.choice(rare) for _ in range(n)]
        return " ".join(w.upper() if upper else w for w in words)

    rows = [(i, text(0.35)) for i in range(40)]
    rows += [(100, text(0.0)), (101, text(0.35, upper=True)), (102, text(0.0, n=79)), (103, text(0.3))]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in divergence.judged(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[i].kept for i in (*range(40), 102, 103))
    # No common words, among usual characters; unusual characters, among usual words.
    assert not got[100].kept and got[100].class_distance <= divergence.MOST_CLASS_DISTANCE
    assert not got[101].kept and got[101].word_distance < got[100].word_distance / 2


def test_word_bound_follows_the_references():
    # A text without common words is (0, ..., 0, 1); the distance by its definition.
    q = [0.125, 0.125, 0.75]
    m = [0.0625, 0.0625, 0.875]
    kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b) if x)
    whole = math.sqrt((kl([0, 0, 1.0], m) + kl(q, m)) / 2)
    bound = divergence.word_bound([{"words": q}, {"words": [0.25, 0.25, 0.5]}])
    assert bound == pytest.approx(max(divergence.WORD_DISTANCE_SHARE * whole, divergence.LEAST_WORD_BOUND))
    assert divergence.word_bound([{"words": [0.0, 0.0, 1.0]}]) == divergence.LEAST_WORD_BOUND
    assert divergence.word_bound([{"words": [0.5, 0.5, 0.0]}]) == divergence.WORD_DISTANCE_SHARE
    assert divergence.word_bound([]) == divergence.LEAST_WORD_BOUND


def test_divergence_of_odd_rows(spark):
    rows = docs(spark, ODD_ROWS).withColumn("words", F.lit("clash")).withColumn("kept", F.lit(None))
    rows = rows.withColumn("lang", F.when(F.col("doc_id") > 2, F.col("lang")))
    got = {(r.doc_id, r.n_words): (r.base_failed, r.kept) for r in divergence.judged(rows).collect()}
    assert got[(1, 0)] == got[(2, 0)] == (True, False) and got[(3, 5000)] == (True, False)
    assert divergence.judged(rows.limit(0)).count() == 0


def test_divergence_has_no_python(spark, sf_dir):
    plan = queries.op7_divergence(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- classifiers

LABELS = "doc_id long, quality int, toxic int"


def test_ftrl_step():
    """One row, by hand: from nothing p = 1/2, so each coordinate has gradient -1/2."""
    z, n = np.zeros(3), np.zeros(3)
    toxicity.learn([np.array([0, 2])], [1], z, n)
    assert z.tolist() == [-0.5, 0, -0.5] and n.tolist() == [0.25, 0, 0.25]
    w = toxicity._weights(np.array([-6.0, 3.0]), np.array([4.0, 4.0]), np.full(2, toxicity.L1))
    assert w[1] == 0 and w[0] == pytest.approx(2 / (3 / toxicity.ALPHA + toxicity.L2))


def brute_ftrl(rows):
    """Weights by feature of (features, label) rows, one coordinate at a time."""
    count = collections.Counter(f for found, _ in rows for f in found)
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(f):
        bound = 0 if f == "bias" else toxicity.L1
        if abs(z[f]) <= bound:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n[f])) / toxicity.ALPHA + toxicity.L2
        return (math.copysign(bound, z[f]) - z[f]) / rate

    rows = [(["bias", *(f for f in found if count[f] >= toxicity.MIN_ROWS)], y) for found, y in rows]
    for _ in range(toxicity.EPOCHS):
        for found, y in rows:
            w = {f: weight(f) for f in found}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for f in found:
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / toxicity.ALPHA * w[f]
                n[f] += g * g
    return {f: weight(f) for f in z if weight(f)}


def test_toxicity_training_by_brute_force(spark):
    """On sf0.01: the weights, whatever the split of the tables, and no miss or false alarm on what was learned."""
    table = queries.table(spark, "/root/testdata/sf0.01", "documents")
    known = queries.table(spark, "/root/testdata/sf0.01", "labels").where(queries.fold(5) != 0)
    sample = table.join(known.where("toxic IS NOT NULL"), "doc_id").withColumn("turn", F.xxhash64("doc_id"))
    sample = sample.select("turn", "doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text")).orderBy("turn")
    rows = [(set(toxicity.hashes(r.text.encode()).tolist()), int(r.toxic), r.text) for r in sample.collect()]
    want = brute_ftrl([r[:2] for r in rows])
    for split in (table, table.repartition(7)):
        model = toxicity.train(split, known)
        assert model.bias == pytest.approx(want["bias"], rel=1e-6)
        assert model.hashes.tolist() == sorted(f for f in want if f != "bias")
        assert model.weights.tolist() == pytest.approx([want[f] for f in model.hashes.tolist()], rel=1e-4)
    assert all((model.score(t.encode()) >= 0.5) == bool(y) for _, y, t in rows)


def test_one_row_of_a_repeated_id_is_learned(spark):
    rows = docs(spark, [*[(1, "a long text of id one")] * 40, (1, "a"), (1, None), (2, None), (3, "other")])
    labels = spark.createDataFrame([(i, 1, 0) for i in (1, 2, 3, 4)] + [(3, 1, 1)], LABELS)
    got = labelled.labelled_sample(rows, labels, "toxic", "doc_id", "text", 2).collect()
    kept = {(r.doc_id, r.label, r.text) for r in got}
    assert len(got) == len(kept) and kept <= {(1, 0, "a"), (2, 0, None), (3, 1, "other")}
    assert (3, 1, "other") in kept


def held_out(spark, sf_dir, query, label):
    labels = queries.table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("y"))
    rows = query(spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    return rows


def test_toxicity_on_the_held_out_fold(spark):
    rows = held_out(spark, "/root/testdata/sf0.1", queries.op8_toxicity, "toxic")
    assert not [r for r in rows if r.y == 0 and r.predicted == 1]
    caught = [r.predicted for r in rows if r.y == 1]
    assert sum(caught) > 0.75 * len(caught)


def test_quality_on_the_held_out_fold(spark):
    rows = held_out(spark, "/root/testdata/sf0.1", queries.op10_neighbours, "quality")
    assert sum(r.predicted == r.y for r in rows) > 0.98 * len(rows)


def test_folds(spark):
    row = spark.range(12345, 12346).select(queries.fold(5, "id").alias("f")).first()
    assert row.f == zlib.crc32(b"12345") % 5


def test_classifiers_of_odd_rows(spark):
    rows = docs(spark, [*ODD_ROWS, (5, "vile words here"), (6, "fine words here")])
    rows = rows.withColumn("score", F.lit("clash")).withColumn("label", F.lit(1))
    labels = spark.createDataFrame(
        [(5, 0, 1), (6, 1, 0), (6, 1, 0), (None, 1, 1), (1, None, None), (2, 1, 0)], LABELS
    )
    none = labels.limit(0)
    for known in (labels, none):
        model = toxicity.train(rows, known)
        assert toxicity.scored(rows, model).count() == 8
        voters = neighbours.train(rows, known)
        scores = neighbours.scored(rows, voters).collect()
        assert len(scores) == 8 and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.drop_toxic(rows, toxicity.train(rows, none)).count() == 8
    empty = rows.limit(0)
    assert toxicity.scored(empty, toxicity.train(empty, labels)).count() == 0
    assert neighbours.scored(empty, neighbours.train(empty, labels)).count() == 0


def test_votes_are_exact_nearest_neighbours():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["a", "B!", "cc", "dd,", "1"], 30)).encode() for _ in range(40)]
    q = np.linalg.qr(rng.normal(size=(neighbours.BUCKETS, 8)))[0]
    space = neighbours.Space(np.ones(neighbours.BUCKETS), q.astype(np.float32))
    vectors, labels = space.rows(texts), rng.integers(0, 2, 40).astype(float)
    got = neighbours.Voters(space, vectors, labels).scores(texts[:5])
    for i in range(5):
        cosines = vectors @ vectors[i]
        best = np.argsort(-cosines, kind="stable")[: neighbours.NEIGHBOURS]
        w = np.maximum(cosines[best], 0).astype(float) ** neighbours.SHARPNESS + 1e-9
        assert got[i] == pytest.approx((w * labels[best]).sum() / w.sum(), abs=1e-5)


def test_tied_voters_all_vote():
    """The order of the voters decides nothing; an empty text gets the sample's share of label 1."""
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(neighbours.BUCKETS, 8)))[0]
    space = neighbours.Space(np.ones(neighbours.BUCKETS), q.astype(np.float32))
    texts = [b"one two three", b"four five six seven", b"eight nine"]
    vectors = np.repeat(space.rows(texts), 20, axis=0)
    labels = np.array(([1.0] * 5 + [0.0] * 15) * 2 + [1.0] * 10 + [0.0] * 10)
    want = neighbours.Voters(space, vectors, labels).scores([*texts, b""])
    for _ in range(5):
        mixed = rng.permutation(len(labels))
        got = neighbours.Voters(space, vectors[mixed], labels[mixed]).scores([*texts, b""])
        assert np.allclose(got, want, rtol=0, atol=1e-6)
    assert np.allclose(want, [0.25, 0.25, 0.5, 20 / 60], rtol=0, atol=1e-6)


# --- cost of the histograms


def test_lower_case_letters_are_not_matched_one_by_one(spark):
    """The letters are counted by what is left without them; totals are no part of what is done for each bin."""
    texts = ["", "aB9|x", "\U0001d41a\U0001d400 \u0130stanbul \u01c5 \u00df 1\u0663", "der die|der $ DIE"]
    docs = spark.createDataFrame([(i, "de", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    counts = divergence.base_counts(docs)
    got = {r["doc_id"]: r["classes"][:4] for r in counts.collect()}
    kinds = [lambda c: unicodedata.category(c) == "Ll", lambda c: unicodedata.category(c) == "Lu"]
    kinds += [lambda c: c in "0123456789", lambda c: c in "#*$%&|<>"]
    assert got == {i: [sum(map(k, t)) for k in kinds] for i, t in enumerate(texts)}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all(text" not in plan and "others" in plan
    one = spark.createDataFrame([([1, 3],)], "n array<long>")
    shares = divergence.once(F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b), lambda t: F.transform("n", lambda n: n / t))
    assert one.select(shares.alias("s")).first()["s"] == [0.25, 0.75]
