"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heronry.llm import (
    bpe,
    collisions,
    collocations,
    decontaminate,
    divergence,
    licences,
    neighbours,
    pseudonyms,
    shards,
    simhash,
    toxicity,
    variants,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

# Key of the pseudonyms where the session names none.
DEFAULT_KEY = "not a secret: set heronry.pseudonyms.key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int, id_col: str = "doc_id") -> Column:
    """The fold of a row: CRC-32 of its id as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string")) % parts


def pseudonym_key(spark: SparkSession) -> bytes:
    return spark.conf.get("heronry.pseudonyms.key", DEFAULT_KEY).encode()


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    # The other queries do not need the vocabulary files.
    import public_tokenizers

    return bpe.Tokenizer(
        spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learned from the labelled rows outside fold 0 of 5."""
    labels = table(spark, sf_dir, "labels").where(fold(5) != 0)
    return toxicity.train(docs, labels)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer(spark))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.pack(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonym_report(table(spark, sf_dir, "documents"), pseudonym_key(spark))


def op5_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judged(table(spark, sf_dir, "documents")).drop(
        "class_distance", "word_distance"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.scored(docs, toxicity_model(spark, docs, sf_dir))
    return rows.select(
        "doc_id",
        (fold(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold(3) != 1)
    return neighbours.scored(docs, neighbours.train(docs, labels)).select(
        "doc_id",
        (fold(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_licences": op2_licences,
    "op3_vector_packing": op3_vector_packing,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_suffix_arrays": op5_suffix_arrays,
    "op6_simhash": op6_simhash,
    "op7_divergence": op7_divergence,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_neighbours": op10_neighbours,
    "op11_collision_counting": op11_collision_counting,
    "op12_collocations": op12_collocations,
    "op13_variants": op13_variants,
}

CONTAMINATION_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT row_number() OVER () AS t, CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT t, item, i AS place_in, least(len(w), 10) AS n,
    array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS s
  FROM item, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS g(i)
  WHERE len(w) > 0
), place AS (
  SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM doc, (SELECT DISTINCT n FROM win), unnest(generate_series(1, len(w) - n + 1)) AS g(i)
), occurs AS (
  SELECT p.r, p.i, p.n, win.item, win.t, win.place_in FROM place p JOIN win ON p.s = win.s AND p.n = win.n
), hit AS (
  SELECT r, count(DISTINCT k) AS n_hit
  FROM (SELECT DISTINCT r, i, n FROM occurs), unnest(generate_series(i, i + n - 1)) AS g(k)
  GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha
  FROM (SELECT DISTINCT r, item FROM occurs) GROUP BY r
), run AS (
  SELECT r, item, min(i) AS i, count(*) - 1 + max(n) AS n
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, t, i - place_in ORDER BY i) AS same FROM occurs)
  GROUP BY r, item, t, i - place_in, same
), longest AS (
  SELECT r, item, i, n FROM run QUALIFY row_number() OVER (PARTITION BY r ORDER BY n DESC, i, item) = 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n, 0) AS BIGINT) AS longest_words,
  item AS longest_item, CAST(i - 1 AS BIGINT) AS longest_at
FROM doc LEFT JOIN hit USING (r) LEFT JOIN items USING (r) LEFT JOIN longest USING (r)
"""

LICENCES_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_replace(regexp_replace(regexp_replace(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^a-z0-9\n]+', ' ', 'g'), ' *\n *', chr(10), 'g'), ' +', ' ', 'g') AS plain
  FROM documents
), passage AS (
  SELECT DISTINCT r, trim(s) AS s FROM (
    SELECT r, unnest(string_split(plain, chr(10))) AS s FROM doc
    UNION ALL
    SELECT r, replace(unnest(string_split_regex(plain, '\n\n+')), chr(10), ' ') FROM doc
    UNION ALL
    SELECT r, replace(plain, chr(10), ' ') FROM doc
  )
), split AS (
  SELECT r, s, string_split(regexp_replace(s, ' +', ' ', 'g'), ' ') AS w FROM passage
), pair AS (
  SELECT DISTINCT r, s, w[i] || ' ' || w[i + 1] AS g
  FROM split, unnest(generate_series(1, len(w) - 1)) AS t(i)
), size AS (
  SELECT r, s, count(*) AS n FROM pair GROUP BY r, s
), template(name, g) AS (VALUES
  {templates}
), total AS (
  SELECT name, count(*) AS n FROM template GROUP BY name
), shared AS (
  SELECT r, s, name, count(*) AS n FROM pair JOIN template USING (g) GROUP BY r, s, name
), found AS (
  SELECT shared.r, shared.s, shared.name, 2.0::DOUBLE * shared.n / (size.n + total.n) AS dice
  FROM shared JOIN size ON shared.r = size.r AND shared.s = size.s JOIN total ON shared.name = total.name
  WHERE 200 * shared.n >= {percent} * (size.n + total.n)
), best AS (
  SELECT r, arg_min(name, (-dice, name)) AS licence, max(dice) AS dice,
    string_agg(DISTINCT name, ',' ORDER BY name) AS licences, count(DISTINCT s) AS n_passages
  FROM found GROUP BY r
)
SELECT doc_id, licence, dice, coalesce(licences, '') AS licences,
  CAST(coalesce(n_passages, 0) AS BIGINT) AS n_passages
FROM doc LEFT JOIN best USING (r)
""".format(
    percent=licences.LEAST_PERCENT,
    templates=",\n  ".join(
        f"('{name}', '{gram}')"
        for name, text in licences.TEMPLATES.items()
        for gram in licences.template_bigrams(text)
    ),
)

DIVERGENCE_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM doc, unnest(generate_series(1, len(w) - 2)) AS g(i)
), repeated AS (
  SELECT r, count(DISTINCT k) AS n
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win),
    unnest(generate_series(i, i + 2)) AS g(k)
  WHERE c > 1 GROUP BY r
), line AS (
  SELECT r, count(*) - count(DISTINCT x) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM doc)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r
), base AS (
  SELECT r, doc_id, lang, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    coalesce(line.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM doc LEFT JOIN line USING (r) LEFT JOIN repeated USING (r)
), judged AS (
  SELECT *, n_words < {least_words} OR 100 * n_repeat_words > {most_repeated} * n_words AS base_failed
  FROM base
), class AS (
  SELECT r, len(regexp_extract_all(t, '\p{{Ll}}')) AS lower, len(regexp_extract_all(t, '\p{{Lu}}')) AS upper,
    len(regexp_extract_all(t, '[0-9]')) AS digit, n_symbols AS symbol, length(t) - word_chars AS blank,
    word_chars - lower - upper - digit - symbol AS other
  FROM judged
), common AS (
  SELECT r, x AS bin, count(*) AS n
  FROM (SELECT r, unnest(string_split(lower(regexp_replace(t, '[^\p{{L}}]+', ' ', 'g')), ' ')) AS x FROM doc)
  WHERE x IN ({words}) GROUP BY r, x
), hist AS (
  SELECT r, 'class' AS kind, bin, n FROM class
  UNPIVOT (n FOR bin IN (lower, upper, digit, symbol, blank, other))
  UNION ALL
  SELECT r, 'word', bin, n FROM common
  UNION ALL
  SELECT r, 'word', '*', greatest(n_words - coalesce(c, 0), 0)
  FROM judged LEFT JOIN (SELECT r, sum(n) AS c FROM common GROUP BY r) USING (r)
), share AS (
  SELECT r, kind, bin, CAST(n AS DOUBLE) / greatest(sum(n) OVER (PARTITION BY r, kind), 1) AS p FROM hist
), pooled AS (
  SELECT lang, kind, bin, sum(n) AS n FROM hist JOIN judged USING (r)
  WHERE NOT base_failed AND lang IN ({languages}) GROUP BY lang, kind, bin
), reference AS (
  SELECT lang, kind, bin, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY lang, kind) AS q
  FROM pooled
  WHERE lang IN (SELECT lang FROM pooled WHERE kind = 'word' GROUP BY lang HAVING sum(n) >= {reference_words})
), pair AS (
  SELECT s.r, f.lang, f.kind, s.p, f.q FROM share s JOIN reference f ON s.kind = f.kind AND s.bin = f.bin
  UNION ALL
  SELECT a.r, f.lang, f.kind, 0, f.q FROM (SELECT r FROM doc) a, reference f
  WHERE NOT EXISTS (SELECT 1 FROM share s WHERE s.r = a.r AND s.kind = f.kind AND s.bin = f.bin)
  UNION ALL
  SELECT s.r, l.lang, s.kind, s.p, 0 FROM share s, (SELECT DISTINCT lang FROM reference) l
  WHERE NOT EXISTS (SELECT 1 FROM reference f WHERE f.lang = l.lang AND f.kind = s.kind AND f.bin = s.bin)
), far AS (
  SELECT r, kind, min(d) AS d FROM (
    SELECT r, lang, kind, sqrt(greatest(sum(
      CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d
    FROM pair GROUP BY r, lang, kind) GROUP BY r, kind
), bound AS (
  SELECT greatest({word_share} * min(d), {least_word_bound}) AS most FROM (
    SELECT sqrt(greatest(sum(CASE WHEN bin <> '*' THEN q ELSE log2(2 / (1 + q))
      + CASE WHEN q > 0 THEN q * log2(2 * q / (1 + q)) ELSE 0 END END) / 2, 0)) AS d
    FROM reference WHERE kind = 'word' GROUP BY lang)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND (n_words < {guard_words} OR (coalesce(c.d, 0) <= {class_distance}
    AND coalesce(w.d, 0) <= coalesce(most, {least_word_bound}))) AS kept
FROM judged CROSS JOIN bound LEFT JOIN (FROM far WHERE kind = 'class') c USING (r)
LEFT JOIN (FROM far WHERE kind = 'word') w USING (r)
""".format(
    least_words=divergence.LEAST_WORDS,
    most_repeated=divergence.MOST_REPEATED,
    guard_words=divergence.GUARD_WORDS,
    reference_words=divergence.REFERENCE_WORDS,
    class_distance=divergence.MOST_CLASS_DISTANCE,
    word_share=divergence.WORD_DISTANCE_SHARE,
    least_word_bound=divergence.LEAST_WORD_BOUND,
    languages=", ".join(f"'{x}'" for x in divergence.LANGUAGES),
    words=", ".join(f"'{x}'" for x in divergence.WORDS),
)

WARC_SQL = """
WITH page AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest,
    CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first_id
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM page
"""

COLLOCATIONS_SQL = r"""
WITH piece AS (
  SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS s
    FROM documents)
), gram AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM piece, unnest([1, 2, 3, 4]) AS t(k), unnest(generate_series(1, len(w) - k + 1)) AS g(i)
), f AS (
  SELECT lang, k, phrase, count(*) AS c, string_split(phrase, ' ') AS w FROM gram GROUP BY lang, k, phrase
), total AS (
  SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang
), candidate AS (
  SELECT * FROM f WHERE k >= 2 AND c >= {least}
), cut AS (
  SELECT q.lang, q.phrase, q.c AS a, i, x.c AS l, y.c AS r,
    CAST({scale}::HUGEINT * q.c // (x.c + y.c) AS BIGINT) AS score
  FROM candidate q, unnest(generate_series(1, q.k - 1)) AS g(i)
  JOIN f x ON x.lang = q.lang AND x.phrase = array_to_string(list_slice(q.w, 1, i), ' ')
  JOIN f y ON y.lang = q.lang AND y.phrase = array_to_string(list_slice(q.w, i + 1, q.k), ' ')
), weakest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), inside AS (
  SELECT lang, array_to_string(list_slice(w, i, i + s - 1), ' ') AS phrase, max(c) AS longest
  FROM candidate, unnest(generate_series(2, k - 1)) AS t(s), unnest(generate_series(1, k - s + 1)) AS g(i)
  GROUP BY ALL
), ranked AS (
  SELECT weakest.*, row_number() OVER (PARTITION BY weakest.lang ORDER BY score DESC, a DESC, weakest.phrase) AS rank
  FROM weakest LEFT JOIN inside ON inside.lang = weakest.lang AND inside.phrase = weakest.phrase
  WHERE longest IS NULL OR 100 * longest < {covered} * a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN total USING (lang) WHERE rank <= {top}
""".format(
    least=collocations.LEAST,
    scale=collocations.SCALE,
    covered=collocations.COVERED,
    top=collocations.TOP,
)

ORACLES: dict[str, str] = {
    "op2_licences": LICENCES_SQL,
    "op5_suffix_arrays": CONTAMINATION_SQL,
    "op7_divergence": DIVERGENCE_SQL,
    "op9_warc": WARC_SQL,
    "op12_collocations": COLLOCATIONS_SQL,
}
