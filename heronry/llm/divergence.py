"""Quality rules by distribution divergence.

Each text's histogram of character classes and of common words is compared with those of its languages by
the Jensen-Shannon distance. The references are sums over all rows of a language. Only built-in
expressions are used; texts are read once and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from heronry.session import materialize

# Frequent words of four languages.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich auf des für ist nicht".split(),
    "en": "the of and to a in is that it for was on with be as".split(),
    "es": "de la que el en y los se del las por un no con su".split(),
    "fr": "de la le et les des en un du une que pour est qui par".split(),
}
LANGUAGES = sorted(COMMON_WORDS)
WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})

# The base rule: fewest words, and the largest share of repeated words in hundredths.
LEAST_WORDS = 50
MOST_REPEATED = 50
# Shorter texts are not judged by their histograms, and a language with fewer words has no reference.
GUARD_WORDS = 80
REFERENCE_WORDS = 2_000
# Largest Jensen-Shannon distance of the character classes.
MOST_CLASS_DISTANCE = 0.25
# That of the words follows from the references: this share of what a text without any common word has, as
# most words of every text are in the bin of all others. It is no smaller than the least bound, so that
# references that hold few common words reject nothing.
WORD_DISTANCE_SHARE = 0.8
LEAST_WORD_BOUND = 0.25

BLANK = "[ \\t-\\r]+"


def base_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts of every row: the words, characters, lines and repeats of the base rule, the characters of
    each class, and the occurrences of each common word."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(lang).cast("string").alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("words", F.filter(F.split("text", BLANK), lambda w: w != ""))
    windows = F.transform(
        "words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))
    )
    # The last two words begin no window.
    rows = rows.withColumn("windows", F.slice(windows, 1, F.greatest(F.size("words") - 2, F.lit(0))))
    placed = F.sort_array(
        F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    )
    # Sorting is only needed where some window occurs twice.
    rows = rows.withColumn(
        "sorted",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).otherwise(
            F.array().cast("array<struct<w:bigint,i:int>>")
        ),
    )
    before = lambda i: F.get("sorted", i - 1)["w"]
    after = lambda i: F.get("sorted", i + 1)["w"]
    twice = F.filter(
        "sorted",
        lambda s, i: F.coalesce((i > 0) & (s["w"] == before(i)), F.lit(False))
        | F.coalesce(s["w"] == after(i), F.lit(False)),
    )
    covered = F.size(
        F.array_distinct(F.flatten(F.transform(twice, lambda s: F.sequence(s["i"], s["i"] + 2))))
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    letters = F.split(F.lower(F.regexp_replace("text", "[^\\p{L}]+", " ")), " ")
    common = F.filter(letters, lambda w: w.isin(WORDS))
    # One character for each common word, so that each is counted in a short string.
    marks = {w: chr(ord("!") + i) for i, w in enumerate(WORDS)}
    mark_of = F.create_map(*[F.lit(x) for pair in marks.items() for x in pair])
    rows = rows.withColumn("lines", lines).withColumn(
        "common", F.array_join(F.transform(common, lambda w: F.element_at(mark_of, w)), "")
    )
    # Most characters are lower-case letters. Counting matches makes an array of them, so these are counted by
    # what is left without them, and the others in that.
    rows = rows.withColumn("others", F.regexp_replace("text", "\\p{Ll}+", ""))
    count = F.regexp_count
    classes = {
        "lower": F.length("text") - F.length("others"),
        "upper": count("others", F.lit("\\p{Lu}")),
        "digit": count("others", F.lit("[0-9]")),
        "symbol": count("others", F.lit("[#*$%&|<>]")),
    }
    occurrences = F.transform(
        F.array(*map(F.lit, marks.values())),
        lambda m: (F.octet_length("common") - F.octet_length(F.replace("common", m, F.lit("")))).cast("long"),
    )
    rows = rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length("text").cast("long").alias("chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        *[c.cast("long").alias(name) for name, c in classes.items()],
        occurrences.alias("common"),
    )
    blank = F.col("chars") - F.col("word_chars")
    other = F.col("word_chars") - sum(F.col(c) for c in classes)
    return rows.select(
        "doc_id",
        "lang",
        "n_words",
        "word_chars",
        F.col("symbol").alias("n_symbols"),
        "n_dup_lines",
        "n_repeat_words",
        F.array(*classes, blank, other).alias("classes"),
        # The last bin holds all other words.
        F.concat(
            "common",
            F.array(
                F.greatest(
                    F.col("n_words") - F.aggregate("common", F.lit(0).cast("long"), lambda a, b: a + b),
                    F.lit(0),
                )
            ),
        ).alias("words"),
    )


def references(counts: DataFrame) -> list[dict[str, list[float]]]:
    """Histograms of the languages with at least ``REFERENCE_WORDS`` words.

    Only rows that pass the base rule count. At most a row for each language and bin comes back,
    whatever the data.
    """
    rows = counts.where(~base_failed() & F.col("lang").isin(LANGUAGES))
    sums: dict[str, dict[str, list[int]]] = {}
    for name in ("classes", "words"):
        found = (
            rows.select("lang", F.posexplode(name).alias("bin", "n"))
            .groupBy("lang", "bin")
            .agg(F.sum("n").alias("n"))
            .orderBy("lang", "bin")
            .collect()
        )
        for row in found:
            sums.setdefault(row["lang"], {}).setdefault(name, []).append(row["n"])
    return [
        {name: [x / sum(bins) for x in bins] for name, bins in of.items()}
        for _, of in sorted(sums.items())
        if sum(of["words"]) >= REFERENCE_WORDS
    ]


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``. A lambda evaluates what it uses from outside anew for each element, but not its argument."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def distance(p: Column, q: Column) -> Column:
    """The Jensen-Shannon distance of two histograms: the root of the divergence in bits, 0 to 1."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    # Where a text has nothing, the second part is b itself: the logarithm is 1.
    both = F.zip_with(p, q, lambda a, b: F.when(a > 0, part(a, b) + part(b, a)).otherwise(b))
    total = F.aggregate(both, F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def word_bound(known: list[dict[str, list[float]]]) -> float:
    """The largest distance of the words that a text may have to the nearest of ``known``."""

    def without_common_words(q: list[float]) -> float:
        *common, others = q
        part = math.log2(2 / (1 + others))
        if others > 0:
            part += others * math.log2(2 * others / (1 + others))
        return math.sqrt(max((part + sum(common)) / 2, 0.0))

    nearest = min((without_common_words(of["words"]) for of in known), default=0.0)
    return max(WORD_DISTANCE_SHARE * nearest, LEAST_WORD_BOUND)


def judged(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts, distances and verdict of every row.

    ``base_failed``: too few words, or too many in repeated windows of three. ``kept``: it did not fail,
    and neither distance to the nearest reference is above its bound (for words, :func:`word_bound`). A text
    without any common word is above it, whatever its characters. Texts with fewer than
    ``GUARD_WORDS`` words, and all texts where no language has a reference, are kept unless the base
    rule fails. Null texts have no words; rows whose language is null or unknown are compared with all
    references but add to none. Repeated rows are each returned; an empty table gives no rows.
    """
    counts = materialize(base_counts(docs, id_col, text, lang), "counts")
    known = references(counts)

    def nearest(name: str) -> Column:
        """Distance to the nearest language; 0 where there is none."""
        if not known:
            return F.lit(0.0)
        each = F.array(*[F.array(*map(F.lit, of[name])) for of in known])
        total = F.greatest(F.aggregate(name, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(1))
        return once(
            total,
            lambda t: once(
                F.transform(name, lambda n: n / t),
                lambda shares: F.array_min(F.transform(each, lambda q: distance(shares, q))),
            ),
        )

    rows = counts.withColumn("class_distance", nearest("classes")).withColumn(
        "word_distance", nearest("words")
    )
    near = (F.col("class_distance") <= MOST_CLASS_DISTANCE) & (F.col("word_distance") <= word_bound(known))
    kept = ~F.col("base_failed") & ((F.col("n_words") < GUARD_WORDS) | near)
    return rows.withColumn("base_failed", base_failed()).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        kept.alias("kept"),
        "class_distance",
        "word_distance",
    )
