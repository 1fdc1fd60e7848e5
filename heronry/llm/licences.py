"""Licence scans: passages compared with licence templates by the Dice coefficient of word bigrams.

Everything is a built-in expression over one row: no shuffle, and no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The wordings of licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
        "in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software."
    ),
}

# Least Dice coefficient of a match, in hundredths.
LEAST_PERCENT = 80

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_bigrams(text: str) -> list[str]:
    """Distinct bigrams of the normalised words, sorted."""
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower().split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, percent: int) -> tuple[int, int]:
    """Sizes that a set can have to reach the coefficient with a set of ``n``: 2 * min / (a + b) must."""
    return -(-n * percent // (200 - percent)), n * (200 - percent) // percent


def _bigrams(passage: Column) -> Column:
    """Distinct bigrams of a passage whose words are parted by single blanks."""
    words = F.split(passage, " ")
    pairs = F.zip_with(
        words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    # The last word has no successor, so its pair is null.
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def licences(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    percent: int = LEAST_PERCENT,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, licence, dice, licences, n_passages) of every row.

    Passages are the text's lines, its paragraphs (lines up to an empty one) and the whole text, each
    counted once, in lower case with everything but ASCII letters and digits as blanks. A passage
    matches a template if the Dice coefficient of their distinct word bigrams is at least ``percent``
    hundredths; templates whose size rules that out are not compared. ``licence`` is the best match (of
    equal ones, the first name), ``licences`` all names, ``n_passages`` the number of matching passages.
    A text without a match, an empty one and a null one have null, null, an empty string and 0. Repeated
    rows are each returned; an empty table gives no rows; other columns are not read.
    """
    known = {name: template_bigrams(t) for name, t in (TEMPLATES if templates is None else templates).items()}
    known = {name: grams for name, grams in sorted(known.items()) if grams}
    bounds = [size_bounds(len(grams), percent) for grams in known.values()]
    plain = F.regexp_replace(
        F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER), "[^a-z0-9\\n]+", " "
    )
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), plain.alias("plain"))

    def flat(passage: Column) -> Column:
        return F.trim(F.translate(passage, "\n", " "))

    def in_bounds(passage: Column) -> Column:
        # Distinct bigrams are at most words - 1, so a shorter passage cannot reach the least bound.
        least = min((lo for lo, _ in bounds), default=1)
        return F.length(passage) - F.length(F.replace(passage, F.lit(" "), F.lit(""))) >= least

    single = F.regexp_replace(F.regexp_replace("plain", " *\\n *", "\n"), " +", " ")
    rows = rows.select("doc_id", single.alias("plain"))
    lines = F.split("plain", "\n")
    paragraphs = F.transform(F.split("plain", "\n\n+"), flat)
    passages = F.array_distinct(
        F.filter(F.concat(F.transform(lines, lambda x: F.trim(x)), paragraphs, F.array(flat(F.col("plain")))), in_bounds)
    )
    # A long passage may repeat few bigrams, so the upper bound applies to the distinct ones.
    most = max((hi for _, hi in bounds), default=0)
    grams = F.filter(
        F.transform(F.transform(passages, lambda p: F.regexp_replace(p, " +", " ")), _bigrams),
        lambda g: (F.size(g) <= most) & (F.size(g) > 0),
    )
    rows = rows.select("doc_id", grams.alias("passages"))

    def matches(passage: Column) -> Column:
        found = []
        for (name, grams_of), (lo, hi) in zip(known.items(), bounds):
            shared = F.size(F.array_intersect(passage, F.array(*map(F.lit, grams_of))))
            total = F.size(passage) + len(grams_of)
            fits = F.size(passage).between(lo, hi)
            # Not evaluated outside the size bounds.
            score = F.when(fits, F.when(200 * shared >= percent * total, 2.0 * shared / total))
            found.append(F.struct(score.alias("dice"), F.lit(name).alias("name")))
        all_found = F.array(*found).cast("array<struct<dice:double,name:string>>")
        return F.filter(all_found, lambda m: m["dice"].isNotNull())

    rows = rows.select("doc_id", F.filter(F.transform("passages", matches), lambda m: F.size(m) > 0).alias("m"))
    rows = rows.select("doc_id", F.size("m").alias("n"), F.flatten("m").alias("m"))
    dice = F.array_max(F.transform("m", lambda m: m["dice"]))
    names = F.array_sort(F.array_distinct(F.transform("m", lambda m: m["name"])))
    rows = rows.withColumn("dice", dice)
    best = F.array_min(F.transform(F.filter("m", lambda m: m["dice"] == F.col("dice")), lambda m: m["name"]))
    return rows.select(
        "doc_id",
        best.alias("licence"),
        "dice",
        F.array_join(names, ",").alias("licences"),
        F.col("n").cast("long").alias("n_passages"),
    )
