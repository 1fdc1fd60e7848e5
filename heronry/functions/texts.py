"""Caption text and column-name cleaning."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

# Everything that counts as white space at the ends of a caption line.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Characters a column name may not keep; a blank becomes an underscore.
FORBIDDEN_IN_NAMES = ";{}()\n\t="


def caption_text(captions: Column) -> Column:
    """The spoken text of a caption file: cue times, NOTE lines and blank lines dropped,
    the rest joined by single blanks. Any line ending will do, since blank lines are dropped."""
    lines = F.split(F.replace(captions, F.lit("\r"), F.lit("\n")), "\n")
    spoken = F.filter(
        F.transform(lines, lambda line: F.btrim(line, F.lit(BLANKS))),
        lambda line: (line != "") & ~line.startswith("NOTE") & ~line.contains("-->"),
    )
    return F.array_join(spoken, " ")


def clean_name(name: str) -> str:
    """A column name without forbidden characters and with blanks as underscores."""
    return re.sub(f"[{re.escape(FORBIDDEN_IN_NAMES)}]", "", name.replace(" ", "_"))


def clean_names(df: DataFrame) -> DataFrame:
    """Clean every column name in one projection; names that collide afterwards are an error."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"column names collide after cleaning: {', '.join(clashes)}")
    return df.toDF(*names)


def strip_names(df: DataFrame) -> DataFrame:
    """Remove blanks around every column name."""
    return df.toDF(*[c.strip() for c in df.columns])
