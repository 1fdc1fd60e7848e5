"""Writing rows and counting what was kept, dropped and bad in the same pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

TOTAL = "row_count"


def rule_counts(rules: dict[str, Column]) -> list[Column]:
    """Rows in all, rows that meet every rule, and per rule the rows that fail it; a rule that is null for a row
    fails."""
    met = F.lit(True)
    for rule in rules.values():
        met = met & F.coalesce(rule, F.lit(False))
    failed = [F.count_if(~F.coalesce(r, F.lit(False))).alias(f"failed_{n}") for n, r in rules.items()]
    return [F.count(F.lit(1)).alias(TOTAL), F.count_if(met).alias("kept"), *failed]


def meeting(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    for rule in rules.values():
        df = df.where(F.coalesce(rule, F.lit(False)))
    return df


def write_meeting(df: DataFrame, path: str, rules: dict[str, Column], mode: str = "errorifexists") -> dict[str, int]:
    """Write the rows that meet all rules, and return the counts of :func:`rule_counts` over all rows. They are
    taken while the rows pass on their way to the files: ``df`` is evaluated once and nothing is read back."""
    seen = Observation()
    meeting(df.observe(seen, *rule_counts(rules)), rules).write.mode(mode).parquet(path)
    return {name: int(n) for name, n in seen.get.items()}


def counting(stream: DataFrame, name: str, rules: dict[str, Column]) -> DataFrame:
    """The rows of a stream that meet all rules; each batch reports the counts over all of its rows under
    ``name`` (see :func:`reported`)."""
    return meeting(stream.observe(name, *rule_counts(rules)), rules)


def reported(query: StreamingQuery, name: str) -> list[dict[str, int]]:
    """The counts of every batch with rows that the query still remembers, oldest first. A query remembers as
    many batches as ``spark.sql.streaming.numRecentProgressUpdates`` says; a listener sees all of them."""
    found = {}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        if row is not None and row[TOTAL]:
            found[progress.batchId] = {k: int(v) for k, v in row.asDict().items()}
    return [found[b] for b in sorted(found)]
