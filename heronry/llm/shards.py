"""Sharding by vector bin packing.

Rows with one text form a group. Groups are placed, largest first, on the shard where the dot product of
their bytes, tokens and rows with the shard's residual capacity is highest. However many groups there
are, only a bounded number of items is placed: groups above a small share of the whole one by one, all
others in bundles made by a hash of the group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from heronry.session import materialize

SHARDS = 8
# Number of bundles for each shard. A group above one part in ``shards * BUNDLES`` of all bytes, tokens or
# rows is placed by itself; there are at most ``3 * shards * BUNDLES`` of those.
BUNDLES = 1024
# Parts of a shard whose rows are numbered independently.
NUMBERED_PARTS = 1024
# A group above this share of a shard's bytes is dealt out in pieces of at most this share.
WHOLE_GROUP = 0.9


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item, given as (bytes, tokens, rows).

    Capacities are equal. The largest items are placed first, each on the shard whose residual capacity
    has the highest dot product with the item; of equal ones, the shard with most bytes left, then the
    first. A shard with no bytes left for the item is taken only if none has room.
    """
    total = np.maximum(items.sum(axis=0), 1)
    need = items / total * shards
    left = np.ones((shards, 3))
    chosen = np.zeros(len(items), np.int64)
    for i in np.lexsort((np.arange(len(items)), -need.sum(axis=1), -need[:, 0])):
        fit = left @ need[i]
        room = left[:, 0] >= need[i, 0]
        order = np.lexsort((np.arange(shards), -left[:, 0], -fit, ~room))
        if not room.any():
            order = np.lexsort((np.arange(shards), -left[:, 0]))
        chosen[i] = order[0]
        left[order[0]] -= need[i]
    return chosen


def pack(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, tokens, shard, slot) of every row.

    ``size`` is the text's UTF-8 bytes plus one; a null text has none, and CRC 0. ``tokens`` counts words
    between blanks. Rows with one text share a shard, unless they make up more than ``WHOLE_GROUP`` of a
    shard's bytes; null texts are a group as well. ``slot`` numbers a shard's rows from 0 without gaps,
    in no order that means anything. Repeated rows and rows without an id are placed like others; an
    empty table gives no rows. Other columns are not read.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(body) + F.lit(1).cast("long")).alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.size(F.filter(F.split(body, "[ \\t-\\r]+"), lambda w: w != "")).cast("long").alias("tokens"),
            F.when(F.col(text).isNull(), F.lit("null")).otherwise(F.md5(body)).alias("group"),
        ),
        "sizes",
    )
    totals = rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    totals = [max(1, t or 0) for t in totals]
    # A hot group is dealt out in pieces by a hash of the id.
    groups = rows.groupBy("group").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    share = F.greatest(
        F.col("bytes") / totals[0], F.col("tokens") / totals[1], F.col("rows") / totals[2]
    )
    large = groups.where(share > 1 / (shards * BUNDLES)).withColumn(
        "pieces", F.ceil(F.col("bytes") * shards / totals[0] / WHOLE_GROUP)
    )
    # At most 3 * shards * BUNDLES rows.
    large = materialize(large.select("group", "pieces"), "large")
    piece = F.pmod(F.xxhash64("doc_id", "group"), F.col("pieces"))
    item = F.when(F.col("pieces").isNotNull(), F.concat_ws("/", "group", piece)).otherwise(
        F.concat(F.lit("bundle/"), F.pmod(F.xxhash64("group"), F.lit(shards * BUNDLES)).cast("string"))
    )
    named = rows.join(F.broadcast(large), "group", "left").withColumn("item", item)
    # At most shards * BUNDLES bundles and the pieces of the large groups come to the driver.
    items = (
        named.groupBy("item")
        .agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
        .orderBy("item")
        .toPandas()
    )
    items["shard"] = place(items[["bytes", "tokens", "rows"]].to_numpy(float), shards)
    spark = docs.sparkSession
    placed = spark.createDataFrame(
        list(zip(items["item"].tolist(), items["shard"].tolist())), "item string, shard int"
    )
    sharded = materialize(
        named.join(F.broadcast(placed), "item")
        .withColumn("part", F.pmod(F.xxhash64("doc_id", "size"), F.lit(NUMBERED_PARTS)))
        .select("doc_id", "size", "text_crc32", "tokens", "shard", "part"),
        "sharded",
    )
    # shards * NUMBERED_PARTS rows.
    counts = sharded.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")
    )
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "size"))
    return (
        sharded.withColumn("number", number)
        .join(F.broadcast(begins), ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "tokens",
            "shard",
            (F.col("begin") + F.col("number") - 1).alias("slot"),
        )
    )
