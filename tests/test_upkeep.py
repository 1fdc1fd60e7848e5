"""Schema versions, partitions, buckets, counted writes, clusters and table graphs."""

import glob
import os
import re
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from heronry.operators import clustering, evolution, keyed
from heronry.operators.evolution import IncompatibleSchema, field
from heronry.plans import upkeep
from heronry.plans.storage import COUNTERS, RECENCY, two_periods
from heronry.plans.views import table
from heronry.session import fresh_path
from heronry.sinks import bucketed, counted, partitions, versions
from heronry.sinks.graph import TableGraph
from heronry.streaming import runs


def struct(*fields):
    return T.StructType(list(fields))


# --- versions of a schema


@pytest.mark.parametrize(
    "writer, reader, fits",
    [
        ("int", "bigint", True),
        ("bigint", "int", False),
        ("tinyint", "double", True),
        ("float", "double", True),
        ("double", "float", False),
        ("string", "binary", True),
        ("string", "int", False),
        ("date", "timestamp_ntz", True),
        ("int", "decimal(10,0)", True),
        ("int", "decimal(10,1)", False),
        ("decimal(5,2)", "decimal(7,3)", True),
        ("decimal(5,2)", "decimal(6,4)", False),
        ("array<int>", "array<bigint>", True),
        ("array<bigint>", "array<int>", False),
        ("map<string,int>", "map<string,double>", True),
        ("map<string,int>", "map<int,int>", False),
        ("struct<a:int>", "struct<a:bigint>", True),
        ("struct<a:int>", "struct<a:int,b:int>", False),
        ("array<struct<a:int,b:int>>", "array<struct<b:bigint>>", True),
    ],
)
def test_promotions(spark, writer, reader, fits):
    found = evolution.problems(struct(field("x", reader)), struct(field("x", writer)))
    assert (not found) == fits


def test_names_defaults_and_required_fields(spark):
    old = struct(field("id", "int", required=True), field("name", "string"))
    renamed = struct(field("id", "int"), field("full", "string", "name"))
    assert evolution.problems(renamed, old) == []
    assert evolution.problems(old, renamed) == ["id may be null", "name is missing and has no default"]
    assert evolution.problems(struct(field("x", "int", default=None)), old) == []
    with pytest.raises(ValueError):
        evolution.violations(old, [], "SIDEWAYS")


def test_transitive_rules_look_at_every_version(spark):
    first, second = struct(field("a", "int")), struct(field("a", "int"), field("b", "int", default=0))
    third = struct(field("a", "int"), field("b", "int"))
    assert evolution.violations(third, [first, second], "BACKWARD") == []
    assert evolution.violations(third, [first, second], "BACKWARD_TRANSITIVE") == ["b is missing and has no default"]
    assert evolution.violations(third, [], "FULL_TRANSITIVE") == []


def test_writer_refuses_an_incompatible_version(spark, sf_dir):
    root = fresh_path(spark, "refusing")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    first = struct(field("id", "bigint"), field("name", "string"))
    assert evolution.append_version(evolution.declared(customer, first), root, "FULL") == 1
    narrow = struct(field("id", "int"), field("name", "string"))
    with pytest.raises(IncompatibleSchema, match="id is bigint and not int"):
        evolution.append_version(evolution.declared(customer, narrow), root, "BACKWARD")
    assert versions.committed(spark, root) == [1]
    wider = struct(field("id", "bigint"), field("name", "string"), field("note", "string", default="none"))
    rows = evolution.declared(customer.withColumn("note", F.lit("new")), wider)
    assert evolution.append_version(rows, root, "FULL") == 2
    assert evolution.version_schemas(spark, root)[2]["note"].metadata == {"default": '"none"'}
    read = evolution.read_resolved(spark, root, wider)
    assert {tuple(r) for r in read.groupBy("note").count().collect()} == {
        ("none", customer.count()), ("new", customer.count())
    }


def test_nested_rows_are_resolved(spark):
    writer = "id int, who struct<name:string,old:int>, tags array<struct<k:int>>, m map<string,int>"
    rows = spark.createDataFrame(
        [(1, ("a", 5), [(1,), (2,)], {"x": 1}), (2, None, None, None), (None, (None, None), [None], {})], writer
    )
    who = struct(field("label", "string", "name"), field("age", "bigint", "old"), field("city", "string", default="?"))
    reader = struct(
        field("id", "bigint"),
        T.StructField("who", who),
        T.StructField("tags", T.ArrayType(struct(field("k", "double")))),
        field("m", "map<string,bigint>"),
        field("list", "array<int>", default=[1, 2]),
    )
    got = [r.asDict(True) for r in evolution.resolved(rows, reader).orderBy(F.desc_nulls_last("id")).collect()]
    assert got[0] == {"id": 2, "who": None, "tags": None, "m": None, "list": [1, 2]}
    assert got[1]["who"] == {"label": "a", "age": 5, "city": "?"} and got[1]["tags"] == [{"k": 1.0}, {"k": 2.0}]
    assert got[2]["who"] == {"label": None, "age": None, "city": "?"} and got[2]["tags"] == [None]
    with pytest.raises(IncompatibleSchema):
        evolution.resolved(rows, struct(field("id", "string")))


# --- partitions that change


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=*/*.parquet")}


def test_update_writes_only_its_partition(spark, sf_dir):
    path, schema = upkeep.monthly_orders(spark, sf_dir)
    before = files_of(path)
    time.sleep(0.05)
    condition = (F.col("month") == "1996-03") & (F.col("o_orderstatus") == "F")
    touched = partitions.update_partitions(
        spark, path, schema, "month", "o_orderkey", "o_totalprice", F.lit(0.0), condition
    )
    after = files_of(path)
    assert touched == ["1996-03"]
    kept = {f: t for f, t in before.items() if "month=1996-03" not in f}
    assert kept and {f: t for f, t in after.items() if "month=1996-03" not in f} == kept
    assert {f for f in before if "month=1996-03" in f}.isdisjoint(after)
    assert partitions.update_partitions(
        spark, path, schema, "month", "o_orderkey", "o_totalprice", F.lit(0.0), F.col("month") == "1800-01"
    ) == []
    assert files_of(path) == after


def test_merge_writes_only_named_partitions_and_removes_empty_ones(spark, sf_dir):
    path, schema = upkeep.monthly_orders(spark, sf_dir)
    before = files_of(path)
    orders = spark.read.schema(schema).parquet(path)
    gone = orders.where("month = '1995-05'").withColumns({"action": F.lit("delete"), "step": F.lit(1)})
    more = (
        orders.where("month = '1995-06'")
        .limit(1)
        .withColumns({"o_orderkey": F.lit(-5).cast("long"), "action": F.lit("insert"), "step": F.lit(1)})
    )
    n = gone.count()
    changes = gone.unionByName(more)
    partitions.merge_partitions(spark, path, schema, "month", "o_orderkey", changes, "o_orderkey", ["step"])
    after = files_of(path)
    other = lambda files: {f: t for f, t in files.items() if not re.search("month=1995-0[56]", f)}
    assert other(after) == other(before) and not any("1995-05" in f for f in after)
    now = spark.read.schema(schema).parquet(path)
    assert now.where("o_orderkey = -5").count() == 1
    assert now.count() == table(spark, sf_dir, "orders").count() - n + 1


def test_rows_without_a_partition_value_are_updated(spark):
    path = fresh_path(spark, "null-partition")
    rows = spark.createDataFrame([(1, 1.0, None), (2, 1.0, "a")], "id long, v double, month string")
    partitions.overwrite_partitions(rows, path, "month", "id")
    touched = partitions.update_partitions(spark, path, rows.schema, "month", "id", "v", F.lit(9.0), F.col("id") == 1)
    assert touched == [None]
    assert sorted(spark.read.schema(rows.schema).parquet(path).select("id", "v").collect()) == [(1, 9.0), (2, 1.0)]


# --- buckets


def test_merge_shuffles_the_batch_only(spark, sf_dir):
    older, newer = two_periods(spark, sf_dir)
    name = "stored_metrics"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for buckets in (2, 4, 16):
            bucketed.save_bucketed(older, name, "customer_id", buckets, fresh_path(spark, "metrics"))
            stored = spark.table(name)
            batch = spark.createDataFrame(newer.collect(), newer.schema)
            merged = bucketed.merged_metrics(stored, batch, "customer_id", COUNTERS, RECENCY, "last_update_time")
            plan = merged._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
            assert "Bucketed: true" in plan
            additive = keyed.merge_additive(older, newer, "customer_id", COUNTERS, RECENCY, "last_update_time")
            assert sorted(merged.collect(), key=str) == sorted(additive.collect(), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_merge_of_odd_rows(spark):
    """Keys of one side, null keys, null counters, equal times and later ones."""
    schema = "k long, n long, v double, day int, at timestamp_ntz"
    at = lambda d: None if d is None else __import__("datetime").datetime(2024, 1, d)
    old = [(1, 2, 0.1, 5, at(3)), (2, None, None, 1, at(1)), (None, 1, 1.0, 1, at(1)), (4, 1, 1e300, 2, None)]
    new = [(1, 3, 0.2, 4, at(2)), (2, 1, 2.5, 2, at(1)), (3, 7, 0.3, 1, at(9)), (4, 1, 1e300, 1, None)]
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    got = bucketed.merged_metrics(a, b, "k", ["n", "v"], ["day", "at"], "at")
    want = keyed.merge_additive(a, b, "k", ["n", "v"], ["day", "at"], "at")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert bucketed.merged_metrics(a.limit(0), b.limit(0), "k", ["n"], ["at"], "at").count() == 0


# --- counts from the write itself


def test_rows_are_counted_in_the_pass_that_writes_them(spark):
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("id", "IF(id % 7 = 0, NULL, id) AS v").mapInArrow(seen, "id long, v long")
    path = fresh_path(spark, "counted")
    counts = counted.write_meeting(rows, path, {"known": F.col("v").isNotNull(), "small": F.col("v") < 500})
    assert evaluated.value == 1000
    assert counts == {"row_count": 1000, "kept": 428, "failed_known": 143, "failed_small": 572}
    assert spark.read.parquet(path).count() == counts["kept"]
    empty = counted.write_meeting(spark.range(0), fresh_path(spark, "counted"), {"any": F.lit(True)})
    assert empty == {"row_count": 0, "kept": 0, "failed_any": 0}


def test_batches_report_their_counts(spark):
    root = fresh_path(spark, "counted-stream")
    rules = {"even": F.col("id") % 2 == 0}
    for begin in (0, 100, 200):
        spark.range(begin, begin + 100, 1, 1).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema("id long").parquet(f"{root}/landed")
        query = runs.finish(runs.to_files(counted.counting(stream, "rules", rules), f"{root}/out", f"{root}/progress"))
        assert counted.reported(query, "rules") == [{"row_count": 100, "kept": 50, "failed_even": 50}]
    assert spark.read.schema("id long").parquet(f"{root}/out").count() == 150


# --- clusters


def overlapping_groups(path, column, low, high):
    """Row groups whose statistics leave room for a value between ``low`` and ``high``, and all row groups."""
    read = total = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(at).statistics
            total += 1
            read += stats.min <= high and stats.max >= low
    return read, total


def test_lookups_on_either_column_skip_row_groups(spark, sf_dir):
    path = fresh_path(spark, "clustered")
    lines = table(spark, sf_dir, "lineitem").select(*upkeep.LINE)
    # Copies make a table large enough for 64 files; both columns spread over 1,000 values.
    rows = lines.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_orderkey") * 7919 % 1000).alias("l_partkey"),
        ((F.col("l_orderkey") * 104729 + F.col("l_linenumber") * 31) % 1000).alias("l_suppkey"),
        "l_extendedprice",
    )
    clustering.write_clustered(rows, path, ["l_partkey", "l_suppkey"], 64)
    for column in ("l_partkey", "l_suppkey"):
        for low, high in ((500, 500), (100, 140)):
            read, total = overlapping_groups(path, column, low, high)
            assert total >= 60 and 0 < read <= 0.3 * total, (column, low, read, total)
            stored = spark.read.schema(rows.schema).parquet(path).where(F.col(column).between(low, high))
            assert stored.count() == rows.where(F.col(column).between(low, high)).count()


def test_bloom_filters_are_written(spark):
    """Where a column has too many values for a dictionary."""
    rows = spark.range(200_000).selectExpr("xxhash64(id) AS a", "xxhash64(id, 1) AS b")
    path, small = fresh_path(spark, "clustered"), fresh_path(spark, "clustered")
    clustering.write_clustered(rows, path, ["a", "b"], 2, distinct=200_000)
    clustering.write_clustered(rows, small, ["a", "b"], 2, distinct=10)
    size = lambda p: sum(os.path.getsize(f) for f in glob.glob(f"{p}/*.parquet"))
    assert size(path) > size(small) + 4 * 100_000


def test_curve_keeps_nulls_and_orders_by_both_columns(spark):
    rows = spark.range(64).selectExpr("id div 8 AS a", "id % 8 AS b").unionAll(spark.sql("SELECT null, 3L"))
    bounds = clustering.slice_bounds(rows, ["a", "b"], 3)
    place = clustering.interleaved([clustering.rank_in(F.col(c), bounds[c]) for c in "ab"], 3)
    got = {(r.a, r.b): r.place for r in rows.withColumn("place", place).collect()}
    exact = lambda a, b: sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(3))
    rank = lambda c, v: 0 if v is None else sum(bound <= v for bound in bounds[c])
    assert got == {(a, b): exact(rank("a", a), rank("b", b)) for a, b in got}
    assert len(set(got.values())) >= 49 and rank("a", 0) > rank("a", None)
    assert clustering.slice_bounds(rows.limit(0), ["a", "b"], 3) == {"a": [], "b": []}


# --- a graph of tables


@pytest.fixture
def sources(spark, sf_dir):
    root = fresh_path(spark, "sources")
    for name in ("orders", "customer", "lineitem"):
        table(spark, sf_dir, name).write.parquet(f"{root}/{name}")
    return {n: f"{root}/{n}" for n in ("orders", "customer", "lineitem")}


def test_only_descendants_of_a_change_are_built(spark, sf_dir, sources):
    root = fresh_path(spark, "graph")
    graph = upkeep.order_graph(spark, root, sources)
    every = {"orders_raw", "customers_raw", "lines_cleaned", "line_totals", "enriched", "revenue"}
    built = graph.refresh()
    assert set(built) == every and built.index("line_totals") > built.index("lines_cleaned")
    assert graph.refresh() == []
    assert upkeep.order_graph(spark, root, sources).refresh() == []
    before = graph.read("revenue").agg(F.sum("orders")).first()[0]
    new = table(spark, sf_dir, "customer").limit(1).withColumn("c_custkey", F.lit(-1).cast("long"))
    new.write.mode("append").parquet(sources["customer"])
    assert graph.refresh() == ["customers_raw", "enriched", "revenue"]
    table(spark, sf_dir, "lineitem").limit(50).write.mode("append").parquet(sources["lineitem"])
    assert graph.refresh("line_totals") == ["lines_cleaned", "line_totals"]
    assert graph.refresh() == ["enriched", "revenue"]
    assert graph.read("revenue").agg(F.sum("orders")).first()[0] == before


def test_half_built_and_changed_tables_are_built_again(spark, sources):
    root = fresh_path(spark, "graph")
    calls = []

    def graph(version):
        made = TableGraph(spark, root, sources)

        def build(df):
            calls.append(version)
            if version == "broken":
                raise RuntimeError("no")
            return df.limit(1)

        made.declare("t", build, "customer", version=version)
        return made

    with pytest.raises(RuntimeError):
        graph("broken").refresh()
    assert graph("1").refresh() == ["t"] and graph("1").refresh() == [] and graph("2").refresh() == ["t"]
    assert calls == ["broken", "1", "2"]


def test_declarations_are_checked(spark, sources):
    graph = TableGraph(spark, fresh_path(spark, "graph"), sources)
    graph.declare("a", lambda b: b, "b")
    graph.declare("b", lambda c: c, "c")
    with pytest.raises(LookupError, match="no table or source c"):
        graph.order()
    graph.declare("c", lambda a: a, "a")
    with pytest.raises(ValueError, match="need each other"):
        graph.refresh()
    with pytest.raises(ValueError, match="declared twice"):
        graph.declare("orders", lambda: None)
