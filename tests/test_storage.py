"""Readers, writers and versioned tables on small hand-written files."""

import glob
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from heronry import session
from heronry.functions.texts import caption_text
from heronry.operators import aggregates, filters, joins, keyed, ranking
from heronry.sinks import files as sinks, versions
from heronry.sources import files as sources, topics


@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    return write


# --- readers ----------------------------------------------------------------------------------


def test_trailing_blanks(spark, folder):
    path = folder("stores.csv", "store_id,region\n1,West\n2,West \n")
    assert {r["region"] for r in sources.read_csv(spark, path).collect()} == {"West"}
    raw = sources.read_csv(spark, path, trim=False)
    assert {r["region"] for r in raw.collect()} == {"West", "West "}


def test_sales_with_inferred_types(spark, folder):
    sales = folder(
        "sales.csv",
        "date,product_id,store_id,quantity,revenue\n2024-05-01,1,1,10,500\n2024-05-02,2,1,4,300\n"
        "2024-06-01,1,2,10,800 \n2024-06-03,3,9,1,70\n",
    )
    items = folder("products.csv", "product_id,product_name,category\n1,Ring,Gold\n2,Bolt,Steel \n")
    places = folder("stores.csv", "store_id,store_name,region\n1,First,North\n2,Second,South \n")
    sales, items, places = (sources.read_csv(spark, p) for p in (sales, items, places))
    assert dict(sales.dtypes)["revenue"] == "int"
    star = joins.star(sales, items, places)
    sold = aggregates.whole_totals(star, ["region", "product_id"], {"qty": "quantity"})
    top = ranking.top_per_group(sold, "region", 1, "qty", "product_id")
    assert {(r["region"], r["product_id"], r["qty"]) for r in top.collect()} == {
        ("North", 1, 10), ("South", 1, 10), (None, 3, 1),
    }
    revenue = aggregates.whole_totals(star, ["store_id"], {"total": "revenue"})
    best, worst = ranking.top(revenue, 1, "total", "store_id"), ranking.bottom(revenue, 1, "total", "store_id")
    assert [r["store_id"] for r in (best.first(), worst.first())] == [1, 9]


def test_dated_csv(spark, folder):
    path = folder("s.csv", " Date , Weighted Revenue\n2024-01-05,10.5\nsoon,20\n2024-02-01,oops\n")
    df = sources.read_csv_dated(spark, path, "Date")
    assert df.columns == ["Date", "Weighted Revenue"]
    assert [r["Date"] for r in df.collect()] == [datetime(2024, 1, 5), None, datetime(2024, 2, 1)]
    totals = aggregates.monthly_totals(df, "Date", "Weighted Revenue", 0)
    assert [tuple(r) for r in totals.collect()] == [("2024-01", 10.5)]


def test_payloads(spark, folder):
    path = folder("users.json", '[\n {"id": 1, "name": "a",\n "address": {"city": "x"}},\n {"id": 2}\n]')
    users = sources.read_payload_records(spark, path, "id int, name string, address struct<city: string>", True)
    assert [(r["id"], r["name"], r["address"] and r["address"]["city"]) for r in users.collect()] == [(1, "a", "x"), (2, None, None)]
    path = folder("w.json", '{"latitude": 21.0,\n "current_weather": {"temperature": 30.5, "surprise": 1}}')
    schema = "latitude double, elevation double, current_weather struct<temperature: double, is_day: int>"
    row = sources.read_payload_object(spark, path, schema, "current_weather", True).first()
    assert row.asDict() == {"temperature": 30.5, "is_day": None, "latitude": 21.0, "elevation": None}


def test_caption_file(spark, folder):
    path = folder("in/a.vtt", "WEBVTT\n\nNOTE\nby hand\n\n00:00.1 --> 00:00.2\nHello\nthere.\n")
    df = sources.read_captions(spark, path)
    assert df.select(caption_text(F.col("captions"))).first()[0] == "WEBVTT by hand Hello there."


def test_bad_record_cap(spark, folder):
    path = folder("m.csv", "month,revenue\n2024-01,10.5\n2024-02,20\n")
    schema = "month string, revenue double"
    assert sources.read_csv_capped(spark, path, schema, 1).count() == 2
    path = folder("n.csv", "month,revenue\n2024-01,ten\n2024-02,20\n")
    with pytest.raises(ValueError, match="2 bad records"):
        sources.read_csv_capped(spark, path, schema, 1)


def test_records_of_two_schema_versions(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", None)], "id int, name string, email string")
    new = spark.createDataFrame([(2, "b", "e", 30)], "id int, name string, email string, age int")
    old.write.parquet(f"{tmp_path}/v1")
    new.write.parquet(f"{tmp_path}/v2")
    both = sources.read_versions(spark, [f"{tmp_path}/v1", f"{tmp_path}/v2"], new.schema)
    assert {tuple(r) for r in both.collect()} == {(1, "a", None, None), (2, "b", "e", 30)}


def test_json_records(spark):
    lines = ['{"id": 1, "v": 2.5, "extra": 9}', '{"id": "x", "v": 1.0}', "not json", '{"v": 3}']
    topic = spark.createDataFrame([(bytearray(x.encode()),) for x in lines], "value binary")
    rows = [tuple(r) for r in topics.decode_json(topic, "id int, v double").collect()]
    assert rows == [(1, 2.5), (None, 1.0), (None, None), (None, 3.0)]


def test_kafka_options():
    options = topics.kafka_options("b:1", "t", "latest", max_per_trigger=10)
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        topics.kafka_options("b:1", "t", "yesterday")


# --- writers ----------------------------------------------------------------------------------


def test_one_file_or_several_is_the_callers_choice(spark, tmp_path):
    df = spark.range(0, 50, 1, 5)
    sinks.write_csv(df, f"{tmp_path}/one", single=True)
    assert len(glob.glob(f"{tmp_path}/one/part-*")) == 1
    sinks.write_csv(df, f"{tmp_path}/many")
    assert len(glob.glob(f"{tmp_path}/many/part-*")) > 1
    for name in ("one", "many"):
        assert sources.read_csv(spark, f"{tmp_path}/{name}", "id bigint").count() == 50


def test_appended_observations_have_one_header_per_file(spark, tmp_path):
    path = f"{tmp_path}/obs"
    for i in range(3):
        sinks.append_csv(spark.createDataFrame([(i, 1.5)], "t int, v double"), path)
    assert [r["t"] for r in sources.read_csv(spark, path, "t int, v double").orderBy("t").collect()] == [0, 1, 2]


def test_run_folders(spark, tmp_path):
    at = datetime(2024, 5, 6, 7, 8)
    for _ in range(2):
        path = sinks.write_run(spark.range(3), str(tmp_path), at)
    assert path.endswith("/2024/05/06/0708") and spark.read.parquet(path).count() == 3


def test_partitions_are_pruned(spark, tmp_path):
    path = f"{tmp_path}/daily"
    df = spark.range(400).select(
        "id", F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("day")
    )
    sinks.write_partitioned(df, path, "day", "id")
    sinks.write_partitioned(df, path, "day", "id")
    stored = spark.read.parquet(path)
    assert stored.count() == 800
    one_day = filters.between_dates(stored, "day", date(2024, 1, 5), date(2024, 1, 5))
    assert one_day.count() == 20
    assert len(one_day.select("id").inputFiles()) > 0
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.shared_folder(spark) == configured.rstrip("/")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_a_cluster_must_name_folder_and_width(spark, monkeypatch):
    with pytest.raises(ValueError, match="shuffle.partitions"):
        session.build_session(master="local-cluster[2,1,1024]")
    master = spark.conf.get("spark.master")
    real = type(spark.conf).get
    answers = {"spark.checkpoint.dir": None, "spark.master": "local-cluster[2,1,1024]"}
    monkeypatch.setattr(
        type(spark.conf), "get", lambda self, k, *d: answers[k] if k in answers else real(self, k, *d)
    )
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.shared_folder(spark)
    assert master.startswith("local[")


def _with_nulls(spark, sf_dir, tmp_path):
    """The given tables with a null in every tenth row of each column that a query splits by."""
    import os

    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)
        df = spark.read.parquet(path)
        split_by = {"customer.parquet": "c_acctbal", "events.parquet": None, "orders.parquet": "o_orderdate"}
        if name == "events.parquet":
            gap = F.col("event_id") % 10 == 3
            df = df.withColumns({c: F.when(~gap, F.col(c)) for c in ("ts", "value")})
        elif name in split_by:
            gap = F.col(df.columns[0]) % 10 == 3
            df = df.withColumn(split_by[name], F.when(~gap, F.col(split_by[name])))
        df.write.parquet(f"{tmp_path}/{name}")
    return str(tmp_path)


def test_no_row_is_lost_at_a_null(spark, sf_dir, tmp_path):
    from heronry.plans import all_queries

    gaps, queries_ = _with_nulls(spark, sf_dir, tmp_path), all_queries()
    count = lambda name: spark.read.parquet(f"{gaps}/{name}.parquet").count()
    for name, source in (
        ("set_append_history", "events"),
        ("snk_table_append", "events"),
        ("src_versioned_records", "customer"),
        ("sch_evolve_read", "customer"),
        ("set_union_versions", "customer"),
        ("st_foreach_batch_multi", "lineitem"),
    ):
        assert queries_[name](spark, gaps).count() == count(source), name
    total = queries_["sch_drift_report"](spark, gaps).agg(F.sum("row_count")).first()[0]
    assert total == count("customer")
    for name in ("keyed_merge_additive", "agg_customer_metrics_pct"):
        lines = queries_[name](spark, gaps).agg(F.sum("total_transactions")).first()[0]
        assert lines == count("lineitem"), name


def _without_discounts(spark, sf_dir, tmp_path):
    """The given orders and lines; no line of every third customer has a discount, and every seventh order
    has no customer."""
    orders, lines = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("orders", "lineitem"))
    orders = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")))
    plain = orders.where("o_custkey % 3 = 0").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0.0).alias("none"))
    lines = lines.join(plain, "l_orderkey", "left").withColumn("l_discount", F.coalesce("none", "l_discount"))
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    lines.drop("none").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["keyed_merge_additive", "keyed_merge_bucketed"])
def test_merged_periods_are_the_metrics_of_all(spark, sf_dir, tmp_path, name):
    """A customer without any discount on record has unknown discounts after a merge as well; lines without a
    customer are one row."""
    import duckdb

    from heronry.plans import all_oracles, all_queries
    from tests.compare import oracle_rows, spark_rows

    odd, con = _without_discounts(spark, sf_dir, tmp_path), duckdb.connect()
    for table in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{odd}/{table}.parquet/*.parquet'")
    got = spark_rows(all_queries()[name](spark, odd))
    assert got == oracle_rows(con, all_oracles()[name])
    at = sorted(all_queries()[name](spark, odd).columns).index("total_discounts_received")
    assert any(row[at] is None for row in got)


def test_reports_follow_the_tables(spark, sf_dir, tmp_path):
    """No stored result or schema outlives a change of the files."""
    import os
    import shutil

    from heronry.plans.customers import metrics_table
    from heronry.plans.views import table

    for name in ("lineitem", "orders"):
        shutil.copy(f"{sf_dir}/{name}.parquet", tmp_path)
    before = metrics_table(spark, str(tmp_path)).agg(F.sum("total_transactions")).first()[0]
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(100).withColumn("more", F.lit(1))
    os.remove(f"{tmp_path}/lineitem.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert "more" in table(spark, str(tmp_path), "lineitem").columns
    after = metrics_table(spark, str(tmp_path)).agg(F.sum("total_transactions")).first()[0]
    assert before > 100 and after == 100


# --- versions ---------------------------------------------------------------------------------


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(LookupError):
        versions.read_version(spark, root)
    first = spark.createDataFrame([(1, None, 0), (2, 5.0, 0)], "id int, amount double, spare int")
    assert versions.next_version(first, root) == 1
    filled = keyed.update_where(versions.read_version(spark, root), "amount", F.lit(0.0), F.col("amount").isNull())
    assert versions.next_version(filled, root) == 2
    assert versions.next_version(keyed.drop_column(versions.read_version(spark, root), "spare"), root) == 3
    assert versions.read_version(spark, root).columns == ["id", "amount"]
    assert {tuple(r) for r in versions.read_version(spark, root).collect()} == {(1, 0.0), (2, 5.0)}
    assert versions.read_version(spark, root, 1).where("amount is null").count() == 1
    assert {tuple(r) for r in versions.history(spark, root).collect()} == {(1, 2), (2, 2), (3, 2)}


def test_half_written_version_is_invisible(spark, tmp_path):
    root = tmp_path / "t"
    versions.next_version(spark.range(3), str(root))
    broken = root / "version=2"
    broken.mkdir()
    (broken / "part-00000.parquet").write_text("not finished")
    assert versions.committed(spark, str(root)) == [1]
    assert versions.read_version(spark, str(root)).count() == 3
    assert versions.next_version(spark.range(5), str(root)) == 3
    assert versions.read_version(spark, str(root)).count() == 5
