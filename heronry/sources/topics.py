"""Topics of JSON records. The connector and its options are arguments; decoding is a function of
the ``value`` column, so any source that delivers such a column will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TOPIC_SCHEMA = T.StructType([T.StructField("value", T.BinaryType())])


def decode_json(topic: DataFrame, schema: T.StructType | str) -> DataFrame:
    """``value`` bytes to the declared columns. Undeclared fields are dropped, a field of the wrong
    type is null, and text that is not JSON gives a row of nulls."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return topic.select(parsed.alias("data")).select("data.*")


def encode_json(df: DataFrame) -> DataFrame:
    """All columns as one JSON object in ``value``."""
    body = F.to_json(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return df.select(body.cast("binary").alias("value"))


def kafka_options(
    brokers: str,
    topic: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. ``starting`` is ``earliest`` or ``latest``; progress after the
    first start is kept by the checkpoint of each query, not by a consumer group."""
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting must be 'earliest' or 'latest', not {starting!r}")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """Bounded read of a topic from its earliest record."""
    reader = spark.read.format(fmt).options(**options)
    return (reader if fmt == "kafka" else reader.schema(TOPIC_SCHEMA)).load(path)


def stream_topic(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """Unbounded read of a topic."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader if fmt == "kafka" else reader.schema(TOPIC_SCHEMA)).load(path)


def publish(df: DataFrame, fmt: str = "kafka", path: str | None = None, **options: str) -> None:
    """Append rows to a topic as JSON records."""
    encode_json(df).write.format(fmt).options(**options).mode("append").save(path)
