"""WARC archives as tables of chunks.

An archive is a table of (record_id, chunk_no, content) rows: chunk 0 is the record's header, the others
are its payload in order, and the last one ends the record. The rows of an archive, one after another,
are the bytes of a WARC file. A payload of any length is written and read chunk by chunk; digests are
carried from chunk to chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heronry.llm.batches import bounded_batches
from heronry.session import fresh_path, materialize

CHUNK_BYTES = 256 << 10
# Shorter payloads are always stored.
LEAST_SHARED_BYTES = 100
ARCHIVES = 64
DATE = "2024-01-01T00:00:00Z"
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_uri(page: Column) -> Column:
    """The record's name: a function of its page only, so that a record can name another one."""
    d = F.md5(F.concat(F.lit("record|"), page))
    parts = [F.substring(d, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def plan_records(pages: DataFrame, id_col: str, url: str, payload: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest, refers_to) of every row.

    Of the rows with one payload of at least ``LEAST_SHARED_BYTES``, that with the smallest id stores it;
    for the others ``refers_to`` is that id. Rows without an id are never referred to and always store
    their payload; of rows that repeat the smallest id, each stores it.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body, 256).alias("digest"),
    )
    # Only digests that occur more than once are looked up, so the payloads are not shuffled by digest.
    known = materialize(rows.select("page_id", "payload_bytes", "digest"), "digests")
    shared = (
        known.where((F.col("payload_bytes") >= LEAST_SHARED_BYTES) & F.col("page_id").isNotNull())
        .groupBy("digest", "payload_bytes")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("digest", "payload_bytes", "first_id")
    )
    refers = (
        known.join(shared, ["digest", "payload_bytes"])
        .where(F.col("page_id") != F.col("first_id"))
        .select(
            F.col("page_id").alias("of"),
            F.col("digest").alias("of_digest"),
            F.col("first_id").alias("refers_to"),
        )
        .distinct()
    )
    return rows.join(
        refers, (F.col("page_id") == F.col("of")) & (F.col("digest") == F.col("of_digest")), "left"
    ).select("page_id", "url", "payload", "payload_bytes", "digest", "refers_to")


def chunks(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(archive, page_id, record_id, chunk_no, n_chunks, content) rows of planned records.

    ``record_id`` also tells rows apart that share a page id. The header names the payload's digest and
    length, and for a revisit the record that stores the payload.
    """
    revisit = F.col("refers_to").isNotNull()
    stored = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    length = F.octet_length("stored")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    clean = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", " ")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_uri(F.coalesce(F.col("page_id").cast("string"), "digest"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", clean),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Refers-To", record_uri(F.col("refers_to").cast("string"))),
                line("WARC-Refers-To-Page", F.col("refers_to").cast("string")),
                line("WARC-Profile", F.lit(PROFILE)),
                line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
            ),
        ).otherwise(F.lit("")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
    )
    n = F.ceil(length / chunk_bytes).cast("int")
    begin = (F.col("chunk_no") - 1) * chunk_bytes + 1
    payload = F.substring(F.col("stored"), begin, F.lit(chunk_bytes))
    content = F.when(F.col("chunk_no") == 0, F.encode("header", "UTF-8")).otherwise(payload)
    end = F.when(F.col("chunk_no") == F.col("n_chunks"), F.lit(b"\r\n\r\n")).otherwise(F.lit(b""))
    return (
        records.withColumn("record_id", F.monotonically_increasing_id())
        .withColumn("stored", stored)
        .withColumn("header", header)
        .withColumn("n_chunks", n)
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("n_chunks"))))
        .select(
            F.pmod(F.xxhash64("record_id"), F.lit(ARCHIVES)).cast("int").alias("archive"),
            "page_id",
            "record_id",
            "chunk_no",
            "n_chunks",
            F.concat(content, end).alias("content"),
        )
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url: str = "url",
    payload: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Writes a WARC record for each row of ``pages`` to the chunk table at ``path``.

    Null payloads count as empty, null URLs as the empty URL; other columns are not read; an empty
    table gives an empty archive.
    """
    records = plan_records(pages, id_col, url, payload)
    chunks(records, chunk_bytes).write.mode("errorifexists").parquet(path)


def _fields(header: Column) -> Column:
    """The header's lines as a map of names to values."""
    lines = F.filter(F.split(header, "\r\n"), lambda x: F.instr(x, ": ") > 0)
    return F.map_from_arrays(
        F.transform(lines, lambda x: F.substring_index(x, ": ", 1)),
        F.transform(lines, lambda x: F.regexp_replace(x, "^[^:]*: ", "")),
    )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (record_id, chunk_no) → one row for each record, its digest carried from chunk to
    chunk and from batch to batch."""
    state, now = hashlib.sha256(), None
    total = 0
    done: list[tuple] = []
    for batch in batches:
        for record, no, last, content in zip(*(c.to_pylist() for c in batch.columns)):
            if record != now or no == 1:
                state, now, total = hashlib.sha256(), record, 0
            # The last chunk also ends the record.
            data = content[:-4] if no == last else content
            state.update(data)
            total += len(data)
            if no == last:
                done.append((record, total, state.hexdigest()))
        if len(done) >= 1000:
            yield _records(done)
            done = []
    yield _records(done)


def _records(done: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*done)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["of", "read_bytes", "read_digest"]
    )


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of a chunk table.

    Stored payloads are digested anew from their chunks: records of one chunk in place, longer ones by
    streaming their chunks in order. Revisits carry length and digest of the payload they stand for.
    A stored payload whose digest is not the one in its header is an error, and so is a revisit that names a page
    without a stored payload of that digest and length.
    """
    first = archives.where(F.col("chunk_no") == 0).select(
        "page_id", "record_id", "n_chunks", _fields(F.decode("content", "UTF-8")).alias("f")
    )

    def field(name: str) -> Column:
        return F.element_at("f", name)

    heads = first.select(
        "page_id",
        "record_id",
        "n_chunks",
        field("WARC-Type").alias("record_type"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("named_digest"),
        F.coalesce(field("WARC-Payload-Length"), field("Content-Length")).cast("long").alias("named_bytes"),
        field("WARC-Refers-To-Page").cast("long").alias("refers_to"),
    )
    payload = archives.where(F.col("chunk_no") > 0)
    body = F.expr("substring(content, 1, octet_length(content) - 4)")
    short = payload.where(F.col("n_chunks") == 1).select(
        F.col("record_id").alias("of"),
        F.octet_length(body).cast("long").alias("read_bytes"),
        F.sha2(body, 256).alias("read_digest"),
    )
    long = (
        bounded_batches(payload)
        .where(F.col("n_chunks") > 1)
        .select("record_id", "chunk_no", "n_chunks", "content")
        .repartition("record_id")
        .sortWithinPartitions("record_id", "chunk_no")
        .mapInArrow(_digested, "of long, read_bytes long, read_digest string")
    )
    empty, revisit = F.col("n_chunks") == 0, F.col("record_type") == "revisit"
    digest = (
        F.when(revisit, F.col("named_digest"))
        .when(empty, EMPTY_DIGEST)
        .otherwise(F.col("read_digest"))
    )
    size = (
        F.when(revisit, F.col("named_bytes"))
        .when(empty, F.lit(0).cast("long"))
        .otherwise(F.col("read_bytes"))
    )
    same = F.coalesce(
        (F.col("named_digest") == digest) & (F.col("named_bytes") == size), F.lit(False)
    )
    damaged = F.raise_error(F.concat(F.lit("damaged record "), F.col("record_id").cast("string")))
    rows = (
        heads.join(short.unionAll(long), F.col("record_id") == F.col("of"), "left")
        .where(F.when(same, True).otherwise(damaged.cast("boolean")))
        .select(
            "page_id",
            size.alias("payload_bytes"),
            digest.alias("payload_digest"),
            "record_type",
            "refers_to",
        )
    )
    return _revisits_checked(materialize(rows, "records"))


def _revisits_checked(rows: DataFrame) -> DataFrame:
    """``rows`` again; a revisit of a payload that is not among the stored ones is an error."""
    revisit = F.col("record_type") == "revisit"
    stored = (
        rows.where(~revisit)
        .select(
            F.col("page_id").alias("stored_id"),
            F.col("payload_digest").alias("stored_digest"),
            F.col("payload_bytes").alias("stored_bytes"),
        )
        .distinct()
    )
    found = rows.where(revisit).join(
        stored,
        F.col("refers_to").eqNullSafe(F.col("stored_id"))
        & (F.col("payload_digest") == F.col("stored_digest"))
        & (F.col("payload_bytes") == F.col("stored_bytes")),
        "left",
    )
    missing = F.raise_error(
        F.concat(F.lit("no stored payload for the revisit of page "), F.coalesce(F.col("refers_to").cast("string"), F.lit("?")))
    )
    known = F.when(F.col("stored_digest").isNotNull(), True).otherwise(missing.cast("boolean"))
    return rows.where(~revisit).unionAll(found.where(known).select(*rows.columns))


def archived(pages: DataFrame) -> DataFrame:
    """Archives ``pages`` in the shared folder and reads the archives back; see ``read_archives``."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark.read.parquet(path))
