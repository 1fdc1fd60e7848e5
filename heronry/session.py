"""Session defaults and the shared folder used for hand-off tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders of sessions that run in this process only and name none.
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}

def build_session(
    app_name: str = "heronry",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the settings the operators are tuned for.

    On a cluster ``conf`` must give ``spark.sql.shuffle.partitions``, for the data and the executors it
    has: adaptive execution merges small partitions, but it cannot split a partition that was planned too
    coarse except for skewed joins.
    """
    local = master is not None and (master == "local" or master.startswith("local["))
    width = (conf or {}).get("spark.sql.shuffle.partitions", str(os.cpu_count() or 8) if local else "")
    if not width:
        raise ValueError("conf must give spark.sql.shuffle.partitions")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.shuffle.partitions": width,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Recording a call site for every column expression doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process may go without the setting, as tests
    do; it then gets a folder for the life of the process. ``local-cluster`` is a cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(
            prefix="heronry-", ignore_cleanup_errors=True
        )
    return _local_folders[app].name


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/heronry/{spark.conf.get('spark.app.id')}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nobody has used."""
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has stored in the shared folder. Results that still read from
    there are lost, so call it at the very end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether Spark has finished writing the dataset at ``path``."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def file_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and change times of the files directly at ``path``, as one hash: equal as long as
    nothing there changes."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted(
        (f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(at)
    )
    return path, hash(tuple(files))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at the written table.

    Unlike a block-manager copy it survives the loss of any executor, and unlike an RDD checkpoint
    it stays columnar, so later readers scan only the columns they use.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
