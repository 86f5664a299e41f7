"""Session factory and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_spark(app: str = "tidewell", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC time, adaptive execution and the RocksDB state store."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's spark.checkpoint.dir.

    Only where that is unset and all work is on one machine (tests) a new local folder is taken, once a session. On a
    cluster such a folder would be another one on every machine, so there an unset folder is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-tidewell-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Paths of the tables that materialize wrote within the scratch around it, one list for each scratch and thread.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Removes at its end the tables that materialize wrote inside, but for those written by the function it gives.

    So what a step needs only for itself is gone once its result is written:

        with scratch(spark) as keep:
            result = keep(step(df), "result")

    Within another scratch, what is kept is a table of that one. Each thread has its own, so steps may run side by side.
    """
    written, kept = [], []
    token = _WRITTEN.set(written)

    def keep(df: DataFrame, name: str = "table") -> DataFrame:
        out = materialize(df, name)
        kept.append(written[-1])
        return out

    try:
        yield keep
    finally:
        _WRITTEN.reset(token)
        if (outer := _WRITTEN.get()) is not None:
            outer.extend(kept)
        for p in written:
            if p not in kept:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str = "table", **options) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back.

    This cuts lineage in a way that outlives lost executors, and lets several consumers read one result. options are
    those of the Parquet writer.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").options(**{"compression": "zstd"} | options).parquet(path)
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tasks for each core that write a table of keys.
KEY_TASKS = 4


def materialize_keys(df: DataFrame, name: str = "table") -> DataFrame:
    """materialize for tables of few bytes a row: KEY_TASKS tasks a core write them, however many parts df has.

    On a local or mounted file system every file and folder also costs a process of the executor (its rights are set by chmod), which
    for a moment counts with all of the executor's memory.
    """
    return materialize(df.coalesce(KEY_TASKS * df.sparkSession.sparkContext.defaultParallelism), name)
