"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plans and may be set on a running session.
RUNTIME_CONF = {
    # Call sites for error messages cost several driver calls per column expression.
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # State per event or session may exceed the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_LOCAL_WORK: dict[str, str] = {}
_STEP_TABLES: ContextVar[list[str] | None] = ContextVar("step_tables", default=None)


def build_session(app_name: str, master: str | None = None, shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RUNTIME_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the options above on a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session without the setting gets a
    temporary folder; on a cluster a missing setting is an error, because a machine-local path loses data there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        if app not in _LOCAL_WORK:
            _LOCAL_WORK[app] = tempfile.mkdtemp(prefix="clickmill-")
        root = _LOCAL_WORK[app]
    return f"{root.rstrip('/')}/clickmill/{context.applicationId}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage, survives lost executors and, unlike a row checkpoint, lets later steps read single columns.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    if (made := _STEP_TABLES.get()) is not None:
        made.append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def step_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes what this thread materialises inside the block when it ends; frames built on it must be written by then."""
    token = _STEP_TABLES.set(made := [])
    try:
        yield
    finally:
        _STEP_TABLES.reset(token)
        remove_paths(spark, made)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop path and the file system that owns it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete folders; returns how many existed."""
    removed = 0
    for path in paths:
        target, files = _file_system(spark, path)
        removed += bool(files.delete(target, True))
    return removed


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = _file_system(spark, path)
    return files.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    target, files = _file_system(spark, path)
    files.mkdirs(target)
