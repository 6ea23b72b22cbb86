"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings every job needs. Session time zone UTC makes day and hour buckets the same on every cluster;
#: merging sessions before the shuffle keeps one very active user from filling a single reducer; large keyed state
#: and state with time-to-live need the RocksDB provider.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, so that no node needs it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    # Spark serves the archive from here while the application runs.
    folder = Path(tempfile.mkdtemp(prefix="playtide-package-")).resolve()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(str(folder / package.name), "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created, and give its workers this package."""
    ship(spark)
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "playtide", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names it on a cluster. Only when nothing is set (a local test) is a temporary folder made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="playtide-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, for a table or a streaming checkpoint."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_OPEN = threading.local()


@contextmanager
def collected() -> Iterator[list[str]]:
    """The paths of the tables that this thread writes by :func:`written` inside; whoever opens it may drop them once they are used up."""
    paths: list[str] = []
    outer = getattr(_OPEN, "paths", None)
    _OPEN.paths = paths
    try:
        yield paths
    finally:
        _OPEN.paths = outer
        if outer is not None:
            outer.extend(paths)


def drop(spark: SparkSession, path: str) -> None:
    """Delete one of the library's own folders, wherever it is stored; nothing happens if it is gone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write an intermediate result below the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives the planner the real size for its choice of join. ``options`` are
    the writer's.
    """
    path = work_path(df.sparkSession, purpose)
    if getattr(_OPEN, "paths", None) is not None:
        _OPEN.paths.append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
