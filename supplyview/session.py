"""Session set-up and staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Where the staged tables of the current run go; None: straight into the shared folder.
_RUN_FOLDER: ContextVar[str | None] = ContextVar("run_folder", default=None)


def local_session(cores: str | int = "*", app: str = "supplyview", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        # Call sites in error messages cost a few round trips per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="supplyview-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


@contextmanager
def run_folder(spark: SparkSession, path: str | None = None) -> Iterator[str]:
    """Tables staged inside go to one folder, which is removed at the end, also after
    a failure. Results that read staged tables must be written inside.

    ``path`` must be reachable by all executors; by default it is a new folder in
    the shared folder.
    """
    folder = (path or f"{shared_folder(spark)}/run-{uuid.uuid4().hex}").rstrip("/")
    token = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(token)
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def current_folder(spark: SparkSession) -> str:
    """Where tables staged now go: the folder of the run, or else the shared folder."""
    return _RUN_FOLDER.get() or shared_folder(spark)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, so costly scans run once and survive lost executors; the
    copy is columnar, so later plans read only the columns they need. It stays until
    its ``run_folder`` ends, or without one like a checkpoint file.
    """
    spark = df.sparkSession
    path = f"{current_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
