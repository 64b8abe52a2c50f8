"""Session helpers: settings every plan relies on, and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2026-01-01 00:00:00"


def build_session(cores: int | str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster pass the cluster's own session instead."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder; the scan stays lazy so that filters and columns reach it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the one named by spark.checkpoint.dir, or the context's checkpoint folder. Only a
    local session may go without; it gets a temporary one. Elsewhere executors would each write to their own disks."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    d = sc._jsc.sc().getCheckpointDir()
    if not d.isDefined():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
        d = sc._jsc.sc().getCheckpointDir()
    return d.get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder and return it with its lineage cut.

    The folder is the one named by spark.checkpoint.dir; it is set here only where the session has
    none (single-machine tests). Checkpoint files survive the loss of executors.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: Folders of stored tables that have not been removed yet, oldest first.
_STORED: list[str] = []


def _path(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def temporary(spark: SparkSession, what: str) -> str:
    """A new folder name in the shared folder, removed with the session or by `scope`."""
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)
    _STORED.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """Like cut(), but as a compressed columnar table in the same shared folder.

    Several times smaller than a checkpoint of rows, and later scans read only the columns they use.
    The folder belongs to the application and is removed with it, or at the end of a `scope`.
    """
    spark = df.sparkSession
    path = temporary(spark, spark.sparkContext.applicationId)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables stored within it: for sessions that run many queries. Results must have been
    written or collected by then."""
    first = len(_STORED)
    try:
        yield
    finally:
        for path in _STORED[first:]:
            p, fs = _path(spark, path)
            fs.delete(p, True)
        del _STORED[first:]
