"""Snapshot tables, JSON lines and dated backups (S-1 to S-5, S-20). Paths may be on any file system Spark reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schemas import SCHEMAS, conform, schema


def read_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """S-1, S-2: a Parquet snapshot, conformed to the schema of table `name` if one is given."""
    df = spark.read.parquet(path)
    return conform(df, schema(name)) if name else df


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] = (0, 0), parts: int = 1, **options: str) -> DataFrame:
    """S-1: a table of a database by Spark's own reader, split by ranges of a numeric key if one is given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key:
        r = r.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return r.load()


def read_jsonl_strict(spark: SparkSession, path: str, name: str) -> DataFrame:
    """S-3: JSON lines; blank lines are skipped, a malformed line fails the read. Adds `arrival`."""
    return with_arrival(spark.read.schema(SCHEMAS[name]).option("mode", "FAILFAST").json(path))


def read_jsonl_counting(spark: SparkSession, path: str, name: str) -> DataFrame:
    """S-4: JSON lines; a malformed line becomes a row with its text in `corrupt`, everything else null. Adds `arrival`."""
    return with_arrival(spark.read.schema(f"{SCHEMAS[name]}, corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").json(path))


def with_arrival(lines: DataFrame) -> DataFrame:
    """Adds `arrival`, text that sorts the lines by file name, and in a file as they stand in it: by the part of the
    file a task read and the row in it."""
    digits = lambda c: F.lpad(c.cast("string"), 20, "0")
    return lines.withColumn("arrival", F.concat_ws("/", "_metadata.file_path", digits(F.col("_metadata.file_block_start")), digits(F.monotonically_increasing_id())))


def harvest(pages: DataFrame, order: list[Column], least: int = 200, per_source: int = 25, cut: int = 12000) -> DataFrame:
    """P-14, S-5: pages whose stripped text has at least `least` characters, the first `per_source` of each source in
    the given order, their text cut to `cut` characters; a null title becomes ''."""
    from pyspark.sql import Window as W

    long = pages.filter(F.length(strip(F.coalesce("text", F.lit("")))) >= least)
    first = long.withColumn("_n", F.row_number().over(W.partitionBy("source_id").orderBy(*order))).filter(F.col("_n") <= per_source)
    return first.drop("_n").withColumns({"text": F.left("text", F.lit(cut)), "title": F.coalesce("title", F.lit(""))})


def write_jsonl(df: DataFrame, path: str) -> None:
    """S-5: one JSON object a line, UTF-8."""
    df.write.mode("errorifexists").json(path)


def backup(df: DataFrame, folder: str, table: str, day: str, columns: list[str]) -> str:
    """S-20: a projected copy bak_<table>_<day>, written once; a second call the same day changes nothing."""
    path = f"{folder.rstrip('/')}/bak_{table}_{day}"
    df.select(*columns).write.mode("ignore").parquet(path)
    return path


def publish(df: DataFrame, folder: str, version: str) -> str:
    """Writes a new version directory of a keyed table; what is being read is never overwritten."""
    path = f"{folder.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path
