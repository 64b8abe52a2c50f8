"""The source registry as data (S-19, M-1, M-2, M-18, M-21, F-27)."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.urls import valid_pattern
from ..schemas import SCHEMAS, conform

SETTABLE = ("canonical_org", "adapter_type", "tier", "root_url", "sitemap_url", "seed_urls", "url_filter", "crawl_cadence_days", "notes")


def seeds_from_json(spark: SparkSession, path: str | Path) -> DataFrame:
    """S-19: a JSON list of sources as registry rows."""
    return spark.read.schema(SCHEMAS["source_registry"]).option("multiLine", True).json(str(path))


def url_filters(registry: DataFrame) -> DataFrame:
    """P-8: (source_id, url_filter) with unusable patterns as null, so that they filter nothing instead of failing a job."""
    return registry.select("source_id", valid_pattern(F.col("url_filter")).alias("url_filter"))


def upsert_sources(registry: DataFrame, seeds: DataFrame, force: bool = False) -> DataFrame:
    """M-1, M-21: adds sources that are not there; with force, overwrites all but `enabled` of those that are."""
    seeds = conform(seeds, registry.schema).select(*registry.columns).withColumns(
        {"tier": F.coalesce("tier", F.lit(3).cast("smallint")), "crawl_cadence_days": F.coalesce("crawl_cadence_days", F.lit(30)), "enabled": F.coalesce("enabled", F.lit(True)), "consecutive_failures": F.coalesce("consecutive_failures", F.lit(0))}
    )
    cfg = [c for c in SETTABLE if c in registry.columns]
    o, n = registry.alias("o"), seeds.alias("n")
    both = o.join(n, F.col("o.source_id") == F.col("n.source_id"), "full_outer")
    old = F.col("o.source_id").isNotNull()

    def pick(c: str) -> Column:
        keep = F.when(F.col("n.source_id").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if force and c in cfg else F.col(f"o.{c}")
        return F.when(old, keep).otherwise(F.col(f"n.{c}")).alias(c)

    return both.select(*[pick(c) for c in registry.columns])


def mark_crawled(registry: DataFrame, marks: DataFrame, now: Column) -> DataFrame:
    """M-2: for (source_id, marker) sets last_crawled_at, and the marker where one is given."""
    m = marks.groupBy("source_id").agg(F.max("marker").alias("_marker"), F.lit(True).alias("_hit"))
    j = registry.join(m, "source_id", "left")
    return j.withColumns({"last_crawled_at": F.when(F.col("_hit"), now).otherwise(F.col("last_crawled_at")), "last_seen_marker": F.coalesce("_marker", "last_seen_marker")}).drop("_marker", "_hit")


def parse_settings(pairs: list[str]) -> dict[str, str | None]:
    """F-27: key=value pairs of settable fields; '' and NULL in any case mean null; others raise ValueError."""
    out: dict[str, str | None] = {}
    for p in pairs:
        k, eq, v = p.partition("=")
        if not eq or k not in SETTABLE:
            raise ValueError(f"cannot set {p!r}")
        out[k] = None if v == "" or v.lower() == "null" else v
    return out


def set_source(registry: DataFrame, source_id: str, settings: dict[str, str | None]) -> DataFrame:
    """M-18: changes fields of one source."""
    at = F.col("source_id") == source_id
    types = dict(registry.dtypes)
    return registry.withColumns({k: F.when(at, F.lit(v).cast(types[k])).otherwise(F.col(k)) for k, v in settings.items()})


def add_source(registry: DataFrame, source: dict[str, str | None]) -> DataFrame:
    """M-18: adds one source; one that exists raises ValueError."""
    if not registry.filter(F.col("source_id") == source["source_id"]).isEmpty():
        raise ValueError(f"{source['source_id']} exists")
    types = dict(registry.dtypes)
    row = registry.sparkSession.range(1).select(*[F.lit(source.get(c)).cast(types[c]).alias(c) for c in registry.columns])
    return upsert_sources(registry, row)


def enable(registry: DataFrame, source_id: str, on: bool) -> DataFrame:
    """M-18: switches a source on or off."""
    return registry.withColumn("enabled", F.when(F.col("source_id") == source_id, F.lit(on)).otherwise(F.col("enabled")))


def cursors(registry: DataFrame) -> DataFrame:
    """M-3: (source_id, offset, child) out of the stored cursor; null where it has none or cannot be read."""
    part = lambda c: F.get_json_object("crawl_cursor", f"$.{c}").try_cast("int").alias(c)
    return registry.select("source_id", part("offset"), part("child"))


def save_cursors(registry: DataFrame, moved: DataFrame) -> DataFrame:
    """M-3: stores the cursors of (source_id, offset, child), one of the two given; other sources keep theirs."""
    m = moved.select("source_id", F.to_json(F.struct("offset", "child")).alias("_to")).groupBy("source_id").agg(F.max("_to").alias("_to"))
    return registry.join(m, "source_id", "left").withColumn("crawl_cursor", F.coalesce("_to", "crawl_cursor")).drop("_to")


def ordered(registry: DataFrame, only: str | None = None) -> DataFrame:
    """O-2, O-12: adds `turn`, the place in order of tier and source_id; of one adapter's enabled sources if `only` is given."""
    r = registry if only is None else registry.filter((F.col("adapter_type") == only) & F.col("enabled"))
    return r.withColumn("turn", F.row_number().over(W.orderBy(F.asc_nulls_last("tier"), "source_id")))  # a small dimension
