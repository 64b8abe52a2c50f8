"""S-22: the reports an operator reads, as named DataFrames in the order they are shown; nothing is printed here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import gates, incremental, lifecycle, rollups
from ..sources import registry as reg
from ..sources import web

RUN = ("run_id", "started_at", "sources_checked", "sources_changed", "urls_changed", "objects_written", "status")
CHANGE = ("detected_at", "source_id", "change_type", "signal", "extract_status", "rules_new", "url")


def status(registry: DataFrame, runs: DataFrame) -> dict[str, DataFrame]:
    """O-2: the registry by tier and source_id, and the last three runs."""
    sources = reg.ordered(registry).orderBy("turn").select("tier", "source_id", "canonical_org", "adapter_type", "crawl_cadence_days", "last_crawled_at")
    return {"sources": sources, "runs": runs.select(*RUN).orderBy(F.desc("run_id")).limit(3)}


def changes(log: DataFrame, n: int = 25) -> dict[str, DataFrame]:
    """O-3: the latest changes."""
    return {"changes": log.dropDuplicates(["change_id"]).orderBy(F.desc("change_id")).limit(n).select(*CHANGE)}


def health(registry: DataFrame) -> dict[str, DataFrame]:
    """O-4: sources by their streaks."""
    return {"health": rollups.source_health_list(registry).orderBy("turn")}


def scorecard(registry: DataFrame, runs: DataFrame, log: DataFrame, rules: DataFrame, now: Column) -> dict[str, DataFrame]:
    """A-6, A-7, A-8, O-13, P-20, P-21: is the loop healthy, and is what it writes any good."""
    return {
        "runs": runs.orderBy(F.desc("run_id")).limit(5).select("run_id", F.to_date("started_at").alias("day"), "status", "urls_changed", "objects_written"),
        "changes": rollups.status_histogram(log.dropDuplicates(["change_id"]), now).orderBy(F.desc("n"), "extract_status"),
        "streaks": rollups.source_health_list(registry).filter("alert").orderBy("turn"),
        "added": rollups.rules_added(rules, now),
        "corpus": rollups.corpus_totals(rules),
    }


def brain_health(tables: dict[str, DataFrame], registry: DataFrame, runs: DataFrame, now: Column, before: DataFrame | None = None) -> dict[str, DataFrame]:
    """A-1 to A-4, A-18, O-8: coverage by table and tag, spellings by their rules, one row of metrics, overdue sources by tier,
    alerts; before: the row of metrics taken last time."""
    rules = tables["rules"]
    siblings = {k: v for k, v in tables.items() if k != "rules"}
    metrics = rollups.snapshot_metrics(rules, siblings, registry, runs, now).withColumn("taken_at", now)
    history = metrics if before is None else before.unionByName(metrics, allowMissingColumns=True)
    overdue = rollups.registry_health(registry, rules, now).filter("overdue").orderBy(F.asc_nulls_last("tier"), "source_id")
    latest = rollups.drift_alerts(history).filter(F.col("taken_at") == now)
    return {"coverage": rollups.brain_health(tables, now), "spellings": rollups.org_hygiene(rules).orderBy(F.desc("n"), "org_key"), "metrics": metrics, "overdue": overdue, "alerts": latest}


def critic(topics: DataFrame, rules: DataFrame, now: Column) -> dict[str, DataFrame]:
    """A-5, O-7: failing topics first, the thinnest first."""
    return {"topics": rollups.ranked_probe(rollups.canon_probe(topics, rules, now)).orderBy("turn")}


def probe_source(files: DataFrame, registry: DataFrame, state: DataFrame, source_id: str) -> dict[str, DataFrame]:
    """P-22: what a cycle would process of one source's sitemap files (source_id, url, parent, xml), and what its list or root
    gives; nothing is written."""
    one = registry.filter(F.col("source_id") == source_id)
    listed = incremental.listing(files.filter(F.col("source_id") == source_id), reg.cursors(one)).select("source_id", "loc")
    return {"sitemap": incremental.preflight(listed, one, state), "list": web.url_list(one)}


def undeprecated(rules: DataFrame, key: str, now: Column) -> DataFrame:
    """M-17 for one id or rule_key; ValueError if no deprecated rule has it."""
    out = lifecycle.undeprecate(rules, [key], now)
    if out.filter("changed").isEmpty():
        raise ValueError(f"no deprecated rule is called {key!r}")
    return out.drop("changed")


def faithful_share(rules: DataFrame) -> dict[str, DataFrame]:
    """P-6, P-7: trusted and source-faithful rules among all."""
    n = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0)).cast("long")
    return {"rules": rules.agg(F.count(F.lit(1)).alias("n"), n(gates.trusted()).alias("trusted"), n(gates.source_faithful()).alias("faithful"))}
