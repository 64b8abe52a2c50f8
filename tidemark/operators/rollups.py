"""Aggregates, health views, scorecards and drift (section 2.4, and the orders of 2.6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import numeric_at_least
from ..functions.urls import org_key
from . import gates


def share(hit: Column, digits: int = 1) -> Column:
    """Percentage of rows that hit, as a double; null for no rows."""
    return F.round(100 * F.try_divide(F.sum(hit.cast("int")), F.count(F.lit(1))), digits).cast("double")


def brain_health(tables: dict[str, DataFrame], now: Column) -> DataFrame:
    """A-1, U-1: per table and tag: rows, share with URL, share of high confidence, stale and unembedded rows. The table
    named rules counts active, candidate and stateless rows only; elsewhere a null last_verified alone is stale, and
    figures a table has no column for are null."""
    parts = []
    for name, df in tables.items():
        is_rules = name == "rules"
        rows = df.filter(F.coalesce("status", F.lit("active")).isin("active", "candidate")) if is_rules else df
        has = set(df.columns)
        count = lambda c: F.sum(c.cast("int")).cast("long")
        none = F.lit(None)
        parts.append(
            rows.groupBy("domain_tag").agg(
                F.count(F.lit(1)).alias("n"),
                share(gates.has_url(F.col("source_url"))).alias("url_pct"),
                (share(numeric_at_least(F.col("confidence_score"), 0.9)) if is_rules else none.cast("double")).alias("hi_conf_pct"),
                (count(gates.stale(F.col("last_verified"), now) if is_rules else F.col("last_verified").isNull()) if "last_verified" in has else none.cast("long")).alias("stale_90d"),
                (count(F.col("embedding").isNull()) if "embedding" in has else none.cast("long")).alias("missing_embedding"),
            ).select(F.lit(name).alias("tbl"), "*")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def registry_health(registry: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """A-2, J-5: each source with its overdue flag and the number of rules of its organisation in any state."""
    n = rules.filter("source_org IS NOT NULL").groupBy(F.col("source_org").alias("canonical_org")).agg(F.count(F.lit(1)).alias("n"))
    j = registry.join(n, "canonical_org", "left")
    return j.select("source_id", "canonical_org", "tier", "crawl_cadence_days", "last_crawled_at", gates.overdue(now).alias("overdue"), F.coalesce("n", F.lit(0)).alias("rules_from_org"), "enabled")


def org_hygiene(rules: DataFrame) -> DataFrame:
    """A-3: organisation keys with more than one spelling, the spellings in order and the number of rules.

    Spellings are counted first, so a hot spelling reaches the second step as one row."""
    spelled = rules.filter(gates.has_url(F.col("source_org"))).groupBy("source_org").agg(F.count(F.lit(1)).alias("n"))
    g = spelled.groupBy(org_key(F.col("source_org")).alias("org_key")).agg(F.sort_array(F.collect_list("source_org")).alias("variants"), F.sum("n").alias("n"))
    return g.filter(F.size("variants") > 1)


def snapshot_metrics(rules: DataFrame, siblings: dict[str, DataFrame], registry: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """A-4, J-6: one row of metrics, each table read once; shares of an empty table are null."""
    num = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0)).cast("long")
    out = rules.agg(
        num(F.coalesce("status", F.lit("active")).isin("active", "candidate")).alias("rules_total"),
        share(gates.has_url(F.col("source_url"))).alias("rules_url_pct"),
        num(gates.trusted()).alias("rules_trusted"),
        num(gates.source_faithful()).alias("rules_source_faithful"),
        num(F.col("domain_tag").isin("aeo", "geo")).alias("aeo_geo_rules"),
        num(F.col("embedding").isNull()).alias("rules_missing_embedding"),
    )
    for name, df in siblings.items():
        out = out.join(F.broadcast(df.agg(F.count(F.lit(1)).alias(f"{name}_total"), share(gates.has_url(F.col("source_url"))).alias(f"{name}_url_pct"))))  # one row each
    out = out.join(F.broadcast(registry.agg(num(gates.overdue(now)).alias("sources_overdue"))))
    return out.join(F.broadcast(runs.agg(F.max_by("status", "run_id").alias("last_run_status"))))


#: Topics up to which their patterns become one expression; a longer list is joined pattern by pattern.
TOPICS = 500


def _ilike(lowered: Column, text: Column, pattern: str) -> Column:
    """text ILIKE pattern; a pattern that only asks for some words is looked for in the lowered text."""
    inner = pattern[1:-1]
    if len(pattern) >= 2 and pattern[0] == pattern[-1] == "%" and not set(inner) & set("%_\\"):
        return F.contains(lowered, F.lower(F.lit(inner)))
    return text.ilike(pattern)


def canon_probe(topics: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """J-1, A-5: for every topic the rules whose text matches one of its patterns (ILIKE), with counts. Topics are a
    configuration: they are counted first, and up to TOPICS of them become one expression, so that every rule is read and
    lowered once, tested against all patterns in one pass and counted before anything is shuffled; more of them are joined.
    Both ways give the same rows. Topics without a match stay with zeros; null patterns match nothing."""
    text = F.concat("name", F.lit(" "), F.coalesce("if_condition", F.lit("")), F.lit(" "), F.coalesce("then_logic", F.lit("")))
    r = rules.filter(~F.col("status").eqNullSafe("deprecated")).select(
        text.alias("txt"), "confidence_score", F.coalesce("last_verified", "extracted_at").alias("seen"), F.col("rule_type").eqNullSafe("observed").alias("observed")
    ).filter("txt IS NOT NULL")
    first = topics.select("topic", "patterns").limit(TOPICS + 1).collect()
    if len(first) <= TOPICS:
        low = F.lower("txt")
        any_of = lambda ps: F.array(*[_ilike(low, F.col("txt"), p) for p in ps if p is not None])
        names = [F.when(F.exists(any_of(t["patterns"]), lambda x: x), F.lit(t["topic"])) for t in first if any(p is not None for p in t["patterns"] or [])]
        found = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
        hit = r.withColumn("topic", F.explode(found)).join(F.broadcast(topics.select("topic", "min_conf")), "topic")  # TOPICS rows at most
    else:
        hit = r.join(topics.select("topic", "patterns", "min_conf"), F.expr("exists(patterns, p -> txt ilike p)"))
    c = lambda x: F.sum(x.cast("int")).cast("long")
    num = F.when(F.col("confidence_score").rlike(r"\A[0-9]+(\.[0-9]+)?\z"), F.col("confidence_score").try_cast("double"))
    got = hit.groupBy("topic").agg(
        F.count(F.lit(1)).alias("hits"), c(F.coalesce(num >= F.col("min_conf"), F.lit(False))).alias("hi_conf_hits"),
        c(F.coalesce(F.col("seen") > now - F.make_dt_interval(F.lit(90)), F.lit(False))).alias("fresh_hits"), c(F.col("observed")).alias("observed_hits"),
    )
    z = lambda n: F.coalesce(n, F.lit(0)).alias(n)
    j = topics.join(got, "topic", "left")
    return j.select("topic", z("hits"), z("hi_conf_hits"), z("fresh_hits"), z("observed_hits"), (F.coalesce("hi_conf_hits", F.lit(0)) >= F.col("min_hits")).alias("ok"))


def ranked_probe(probe: DataFrame) -> DataFrame:
    """O-7: adds `turn`: failing topics first, those with the fewest hits first."""
    return probe.withColumn("turn", F.row_number().over(W.orderBy("ok", "hits", "topic")))  # the topics, a configuration


def source_health_list(registry: DataFrame, limit: int = 3) -> DataFrame:
    """O-4, P-21: every source with its streak and whether it alerts, `turn` by the longest streak, then source_id."""
    fails = F.coalesce("consecutive_failures", F.lit(0))
    r = registry.select("source_id", "enabled", "consecutive_failures", F.left(F.coalesce("last_error", F.lit("")), F.lit(60)).alias("error"), (fails >= limit).alias("alert"))
    return r.withColumn("turn", F.row_number().over(W.orderBy(F.desc(fails), "source_id")))  # a small dimension


def status_histogram(changes: DataFrame, now: Column | None = None, days: int = 7) -> DataFrame:
    """A-6: extract states with their share as a whole percentage, rounded down; of the last days if now is given."""
    rows = changes if now is None else changes.filter(gates.recent(F.col("detected_at"), now, days))
    g = rows.groupBy("extract_status").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.partitionBy())  # over the few states only
    return g.withColumn("pct", F.floor(100 * F.col("n") / total))


def rules_added(rules: DataFrame, now: Column, days: int = 7, top: int = 8) -> DataFrame:
    """A-7: organisations by rules extracted in the last days, with those that have a URL."""
    g = rules.filter(gates.recent(F.col("extracted_at"), now, days)).groupBy("source_org").agg(F.count(F.lit(1)).alias("n"), F.sum(gates.has_url(F.col("source_url")).cast("int")).cast("long").alias("with_url"))
    return g.orderBy(F.desc("n"), F.asc_nulls_last("source_org")).limit(top)


def corpus_totals(rules: DataFrame) -> DataFrame:
    """A-8, A-9: rows, latest verification day, embedded rows and floor percentages; without an embedding column
    those are null."""
    emb = F.count("embedding") if "embedding" in rules.columns else F.lit(None).cast("long")
    n = F.count(F.lit(1))
    floor = lambda x: F.floor(100 * x / F.greatest(n, F.lit(1)))
    url = F.coalesce(F.sum(gates.has_url(F.col("source_url")).cast("int")), F.lit(0)).cast("long")
    return rules.agg(n.alias("n"), F.to_date(F.max("last_verified")).alias("verified_through"), emb.alias("embedded"), floor(emb).alias("embedded_pct"), url.alias("with_url"), floor(url).alias("url_pct"))


def top_orgs(rules: DataFrame, top: int = 12) -> DataFrame:
    """A-10"""
    return rules.groupBy(F.coalesce("source_org", F.lit("(null)")).alias("org")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "org").limit(top)


def tag_mode(rules: DataFrame, key: str = "document_id", tag: str = "domain_tag", order: str = "id") -> DataFrame:
    """A-15: the most frequent tag per key; of equal counts the one that came first in `order`. Null tags do not count."""
    g = rules.filter(F.col(key).isNotNull() & F.col(tag).isNotNull()).groupBy(key, tag).agg(F.count(F.lit(1)).alias("c"), F.min(order).alias("first"))
    return g.groupBy(key).agg(F.min_by(tag, F.struct(-F.col("c"), F.col("first"))).alias("mode"), F.sum("c").alias("n"))


def max_numeric_id(df: DataFrame, col: str = "id") -> DataFrame:
    """A-13: the largest id among those that are numbers; 0 if there is none."""
    return df.agg(F.coalesce(F.max(F.when(F.col(col).rlike(r"\A[0-9]+\z"), F.col(col).try_cast("bigint"))), F.lit(0)).alias("max_id"))


def run_summary(changes: DataFrame) -> DataFrame:
    """A-14: per run what its changes came to; done iff nothing failed and nothing was given up."""
    c = lambda x: F.coalesce(F.sum(x.cast("int")), F.lit(0)).cast("long")
    s = F.col("extract_status")
    bad = s.isin("failed", "gave_up")
    per = changes.filter("run_id IS NOT NULL").groupBy("run_id").agg(
        F.count_distinct("source_id").alias("sources_changed"), F.count(F.lit(1)).alias("urls_changed"), F.coalesce(F.sum("rules_new"), F.lit(0)).alias("rules_written"),
        F.coalesce(F.sum("rules_refreshed"), F.lit(0)).alias("refreshed"), c(s == "retired").alias("retired"), c(bad).alias("failed"),
    )
    failing = changes.filter(bad & F.col("run_id").isNotNull()).groupBy("run_id", "source_id").agg(F.lit(1)).groupBy("run_id").agg(F.sort_array(F.collect_list("source_id")).alias("failing_sources"))
    j = per.join(failing, "run_id", "left")
    return j.withColumns({"status": F.when(F.col("failed") == 0, "done").otherwise("partial"), "failing_sources": F.coalesce("failing_sources", F.array().cast("array<string>"))})


def source_ledger(changes: DataFrame) -> DataFrame:
    """A-16: counters per source."""
    c = lambda x: F.coalesce(F.sum(x.cast("int")), F.lit(0)).cast("long")
    return changes.filter("source_id IS NOT NULL").groupBy("source_id").agg(
        F.count(F.lit(1)).alias("changes"), c(F.col("extract_status") == "extracted").alias("extracted"), c(F.col("extract_status").isin("failed", "gave_up")).alias("failed"),
        F.coalesce(F.sum("rules_new"), F.lit(0)).alias("rules_new"), F.max("detected_at").alias("last_detected"),
    )


def metric_delta(snapshots: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """A-18, W-6: each metric's value, the one before and the difference."""
    w = W.partitionBy(*keys).orderBy(at)
    return snapshots.withColumn("previous", F.lag(value).over(w)).withColumn("delta", F.col(value) - F.col("previous"))


def drift_alerts(history: DataFrame, drop: float = 2.0) -> DataFrame:
    """A-18: (taken_at, alert): url share fell by more than `drop` points, or the last run was degraded (as distinct
    from partial or failed, which do not alert here)."""
    d = metric_delta(history.withColumn("_k", F.lit(1)), ["_k"], "taken_at", "rules_url_pct")
    alerts = F.array_compact(F.array(F.when(F.col("delta") < -drop, "url share fell"), F.when(F.col("last_run_status") == "degraded", "degraded run")))
    return d.select("taken_at", F.explode(alerts).alias("alert"))


def alert_needed(run_status: Column, longest_streak: Column, limit: int = 3) -> Column:
    """S-23: whether a run is reported: it is not done, or a source has failed `limit` times in a row."""
    return ~run_status.eqNullSafe("done") | F.coalesce(longest_streak >= limit, F.lit(False))
