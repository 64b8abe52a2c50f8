"""The reference's own operators as queries over whole tables: (spark, folder) -> DataFrame.

Every query that needs a clock takes the as-of time of the data. Timestamps leave as text, so that results compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls as ux
from ..operators import gates, incremental, lifecycle, lookups, rollups
from ..session import AS_OF, table, temporary
from ..sources import files, registry, web
from ..streaming import replay
from .sql import ORACLES  # noqa: F401


def now() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def stamp(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _snapshot(s: SparkSession, d: str, back: int = 0) -> DataFrame:
    """The rows of the last delivery of url_state, or of the one `back` before it. Its number is read first (one number per
    delivery), so that the scan is pruned by it; without such a delivery there are no rows."""
    u = table(s, d, "url_state")
    numbers = sorted((r[0] for r in u.filter("snapshot_no IS NOT NULL").select("snapshot_no").distinct().collect()), reverse=True)
    return u.filter(F.col("snapshot_no") == numbers[back]) if len(numbers) > back else u.filter(F.lit(False))


def _prior(s: SparkSession, d: str) -> DataFrame:
    """The state after the last snapshot: one row per normalised URL, the latest capture counts."""
    return lifecycle.rekey_url_state(_snapshot(s, d).drop("snapshot_no"))


def page_change_detect(s: SparkSession, d: str) -> DataFrame:
    """T-5 with F-1, P-8, F-2, F-5, W-2: the first capture of every page against the prior state."""
    p = table(s, d, "changed_urls").filter("text IS NOT NULL AND url IS NOT NULL").withColumn("url", ux.normalize_url(F.col("url")))
    p = p.filter(ux.url_allowed(F.col("url"))).select("url", "page_id", "run_id", "title", "text")
    first = incremental.first_occurrence(p, ["url"], [F.coalesce("run_id", F.lit(0)), F.col("page_id")])
    seen = incremental.classify(first.withColumn("status", F.lit(200)), _prior(s, d).select("url", F.lower("content_hash").alias("content_hash")))
    return seen.select("page_id", F.col("url").alias("norm_url"), "title", F.col("new_hash").alias("content_hash"), "change_type")


def url_normalize(s, d):
    return table(s, d, "ingest_changes").select("change_id", "url", ux.normalize_url(F.col("url")).alias("norm_url")).distinct()


def url_hygiene(s, d):
    u = table(s, d, "ingest_changes").filter("url IS NOT NULL").select("source_id", ux.normalize_url(F.col("url")).alias("url")).distinct()
    j = u.join(registry.url_filters(table(s, d, "source_registry")), "source_id", "left")
    return j.select("source_id", "url", ux.deny_reason(F.col("url")).alias("deny_reason"), ux.url_allowed(F.col("url"), F.col("url_filter")).alias("allowed"))


def url_specificity(s, d):
    u = F.col("source_url")
    return table(s, d, "rules").select("id", ux.specificity(u).alias("spec_backfill"), ux.specificity_upsert(u).alias("spec_upsert"), F.coalesce(ux.host(u), F.lit("")).alias("host"), F.coalesce(ux.url_tail(u), F.lit("")).alias("tail"))


def page_title(s, d):
    h = F.concat(F.lit("<html><head><Title lang='en'> "), F.coalesce("title", F.lit("")), F.lit(" | "), F.initcap("source_id"), F.lit("</title></head>"))
    return table(s, d, "changed_urls").select("page_id", tx.page_title(h).alias("title"))


def page_main_text(s, d):
    h = F.concat(F.lit("<html><style>p {x: y}</style><body><p>"), F.replace("text", F.lit("\n"), F.lit("</p><p class='x'>")), F.lit("</p><script>let a = 1;</script></body></html>"))
    t = tx.main_text(h)
    return table(s, d, "changed_urls").filter("text IS NOT NULL").select("page_id", F.length(t).alias("n_chars"), F.sha2(t, 256).alias("text_hash"))


def doc_content_hash(s, d):
    return table(s, d, "documents").select("doc_id", tx.content_hash(F.col("text")).alias("content_hash"))


def doc_dedupe_first(s, d):
    h = table(s, d, "documents").select("doc_id", tx.content_hash(F.col("text")).alias("content_hash"))
    return h.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("dup_count"))


def relevance_screen(s, d):
    hits = tx.relevance_hits(F.col("text"))
    return table(s, d, "documents").select("doc_id", hits.alias("hits"), (hits >= 2).alias("relevant"))


def doc_chunks(s, d):
    c = table(s, d, "documents").filter("text IS NOT NULL").select("doc_id", F.posexplode(tx.chunks(F.col("text"))).alias("chunk_no", "chunk"))
    return c.select("doc_id", "chunk_no", F.length("chunk").alias("n_chars"), F.sha2("chunk", 256).alias("chunk_hash"))


def rule_key(s, d):
    return table(s, d, "rules").select("id", tx.rule_key(F.col("name"), F.col("if_condition")).alias("rule_key"))


def numeric_text_guard(s, d):
    c = F.col("confidence_score")
    return table(s, d, "rules").select("id", tx.numeric_at_least(c, 0.6).alias("at_least_60"), tx.numeric_at_least(c, 0.9).alias("at_least_90"))


def embed_text(s, d):
    cols = [F.col(c) for c in ("name", "if_condition", "then_logic")]
    return table(s, d, "rules").select("id", F.sha2(tx.embed_text_batch(*cols), 256).alias("batch_hash"), F.sha2(tx.embed_text_cycle(*cols), 256).alias("cycle_hash"))


def rule_status(s, d):
    t = F.concat_ws(" ", "name", "if_condition", "then_logic")
    return table(s, d, "rules").select("id", tx.rule_status(F.col("status")).alias("status"), gates.deprecated_claim(t).alias("deprecated_claim"), tx.refs(F.coalesce("document_id", F.lit(""))).alias("refs"))


def brain_health(s, d):
    docs = table(s, d, "documents")
    return rollups.brain_health({"rules": table(s, d, "rules"), "documents": docs.select("domain_tag", "source_url")}, now())


def trusted_rules(s, d):
    return table(s, d, "rules").filter(gates.trusted()).select("id", "rule_key")


def citable_rules(s, d):
    r = table(s, d, "rules")
    return r.select("id", gates.citable(r).alias("citable"), gates.source_faithful().alias("faithful"), gates.locale_variant(F.coalesce("source_url", F.lit(""))).alias("locale"))


def registry_health(s, d):
    return rollups.registry_health(table(s, d, "source_registry"), table(s, d, "rules"), now()).withColumn("last_crawled_at", stamp("last_crawled_at"))


def overdue_sources(s, d):
    """P-2 with the order of O-8 as a rank."""
    r = registry.ordered(table(s, d, "source_registry").filter(gates.overdue(now())))
    return r.select("source_id", "tier", stamp("last_crawled_at").alias("last_crawled"), "turn")


def due_sources(s, d):
    """P-1 with the order of O-1 as a rank."""
    r = table(s, d, "source_registry").filter(gates.due(now()))
    rank = F.row_number().over(W.orderBy("tier", F.asc_nulls_first("last_crawled_at"), "source_id"))  # sources only, a small dimension
    return r.select("source_id", rank.alias("turn"))


def org_hygiene(s, d):
    return rollups.org_hygiene(table(s, d, "rules")).select("org_key", F.array_join("variants", "|").alias("variants"), "n")


def health_snapshot(s, d):
    return rollups.snapshot_metrics(table(s, d, "rules"), {"documents": table(s, d, "documents")}, table(s, d, "source_registry"), table(s, d, "ingest_runs"), now())


def drift(s, d):
    """A-18 over the history of runs: the share of rules with a URL per run, and alerts."""
    per = table(s, d, "rules").filter("run_id IS NOT NULL").groupBy("run_id").agg(rollups.share(gates.has_url(F.col("source_url"))).alias("rules_url_pct"))
    h = per.join(table(s, d, "ingest_runs").select("run_id", F.col("started_at").alias("taken_at"), F.col("status").alias("last_run_status")), "run_id")
    return rollups.drift_alerts(h).withColumn("taken_at", stamp("taken_at"))


def status_histogram(s, d):
    return rollups.status_histogram(table(s, d, "ingest_changes"))


def scorecard_runs(s, d):
    """O-2, O-13: the last five runs."""
    return table(s, d, "ingest_runs").orderBy(F.desc("run_id")).limit(5).select("run_id", F.date_format("started_at", "yyyy-MM-dd").alias("day"), "status", "urls_changed", "objects_written")


def recent_changes(s, d):
    """O-3: the 25 latest changes; deliveries of the same change count once."""
    c = table(s, d, "ingest_changes").dropDuplicates(["change_id"])
    return c.orderBy(F.desc("change_id")).limit(25).select("change_id", "source_id", "change_type", "extract_status")


def source_health_list(s, d):
    """O-4 (as a rank), P-21, F-19, F-20"""
    return rollups.source_health_list(table(s, d, "source_registry"))


def rules_added(s, d):
    return rollups.rules_added(table(s, d, "rules"), now(), days=180)


def top_orgs_with_url(s, d):
    return rollups.top_orgs(table(s, d, "rules"))


def coverage_totals(s, d):
    return rollups.corpus_totals(table(s, d, "rules")).withColumn("verified_through", F.col("verified_through").cast("string"))


def tag_mode(s, d):
    return rollups.tag_mode(table(s, d, "rules"))


def max_rule_id(s, d):
    return rollups.max_numeric_id(table(s, d, "rules"))


def run_summary(s, d):
    c = table(s, d, "ingest_changes").dropDuplicates(["change_id"])
    return rollups.run_summary(c).withColumn("failing_sources", F.array_join("failing_sources", ","))


def source_ledger(s, d):
    return rollups.source_ledger(table(s, d, "ingest_changes").dropDuplicates(["change_id"])).withColumn("last_detected", stamp("last_detected"))


TOPICS = [
    ("sitemaps", "seo", ["%sitemap%", "%crawl log%"], 3, 0.7),
    ("snippets", "aeo", ["%answer box%", "%snippet%"], 5, 0.8),
    ("structure", "seo", ["%schema block%", "%json-ld%"], 3, 0.9),
    ("speed", "content", ["%loads in _ seconds%"], 3, 0.7),
    ("absent", "geo", ["%quantum blockchain%"], 1, 0.7),
]


def canon_probe(s, d):
    topics = s.createDataFrame(TOPICS, "topic string, domain_tag string, patterns array<string>, min_hits int, min_conf double")
    return rollups.ranked_probe(rollups.canon_probe(topics, table(s, d, "rules"), now()))


def neighbor_adopt(s, d):
    """J-2, M-14: every rule with a vector of 64 numbers may adopt the URL of its nearest neighbour in its organisation."""
    near = lookups.nearest_citation(table(s, d, "rules"), candidate=F.col("embedding").isNotNull(), dim=64)
    return near.select("id", "nn_id", F.round("sim", 5).alias("sim"))


def alias_normalize(s, d):
    return lookups.apply_aliases(table(s, d, "rules").select("id", "source_org"), table(s, d, "org_aliases"))


def org_normalize_pipeline(s, d):
    return lookups.normalize_orgs(table(s, d, "rules").select("id", "source_org", "source_url"), table(s, d, "org_aliases")).select("id", "source_org")


def evidence_cutoff(s, d):
    return lookups.evidence_cutoff(table(s, d, "ingest_changes")).withColumn("cutoff", stamp("cutoff"))


def latest_change_per_url(s, d):
    c = table(s, d, "ingest_changes").filter("url IS NOT NULL").select("url", "change_id", "extract_status", "change_type").distinct()
    return lifecycle.latest(c, ["url"], [F.col("change_id")])


def pending_retries(s, d):
    return incremental.pending_retries(table(s, d, "ingest_changes").filter("source_id IS NOT NULL"))


def failure_backstop(s, d):
    return incremental.failures_by_version(table(s, d, "ingest_changes"), now())


def failure_streak(s, d):
    return lifecycle.failure_streaks(table(s, d, "ingest_changes"))


def capped_changes(s, d):
    c = table(s, d, "ingest_changes").dropDuplicates(["change_id"]).filter("run_id IS NOT NULL")
    return incremental.capped(c).select("change_id", "run_id", "source_id", "truncated")


def consume(s, d):
    """T-2, T-3, T-4: what each change of the log comes to, given the failures recorded for its version."""
    c = table(s, d, "ingest_changes").dropDuplicates(["change_id"])
    got = incremental.consume(c, incremental.failures_by_version(c, now()))
    return got.select("change_id", "final_status", "consumed")


def marker_moves(s, d):
    c = incremental.capped(table(s, d, "ingest_changes").dropDuplicates(["change_id"]).filter("run_id IS NOT NULL AND source_id IS NOT NULL"))
    return incremental.marker_moves(incremental.consume(c, incremental.failures_by_version(c, now())))


def _listed(s, d) -> DataFrame:
    """The pages of each source as its sitemap would list them: the URLs of the last snapshot in order."""
    u = _snapshot(s, d).filter("url IS NOT NULL AND source_id IS NOT NULL").select("source_id", F.col("url").alias("loc"), F.col("last_modified").alias("lastmod")).groupBy("source_id", "loc").agg(F.max("lastmod").alias("lastmod"))
    return u.withColumn("pos", F.row_number().over(W.partitionBy("source_id").orderBy("loc")) - 1)


def rotation_window(s, d):
    return incremental.rotate(_listed(s, d), registry.cursors(table(s, d, "source_registry"))).select("source_id", "loc", "turn")


def probe_budget(s, d):
    """T-6 over the sitemaps of the last snapshot against the state before it."""
    r = table(s, d, "source_registry")
    before = _snapshot(s, d, 1).select(ux.normalize_url(F.col("url")).alias("url"), "last_modified").filter("url IS NOT NULL").groupBy("url").agg(F.max("last_modified").alias("last_modified"))
    retries = incremental.pending_retries(table(s, d, "ingest_changes").filter("source_id IS NOT NULL"))
    return incremental.walk(incremental.rotate(_listed(s, d), registry.cursors(r)), before, retries, filters=r)


def preflight(s, d):
    """P-22: a dry run over the sitemaps of the last snapshot against the state before it."""
    before = _snapshot(s, d, 1).select(ux.normalize_url(F.col("url")).alias("url")).filter("url IS NOT NULL")
    return incremental.preflight(_listed(s, d), table(s, d, "source_registry"), before)


def next_cursor(s, d):
    n = _listed(s, d).groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    r = table(s, d, "source_registry").filter("adapter_type = 'sitemap'")
    j = registry.cursors(r).join(n, "source_id", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("is_index", F.col("child").isNotNull())
    return incremental.next_cursor(j).select("source_id", F.col("offset").cast("bigint").alias("offset"), F.col("child").cast("bigint").alias("child"))


def sitemap_parse(s, d):
    """S-6: sitemap files are built from the last snapshot, one per source, and read again, at most 300 entries each."""
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    p = _listed(s, d)
    entry = F.concat(F.lit("<url><loc> "), esc(F.col("loc")), F.lit(" </loc>"), F.when(F.col("lastmod").isNotNull(), F.concat(F.lit("<lastmod>"), esc(F.col("lastmod")), F.lit("</lastmod>"))).otherwise(""), F.lit("</url>"))
    # a sitemap file holds 50,000 entries at most; sources with more have several
    part = F.floor(F.col("pos") / 300)
    xml = F.concat(F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", entry.alias("e")))), lambda x: x["e"]), ""), F.lit("</urlset>"))
    files_ = p.groupBy("source_id", part.alias("part")).agg(xml.alias("xml"))
    return web.sitemap_urls(files_).select("source_id", "part", "pos", "loc", "lastmod")


def seed_url_list(s, d):
    return web.url_list(table(s, d, "source_registry"))


def adapter_dispatch(s, d):
    """S-13, S-18, S-23"""
    r = table(s, d, "source_registry")
    return r.select("source_id", web.adapter(F.col("adapter_type")).alias("adapter"), web.content_kind(F.lit("text/html"), F.col("root_url")).alias("kind"), rollups.alert_needed(F.lit("done"), F.col("consecutive_failures")).alias("alert"))


def harvest(s, d):
    """P-14, S-5: the pages handed on for extraction."""
    p = files.harvest(table(s, d, "changed_urls").filter("source_id IS NOT NULL"), [F.col("page_id")])
    return p.select("page_id", "source_id", "title", F.length("text").alias("n_chars"))


def _versions(s, d) -> DataFrame:
    """One fetched version per raw URL: the latest capture of changed_urls."""
    c = table(s, d, "changed_urls").filter("url IS NOT NULL AND coalesce(text, '') <> ''").select("url", "text", "page_id", F.coalesce("run_id", F.lit(0)).alias("run_id"))
    return lifecycle.latest(c, ["url"], [F.col("run_id"), F.col("page_id")]).withColumn("content_hash", tx.content_hash(F.col("text")))


def reconcile_excerpts(s, d):
    out = lifecycle.reconcile(table(s, d, "rules"), _versions(s, d), now())
    return out.filter("outcome IS NOT NULL").select("id", "outcome", "status", "provenance_status", "source_content_hash")


def quality_gate(s, d):
    """P-11, P-12: every rule against the text of its document."""
    docs = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("document_id"), "text").dropDuplicates(["document_id"])
    r = table(s, d, "rules").select("id", "name", "if_condition", "then_logic", "confidence_score", "source_excerpt", "status", "document_id")
    g = gates.quality_gate(r.join(docs, "document_id", "left"))
    return g.select("id", "kept", "reject_reason", "new_status")


def reverify_stamp(s, d):
    seen = _snapshot(s, d).filter("content_hash IS NOT NULL").select("url", F.lower("content_hash").alias("content_hash"))
    out = lifecycle.restamp(table(s, d, "rules").select("id", "source_url", "last_verified", "status", "url_provenance"), seen, table(s, d, "ingest_changes"), now())
    return out.select("id", "stamped")


def retire_removed(s, d):
    gone = table(s, d, "ingest_changes").filter("change_type = 'removed'").select("url").filter("url IS NOT NULL")
    rules, _ = lifecycle.retire_removed(table(s, d, "rules").select("id", "source_url", "status"), table(s, d, "url_state").select("url"), gone)
    return rules.select("id", "status")


def state_after_removal(s, d):
    gone = table(s, d, "ingest_changes").filter("change_type = 'removed'").select("url").filter("url IS NOT NULL")
    _, state = lifecycle.retire_removed(table(s, d, "rules").select("source_url", "status"), _snapshot(s, d).select("url", "content_hash"), gone)
    return state.groupBy("url").agg(F.count(F.lit(1)).alias("n"))


def mark_pending(s, d):
    changed = table(s, d, "ingest_changes").filter("change_type = 'modified' AND url IS NOT NULL").select("url")
    return lifecycle.mark_pending(table(s, d, "rules").select("id", "source_url", "status", "provenance_status"), changed).select("id", "provenance_status")


def url_state_rekey(s, d):
    u = _snapshot(s, d).select("url", "content_hash", "last_seen_at")
    return lifecycle.rekey_url_state(u).select("url", "content_hash", stamp("last_seen_at").alias("last_seen_at"), "spellings")


def url_state_upsert(s, d):
    base = lifecycle.latest(_snapshot(s, d, 1).filter("url IS NOT NULL").drop("snapshot_no"), ["url"], [F.coalesce("last_seen_at", F.lit("0001-01-01").cast("timestamp")), F.coalesce("content_hash", F.lit("")), F.coalesce("source_id", F.lit(""))])
    out = lifecycle.save_url_state(base, _snapshot(s, d).drop("snapshot_no").withColumn("last_seen_at", F.coalesce("last_seen_at", F.lit("0001-01-01").cast("timestamp"))))
    return out.select("url", "source_id", "content_hash")


def source_upsert(s, d):
    """M-1, M-2: seeds with half of the sources changed and some new ones, forced; then all are marked as crawled."""
    r = table(s, d, "source_registry")
    seeds = r.select("source_id", F.upper("canonical_org").alias("canonical_org"), F.lit(False).alias("enabled"), "adapter_type", F.lit(1).cast("smallint").alias("tier"))
    seeds = seeds.filter(F.length("source_id") % 2 == 0).unionByName(seeds.withColumn("source_id", F.concat("source_id", F.lit("-new"))))
    out = registry.upsert_sources(r, seeds, force=True)
    marks = r.select("source_id", F.concat(F.lit("v"), F.col("tier")).alias("marker"))
    return registry.mark_crawled(out, marks, now()).select("source_id", "canonical_org", "enabled", "tier", "last_seen_marker", stamp("last_crawled_at").alias("last_crawled_at"))


def source_health_fold(s, d):
    c = table(s, d, "ingest_changes").filter("source_id IS NOT NULL").dropDuplicates(["change_id"]).filter("detected_at IS NOT NULL")
    o = c.groupBy("source_id", F.col("detected_at").alias("at")).agg(F.bool_and(~F.coalesce(F.col("extract_status").isin("failed", "gave_up"), F.lit(False))).alias("ok"), F.max("url").alias("error"))
    return lifecycle.source_health(table(s, d, "source_registry"), o).select("source_id", "consecutive_failures", stamp("last_ok_at").alias("last_ok_at"), "last_error")


def upsert_fold(s, d):
    return lifecycle.upsert_fold(lifecycle.rule_events(table(s, d, "rules"))).select("rule_key", "source_url", "url_provenance", "status", "proof", "content_hash", stamp("last_verified").alias("last_verified"), "n_events")


def undeprecate(s, d):
    """M-17 over all deprecated rules, by rule_key, or by id where they have none."""
    r = table(s, d, "rules").select("id", "rule_key", "status", "last_verified")
    keys = r.filter("status = 'deprecated'").select(F.coalesce("rule_key", "id").alias("key"))
    return lifecycle.undeprecate(r, keys, now()).filter("changed").select("id", "status")


def stale_runs(s, d):
    """M-8, T-12"""
    return lifecycle.start_run(table(s, d, "ingest_runs"), now()).select("run_id", "status", stamp("finished_at").alias("finished_at"))


def run_detail(s, d):
    """F-24: paths into the JSON detail of runs."""
    j = lambda p: F.get_json_object("detail", p)
    return table(s, d, "ingest_runs").select("run_id", j("$.sources[0].status").alias("first_status"), j("$.host_no").alias("host_no"))


def embedding_queue(s, d):
    return lookups.embedding_queue(table(s, d, "rules")).select("id")


def document_upsert(s, d):
    """M-9: pages as documents. Half of the pages are known beforehand by their URL."""
    docs = table(s, d, "documents").filter("source_url IS NOT NULL").groupBy("source_url").agg(F.min("doc_id").cast("string").alias("id"), F.lit("old").alias("title"))
    at = F.coalesce("run_id", F.lit(0)) * 1_000_000 + F.col("page_id")
    pages = table(s, d, "changed_urls").select("url", "title", F.col("source_id").alias("source_org"), at.alias("at"))
    pages = pages.unionByName(docs.filter(F.length("source_url") % 2 == 0).select(F.col("source_url").alias("url"), F.lit("again").alias("title"), F.lit("x").alias("source_org"), F.lit(0).cast("bigint").alias("at")))
    return lifecycle.upsert_documents(docs, pages).select("id", "title", "source_url")


def observe_gate(s, d):
    """P-13, F-12: rules as observations: n of m records of an organisation are verified, over its loads."""
    r = table(s, d, "rules").filter("source_org IS NOT NULL")
    g = r.groupBy("source_org").agg(F.count(F.lit(1)).alias("m"), F.sum((F.col("provenance_status") == "verified_excerpt").cast("int")).alias("n"), F.count_distinct("run_id").alias("sessions"), F.max("name").alias("name"), F.max("if_condition").alias("if_condition"), F.max("then_logic").alias("then_logic"), F.max("domain_tag").alias("domain_tag"))
    o = g.withColumn("prevalence", F.struct(F.col("n").cast("string").alias("n"), F.col("m").cast("string").alias("m"), F.col("sessions").cast("string").alias("sessions")))
    return gates.observation_gate(o).select("source_org", "reject_reason", "confidence", "tag")


def snapshot_delta(s, d):
    per = table(s, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return rollups.metric_delta(per, ["event_type"], "day", "n")


def event_windows(s, d):
    """Structured Streaming: daily counts per event type with a watermark, replayed as available micro-batches. The
    log is bounded, so the windows the watermark has not passed at its end are flushed."""
    root = temporary(s, "stream")
    events = replay.stream_table(s, d, "events", table(s, d, "events").schema)
    at = F.col("ts").cast("timestamp")
    replay.replay_to_folder(replay.windowed_counts(events.withColumn("ts", at)), f"{root}/out", f"{root}/offsets")
    got = s.read.schema("window_start timestamp, event_type string, n bigint, total double").option("recursiveFileLookup", "true").parquet(f"{root}/out")
    got = got.unionByName(replay.open_windows(table(s, d, "events").withColumn("ts", at), got))
    return got.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total")


def numbered_rules(s, d):
    """W-7: new consecutive ids after the largest one, in order of creation."""
    r = table(s, d, "rules").select("id", "created_at")
    start = rollups.max_numeric_id(r).first()[0]
    return lookups.numbered(r, start, [F.col("created_at"), F.col("id")]).select("id", "new_id")


QUERIES = {
    f.__name__: f
    for f in (
        page_change_detect, url_normalize, url_hygiene, url_specificity, page_title, page_main_text, doc_content_hash, doc_dedupe_first, relevance_screen, doc_chunks,
        rule_key, numeric_text_guard, embed_text, rule_status, brain_health, trusted_rules, citable_rules, registry_health, overdue_sources, due_sources, org_hygiene,
        health_snapshot, drift, status_histogram, scorecard_runs, recent_changes, source_health_list, rules_added, top_orgs_with_url, coverage_totals, tag_mode, max_rule_id,
        run_summary, source_ledger, canon_probe, neighbor_adopt, alias_normalize, org_normalize_pipeline, evidence_cutoff, latest_change_per_url, pending_retries,
        failure_backstop, failure_streak, capped_changes, consume, marker_moves, rotation_window, probe_budget, preflight, next_cursor, sitemap_parse, seed_url_list, adapter_dispatch,
        harvest, reconcile_excerpts, quality_gate, reverify_stamp, retire_removed, state_after_removal, mark_pending, url_state_rekey, url_state_upsert, source_upsert,
        source_health_fold, upsert_fold, undeprecate, stale_runs, run_detail, embedding_queue, document_upsert, observe_gate, snapshot_delta, event_windows, numbered_rules,
    )
}
