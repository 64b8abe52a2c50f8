"""Queries over the jobs, sources and sinks, and their SQL: what no single operator's query shows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls as ux
from ..functions.salvage import rules_from_answer
from ..operators import gates, incremental, lifecycle, lookups
from ..schemas import SCHEMAS, conform, missing_columns, schema
from ..session import stored, table, temporary
from ..sources import files, registry, web
from . import external, jobs
from .queries import _listed, _prior, _snapshot, now, stamp
from .sql import BEFORE, CHANGES, CITABLE, KEY, LAST, LISTED, LOCALE, NOW, OFFSETS, RELEVANCE, RETRIES, TURNS, WS, claim, deny, norm, path_of, squeeze, text, utc

RULE = "name string, if_condition string, then_logic string, source_excerpt string, domain_tag string, confidence_score string, status string"


def _corpus(s: SparkSession, d: str) -> jobs.Corpus:
    rules = conform(table(s, d, "rules").drop("run_id"), schema("rules")).select(*schema("rules").names)
    docs = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "title", "domain_tag", "source_url", "created_at")
    state = _prior(s, d).select("url", "source_id", "etag", "last_modified", F.lower("content_hash").alias("content_hash"), F.col("last_seen_at").cast("timestamp").alias("last_seen_at"))
    changes = table(s, d, "ingest_changes").dropDuplicates(["change_id"])
    return jobs.Corpus(rules, stored(state), stored(changes), conform(docs, schema("documents")).select(*schema("documents").names), table(s, d, "source_registry"), table(s, d, "ingest_runs"))


def _observed(s: SparkSession, d: str) -> DataFrame:
    """The first capture of every page of changed_urls as an observation; one without text counts as a page that is gone."""
    p = table(s, d, "changed_urls").filter("url IS NOT NULL")
    p = p.select(ux.normalize_url(F.col("url")).alias("url"), "source_id", "text", "etag", "lastmod", F.concat(F.lpad(F.coalesce("run_id", F.lit(0)).cast("string"), 12, "0"), F.lpad(F.col("page_id").cast("string"), 12, "0")).alias("arrival"))
    one = incremental.first_occurrence(p, ["url"], [F.col("arrival")])
    return stored(one.withColumn("status", F.when(F.col("text").isNull(), 410).otherwise(200)))


def _answers(s: SparkSession, d: str, pages: DataFrame) -> DataFrame:
    """A model's answers for the first captures: of each page one rule that it proves by its first 80 characters, and one that
    restates a known rule of the same URL (the page of a rule_key is its smallest URL). Pages with an empty lastmod and no
    etag stay without an answer."""
    r = table(s, d, "rules").filter("rule_key IS NOT NULL AND source_url IS NOT NULL AND name IS NOT NULL AND if_condition IS NOT NULL")
    mine = r.withColumn("k", tx.rule_key(F.col("name"), F.col("if_condition"))).filter("k = rule_key")
    mine = mine.groupBy("rule_key").agg(F.min_by(F.struct("name", "if_condition"), "id").alias("n"), F.min(ux.normalize_url(F.col("source_url"))).alias("url"))
    mine = mine.groupBy("url").agg(F.min_by("n", "rule_key").alias("old"))
    p = pages.filter("etag IS NOT NULL OR lastmod IS NOT NULL").join(mine, "url", "left")
    quote = F.left(tx.squeeze(F.col("text")), F.lit(80))
    item = lambda name, cond: F.struct(name.alias("name"), cond.alias("if_condition"), F.lit("see the page").alias("then_logic"), quote.alias("source_excerpt"), F.lit("seo").alias("domain_tag"), F.lit("0.9").alias("confidence_score"), F.lit("active").alias("status"))
    new, old = item(F.concat(F.lit("Read "), F.col("url")), F.lit("always")), item(F.col("old.name"), F.col("old.if_condition"))
    return stored(p.select("url", F.col("source_id").alias("org"), F.when(F.col("old").isNotNull(), F.array(new, old)).otherwise(F.array(new)).alias("rules")))


def _cycle(s: SparkSession, d: str, monitor: bool = False):
    pages = _observed(s, d)
    return jobs.cycle(_corpus(s, d), pages, _answers(s, d, pages), now(), monitor=monitor)


def _rows(what: str, df: DataFrame, key: str, *cols: str | Column) -> DataFrame:
    """Rows of several tables as one: everything as text."""
    c = [F.col(x).cast("string").alias(n) for x, n in zip(cols, "abcd")]
    return df.select(F.lit(what).alias("what"), F.col(key).cast("string").alias("key"), *c, *[F.lit(None).cast("string").alias(n) for n in "abcd"[len(cols) :]])


def cycle(s, d):
    """T-1 to T-5, T-9 to T-11, X-5, M-2, M-4 to M-12: all tables after one cycle over all pages: its log rows, every rule, page,
    source and run, and the documents that were added."""
    pages = _observed(s, d)
    start = _corpus(s, d)
    after, _ = jobs.cycle(start, pages, _answers(s, d, pages), now())
    log = after.changes.join(start.changes.select("change_id"), "change_id", "left_anti").withColumn("n", F.concat_ws("/", "rules_new", "rules_refreshed"))
    rules = after.rules.withColumn("t", stamp("last_verified"))
    state = after.url_state.withColumn("t", stamp("last_seen_at"))
    sources = after.registry.withColumn("t", stamp("last_crawled_at"))
    runs = after.runs.withColumns({"n": F.concat_ws("/", "sources_checked", "sources_changed", "urls_changed", "objects_written"), "t": stamp("finished_at")})
    docs = after.documents.join(start.documents.select("id"), "id", "left_anti")
    parts = [
        _rows("log", log, "change_id", "url", "change_type", "extract_status", "n"), _rows("rule", rules, "id", "status", "source_url", "provenance_status", "t"), _rows("proof", rules, "id", "source_content_hash", "document_id"),
        _rows("page", state, "url", "source_id", "etag", "content_hash", "t"), _rows("source", sources, "source_id", "consecutive_failures", "last_error", "t", "last_seen_marker"), _rows("run", runs, "run_id", "status", "n", "t"),
        _rows("document", docs, "id", "source_url", "title", "domain_tag", "source_type"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def monitor_cycle(s, d):
    """T-8: rules, log and state after a cycle in monitor mode, as counts."""
    pages = _observed(s, d)
    after, log = jobs.cycle(_corpus(s, d), pages, _answers(s, d, pages), now(), monitor=True)
    count = lambda df, what, a, b: df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "a", "b", "n")
    pages = after.url_state.agg(F.count(F.lit(1)).alias("n")).select(F.lit("state").alias("what"), F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"), "n")
    return count(after.rules, "rules", "status", "provenance_status").unionByName(count(log, "log", "change_type", "extract_status")).unionByName(pages)


def _harvested(s, d) -> DataFrame:
    """Extracted pages as a file bridge hands them over: written as JSON lines in order of page_id and read again."""
    p = files.harvest(table(s, d, "changed_urls").filter("source_id IS NOT NULL AND url IS NOT NULL"), [F.col("page_id")])
    quote = F.left(tx.squeeze(F.col("text")), F.lit(60))
    rule = F.struct(F.concat(F.lit("Keep "), F.col("source_id")).alias("name"), F.lit("always").alias("if_condition"), F.lit("see the page").alias("then_logic"), quote.alias("source_excerpt"), F.col("lang").alias("domain_tag"), F.lit("0.7").alias("confidence_score"))
    own = F.struct(F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("name"), F.lit("always").alias("if_condition"), F.lit("see the page").alias("then_logic"), F.lit("words that no page has").alias("source_excerpt"), F.lit("seo").alias("domain_tag"), F.lit("0.7").alias("confidence_score"))
    path = temporary(s, "harvest")
    files.write_jsonl(p.repartitionByRange("page_id").sortWithinPartitions("page_id").select("source_id", F.col("source_id").alias("org"), "url", "title", tx.content_hash(F.col("text")).alias("new_hash"), "text", F.array(rule, own).alias("rules")), path)
    return files.read_jsonl_strict(s, path, "extracted_pages")


def jsonl_pages(s, d):
    """S-3, S-5: harvested pages as JSON lines and back."""
    return _harvested(s, d).select("source_id", "url", "title", "new_hash", F.length("text").alias("n_chars"), F.size("rules").alias("n_rules"))


def bridge(s, d):
    """T-13: what a file of extracted pages comes to: the rules it adds, and the log of its pages by source."""
    start = _corpus(s, d)
    after, log = jobs.bridge(start, _harvested(s, d), now())
    new = after.rules.join(start.rules.select("id"), "id", "left_anti")
    per = log.groupBy("source_id", "extract_status").agg(F.count(F.lit(1)).alias("pages"), F.sum("rules_new").alias("rules_new"), F.sum("rules_refreshed").alias("rules_refreshed"))
    return _rows("rule", new, "name", "status", "source_url", "provenance_status", "source_content_hash").unionByName(_rows("log", per, "source_id", "extract_status", "pages", "rules_new", "rules_refreshed"))


def _observations(s, d) -> DataFrame:
    """Observations as JSON lines, one of each organisation, and a line that is no JSON for each source."""
    g = table(s, d, "rules").filter("source_org IS NOT NULL").groupBy("source_org").agg(F.count(F.lit(1)).alias("m"), F.sum((F.col("provenance_status") == "verified_excerpt").cast("int")).alias("n"), F.count_distinct("run_id").alias("sessions"), F.min("source_url").alias("exemplar_url"))
    line = F.to_json(F.struct(F.concat(F.lit("Seen "), F.col("source_org")).alias("name"), F.lit("always").alias("if_condition"), F.lit("do so").alias("then_logic"), F.lit("SEO").alias("domain_tag"), F.struct("n", "m", "sessions").alias("prevalence"), "exemplar_url"))
    lines = g.select(line.alias("value")).unionByName(table(s, d, "source_registry").select(F.concat(F.lit("{ "), F.col("source_id")).alias("value")))
    path = temporary(s, "observations")
    lines.write.text(path)
    return files.read_jsonl_counting(s, path, "observations")


def observe(s, d):
    """T-14, S-4, P-13, F-23: the candidate rules that observations add, and the rejected lines by reason."""
    start = _corpus(s, d)
    after, rejected = jobs.observe(start, _observations(s, d), now())
    new = after.rules.filter("rule_type = 'observed'").join(start.rules.select("id"), "id", "left_anti").withColumn("n", F.get_json_object("url_provenance", "$.prevalence.n"))
    why = rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
    return _rows("rule", new.withColumn("s", F.concat_ws("/", "status", "domain_tag", "provenance_status")), "name", "s", "confidence_score", "source_url", "n").unionByName(_rows("rejected", why, "reject_reason", "n"))


def enrich_exact(s, d):
    """X-6: all pages of the url_list sources at once."""
    pages = _observed(s, d)
    _, counts = jobs.enrich_exact(_corpus(s, d), pages, _answers(s, d, pages), now())
    return counts


def conditional_requests(s, d):
    """S-14, P-9: the requests for all changed pages with the validators of the state before."""
    p = table(s, d, "changed_urls").filter("url IS NOT NULL").select("source_id", ux.normalize_url(F.col("url")).alias("url")).distinct()
    return incremental.requests(p, _corpus(s, d).url_state)


def text_on_demand(s, d):
    """S-15: pages without a text take it from an answer for the same source's root (a page made of its name)."""
    r = table(s, d, "source_registry").select("source_id", F.concat(F.lit("<html><script>x</script><p>"), F.col("canonical_org"), F.lit("</p>")).alias("body"))
    p = table(s, d, "changed_urls").select("page_id", "source_id", F.concat(F.lit("u"), F.col("page_id").cast("string")).alias("url"), "text")
    answers = p.join(r, "source_id").select("url", F.lit(200).alias("status"), "body")
    return web.fill_text(p.select("page_id", "url", "text"), answers).select("page_id", F.length("text").alias("n_chars"))


def _sitemaps(s, d) -> DataFrame:
    """Sitemap files of every source of the last snapshot: an index with a child file for every 25 pages where it has more
    than that, else the pages themselves."""
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    p = _listed(s, d)
    entry = F.concat(F.lit("<url><loc>"), esc(F.col("loc")), F.lit("</loc></url>"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", c.alias("e")))), lambda x: x["e"]), "")
    part = p.groupBy("source_id", F.floor(F.col("pos") / 25).cast("int").alias("pos")).agg(F.concat(F.lit("<urlset>"), joined(entry), F.lit("</urlset>")).alias("xml"))
    name = F.concat(F.lit("https://"), F.col("source_id"), F.lit(".example/part-"), F.col("pos").cast("string"))
    n = part.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    part = part.join(n, "source_id").withColumn("url", name)
    roots = part.filter("n > 1").groupBy("source_id").agg(F.concat(F.lit("<sitemapindex>"), joined(F.concat(F.lit("<sitemap><loc>"), F.col("url"), F.lit("</loc></sitemap>"))), F.lit("</sitemapindex>")).alias("xml"))
    return roots.select("source_id", F.lit("root").alias("url"), F.lit(None).cast("string").alias("parent"), "xml").unionByName(part.select("source_id", "url", F.when(F.col("n") > 1, "root").alias("parent"), "xml"))


def index_listing(s, d):
    """S-7, S-8, S-12: what a walk goes through, plain sitemaps from their offset, indexes from their child on."""
    return incremental.listing(_sitemaps(s, d), registry.cursors(table(s, d, "source_registry")), 40).select("source_id", "turn", "loc")


def cursor_moves(s, d):
    """M-3, T-6: the cursors of all sources after a walk, stored."""
    r = table(s, d, "source_registry")
    moved = incremental.next_cursor(incremental.cursor_sizes(_sitemaps(s, d), registry.cursors(r)))
    return registry.cursors(registry.save_cursors(r, moved)).select("source_id", "offset", "child")


def fetch_targets(s, d):
    """S-13: what every enabled source's adapter looks at."""
    r = table(s, d, "source_registry")
    retries = incremental.pending_retries(table(s, d, "ingest_changes").filter("source_id IS NOT NULL"))
    before = _snapshot(s, d, 1).select(ux.normalize_url(F.col("url")).alias("url"), "last_modified").filter("url IS NOT NULL").groupBy("url").agg(F.max("last_modified").alias("last_modified"))
    walked = incremental.walk(incremental.rotate(_listed(s, d), registry.cursors(r)), before, retries, filters=r)
    return web.targets(r, walked).filter("adapter <> 'sitemap' OR at > 0").groupBy("source_id", "adapter").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("first_url"))


def release_pages(s, d):
    """S-9: the answers of release sources as pages."""
    body = F.to_json(F.struct(F.col("last_seen_marker").alias("tag_name"), F.col("canonical_org").alias("name"), F.col("notes").alias("body"), F.when(F.col("tier") > 1, F.concat("root_url", F.lit("/latest"))).alias("html_url")))
    return web.latest_release(table(s, d, "source_registry").select("source_id", "root_url", F.when(F.col("enabled"), 200).otherwise(404).alias("status"), body.alias("body")))


def changelog_pages(s, d):
    """S-10: the root pages of sources as changelogs."""
    body = F.concat(F.lit("<title>"), F.col("canonical_org"), F.lit("</title><style>x</style><p>"), F.coalesce("notes", F.lit("")), F.lit("</p>"))
    return web.changelog(table(s, d, "source_registry").select("source_id", "root_url", F.when(F.col("enabled"), 200).otherwise(500).alias("status"), body.alias("body"))).drop("title")


def backup_projection(s, d):
    """S-20: a dated copy of a few columns; the second call the same day changes nothing."""
    folder, r = temporary(s, "backup"), table(s, d, "rules")
    files.backup(r, folder, "rules", "20260101", ["id", "source_org", "source_url"])
    return s.read.parquet(files.backup(r.limit(0), folder, "rules", "20260101", ["id", "source_org", "source_url"]))


def schema_migration(s, d):
    """S-21, U-3, A-17: the columns each table lacks of its schema, which conform adds as typed nulls."""
    rows = []
    for name in ("source_registry", "ingest_runs", "ingest_changes", "url_state", "rules", "documents", "org_aliases"):
        df = table(s, d, name)
        lacking = missing_columns(df, schema(name))
        assert not missing_columns(conform(df, schema(name)), schema(name))
        rows += [(name, c) for c in lacking]
    return s.createDataFrame(rows, "table_name string, column_name string")


def salvage_answers(s, d):
    """F-10, F-11, X-2: answers of a model about every rule: whole, with prose behind, cut off behind a rule, cut inside one,
    without any array."""
    one = F.to_json(F.struct(F.coalesce("name", F.lit("")).alias("name"), F.coalesce("then_logic", F.lit("")).alias("then_logic")))
    st = F.coalesce("status", F.lit(""))
    raw = (
        F.when(st == "active", F.concat(F.lit("Here: ["), one, F.lit("]"))).when(st == "candidate", F.concat(F.lit("["), one, F.lit("] and [more]")))
        .when(st == "deprecated", F.concat(F.lit("["), one, F.lit(', {"name": "cut'))).when(st == "retired", F.concat(F.lit("["), one, F.lit(', {"name": "a", "more": {"b": 1}'))).otherwise(one)
    )
    r = rules_from_answer(raw)
    return table(s, d, "rules").select("id", r.alias("r")).select("id", F.when(F.col("r").isNotNull(), F.size("r")).alias("n"), F.col("r")[0]["name"].alias("name"))


def cosine_pairs(s, d):
    """F-18: each rule's vector against that of the first rule of its key."""
    r = table(s, d, "rules").filter("rule_key IS NOT NULL").select("id", "rule_key", "embedding")
    first = r.groupBy("rule_key").agg(F.min("id").alias("id")).join(r.select("id", F.col("embedding").alias("to")), "id").select("rule_key", "to")
    return r.join(first, "rule_key").select("id", F.round(lookups.cosine(F.col("embedding"), F.col("to")), 6).alias("sim"))


def _authoritative(s, d) -> list[str]:
    return [r[0] for r in table(s, d, "source_registry").filter("tier = 1 AND canonical_org IS NOT NULL").select("canonical_org").distinct().collect()]  # a small dimension


def backfill_candidates(s, d):
    """P-15: rules of first-tier organisations with a vector and a generic URL."""
    return table(s, d, "rules").filter(gates.backfill_candidate(_authoritative(s, d))).select("id")


def adopted(s, d):
    """M-14, J-4, P-15, F-23: rules after candidates took URL and document of their nearest neighbour."""
    r = table(s, d, "rules")
    near = lookups.nearest_citation(r, candidate=gates.backfill_candidate(_authoritative(s, d)), dim=64)
    out = lookups.adopt_citations(r, near, "2026-01-01T00:00:00")
    return out.select("id", "source_url", "document_id", F.get_json_object("url_provenance", "$.from").alias("nn_id"))


def source_settings(s, d):
    """M-18, F-27: fields of one source set, one switched off, one added."""
    r = table(s, d, "source_registry")
    first, last = r.agg(F.min("source_id"), F.max("source_id")).first()
    out = registry.set_source(r, first, registry.parse_settings(["tier=3", "notes=NULL", "crawl_cadence_days=7", "url_filter="]))
    out = registry.enable(out, last, False)
    out = registry.add_source(out, {"source_id": "zz-added", "canonical_org": "Added", "root_url": "https://added.example", "adapter_type": "sitemap"})
    return out.select("source_id", "canonical_org", "tier", "notes", "crawl_cadence_days", "url_filter", "enabled")


def alias_upsert(s, d):
    """M-20: the canonical names as aliases of themselves, in upper case, over the alias table."""
    seed = table(s, d, "source_registry").filter("canonical_org IS NOT NULL").select(F.upper("canonical_org").alias("alias"), "canonical_org").distinct()
    return lookups.upsert_aliases(table(s, d, "org_aliases"), seed).groupBy("alias").agg(F.count(F.lit(1)).alias("n"), F.max("canonical_org").alias("canonical_org"))


def topic_upsert(s, d):
    """M-19: a topic per tag with its rules' count as least hits; those of one tag are seeded anew."""
    old = table(s, d, "rules").filter("domain_tag IS NOT NULL").groupBy(F.col("domain_tag").alias("topic")).agg(F.count(F.lit(1)).cast("int").alias("min_hits"))
    seed = old.filter("topic < 'd'").select("topic", F.lit(1).alias("min_hits")).unionByName(s.range(1).select(F.lit("added").alias("topic"), F.lit(2).alias("min_hits")))
    return lookups.upsert_topics(old, seed)


def asked_rules(s, d):
    """X-1: every page's chunks put to a stand-in for a model, which answers with a rule named by the chunk's length."""

    def model(text: str, org: str, url: str) -> str:
        return "Rules: " + json.dumps([{"name": f"{len(text)}", "then_logic": org}])

    p = table(s, d, "changed_urls").filter("text IS NOT NULL").select(F.col("page_id").cast("string").alias("url"), F.col("source_id").alias("org"), "text")
    got = external.answers(stored(external.ask(p, model)))
    return got.select(F.col("url").cast("bigint").alias("page_id"), "org", F.size("rules").alias("n_rules"), F.array_join(F.col("rules")["name"], ",").alias("names"))


def embedded_rules(s, d):
    """X-4, F-17, P-17: rules without a vector get one of a stand-in: the lengths of text and of its first word."""
    r = lookups.embedding_queue(table(s, d, "rules"), active_only=False, limit=None)
    r = r.select("id", tx.embed_text_batch(F.col("name"), F.col("if_condition"), F.col("then_logic")).alias("text"))
    got = external.embed(r, "text", lambda texts: [[float(len(t)), float(len(t.split(" ")[0]))] for t in texts], 2)
    return got.select("id", F.col("embedding")[0].cast("double").alias("a"), F.col("embedding")[1].cast("double").alias("b"))


def source_order(s, d):
    """O-2, O-12: every source's place, and that of the enabled list sources among themselves."""
    r = table(s, d, "source_registry")
    lists = registry.ordered(r, "url_list").select("source_id", F.col("turn").alias("list_turn"))
    return registry.ordered(r).select("source_id", "turn").join(lists, "source_id", "left")


QUERIES = {
    f.__name__: f
    for f in (
        cycle, monitor_cycle, jsonl_pages, bridge, observe, enrich_exact, conditional_requests, text_on_demand, index_listing,
        cursor_moves, fetch_targets, release_pages, changelog_pages, backup_projection, schema_migration, salvage_answers, cosine_pairs, backfill_candidates, adopted, source_settings, alias_upsert,
        topic_upsert, asked_rules, embedded_rules, source_order,
    )
}

SLASHES = lambda c: f"(len(rtrim(coalesce({c}, ''), '/')) - len(replace(rtrim(coalesce({c}, ''), '/'), '/', '')))"
RK = lambda a, b: f"'rk_' || left(sha256(lower(trim({a}, {WS})) || '|' || lower(trim({b}, {WS}))), 20)"
AT = "'2026-01-01 00:00:00'"
_STATE = f"""prior AS (SELECT {norm('url')} AS n, * FROM url_state WHERE snapshot_no = {LAST}),
state AS (SELECT n AS url, source_id, etag, lower(content_hash) AS content_hash, last_modified, last_seen_at FROM prior WHERE n IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY last_seen_at DESC NULLS LAST, url DESC, coalesce(content_hash, '') DESC) = 1)"""
_FAILURES = f"""failures AS (
  SELECT url, new_hash, sum(CASE WHEN extract_status IN ('failed', 'gave_up') OR (extract_status = 'detected' AND {utc('detected_at')} < {NOW} - INTERVAL 1 HOUR) THEN 1 ELSE 0 END) AS failures
  FROM changes WHERE url IS NOT NULL AND new_hash IS NOT NULL GROUP BY ALL)"""


def _events(cap: str, only: str = "true", screen: str = "adapter_type = 'sitemap'") -> str:
    """What a cycle sees, takes and extracts: obs, seen, moves, page, ev (one event a key), done."""
    return f"""{CHANGES}, {_STATE}, {_FAILURES},
obs AS (SELECT {norm('url')} AS url, source_id, text, etag, lastmod, lpad(coalesce(run_id, 0)::VARCHAR, 12, '0') || lpad(page_id::VARCHAR, 12, '0') AS arrival, {squeeze('text')} AS body FROM changed_urls WHERE changed_urls.url IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {norm('url')} ORDER BY coalesce(run_id, 0), page_id) = 1),
seen AS (SELECT o.*, s.content_hash AS old_hash, CASE WHEN text IS NOT NULL THEN sha256(body) END AS h, adapter_type,
    CASE WHEN text IS NULL THEN CASE WHEN s.url IS NOT NULL THEN 'removed' END WHEN sha256(body) = s.content_hash THEN 'unchanged' WHEN s.url IS NOT NULL THEN 'modified' ELSE 'new' END AS kind
  FROM obs o LEFT JOIN state s ON s.url = o.url LEFT JOIN source_registry r ON r.source_id = o.source_id WHERE {only}),
moves AS (SELECT * FROM seen WHERE kind IN ('new', 'modified', 'removed') QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY arrival, url) <= {cap}),
old AS (SELECT page, first(name ORDER BY rule_key) AS name, first(if_condition ORDER BY rule_key) AS cond FROM (
    SELECT rule_key, first(name ORDER BY id) AS name, first(if_condition ORDER BY id) AS if_condition, min({norm('source_url')}) AS page FROM rules
    WHERE rule_key IS NOT NULL AND source_url IS NOT NULL AND name IS NOT NULL AND if_condition IS NOT NULL AND rule_key = {KEY} GROUP BY rule_key) GROUP BY page),
page AS (SELECT m.*, coalesce(text, '') = '' AS blank,
    coalesce(text, '') <> '' AND coalesce({screen}, false) AND len(list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '(?i){RELEVANCE}', 0), lambda x: lower(x)))) < 2 AS dull,
    etag IS NOT NULL OR lastmod IS NOT NULL AS answered, len(trim(left(body, 80))) >= 12 AS proves FROM moves m WHERE kind <> 'removed'),
ev AS (
  SELECT url, arrival, h, 'Read ' || url AS name, {RK("'Read ' || url", "'always'")} AS k, 'Read ' || url || ' always see the page' AS said, 0 AS nth FROM page WHERE NOT blank AND NOT dull AND answered AND proves
  UNION ALL SELECT url, arrival, h, name, {RK('name', 'cond')}, concat_ws(' ', name, cond, 'see the page'), 1 FROM page JOIN old ON old.page = url WHERE NOT blank AND NOT dull AND answered AND proves AND name <> '' AND cond <> ''),
ev2 AS (SELECT *, CASE WHEN {claim('said')} THEN 'deprecated' ELSE 'active' END AS st, k NOT IN (SELECT rule_key FROM rules WHERE rule_key IS NOT NULL) AS fresh FROM ev),
done AS (SELECT p.* EXCLUDE (n, r), coalesce(n, 0) AS n, coalesce(r, 0) AS r, CASE WHEN s0 = 'failed' AND coalesce(failures, 0) + 1 >= 3 THEN 'gave_up' ELSE s0 END AS st FROM (
    SELECT page.*, n, r, CASE WHEN blank THEN 'empty' WHEN dull THEN 'irrelevant' WHEN NOT answered THEN 'failed' WHEN n + r > 0 THEN 'extracted' ELSE 'empty' END AS s0
    FROM page LEFT JOIN (SELECT url, count(*) FILTER (fresh) AS n, count(*) FILTER (NOT fresh) AS r FROM ev2 GROUP BY url) USING (url)) p LEFT JOIN failures f ON f.url = p.url AND f.new_hash = p.h),
gone AS (SELECT * FROM moves WHERE kind = 'removed'),
r0 AS (SELECT * REPLACE (CASE WHEN status = 'active' AND source_url IN (SELECT url FROM gone) THEN 'retired' ELSE status END AS status) FROM rules),
r1 AS (SELECT r.*, p.h AS page_hash, CASE WHEN p.url IS NULL THEN NULL WHEN contains(p.body, {squeeze('source_excerpt')}) THEN 'rebound' WHEN source_content_hash IS DISTINCT FROM p.h THEN 'superseded' ELSE 'kept' END AS outcome
  FROM r0 r LEFT JOIN page p ON p.url = r.source_url AND NOT p.blank AND coalesce(status, 'active') = 'active' AND coalesce(rule_type, '') <> 'observed' AND provenance_status IN ('verified_excerpt', 'source_change_pending') AND coalesce(source_excerpt, '') <> ''),
r2 AS (SELECT id, rule_key, source_url, url_provenance, document_id, CASE WHEN outcome = 'superseded' THEN 'superseded' ELSE status END AS status, CASE WHEN outcome = 'superseded' THEN 'source_changed' ELSE provenance_status END AS proof,
    CASE WHEN outcome = 'rebound' THEN page_hash ELSE source_content_hash END AS hash, CASE WHEN outcome = 'rebound' THEN {NOW} ELSE {utc('last_verified')} END AS verified FROM r1),
cut AS (SELECT v.url, min(cutoff) AS cutoff FROM (SELECT url, new_hash, min({utc('detected_at')}) AS cutoff FROM ingest_changes WHERE url IS NOT NULL AND new_hash IS NOT NULL GROUP BY ALL) v JOIN seen s ON s.url = v.url AND s.h = v.new_hash AND s.kind = 'unchanged' GROUP BY v.url),
r3 AS (SELECT r2.* REPLACE (CASE WHEN verified >= cutoff AND verified < {NOW} - INTERVAL 1 HOUR AND {CITABLE} THEN {NOW} ELSE verified END AS verified) FROM r2 LEFT JOIN cut ON cut.url = r2.source_url)"""


_DOCS = """doc0 AS (SELECT doc_id::VARCHAR AS id, source_url FROM documents),
titles AS (SELECT url, first(left(CASE WHEN name = '' THEN url ELSE name END, 200) ORDER BY arrival, nth) AS title FROM ev2 GROUP BY url),
doc1 AS (SELECT ((SELECT max(doc_id) FROM documents) + row_number() OVER (ORDER BY url))::VARCHAR AS id, url AS source_url, title FROM titles WHERE url NOT IN (SELECT source_url FROM doc0 WHERE source_url IS NOT NULL)),
docs AS (SELECT source_url, min(id) AS doc FROM (SELECT id, source_url FROM doc0 UNION ALL SELECT id, source_url FROM doc1) GROUP BY 1)"""

ORACLES: dict[str, str] = {
    "cycle": f"""WITH {_events('15')}, {_DOCS},
hit AS (SELECT r.*, e.url AS e_url, e.h AS e_h, e.st AS e_st, doc,
    coalesce({SLASHES('e.url')} > {SLASHES('r.source_url')} OR coalesce(r.source_url, '') = '', false) OR (coalesce(proof, '') <> 'verified_excerpt' AND coalesce(r.source_url, '') IN ('', e.url)) AS full_write,
    coalesce(proof = 'verified_excerpt' AND r.source_url = e.url, false) AS refresh
  FROM r3 r LEFT JOIN ev2 e ON e.k = r.rule_key AND NOT e.fresh LEFT JOIN docs ON docs.source_url = e.url),
known AS (SELECT id, CASE WHEN e_url IS NULL THEN status WHEN e_st = 'deprecated' OR coalesce(status, '') = 'deprecated' THEN 'deprecated' ELSE 'active' END AS status, CASE WHEN e_url IS NOT NULL AND full_write THEN e_url ELSE source_url END AS source_url,
    CASE WHEN e_url IS NOT NULL AND (full_write OR refresh) THEN 'verified_excerpt' ELSE proof END AS proof, CASE WHEN e_url IS NOT NULL AND (full_write OR refresh) THEN {NOW} ELSE verified END AS verified,
    CASE WHEN e_url IS NOT NULL AND (full_write OR refresh) THEN e_h ELSE hash END AS hash, CASE WHEN e_url IS NOT NULL AND full_write THEN doc ELSE document_id END AS document_id FROM hit),
added AS (SELECT ((SELECT max(id::BIGINT) FROM rules) + row_number() OVER (ORDER BY arrival, url, nth))::VARCHAR AS id, st AS status, url AS source_url, 'verified_excerpt' AS proof, {NOW} AS verified, h AS hash, doc AS document_id
  FROM ev2 JOIN docs ON docs.source_url = url WHERE fresh),
every AS (SELECT * FROM known UNION ALL SELECT * FROM added),
logged AS (SELECT source_id, url, kind, h, st, n::VARCHAR || '/' || r AS n FROM done UNION ALL SELECT source_id, url, kind, NULL, 'retired', '0/0' FROM gone),
numbered AS (SELECT *, (SELECT max(change_id) FROM ingest_changes) + row_number() OVER (ORDER BY coalesce(source_id, ''), url, kind, coalesce(h, '')) AS change_id FROM logged),
fresh_state AS (SELECT url, source_id, etag, h FROM done WHERE st IN ('extracted', 'empty', 'irrelevant', 'gave_up') UNION ALL SELECT url, source_id, etag, h FROM seen WHERE kind = 'unchanged'),
pages AS (SELECT coalesce(s.url, f.url) AS url, coalesce(s.source_id, f.source_id) AS source_id, CASE WHEN f.url IS NOT NULL THEN f.etag ELSE s.etag END AS etag, CASE WHEN f.url IS NOT NULL THEN f.h ELSE s.content_hash END AS h,
    CASE WHEN f.url IS NOT NULL THEN {AT} ELSE {text('s.last_seen_at')} END AS seen_at FROM (SELECT * FROM state WHERE url NOT IN (SELECT url FROM gone)) s FULL JOIN fresh_state f ON f.url = s.url),
bad AS (SELECT source_id, count(*) AS n FROM done WHERE st = 'failed' GROUP BY 1),
watched AS (SELECT DISTINCT source_id FROM obs WHERE source_id IS NOT NULL),
running AS (SELECT *, coalesce(status = 'running' AND {utc('started_at')} < {NOW} - INTERVAL 2 HOUR, false) AS late FROM ingest_runs),
mine AS (SELECT count(DISTINCT source_id) AS sources, count(*) AS urls FROM logged WHERE source_id IN (SELECT source_id FROM watched))
SELECT 'log' AS what, change_id::VARCHAR AS key, url AS a, kind AS b, st AS c, n AS d FROM numbered
UNION ALL SELECT 'rule', id, status, source_url, proof, strftime(verified, '%Y-%m-%d %H:%M:%S') FROM every
UNION ALL SELECT 'proof', id, hash, document_id, NULL, NULL FROM every
UNION ALL SELECT 'page', url, source_id, etag, h, seen_at FROM pages
UNION ALL SELECT 'source', s.source_id, CASE WHEN b.n IS NOT NULL THEN coalesce(consecutive_failures, 0) + 1 WHEN w.source_id IS NOT NULL THEN 0 ELSE consecutive_failures END::VARCHAR,
  CASE WHEN b.n IS NOT NULL THEN b.n || ' extraction failure(s)' WHEN w.source_id IS NOT NULL THEN NULL ELSE last_error END, CASE WHEN w.source_id IS NOT NULL AND b.n IS NULL THEN {AT} ELSE {text('last_crawled_at')} END, last_seen_marker
  FROM source_registry s LEFT JOIN watched w ON w.source_id = s.source_id LEFT JOIN bad b ON b.source_id = s.source_id
UNION ALL SELECT 'run', run_id::VARCHAR, CASE WHEN late THEN 'aborted' ELSE status END, concat_ws('/', sources_checked, sources_changed, urls_changed, objects_written), CASE WHEN late THEN {AT} ELSE {text('finished_at')} END, NULL FROM running
UNION ALL SELECT 'run', ((SELECT max(run_id) FROM ingest_runs) + 1)::VARCHAR, CASE WHEN EXISTS (SELECT 1 FROM done WHERE st IN ('failed', 'gave_up') AND source_id IS NOT NULL) THEN 'partial' ELSE 'done' END,
  concat_ws('/', (SELECT count(*) FROM watched), sources, urls, (SELECT coalesce(sum(n), 0)::BIGINT FROM done WHERE source_id IS NOT NULL)), {AT}, NULL FROM mine
UNION ALL SELECT 'document', id, source_url, title, 'seo', 'ingest' FROM doc1""",
    "monitor_cycle": f"""WITH {_events('1000000000')},
waiting AS (SELECT url FROM page WHERE blank),
m AS (SELECT status, CASE WHEN coalesce(status, 'active') = 'active' AND proof = 'verified_excerpt' AND source_url IN (SELECT url FROM waiting) THEN 'source_change_pending' ELSE proof END AS proof FROM r2)
SELECT 'rules' AS what, status AS a, proof AS b, count(*) AS n FROM m GROUP BY ALL
UNION ALL SELECT 'log', kind, 'skipped_monitor', count(*) FROM moves GROUP BY ALL
UNION ALL SELECT 'state', NULL, NULL, count(*) FROM state WHERE url NOT IN (SELECT url FROM gone)""",
    "enrich_exact": f"""WITH {_events('1000000000', "adapter_type = 'url_list' AND enabled")}
SELECT (SELECT count(*) FROM moves) AS pages, (SELECT coalesce(sum(n), 0)::BIGINT FROM done) AS "new", (SELECT coalesce(sum(r), 0)::BIGINT FROM done) AS refreshed, (SELECT count(*) FROM done WHERE st = 'failed') AS failed,
  (SELECT count(*) FROM rules WHERE coalesce(source_url, '') <> '') AS url_before,
  (SELECT count(*) FROM rules WHERE coalesce(source_url, '') <> '' OR rule_key IN (SELECT k FROM ev2)) + (SELECT count(*) FROM ev2 WHERE fresh) AS url_after""",
    "jsonl_pages": f"""SELECT source_id, url, coalesce(title, '') AS title, sha256({squeeze('left(text, 12000)')}) AS new_hash, len(left(text, 12000))::INTEGER AS n_chars, 2 AS n_rules FROM changed_urls WHERE source_id IS NOT NULL AND url IS NOT NULL AND len(trim(coalesce(text, ''), {WS})) >= 200
QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY page_id) <= 25""",
    "bridge": f"""WITH p AS (SELECT page_id, source_id, url, sha256({squeeze('left(text, 12000)')}) AS h, {SLASHES('url')} AS depth FROM changed_urls WHERE source_id IS NOT NULL AND url IS NOT NULL AND len(trim(coalesce(text, ''), {WS})) >= 200
  QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY page_id) <= 25),
best AS (SELECT source_id, first(url ORDER BY depth DESC, page_id) AS url FROM p GROUP BY 1),
rule AS (SELECT source_id, url, first(h ORDER BY page_id DESC) AS h FROM p JOIN best USING (source_id, url) GROUP BY ALL)
SELECT 'rule' AS what, 'Keep ' || source_id AS key, 'active' AS a, url AS b, 'verified_excerpt' AS c, h AS d FROM rule
UNION ALL SELECT 'log', source_id, 'extracted', count(*)::VARCHAR, '1', (count(*) - 1)::VARCHAR FROM p GROUP BY source_id""",
    "observe": """WITH g AS (SELECT source_org, count(*) AS m, count(*) FILTER (provenance_status = 'verified_excerpt') AS n, count(DISTINCT run_id) AS s, coalesce(min(source_url), '') AS url FROM rules WHERE source_org IS NOT NULL GROUP BY 1),
r AS (SELECT *, CASE WHEN n / m < 0.7 THEN 'rare' WHEN s < 3 THEN 'few sessions' END AS why FROM g)
SELECT 'rule' AS what, 'Seen ' || source_org AS key, 'candidate/seo/observed' AS a, round(least(0.84::DOUBLE, 0.5::DOUBLE + 0.4::DOUBLE * n / m), 2)::VARCHAR AS b, url AS c, n::VARCHAR AS d FROM r WHERE why IS NULL
UNION ALL SELECT 'rejected', why, count(*)::VARCHAR, NULL, NULL, NULL FROM r WHERE why IS NOT NULL GROUP BY why
UNION ALL SELECT 'rejected', 'malformed', count(*)::VARCHAR, NULL, NULL, NULL FROM source_registry""",
    "conditional_requests": f"""WITH {_STATE}, p AS (SELECT DISTINCT source_id, {norm('url')} AS source_url FROM changed_urls WHERE url IS NOT NULL)
SELECT p.source_id, p.source_url AS url, nullif(etag, '') AS if_none_match, nullif(last_modified, '') AS if_modified_since FROM p LEFT JOIN state s ON s.url = source_url WHERE NOT {LOCALE}""",
    "text_on_demand": f"SELECT page_id, CASE WHEN coalesce(text, '') <> '' THEN len(text) ELSE len({squeeze('canonical_org')}) END::INTEGER AS n_chars FROM changed_urls LEFT JOIN source_registry USING (source_id)",
    "index_listing": f"""WITH {LISTED}, {OFFSETS}, n AS (SELECT source_id, count(*) AS n, ((count(*) - 1) // 25 + 1)::BIGINT AS parts FROM listed GROUP BY 1),
l AS (SELECT l.*, n, parts, coalesce(off, 0) AS off, coalesce(child, 0) AS child, pos // 25 AS part, pos % 25 AS place FROM listed l JOIN n USING (source_id) LEFT JOIN offsets USING (source_id)),
o AS (SELECT *, ((part - child) % parts + parts) % parts AS turn_of_part, count(*) OVER (PARTITION BY source_id, part) AS size FROM l WHERE parts > 1),
f AS (SELECT source_id, part, turn_of_part, coalesce(sum(size) OVER (PARTITION BY source_id ORDER BY turn_of_part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT DISTINCT source_id, part, turn_of_part, size FROM o))
SELECT source_id, (before + place)::BIGINT AS turn, loc FROM o JOIN f USING (source_id, part) WHERE before < 40
UNION ALL SELECT source_id, (((pos - off) % n) + n) % n, loc FROM l WHERE parts = 1""",
    "cursor_moves": f"""WITH {LISTED}, {OFFSETS}, n AS (SELECT source_id, count(*) AS n FROM listed GROUP BY 1), o AS (SELECT source_id, off, child, n, (n - 1) // 25 + 1 AS parts FROM offsets LEFT JOIN n USING (source_id))
SELECT source_id, CASE WHEN n IS NULL THEN off WHEN parts = 1 THEN (coalesce(off, 0) + 20) % n END::INTEGER AS "offset", CASE WHEN n IS NULL THEN child WHEN parts > 1 THEN (coalesce(child, 0) + 1) % parts END::INTEGER AS child FROM o""",
    "release_pages": """SELECT source_id, CASE WHEN tier > 1 THEN root_url || '/latest' ELSE root_url END AS url, last_seen_marker AS marker, coalesce(nullif(canonical_org, ''), last_seen_marker) AS title,
  coalesce(nullif(canonical_org, ''), last_seen_marker) || chr(10) || chr(10) || coalesce(notes, '') AS text FROM source_registry WHERE enabled AND last_seen_marker <> ''""",
    "changelog_pages": f"""WITH p AS (SELECT source_id, root_url AS url, {squeeze("canonical_org || '  ' || coalesce(notes, '')")} AS text FROM source_registry WHERE enabled)
SELECT source_id, url, coalesce(text, '') AS text, sha256(coalesce(text, '')) AS content_hash FROM p""",
    "backup_projection": "SELECT id, source_org, source_url FROM rules",
    "schema_migration": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, c AS column_name FROM (SELECT unnest({[x.split()[0] for x in SCHEMAS[t].split(',')]}) AS c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM {t}))"
        for t in ("source_registry", "ingest_runs", "ingest_changes", "url_state", "rules", "documents", "org_aliases")
    ),
    "salvage_answers": "SELECT id, CASE WHEN status IN ('active', 'candidate', 'deprecated') THEN 1 END::INTEGER AS n, CASE WHEN status IN ('active', 'candidate', 'deprecated') THEN coalesce(name, '') END AS name FROM rules",
    "cosine_pairs": """WITH f AS (SELECT rule_key, min(id) AS id FROM rules WHERE rule_key IS NOT NULL GROUP BY 1), t AS (SELECT f.rule_key, list_transform(embedding, lambda x: x::DOUBLE) AS w FROM f JOIN rules USING (id)),
p AS (SELECT id, list_transform(embedding, lambda x: x::DOUBLE) AS v, w FROM rules JOIN t USING (rule_key))
SELECT id, CASE WHEN len(v) = len(w) AND len(v) > 0 AND list_sum(list_transform(v, lambda x: x * x)) > 0 AND list_sum(list_transform(w, lambda x: x * x)) > 0
  THEN round(list_sum(list_transform(list_zip(v, w), lambda z: z[1] * z[2])) / (sqrt(list_sum(list_transform(v, lambda x: x * x))) * sqrt(list_sum(list_transform(w, lambda x: x * x)))), 6) END AS sim FROM p""",
    "source_settings": """SELECT source_id, canonical_org, CASE WHEN source_id = (SELECT min(source_id) FROM source_registry) THEN 3 ELSE tier END::SMALLINT AS tier, CASE WHEN source_id <> (SELECT min(source_id) FROM source_registry) THEN notes END AS notes,
  CASE WHEN source_id = (SELECT min(source_id) FROM source_registry) THEN 7 ELSE crawl_cadence_days END::INTEGER AS crawl_cadence_days, CASE WHEN source_id <> (SELECT min(source_id) FROM source_registry) THEN url_filter END AS url_filter,
  enabled AND source_id <> (SELECT max(source_id) FROM source_registry) AS enabled FROM source_registry UNION ALL SELECT 'zz-added', 'Added', 3, NULL, 30, NULL, true""",
    "alias_upsert": f"""WITH s AS (SELECT DISTINCT lower(trim(upper(canonical_org), {WS})) AS alias, canonical_org FROM source_registry WHERE canonical_org IS NOT NULL)
SELECT alias, count(*) AS n, max(canonical_org) AS canonical_org FROM (SELECT alias, canonical_org FROM org_aliases WHERE alias IS NULL OR alias NOT IN (SELECT alias FROM s) UNION ALL SELECT alias, min(canonical_org) FROM s GROUP BY alias) GROUP BY alias""",
    "topic_upsert": """WITH o AS (SELECT domain_tag AS topic, count(*)::INTEGER AS n FROM rules WHERE domain_tag IS NOT NULL GROUP BY 1)
SELECT topic, CASE WHEN topic < 'd' THEN 1 ELSE n END::INTEGER AS min_hits FROM o WHERE topic <> 'added' UNION ALL SELECT 'added', 2""",
    "asked_rules": """WITH c AS (SELECT page_id, source_id, text, left(text, 12000) AS a FROM changed_urls WHERE text IS NOT NULL),
k AS (SELECT *, CASE WHEN strpos(reverse(a), chr(10)) > 0 AND 12000 - strpos(reverse(a), chr(10)) > 6000 THEN 12000 - strpos(reverse(a), chr(10)) ELSE 12000 END AS cut FROM c)
SELECT page_id, source_id AS org, CASE WHEN len(text) <= 12000 THEN 1 ELSE 2 END::INTEGER AS n_rules, CASE WHEN len(text) <= 12000 THEN len(text)::VARCHAR ELSE cut::VARCHAR || ',' || len(substr(text, cut + 1, 12000)) END AS names FROM k""",
    "embedded_rules": f"""WITH t AS (SELECT id, trim(left(coalesce(name, '') || ' ' || coalesce(if_condition, '') || ' ' || coalesce(then_logic, ''), 6000), {WS}) AS b FROM rules WHERE embedding IS NULL)
SELECT id, len(CASE WHEN b = '' THEN ' ' ELSE b END)::DOUBLE AS a, CASE WHEN b = '' THEN 0 ELSE len(split_part(b, ' ', 1)) END::DOUBLE AS b FROM t""",
    "source_order": """SELECT source_id, row_number() OVER (ORDER BY tier NULLS LAST, source_id)::INTEGER AS turn,
  CASE WHEN adapter_type = 'url_list' AND enabled THEN row_number() OVER (PARTITION BY adapter_type = 'url_list' AND enabled ORDER BY tier NULLS LAST, source_id) END::INTEGER AS list_turn FROM source_registry""",
    "backfill_candidates": """SELECT id FROM rules WHERE source_org IN (SELECT canonical_org FROM source_registry WHERE tier = 1) AND embedding IS NOT NULL
  AND CASE WHEN coalesce(source_url, '') = '' THEN -1 ELSE len(source_url) - len(replace(source_url, '/', '')) END < 4 AND NOT regexp_matches(coalesce(url_provenance, ''), 'exact|exact-upgrade|doc-join')""",
    "adopted": """WITH r AS (SELECT id, source_org, source_url, document_id, url_provenance, list_transform(embedding, lambda x: x::DOUBLE) AS v, CASE WHEN coalesce(source_url, '') = '' THEN -1 ELSE len(source_url) - len(replace(source_url, '/', '')) END AS spec
  FROM rules WHERE source_org IN (SELECT canonical_org FROM source_registry WHERE tier = 1) AND len(embedding) = 64 AND NOT list_bool_or(list_transform(embedding, lambda x: isnan(x))) AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
p AS (SELECT a.id, b.id AS nn, list_cosine_similarity(a.v, b.v) AS sim FROM r a JOIN r b ON a.source_org = b.source_org AND b.spec > a.spec AND coalesce(b.source_url, '') <> '' WHERE a.spec < 4 AND NOT regexp_matches(coalesce(a.url_provenance, ''), 'exact|exact-upgrade|doc-join')),
n AS (SELECT id, first(nn ORDER BY round(sim, 9) DESC, nn) AS nn FROM p WHERE sim >= 0.8 GROUP BY id)
SELECT t.id, coalesce(b.source_url, t.source_url) AS source_url, coalesce(b.document_id, t.document_id) AS document_id, CASE WHEN n.nn IS NOT NULL THEN n.nn WHEN json_valid(t.url_provenance) THEN json_extract_string(t.url_provenance, '$.from') END AS nn_id FROM rules t LEFT JOIN n ON n.id = t.id LEFT JOIN rules b ON b.id = n.nn""",
    "fetch_targets": f"""WITH {LISTED}, {OFFSETS}, {TURNS}, {RETRIES},
before AS (SELECT url, max(last_modified) AS last_modified FROM (SELECT {norm('url')} AS url, last_modified FROM url_state WHERE snapshot_no = {BEFORE}) WHERE url IS NOT NULL GROUP BY 1),
n AS (SELECT t.source_id, {norm('loc')} AS loc, lastmod, turn, url_filter FROM turns t LEFT JOIN offsets USING (source_id)),
ok AS (SELECT * FROM n WHERE {deny('loc')} IS NULL AND (coalesce(url_filter, '') = '' OR coalesce(regexp_matches({path_of('loc')}, url_filter), false)) QUALIFY row_number() OVER (PARTITION BY source_id, loc ORDER BY turn) = 1),
first AS (SELECT DISTINCT source_id, {norm('url')} AS loc FROM retries),
p AS (SELECT o.*, coalesce(lastmod <> '' AND lastmod = b.last_modified, false) AS still, coalesce((SELECT count(*) FROM first f WHERE f.source_id = o.source_id), 0) AS paid
  FROM ok o LEFT JOIN before b ON b.url = o.loc WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.source_id = o.source_id AND f.loc = o.loc)),
w AS (SELECT *, sum(CASE WHEN still THEN 0 ELSE 1 END) OVER (PARTITION BY source_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS cost FROM p),
fetched AS (SELECT source_id, loc FROM w WHERE cost <= 20 - paid AND NOT still UNION ALL SELECT source_id, loc FROM first),
s AS (SELECT source_id, CASE WHEN adapter_type IN ('url_list', 'github_release', 'changelog') THEN adapter_type ELSE 'sitemap' END AS adapter, root_url, seed_urls FROM source_registry WHERE enabled),
e AS (SELECT source_id, unnest(CASE WHEN seed_urls LIKE '[%' THEN from_json(seed_urls, '["VARCHAR"]') ELSE string_split(seed_urls, ',') END) AS u FROM s WHERE adapter = 'url_list' AND seed_urls IS NOT NULL),
t AS (SELECT source_id, adapter, loc AS url FROM s JOIN fetched USING (source_id) WHERE adapter = 'sitemap' UNION ALL SELECT source_id, 'url_list', {norm('u')} FROM e WHERE trim(u) <> '' GROUP BY ALL
  UNION ALL SELECT source_id, adapter, root_url FROM s WHERE adapter IN ('github_release', 'changelog') AND root_url IS NOT NULL)
SELECT source_id, adapter, CASE WHEN adapter = 'url_list' THEN least(count(*), 60) ELSE count(*) END AS n, min(url) AS first_url FROM t GROUP BY source_id, adapter""",
}
