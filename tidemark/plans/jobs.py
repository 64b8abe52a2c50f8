"""Whole jobs composed of the operators (T-1, T-8, T-13, T-14, X-5, X-6): one micro-batch each, tables in, tables out."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import RELEVANCE, content_hash, relevance_hits, rule_key, strip
from ..functions.urls import normalize_url
from ..operators import gates, incremental, lifecycle, lookups
from ..schemas import conform, schema
from ..session import stored
from ..sources import registry

CHANGE = ("run_id", "source_id", "url", "change_type", "signal", "old_hash", "new_hash", "detected_at", "extract_status", "rules_new", "rules_refreshed")


@dataclass(frozen=True)
class Corpus:
    """The tables a job reads and writes. Documents, registry and runs are kept where there are any."""

    rules: DataFrame
    url_state: DataFrame
    changes: DataFrame
    documents: DataFrame | None = None
    registry: DataFrame | None = None
    runs: DataFrame | None = None


def extracted_rules(pages: DataFrame, relevance: str | None = None) -> DataFrame:
    """X-5: from pages (source_id, org, url, text, rules array) one row per extracted rule with its gate's verdict.
    With a relevance pattern, pages with fewer than two distinct terms are not asked (P-10)."""
    p = pages if relevance is None else pages.filter(relevance_hits(F.col("text"), relevance) >= 2)
    arrival = F.col("arrival") if "arrival" in p.columns else F.lit("")
    new_hash = F.coalesce("new_hash", content_hash(F.col("text"))) if "new_hash" in p.columns else content_hash(F.col("text"))
    kept = ("source_id", "org", "url", "text", arrival.alias("arrival"), new_hash.alias("new_hash"))
    r = p.select(*kept, F.posexplode("rules").alias("ordinal", "r")).select("source_id", "org", "url", "text", "arrival", "new_hash", "ordinal", "r.*")
    return gates.quality_gate(r)


def screened(pages: DataFrame, relevance: str | None) -> DataFrame:
    """P-10: adds `irrelevant` (the page of a sitemap source without two distinct terms) and takes the rules of irrelevant
    pages and of pages without text away. pages: text, rules, adapter."""
    blank = F.coalesce("text", F.lit("")) == ""
    dull = F.lit(False) if relevance is None else ~blank & F.col("adapter").eqNullSafe("sitemap") & (relevance_hits(F.col("text"), relevance) < 2)
    return pages.withColumn("irrelevant", dull).withColumn("rules", F.when(~dull & ~blank, F.col("rules")))


def page_outcomes(pages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Per page how its extraction ended: empty (no text, or nothing kept), irrelevant, failed (no answer), extracted."""
    kept = verdicts.groupBy("url").agg(F.sum(F.col("kept").cast("int")).alias("kept_rules"), F.sum((~F.col("kept")).cast("int")).alias("rejected"))
    j = pages.join(kept, "url", "left")
    dull = F.col("irrelevant") if "irrelevant" in pages.columns else F.lit(False)
    status = (
        F.when(F.coalesce("text", F.lit("")) == "", "empty").when(dull, "irrelevant").when(F.col("rules").isNull(), "failed")
        .when(F.coalesce("kept_rules", F.lit(0)) > 0, "extracted").otherwise("empty")
    )
    return j.withColumns({"extract_status": status, "rejected": F.coalesce("rejected", F.lit(0))}).drop("kept_rules")


def log_rows(changes: DataFrame, log: DataFrame) -> DataFrame:
    """M-7: the log with the rows of a batch, in order of source and URL, under change_ids that follow the largest one."""
    start = changes.agg(F.coalesce(F.max("change_id"), F.lit(0))).first()[0]
    new = lookups.numbered(log, start, [F.coalesce("source_id", F.lit("")), F.col("url"), F.coalesce("change_type", F.lit("")), F.coalesce("new_hash", F.lit(""))])
    return changes.unionByName(new.select(F.col("new_id").cast("bigint").alias("change_id"), *CHANGE), allowMissingColumns=True)


def fold_in(corpus: Corpus, events: DataFrame, titles: DataFrame, now: Column) -> tuple[DataFrame, DataFrame | None]:
    """M-9 before M-12: the documents of the events' pages (url, title, tag, source_org, at), then the rules after the events,
    each bound to its page's document. (rules, documents)"""
    documents = corpus.documents
    if documents is not None:
        documents = stored(page_documents(documents, titles))
        ids = documents.groupBy(F.col("source_url").alias("url")).agg(F.min("id").alias("document_id"))
        events = events.drop("document_id").join(ids, "url", "left")
    return stored(lifecycle.upsert_rules(conform(corpus.rules, schema("rules")), events, now)), documents


def cycle(
    corpus: Corpus, observations: DataFrame, answers: DataFrame, now: Column, run_id: int | None = None, monitor: bool = False, unread: DataFrame | None = None,
    relevance: str | None = RELEVANCE, cap: int | None = 15, record: bool = True,
) -> tuple[Corpus, DataFrame]:
    """T-1: one batch of observations (source_id, url, status, text, etag, lastmod; perhaps marker and arrival) and the
    answers (url, org, rules) for changed pages. Returns the next corpus and the log rows of the run.

    Removed pages retire their rules, changed ones reconcile theirs (those that changed without a text wait for a new
    check), unchanged ones renew stamps and their own state (T-5, T-7). Pages of sitemap sources without two terms of
    `relevance` are irrelevant (P-10). New rules pass the gate and are folded in (M-12) with their documents (M-9), in order
    of arrival and place on the page, in monitor mode not. A page's state advances only if its change was consumed (T-2), in
    monitor mode never (T-8). Of each source the first `cap` changes are taken (W-5), in monitor mode all. Sources without a
    failed page, and not among the unread (source_id, error), count as crawled and healthy, the others lengthen their
    streak (T-10, T-11); the version marker of a release source moves only if all its changes were taken and consumed
    (T-4). With a table of runs, the run is opened and finished (M-8), and run_id follows from it. record=False leaves
    the log as it is. Repeated observations of a URL count once, the first to arrive; no order is given without arrival."""
    runs = corpus.runs
    if runs is not None:
        runs = stored(lifecycle.open_run(runs, now))
        run_id = runs.agg(F.max("run_id")).first()[0]
    extra = {c: F.lit(None).cast("string") for c in ("marker", "arrival") if c not in observations.columns}
    obs = observations.withColumns({"url": normalize_url(F.col("url")), **extra}).filter("url IS NOT NULL")
    obs = incremental.first_occurrence(obs, ["url"], [F.coalesce("arrival", F.lit("")), F.coalesce("source_id", F.lit("")), F.coalesce("status", F.lit(0)), F.coalesce("text", F.lit(""))])
    sources = corpus.registry
    markers = sources.select("source_id", "last_seen_marker") if sources is not None else None
    seen = stored(incremental.classify(stored(obs), corpus.url_state, markers).withColumn("run_id", F.lit(run_id).cast("bigint")))
    moves = seen.filter(F.col("change_type").isin("new", "modified", "removed"))
    if monitor or cap is None:
        moves = moves.withColumn("truncated", F.lit(False))
    else:
        moves = incremental.capped(moves, cap, ("arrival", "url"))
    moves = stored(moves)
    same = seen.filter("change_type = 'unchanged'")
    changed = moves.filter("change_type <> 'removed'")
    gone = moves.filter("change_type = 'removed'")

    pages = changed.join(answers.select("url", "org", "rules"), "url", "left")
    if sources is not None:
        pages = pages.join(sources.select("source_id", F.col("adapter_type").alias("adapter")).dropDuplicates(["source_id"]), "source_id", "left")
    else:
        pages = pages.withColumn("adapter", F.lit(None).cast("string"))
    pages = stored(screened(pages, relevance))
    outcome = page_outcomes(pages, extracted_rules(pages))
    events = stored(bridge_events(pages, now).filter(F.lit(not monitor)))
    outcome = outcome.join(upsert_counts(events, corpus.rules), "url", "left").fillna(0, ["rules_new", "rules_refreshed"])
    prior = incremental.failures_by_version(corpus.changes, now)
    done = stored(incremental.consume(outcome.select("source_id", "url", "change_type", "signal", "old_hash", "new_hash", "extract_status", "rules_new", "rules_refreshed", "etag", "lastmod", "marker", "truncated"), prior, monitor=monitor))

    row = lambda df, status, new, again: df.select(F.lit(run_id).cast("bigint").alias("run_id"), "source_id", "url", "change_type", "signal", "old_hash", "new_hash", now.alias("detected_at"), status.alias("extract_status"), new.cast("int").alias("rules_new"), again.cast("int").alias("rules_refreshed"))
    log = row(done, F.col("final_status"), F.col("rules_new"), F.col("rules_refreshed"))
    log = log.unionByName(row(gone, F.lit("skipped_monitor" if monitor else "retired"), F.lit(0), F.lit(0)))

    rules, state = lifecycle.retire_removed(corpus.rules, corpus.url_state, gone.select("url"))
    texts = changed.select("url", F.col("new_hash").alias("content_hash"), "text")
    rules = lifecycle.reconcile(rules, texts, now).drop("outcome")
    still = same.select("url", F.coalesce("new_hash", "old_hash").alias("content_hash"))
    rules = lifecycle.restamp(rules, still, corpus.changes, now).drop("stamped")
    if monitor:
        rules = lifecycle.mark_pending(rules, changed.filter("coalesce(text, '') = '' AND new_hash IS NOT NULL").select("url"))
    rules, documents = fold_in(replace(corpus, rules=stored(rules)), events, page_titles(events, now), now)
    renewed = same.filter("marker IS NULL").join(corpus.url_state.select("url", F.col("etag").alias("_etag"), F.col("last_modified").alias("_modified")), "url", "left")
    not_sent = F.col("status") == 304
    renewed = renewed.select(
        "url", "source_id", F.when(not_sent, F.col("_etag")).otherwise(F.col("etag")).alias("etag"), F.when(not_sent, F.coalesce("lastmod", "_modified")).otherwise(F.col("lastmod")).alias("last_modified"),
        F.coalesce("new_hash", "old_hash").alias("content_hash"), now.alias("last_seen_at"),
    )
    advance = done.filter("consumed").select("url", "source_id", "etag", F.col("lastmod").alias("last_modified"), F.col("new_hash").alias("content_hash"), now.alias("last_seen_at"))
    state = lifecycle.save_url_state(state, advance.unionByName(renewed))
    if sources is not None:
        sources = source_outcomes(sources, observations, done, unread, now, monitor)
    if runs is not None:
        runs = lifecycle.finish_run(runs, run_outcome(stored(log), observations, unread, run_id), now)
    changes = log_rows(corpus.changes, log) if record else corpus.changes
    return replace(corpus, rules=rules, url_state=state, documents=documents, registry=sources, runs=runs, changes=changes), log


def upsert_counts(events: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rules_new, rules_refreshed): the first event of a rule_key that no rule has makes a rule, the others refresh."""
    first = events.join(rules.select("rule_key").distinct(), "rule_key", "left_anti").groupBy("rule_key").agg(F.min("tie").alias("tie"))
    j = events.select("url", "rule_key", "tie").join(first.withColumn("_new", F.lit(1)), ["rule_key", "tie"], "left")
    return j.groupBy("url").agg(F.sum(F.coalesce("_new", F.lit(0))).alias("rules_new"), F.sum(1 - F.coalesce("_new", F.lit(0))).alias("rules_refreshed"))


def page_titles(events: DataFrame, now: Column) -> DataFrame:
    """(url, title, tag, source_org, at) for the documents of the events' pages: the name of a page's first rule is its
    title, that rule's tag the tag of a new document."""
    first = events.groupBy("url").agg(F.min_by(F.struct("name", "domain_tag", "source_org"), "tie").alias("f"))
    return first.select("url", F.left(F.coalesce(F.nullif("f.name", F.lit("")), "url"), F.lit(200)).alias("title"), F.coalesce("f.domain_tag", F.lit("general")).alias("tag"), "f.source_org", now.alias("at"))


def page_documents(documents: DataFrame, titles: DataFrame, source_type: str = "ingest") -> DataFrame:
    """M-9 with the tags: known documents of the pages take the new title, the others are added."""
    tags = titles.groupBy(F.col("url").alias("source_url")).agg(F.min_by("tag", "at").alias("_tag"))
    out = lifecycle.upsert_documents(conform(documents, schema("documents")).withColumn("_old", F.lit(True)), titles).join(tags, "source_url", "left")
    fill = lambda c, v: F.when(F.col("_old"), F.col(c)).otherwise(v)
    return out.withColumns({"source_type": fill("source_type", F.lit(source_type)), "domain_tag": fill("domain_tag", F.col("_tag"))}).drop("_old", "_tag")


def source_outcomes(sources: DataFrame, observations: DataFrame, done: DataFrame, unread: DataFrame | None, now: Column, monitor: bool) -> DataFrame:
    """M-2, M-4, T-4, T-10, T-11: a source that could not be read, or with a page whose extraction failed, lengthens its streak
    and is not marked as crawled; any other observed one is healthy and crawled, and a release source whose changes were all
    taken and consumed moves its marker to the release. A page given up is no failure any more."""
    bad = done.filter(F.lit(not monitor) & (F.col("final_status") == "failed")).groupBy("source_id").agg(F.concat(F.count(F.lit(1)).cast("string"), F.lit(" extraction failure(s)")).alias("error"))
    if unread is not None:
        lost = unread.groupBy("source_id").agg(F.concat(F.lit("detect: "), F.coalesce(F.min("error"), F.lit(""))).alias("error"))
        bad = lost.unionByName(bad.join(lost, "source_id", "left_anti"))
    seen = observations.select("source_id").union(bad.select("source_id")).filter("source_id IS NOT NULL").distinct()
    moved = done.groupBy("source_id").agg(F.when(F.bool_and("consumed") & ~F.bool_or("truncated"), F.max("marker")).alias("marker"))
    out = stored(seen.join(bad, "source_id", "left").join(moved, "source_id", "left").select("source_id", now.alias("at"), F.col("error").isNull().alias("ok"), "error", "marker"))
    return registry.mark_crawled(lifecycle.source_health(sources, out.drop("marker")), out.filter("ok").select("source_id", "marker"), now)


STATES = ("extracted", "empty", "irrelevant", "failed", "gave_up", "skipped_monitor", "retired")


def run_outcome(log: DataFrame, observations: DataFrame, unread: DataFrame | None, run_id: int) -> DataFrame:
    """A-14, A-16: the row that closes a run: done iff every source was read and nothing failed or was given up, else
    partial; the detail lists its sources (a bounded configuration) with their counters in order of source_id."""
    count = lambda s: F.sum((F.col("extract_status") == s).cast("int")).alias(s)
    per = log.groupBy("source_id").agg(F.count(F.lit(1)).alias("changes"), *[count(s) for s in STATES], F.sum("rules_new").alias("rules_new"), F.sum("rules_refreshed").alias("rules_refreshed"))
    lost = unread.select("source_id").distinct().withColumn("_lost", F.lit(True)) if unread is not None else log.select("source_id").limit(0).withColumn("_lost", F.lit(True))
    every = observations.select("source_id").union(lost.select("source_id")).filter("source_id IS NOT NULL").distinct()
    j = every.join(per, "source_id", "left").join(lost, "source_id", "left").fillna(0)
    status = F.when(F.col("_lost"), "detect_failed").when(F.col("failed") > 0, "extract_failed").otherwise("ok")
    j = j.withColumn("status", status)
    item = F.struct("source_id", "status", "changes", *STATES, "rules_new", "rules_refreshed")
    clean = F.coalesce(F.bool_and((F.col("status") == "ok") & (F.col("gave_up") == 0)), F.lit(True))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("int")
    return j.agg(
        F.lit(run_id).cast("bigint").alias("run_id"), F.when(clean, "done").otherwise("partial").alias("status"), F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("sources"))).alias("detail"),
        F.count(F.lit(1)).cast("int").alias("sources_checked"), n((F.col("changes") > 0).cast("int")).alias("sources_changed"), n("changes").alias("urls_changed"), n("rules_new").alias("objects_written"),
    )


def bridge_events(pages: DataFrame, now: Column) -> DataFrame:
    """The upserts of extracted pages for the fold (M-12), in order of their arrival and the rule's place. Replaying a file
    changes nothing but stamps."""
    v = extracted_rules(pages).filter("kept")
    return v.select(
        rule_key(F.col("name"), F.col("if_condition")).alias("rule_key"), F.lit(0).cast("bigint").alias("seq"), "url", F.lit(None).cast("string").alias("document_id"), F.col("new_status").alias("status"),
        F.nullif("excerpt", F.lit("")).alias("excerpt"), F.nullif("new_hash", F.lit("")).alias("content_hash"), F.lit(None).cast("string").alias("custom_provenance"), "then_logic", now.alias("at"),
        F.concat_ws("\x01", F.coalesce("arrival", F.lit("")), "url", F.lpad(F.col("ordinal").cast("string"), 6, "0")).alias("tie"),
        "name", "if_condition", "domain_tag", "confidence_score", F.col("org").alias("source_org"),
    )


def bridge(corpus: Corpus, pages: DataFrame, now: Column, run_id: int | None = None) -> tuple[Corpus, DataFrame]:
    """T-13: a file of extracted pages (the schema extracted_pages, with `arrival` from read_jsonl_strict): rules of every
    line pass the gate and are folded in, old rules are reconciled with the text, documents take the page's title (else its
    first rule's name, else its URL) and, if new, the most frequent tag (A-15), the log says `extracted` or `empty`, the page's
    state takes the hash (without validators), its source is crawled. Of several lines for a URL the last gives state, text
    and title; the rules of all count, and each line is logged. Returns the next corpus and the log rows."""
    runs = corpus.runs
    if runs is not None:
        runs = stored(lifecycle.open_run(runs, now))
        run_id = runs.agg(F.max("run_id")).first()[0]
    p = pages.filter("url IS NOT NULL")
    p = p if "arrival" in p.columns else p.withColumn("arrival", F.lit("").cast("string"))
    p = stored(p.withColumn("line", F.row_number().over(W.partitionBy("url").orderBy("arrival"))))
    rules = F.coalesce("rules", F.array().cast(p.schema["rules"].dataType))
    gated = stored(extracted_rules(p.withColumn("rules", rules)))
    events = stored(bridge_events(p.withColumn("rules", rules), now))
    per = gated.groupBy("url", "arrival").agg(F.sum(F.col("kept").cast("int")).alias("kept"))
    first = events.join(corpus.rules.select("rule_key").distinct(), "rule_key", "left_anti").groupBy("rule_key").agg(F.min("tie").alias("tie")).withColumn("_new", F.lit(1))
    written = events.join(first, ["rule_key", "tie"], "left").withColumn("arrival", F.substring_index("tie", "\x01", 1)).groupBy("url", "arrival")
    written = written.agg(F.sum(F.coalesce("_new", F.lit(0))).alias("rules_new"), F.sum(1 - F.coalesce("_new", F.lit(0))).alias("rules_refreshed"))
    log = p.join(per, ["url", "arrival"], "left").join(written, ["url", "arrival"], "left").select(
        F.lit(run_id).cast("bigint").alias("run_id"), "source_id", "url", F.lit("modified").alias("change_type"), F.lit("content_hash").alias("signal"), F.lit(None).cast("string").alias("old_hash"), "new_hash",
        now.alias("detected_at"), F.when(F.coalesce("kept", F.lit(0)) > 0, "extracted").otherwise("empty").alias("extract_status"),
        F.coalesce("rules_new", F.lit(0)).cast("int").alias("rules_new"), F.coalesce("rules_refreshed", F.lit(0)).cast("int").alias("rules_refreshed"),
    )
    log = stored(log)
    last = lifecycle.latest(p.select("url", "source_id", "org", "title", "new_hash", "text", "line"), ["url"], [F.col("line")])
    kept = lifecycle.reconcile(corpus.rules, last.select("url", F.col("new_hash").alias("content_hash"), "text"), now).drop("outcome")
    tags = events.groupBy("url", F.coalesce(F.nullif("domain_tag", F.lit("")), F.lit("general")).alias("tag")).agg(F.count(F.lit(1)).alias("c"), F.min("tie").alias("f"))
    tags = tags.groupBy("url").agg(F.min_by("tag", F.struct(-F.col("c"), F.col("f"))).alias("tag"))
    names = events.groupBy("url").agg(F.min_by("name", "tie").alias("name"))
    titles = last.join(tags, "url").join(names, "url").select("url", F.left(F.coalesce(F.nullif("title", F.lit("")), "name", "url"), F.lit(200)).alias("title"), "tag", F.col("org").alias("source_org"), now.alias("at"))
    rules_, documents = fold_in(replace(corpus, rules=stored(kept)), events, titles, now)
    none = F.lit(None).cast("string")
    saved = last.filter("coalesce(new_hash, '') <> ''").select("url", "source_id", none.alias("etag"), none.alias("last_modified"), F.col("new_hash").alias("content_hash"), now.alias("last_seen_at"))
    state = lifecycle.save_url_state(corpus.url_state, saved)
    sources = corpus.registry
    if sources is not None:
        sources = registry.mark_crawled(sources, saved.select("source_id", none.alias("marker")).distinct(), now)
    if runs is not None:
        out = run_outcome(log, log.join(saved.select("url"), "url", "left_semi").select("source_id"), None, run_id)
        runs = lifecycle.finish_run(runs, out.withColumns({"status": F.lit("done"), "sources_changed": F.col("sources_checked"), "urls_changed": F.lit(log.count())}), now)
    return replace(corpus, rules=rules_, url_state=state, documents=documents, registry=sources, runs=runs, changes=log_rows(corpus.changes, log)), log


def observation_events(observations: DataFrame, now: Column, org: str = "observed") -> tuple[DataFrame, DataFrame]:
    """The accepted observations as upserts of candidate rules with their provenance (F-23), and the rejected ones with the
    reason; lines that were no JSON are rejected too."""
    o = observations
    for c in ("corrupt", "arrival"):
        o = o if c in o.columns else o.withColumn(c, F.lit(None).cast("string"))
    g = gates.observation_gate(o).withColumn("reject_reason", F.when(F.col("corrupt").isNotNull(), "malformed").otherwise(F.col("reject_reason")))
    exemplars = F.when(F.coalesce("exemplar_url", F.lit("")) != "", F.array("exemplar_url")).otherwise(F.array().cast("array<string>"))
    whole = lambda c: F.coalesce(F.col(f"prevalence.{c}").cast("string").try_cast("bigint"), F.lit(0)).alias(c)
    prevalence = F.struct(whole("n"), whole("m"), whole("sessions"), "ratio")
    note = F.to_json(F.struct(F.lit("observed-crawl").alias("method"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss").alias("at"), prevalence.alias("prevalence"), F.coalesce("observer", F.lit("unknown")).alias("observer"), exemplars.alias("exemplars"), F.slice(F.coalesce("session_ids", F.array().cast("array<string>")), 1, 20).alias("session_ids")))
    name = F.left(strip(F.col("name")), F.lit(300))
    ok = g.filter("reject_reason IS NULL").select(
        rule_key(name, F.col("if_condition")).alias("rule_key"), F.lit(0).cast("bigint").alias("seq"), F.coalesce("exemplar_url", F.lit("")).alias("url"), F.lit(None).cast("string").alias("document_id"),
        F.lit("candidate").alias("status"), F.lit(None).cast("string").alias("excerpt"), F.lit(None).cast("string").alias("content_hash"), note.alias("custom_provenance"), strip(F.col("then_logic")).alias("then_logic"),
        now.alias("at"), F.concat_ws("\x01", F.coalesce("arrival", F.lit("")), name, strip(F.col("if_condition"))).alias("tie"),
        name.alias("name"), strip(F.col("if_condition")).alias("if_condition"), F.col("tag").alias("domain_tag"), F.col("confidence").cast("string").alias("confidence_score"), F.lit(org).alias("source_org"), F.lit("observed").alias("rule_type"),
    )
    return ok, g.filter("reject_reason IS NOT NULL").select("name", "reject_reason", "corrupt")


def observe(corpus: Corpus, observations: DataFrame, now: Column, org: str = "observed") -> tuple[Corpus, DataFrame]:
    """T-14: a file of observations: accepted ones become candidate rules (P-13, M-12) under a document of their exemplar's URL
    ('' for all that have none), titled by the last of them to arrive. Returns the next corpus and the rejected lines. Neither
    log nor state is touched."""
    events, rejected = observation_events(observations, now, org)
    events = stored(events)
    titles = events.groupBy("url").agg(F.max_by("name", "tie").alias("name"), F.min_by("domain_tag", "tie").alias("tag"))
    titles = titles.select("url", F.left(F.concat(F.lit("Observed pattern: "), F.col("name")), F.lit(200)).alias("title"), "tag", F.lit(org).alias("source_org"), now.alias("at"))
    rules, documents = fold_in(corpus, events, titles, now)
    return replace(corpus, rules=rules, documents=documents), rejected


def enrich_exact(corpus: Corpus, observations: DataFrame, answers: DataFrame, now: Column, unread: DataFrame | None = None) -> tuple[Corpus, DataFrame]:
    """X-6: all listed pages of the enabled url_list sources at once, without a cap and without a log. Unlike a script that
    marks every source as crawled, one with failures is not; pages that are gone retire their rules. Returns the next corpus
    and the counts: (pages, new, refreshed, failed, url_before, url_after)."""
    listed = registry.ordered(corpus.registry, "url_list").select("source_id")
    only = lambda df: df.join(F.broadcast(listed), "source_id", "left_semi") if df is not None else None  # noqa: E731  a small dimension
    after, log = cycle(replace(corpus, runs=None), only(observations), answers, now, unread=only(unread), cap=None, record=False)
    with_url = lambda r: F.coalesce(F.sum(gates.has_url(F.col("source_url")).cast("int")), F.lit(0)).cast("bigint").alias(r)
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    counts = log.agg(F.count(F.lit(1)).alias("pages"), n("rules_new").alias("new"), n("rules_refreshed").alias("refreshed"), n((F.col("extract_status") == "failed").cast("int")).alias("failed"))
    counts = counts.join(F.broadcast(corpus.rules.agg(with_url("url_before")))).join(F.broadcast(after.rules.agg(with_url("url_after"))))  # one row each
    return replace(after, runs=corpus.runs), counts
