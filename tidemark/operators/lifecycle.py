"""Keyed state: verification stamps, retirement, reconciliation and the upsert fold (section 2.9).

Every mutation takes the current snapshot and a batch and returns the next snapshot; nothing is updated in place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import refs, rule_key, strip
from ..functions.urls import normalize_url
from . import gates
from .lookups import evidence_cutoff, excerpt_outcome


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """W-1: the row that is last by `order` of each key, by max_by with map-side combination; order must be total."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return g.select(*keys, "r.*")


def save_url_state(state: DataFrame, seen: DataFrame) -> DataFrame:
    """M-5: the last observation of each URL wins, but a known URL keeps its source_id. seen: url, source_id, etag,
    last_modified, content_hash, last_seen_at."""
    new = latest(seen.filter("url IS NOT NULL"), ["url"], [F.col("last_seen_at"), F.coalesce("content_hash", F.lit("")), F.coalesce("source_id", F.lit(""))])
    s, n = state.alias("s"), new.alias("n")
    hit = F.col("n.url").isNotNull()
    pick = lambda c: F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
    j = s.join(n, F.col("s.url") == F.col("n.url"), "full_outer")
    return j.select(F.coalesce("s.url", "n.url").alias("url"), F.coalesce("s.source_id", "n.source_id").alias("source_id"), *[pick(c) for c in ("etag", "last_modified", "content_hash", "last_seen_at")])


def rekey_url_state(state: DataFrame) -> DataFrame:
    """M-16: one row per normalised URL, the newest spelling wins (of equal times the greater spelling). Unlike a
    row-by-row migration this does not let an older raw spelling overwrite a newer normalised one."""
    s = state.withColumns({"raw": F.col("url"), "url": normalize_url(F.col("url"))}).filter("url IS NOT NULL")
    never = F.lit("0001-01-01").cast("timestamp")
    one = latest(s, ["url"], [F.coalesce("last_seen_at", never), F.coalesce("raw", F.lit("")), F.coalesce("content_hash", F.lit(""))])
    n = s.groupBy("url").agg(F.count_distinct("raw").alias("spellings"))
    return one.join(n, "url").drop("raw")


def source_health(registry: DataFrame, outcomes: DataFrame) -> DataFrame:
    """M-4: folds a batch of (source_id, at, ok, error), at most one a moment, into the failure streak: an ok sets it to 0
    and clears the error, a failure adds 1 and keeps its message to 300 characters. Works from counts: only failures
    after the last ok matter."""
    o = outcomes.groupBy("source_id").agg(
        F.max(F.when(F.col("ok"), F.col("at"))).alias("_ok"), F.max_by(F.left("error", F.lit(300)), F.when(~F.col("ok"), F.col("at"))).alias("_err"), F.max(F.when(~F.col("ok"), F.col("at"))).alias("_bad"), F.lit(True).alias("_hit")
    )
    after = outcomes.join(o.select("source_id", "_ok"), "source_id").filter(~F.col("ok") & (F.col("_ok").isNull() | (F.col("at") > F.col("_ok")))).groupBy("source_id").agg(F.count(F.lit(1)).alias("_fails"))
    j = registry.join(o, "source_id", "left").join(after, "source_id", "left")
    base = F.when(F.col("_ok").isNotNull(), 0).otherwise(F.coalesce("consecutive_failures", F.lit(0)))
    fails = (base + F.coalesce("_fails", F.lit(0))).cast("int")
    ends_bad = F.col("_bad").isNotNull() & (F.col("_ok").isNull() | (F.col("_bad") > F.col("_ok")))
    return j.withColumns({
        "consecutive_failures": F.when(F.col("_hit"), fails).otherwise(F.col("consecutive_failures")),
        "last_ok_at": F.greatest("last_ok_at", "_ok"),
        "last_error": F.when(F.col("_hit"), F.when(ends_bad, F.col("_err"))).otherwise(F.col("last_error")),
    }).drop("_ok", "_err", "_bad", "_hit", "_fails")


def failure_streaks(changes: DataFrame) -> DataFrame:
    """W-8: failures per source after its last success, from the whole history: (source_id, failures, last_ok)."""
    bad = F.col("extract_status").isin("failed", "gave_up")
    ok = changes.groupBy("source_id").agg(F.max(F.when(~bad, F.col("change_id"))).alias("last_ok"))
    j = changes.filter(bad).join(ok, "source_id").filter(F.col("last_ok").isNull() | (F.col("change_id") > F.col("last_ok")))
    n = j.groupBy("source_id").agg(F.count_distinct("change_id").alias("failures"))
    return ok.join(n, "source_id", "left").withColumn("failures", F.coalesce("failures", F.lit(0))).filter("source_id IS NOT NULL")


def restamp(rows: DataFrame, observed: DataFrame, changes: DataFrame, now: Column, least_age_s: int = 3600) -> DataFrame:
    """M-6, T-7: adds `stamped` and renews last_verified of rows whose page was observed unchanged: (url, content_hash) in
    `observed` is a version on record, the row was verified since that version was first seen but not within the last
    hour, and it may be cited. A null last_verified is never stamped; null hashes prove nothing."""
    cut = observed.filter("content_hash IS NOT NULL").select("url", F.col("content_hash").alias("new_hash")).distinct().join(evidence_cutoff(changes), ["url", "new_hash"])
    cut = cut.groupBy(F.col("url").alias("source_url")).agg(F.min("cutoff").alias("_cutoff"))
    j = rows.join(cut, "source_url", "left")
    old = now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(least_age_s))
    hit = F.coalesce((F.col("last_verified") >= F.col("_cutoff")) & (F.col("last_verified") < old), F.lit(False)) & gates.citable(rows)
    return j.withColumns({"stamped": hit, "last_verified": F.when(hit, now).otherwise(F.col("last_verified"))}).drop("_cutoff")


def retire_removed(rules: DataFrame, state: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M-10, T-9: rules of pages that are gone become retired if they were exactly `active` (a null or candidate state
    stays); the pages leave url_state."""
    g = gone.select(F.col("url").alias("source_url"), F.lit(True).alias("_gone")).distinct()
    j = rules.join(g, "source_url", "left")
    out = j.withColumn("status", F.when(F.col("_gone") & (F.col("status") == "active"), "retired").otherwise(F.col("status"))).drop("_gone")
    return out, state.join(gone.select("url").distinct(), "url", "left_anti")


def reconcile(rules: DataFrame, pages: DataFrame, now: Column) -> DataFrame:
    """M-11: adds `outcome` and applies it: rules in force with an excerpt, of a page whose text was fetched. `rebound` if
    the excerpt is still there (new hash, verified now, proof unchanged), else `superseded` if the rule was bound to
    another version, else `kept`; null for rules it does not concern. Pages without url, hash or text do nothing."""
    usable = pages.filter((F.coalesce("url", F.lit("")) != "") & (F.coalesce("content_hash", F.lit("")) != "") & (F.coalesce("text", F.lit("")) != ""))
    concerned = (
        (F.coalesce("status", F.lit("active")) == "active") & ~F.col("rule_type").eqNullSafe("observed")
        & F.col("provenance_status").isin("verified_excerpt", "source_change_pending") & (F.coalesce("source_excerpt", F.lit("")) != "")
    )
    seen = excerpt_outcome(rules.filter(concerned).select("id", "source_url", "source_excerpt"), usable).select("id", "page_hash", "present").dropDuplicates(["id"])
    j = rules.join(seen, "id", "left")
    outcome = F.when(F.col("present"), "rebound").when(~F.col("present") & ~F.col("source_content_hash").eqNullSafe(F.col("page_hash")), "superseded").when(~F.col("present"), "kept")
    is_ = lambda o: F.col("outcome").eqNullSafe(o)
    return j.withColumn("outcome", outcome).withColumns({
        "source_content_hash": F.when(is_("rebound"), F.col("page_hash")).otherwise(F.col("source_content_hash")),
        "last_verified": F.when(is_("rebound"), now).otherwise(F.col("last_verified")),
        "status": F.when(is_("superseded"), "superseded").otherwise(F.col("status")),
        "provenance_status": F.when(is_("superseded"), "source_changed").otherwise(F.col("provenance_status")),
    }).drop("page_hash", "present")


def mark_pending(rules: DataFrame, changed: DataFrame) -> DataFrame:
    """M-13: verified active (or stateless) rules of changed pages wait for a new check."""
    c = changed.select(F.col("url").alias("source_url"), F.lit(True).alias("_hit")).distinct()
    hit = F.col("_hit").eqNullSafe(True) & (F.coalesce("status", F.lit("active")) == "active") & F.col("provenance_status").eqNullSafe("verified_excerpt")
    return rules.join(c, "source_url", "left").withColumn("provenance_status", F.when(hit, "source_change_pending").otherwise(F.col("provenance_status"))).drop("_hit")


def undeprecate(rules: DataFrame, keys: list[str] | DataFrame, now: Column) -> DataFrame:
    """M-17: lifts the latch of deprecated rules given by id or rule_key, in a list or the first column of a table of any
    size; adds `changed`."""
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(keys.columns[0]).alias("_key")).filter("_key IS NOT NULL").distinct()
        for c, flag in (("id", "_by_id"), ("rule_key", "_by_key")):
            rules = rules.join(k.select(F.col("_key").alias(c), F.lit(True).alias(flag)), c, "left")
        named = F.coalesce("_by_id", "_by_key", F.lit(False))
    else:
        named = F.col("id").isin(*keys) | F.coalesce(F.col("rule_key").isin(*keys), F.lit(False))
    hit = named & F.col("status").eqNullSafe("deprecated")
    return rules.withColumns({"changed": hit, "status": F.when(hit, "active").otherwise(F.col("status")), "last_verified": F.when(hit, now).otherwise(F.col("last_verified"))}).drop("_by_id", "_by_key")


def upsert_documents(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """M-9: one document per source_url ('' is a key too); a known one takes the title of the latest page (url, title,
    source_id, at), a new one gets the id after the largest numeric one, in order of its first page."""
    from .lookups import numbered
    from .rollups import max_numeric_id

    p = pages.filter("url IS NOT NULL").groupBy("url").agg(F.max_by("title", "at").alias("title"), F.min("at").alias("first"), F.min_by("source_org", "at").alias("source_org"))
    d = documents.join(p.select(F.col("url").alias("source_url"), F.col("title").alias("_title")), "source_url", "left").withColumn("title", F.coalesce("_title", "title")).drop("_title")
    new = p.join(documents.select(F.col("source_url").alias("url")).distinct(), "url", "left_anti")
    start = max_numeric_id(documents).first()[0]
    new = numbered(new, start, [F.col("first"), F.col("url")]).select(F.col("new_id").cast("string").alias("id"), "title", F.col("url").alias("source_url"), "source_org", F.col("first").alias("created_at"))
    return d.unionByName(new, allowMissingColumns=True)


def start_run(runs: DataFrame, now: Column, limit_s: int = 7200) -> DataFrame:
    """M-8, T-12: runs that have been running for more than two hours are aborted."""
    late = (F.col("status") == "running") & (F.col("started_at") < now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(limit_s)))
    hit = F.coalesce(late, F.lit(False))
    return runs.withColumns({"status": F.when(hit, "aborted").otherwise(F.col("status")), "finished_at": F.when(hit, now).otherwise(F.col("finished_at"))})


def open_run(runs: DataFrame, now: Column) -> DataFrame:
    """M-8: sweeps the stale runs and appends one that is running, numbered after the largest run_id (from 1)."""
    last = runs.agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).alias("run_id"))
    new = last.select(F.col("run_id").cast("bigint").alias("run_id"), now.alias("started_at"), F.lit("running").alias("status"))
    return start_run(runs, now).unionByName(new, allowMissingColumns=True)


RUN_COUNTERS = ("sources_checked", "sources_changed", "urls_changed", "objects_written")


def finish_run(runs: DataFrame, outcome: DataFrame, now: Column) -> DataFrame:
    """M-8: closes runs by (run_id, status, detail and any of the counters); other runs stay as they are."""
    given = ["status", "detail", *[c for c in RUN_COUNTERS if c in outcome.columns]]
    types = dict(runs.dtypes)
    o = outcome.select("run_id", *[F.col(c).cast(types[c]).alias(f"_{c}") for c in given], F.lit(True).alias("_hit"))
    j = runs.join(F.broadcast(o), "run_id", "left")  # one row a run that ends
    return j.withColumns({c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in given} | {"finished_at": F.when(F.col("_hit"), now).otherwise(F.col("finished_at"))}).select(*runs.columns)


EVENT = "rule_key string, seq long, url string, document_id string, status string, excerpt string, content_hash string, custom_provenance string, then_logic string, at timestamp"
STATE_COLUMNS = ("source_url", "document_id", "url_provenance", "status", "proof", "excerpt", "content_hash", "last_verified", "then_logic")
STATE = "rule_key string, source_url string, document_id string, url_provenance string, status string, proof string, excerpt string, content_hash string, last_verified timestamp, then_logic string, n_events long"


def rule_events(rules: DataFrame) -> DataFrame:
    """Upserts as they would have arrived: each row of rules, in order of creation and id."""
    seq = F.unix_micros("created_at")
    key = F.coalesce(F.nullif("rule_key", F.lit("")), rule_key(F.col("name"), F.col("if_condition")))
    return rules.select(
        key.alias("rule_key"), seq.alias("seq"), F.col("source_url").alias("url"), "document_id", "status", F.left(F.nullif(strip(F.col("source_excerpt")), F.lit("")), F.lit(1000)).alias("excerpt"),
        F.nullif("source_content_hash", F.lit("")).alias("content_hash"), F.when(F.col("rule_type") == "observed", F.col("url_provenance")).alias("custom_provenance"), "then_logic",
        F.col("extracted_at").alias("at"), F.col("id").alias("tie"),
    )


def _depth(url: str | None) -> int:
    return (url or "").rstrip("/").count("/")


def fold_step(state: dict | None, e: dict) -> dict:
    """M-12: what one upsert makes of a rule. Four outcomes for the citation: full rewrite, refresh, or status alone. A null
    URL of an upsert equals no stored one; a stored null counts as empty."""
    proof = "observed" if e["custom_provenance"] else "verified_excerpt" if e["excerpt"] and e["content_hash"] else "unverified"
    evidence = {"excerpt": e["excerpt"], "content_hash": e["content_hash"], "proof": proof, "last_verified": e["at"]}
    cite = {"source_url": e["url"], "document_id": e["document_id"], "url_provenance": "extracted", **evidence}
    if state is None:
        return {**cite, "url_provenance": e["custom_provenance"] or "extracted", "status": e["status"], "then_logic": e["then_logic"], "n_events": 1}
    proven, known = proof == "verified_excerpt", state["proof"] == "verified_excerpt"
    deeper = bool(e["url"]) and (not state["source_url"] or _depth(e["url"]) > _depth(state["source_url"]))
    same = (state["source_url"] or "") == e["url"]
    out = dict(state)
    if (deeper and (proven or not known)) or (proven and not known and (same or not state["source_url"])):
        out.update(cite)
    elif proven and known and same:
        out.update(evidence)
    out["status"] = "deprecated" if "deprecated" in (e["status"], state["status"]) else "active"
    if not (state["then_logic"] or "").strip() and e["then_logic"]:
        out["then_logic"] = e["then_logic"]
    out["n_events"] = state["n_events"] + 1
    return out


def fold_once(b: pa.RecordBatch) -> pa.RecordBatch:
    """fold_step for many rules with one upsert each, by columns."""
    import pyarrow.compute as pc

    text = lambda c: pc.fill_null(c, "")
    any_of = lambda x, *more: pc.or_(x, any_of(*more)) if more else x
    all_of = lambda x, *more: pc.and_(x, all_of(*more)) if more else x
    filled = lambda c: pc.not_equal(text(c), "")
    depth = lambda c: pc.count_substring(pc.utf8_rtrim(text(c), "/"), "/")
    e = {c: b.column(c) for c in ("url", "document_id", "status", "excerpt", "content_hash", "custom_provenance", "then_logic", "at")}
    observed = filled(e["custom_provenance"])
    proof = pc.if_else(observed, "observed", pc.if_else(pc.and_(filled(e["excerpt"]), filled(e["content_hash"])), "verified_excerpt", "unverified"))
    new = {
        "source_url": e["url"], "document_id": e["document_id"], "url_provenance": pc.if_else(observed, e["custom_provenance"], "extracted"), "status": e["status"], "proof": proof,
        "excerpt": e["excerpt"], "content_hash": e["content_hash"], "last_verified": e["at"], "then_logic": e["then_logic"],
    }
    n = pa.array([1] * b.num_rows, pa.int64())
    if "prior" in b.schema.names:
        prior = b.column("prior")
        s = {c: pc.struct_field(prior, c) for c in (*STATE_COLUMNS, "n_events")}
        has, empty = pc.is_valid(prior), pc.invert(filled(s["source_url"]))
        proven, known = pc.equal(proof, "verified_excerpt"), pc.equal(text(s["proof"]), "verified_excerpt")
        deeper = pc.and_(filled(e["url"]), pc.or_(empty, pc.greater(depth(e["url"]), depth(s["source_url"]))))
        same = pc.and_(pc.is_valid(e["url"]), pc.equal(text(s["source_url"]), text(e["url"])))
        cite = pc.or_(pc.and_(deeper, pc.or_(proven, pc.invert(known))), all_of(proven, pc.invert(known), pc.or_(same, empty)))
        evidence = pc.or_(cite, all_of(proven, known, same))
        latched = pc.or_(pc.equal(text(e["status"]), "deprecated"), pc.equal(text(s["status"]), "deprecated"))
        backfill = pc.and_(pc.equal(pc.utf8_trim_whitespace(text(s["then_logic"])), ""), filled(e["then_logic"]))
        after = {c: pc.if_else(cite, new[c], s[c]) for c in ("source_url", "document_id")} | {c: pc.if_else(evidence, new[c], s[c]) for c in ("proof", "excerpt", "content_hash", "last_verified")}
        after |= {"url_provenance": pc.if_else(cite, "extracted", s["url_provenance"]), "status": pc.if_else(latched, "deprecated", "active"), "then_logic": pc.if_else(backfill, e["then_logic"], s["then_logic"])}
        new = {c: pc.if_else(has, after[c], new[c]) for c in STATE_COLUMNS}
        n = pc.if_else(has, pc.add(pc.fill_null(s["n_events"], 0), 1), n)
    return pa.RecordBatch.from_arrays([b.column("rule_key"), *[new[c].cast(t) for c, t in zip(STATE_COLUMNS, _FOLDED.types[1:])], n], schema=_FOLDED)


_FOLDED = pa.schema([("rule_key", pa.string()), *[(c, pa.timestamp("us", "UTC") if c == "last_verified" else pa.string()) for c in STATE_COLUMNS], ("n_events", pa.int64())])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams over events sorted by key and order. Keys with a single event inside a batch are folded by columns; of the
    others, and of those at a batch's ends, one step an event with only the rule at hand held."""
    key, state = None, None
    for b in batches:
        if not b.num_rows:
            continue
        code = b.column("rule_key").dictionary_encode(null_encoding="encode").indices.to_numpy()
        new = np.append(True, code[1:] != code[:-1])
        alone = new & np.append(new[1:], False)
        alone[0] = False
        if alone.any():
            yield fold_once(b.filter(pa.array(alone)))
        done = []
        for e in b.filter(pa.array(~alone)).to_pylist():
            if e["rule_key"] != key:
                if state:
                    done.append({"rule_key": key, **state})
                key, state = e["rule_key"], e.get("prior")
            state = fold_step(state, e)
        yield pa.RecordBatch.from_pylist(done, schema=_FOLDED)
    if state:
        yield pa.RecordBatch.from_pylist([{"rule_key": key, **state}], schema=_FOLDED)


def upsert_fold(events: DataFrame) -> DataFrame:
    """M-12: the state of every rule after its events in order (seq, tie), from the state `prior` if there is one. Keys are shuffled once and sorted inside the
    partitions, then folded as a stream, so a hot key needs time in proportion to its events but no memory."""
    order = ["rule_key", "seq"] + (["tie"] if "tie" in events.columns else [])
    cols = [c for c in events.columns]
    return events.select(cols).repartition("rule_key").sortWithinPartitions(*order).mapInArrow(_fold, STATE)


def upsert_rules(rules: DataFrame, events: DataFrame, now: Column) -> DataFrame:
    """M-12 on a snapshot: the rules after the events, which also carry name, if_condition, domain_tag, confidence_score and
    source_org, perhaps rule_type. Every row of a known rule_key goes on from its own state; a new key becomes a row with the
    next id (W-7), of type `ingested` and confidence 0.8 where its first event states none."""
    from .lookups import numbered
    from .rollups import max_numeric_id

    at = {"proof": "provenance_status", "excerpt": "source_excerpt", "content_hash": "source_content_hash"}
    cols = {c: at.get(c, c) for c in STATE_COLUMNS}
    prior = F.struct(*[F.col(f"r.{c}").alias(s) for s, c in cols.items()], F.lit(0).cast("bigint").alias("n_events")).alias("prior")
    known = events.alias("e").join(rules.alias("r"), F.col("e.rule_key") == F.col("r.rule_key"))
    known = known.select(F.col("r.id").alias("rule_key"), *[F.col(f"e.{c}").alias(c) for c in events.columns if c != "rule_key"], prior)
    after = upsert_fold(known).select(F.col("rule_key").alias("id"), F.struct(*cols).alias("_after"))
    out = rules.join(after, "id", "left").withColumns({c: F.when(F.col("_after").isNotNull(), F.col(f"_after.{s}")).otherwise(F.col(c)) for s, c in cols.items()}).drop("_after")

    fresh = events.join(rules.select("rule_key").distinct(), "rule_key", "left_anti")
    given = ("name", "if_condition", "domain_tag", "confidence_score", "source_org", "rule_type")
    if "rule_type" not in fresh.columns:
        fresh = fresh.withColumn("rule_type", F.lit(None).cast("string"))
    first = fresh.groupBy("rule_key").agg(F.min_by(F.struct("document_id", "tie", *given), F.struct("seq", "tie")).alias("f"))
    new = upsert_fold(fresh).select("rule_key", *[F.col(s).alias(c) for s, c in cols.items()]).join(first, "rule_key")
    new = numbered(new, max_numeric_id(rules).first()[0], [F.col("f.tie"), F.col("rule_key")])
    new = new.select(
        F.col("new_id").cast("string").alias("id"), "rule_key", *cols.values(), *[F.col(f"f.{c}").alias(c) for c in given],
        refs(F.col("f.document_id")).alias("source_refs_json"), now.alias("created_at"), now.alias("extracted_at"),
    ).withColumns({c: F.coalesce(c, F.lit(v)) for c, v in (("domain_tag", "general"), ("rule_type", "ingested"), ("confidence_score", "0.8"))})
    return out.unionByName(new, allowMissingColumns=True)
