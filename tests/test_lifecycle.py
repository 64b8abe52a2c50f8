"""Keyed state against sequential models."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lifecycle as lc
from tidemark.operators import lookups

T0 = datetime(2025, 1, 1)
NOW = datetime(2026, 1, 1)
now = lambda: F.lit("2026-01-01").cast("timestamp")
R = "id string, source_url string, status string, rule_type string, provenance_status string, url_provenance string, source_excerpt string, source_content_hash string, last_verified timestamp, rule_key string"


def rule(spark, *rows):
    return spark.createDataFrame(rows, R)


def r(i, url="u", status="active", kind="ingested", proof="verified_excerpt", prov="extracted", excerpt="exact words here", h="h1", seen=T0, key=None):
    return (i, url, status, kind, proof, prov, excerpt, h, seen, key)


def col(df, c, key="id"):
    return {x[key]: x[c] for x in df.collect()}


def test_restamp_gates(spark):
    changes = spark.createDataFrame([("u", "h1", T0), ("u", "h1", T0 + timedelta(days=9)), ("u", "old", T0 - timedelta(days=99)), (None, "h1", T0), ("v", None, T0)], "url string, new_hash string, detected_at timestamp")
    rows = [
        r("ok"), r("null", status=None), r("cand", status="candidate"), r("before", seen=T0 - timedelta(days=1)), r("never", seen=None), r("young", seen=NOW - timedelta(minutes=5)), r("neighbor", prov='{"method":"neighbor"}'),
        *[r(s, status=s) for s in ("rejected", "retired", "superseded", "deprecated")], r("other", url="w"), r("nohash", url="v"),
    ]
    seen = spark.createDataFrame([("u", "h1"), ("v", None), ("w", "unknown")], "url string, content_hash string")
    got = lc.restamp(rule(spark, *rows), seen, changes, now())
    assert {k for k, v in col(got, "stamped").items() if v} == {"ok", "null", "cand"}
    assert col(got, "last_verified")["ok"] == NOW and col(got, "last_verified")["before"] == T0 - timedelta(days=1)
    again = lc.restamp(got.drop("stamped"), seen, changes, now())
    assert not any(col(again, "stamped").values())


def test_retire(spark):
    rows = [r("a"), r("null", status=None), r("cand", status="candidate"), r("else", url="v")]
    state = spark.createDataFrame([("u",), ("v",)], "url string")
    rules, left = lc.retire_removed(rule(spark, *rows), state, spark.createDataFrame([("u",), ("u",)], "url string"))
    assert col(rules, "status") == {"a": "retired", "null": None, "cand": "candidate", "else": "active"} and [x[0] for x in left.collect()] == ["v"]


def test_reconcile(spark):
    rows = [r("kept"), r("gone", excerpt="words that vanished"), r("same", excerpt="words that vanished", h="h2"), r("nohash", excerpt="words that vanished", h=None), r("pend", proof="source_change_pending"), r("obs", kind="observed"), r("unv", proof="unverified"), r("else", url="v"), r("blank", url="w")]
    pages = spark.createDataFrame([("u", "h2", "some  exact\nwords here"), ("w", "h", "")], "url string, content_hash string, text string")
    out = lc.reconcile(rule(spark, *rows), pages, now())
    assert col(out, "outcome") == {"kept": "rebound", "gone": "superseded", "same": "kept", "nohash": "superseded", "pend": "rebound", "obs": None, "unv": None, "else": None, "blank": None}
    assert col(out, "source_content_hash")["kept"] == "h2" and col(out, "provenance_status")["pend"] == "source_change_pending"
    assert col(out, "provenance_status")["gone"] == "source_changed" and col(out, "status")["gone"] == "superseded" and col(out, "last_verified")["same"] == T0


def test_pending_and_undeprecate(spark):
    rows = [r("a"), r("null", status=None), r("unv", proof="unverified"), r("dep", status="deprecated", key="k"), r("else", url="v")]
    out = lc.mark_pending(rule(spark, *rows), spark.createDataFrame([("u",)], "url string"))
    assert {k for k, v in col(out, "provenance_status").items() if v == "source_change_pending"} == {"a", "null"}
    un = lc.undeprecate(rule(spark, *rows), ["k", "a"], now())
    assert {k for k, v in col(un, "changed").items() if v} == {"dep"} and col(un, "status")["dep"] == "active"


def test_save_and_rekey_url_state(spark):
    t = "url string, source_id string, etag string, last_modified string, content_hash string, last_seen_at timestamp"
    state = spark.createDataFrame([("u", "s1", "e", "m", "h", T0), ("v", "s1", None, None, "h", T0)], t)
    seen = spark.createDataFrame([("u", "s2", "e2", None, "h2", T0 + timedelta(1)), ("u", "s2", "e1", None, "h1", T0), ("n", "s3", None, None, None, None), (None, "s", None, None, None, T0)], t)
    got = {x["url"]: x for x in lc.save_url_state(state, seen).collect()}
    assert set(got) == {"u", "v", "n"} and (got["u"]["source_id"], got["u"]["content_hash"], got["u"]["last_modified"]) == ("s1", "h2", None) and got["v"]["content_hash"] == "h"
    raw = spark.createDataFrame([("https://x.example/a", "old", T0), ("https://x.example/a/?utm_source=q", "new", T0 + timedelta(1)), ("https://x.example/a#t", "none", None), ("https://x.example/b", "b", None)], "url string, content_hash string, last_seen_at timestamp")
    one = {x["url"]: (x["content_hash"], x["spellings"]) for x in lc.rekey_url_state(raw).collect()}
    assert one == {"https://x.example/a": ("new", 3), "https://x.example/b": ("b", 1)}


def test_source_health_equals_sequential(spark):
    rng = random.Random(3)
    reg, outcomes, model = [], [], {}
    for s in range(12):
        start = rng.randrange(4)
        reg.append((f"s{s}", start, None, "before"))
        fails, err, ok_at = start, "before", None
        for k in range(rng.randrange(6)):
            ok = rng.random() < 0.4
            at = T0 + timedelta(hours=k)
            outcomes.append((f"s{s}", at, ok, None if ok else f"e{k}" * 200))
            fails, err, ok_at = (0, None, at) if ok else (fails + 1, (f"e{k}" * 200)[:300], ok_at)
        model[f"s{s}"] = (fails, ok_at, err)
    df = spark.createDataFrame(reg, "source_id string, consecutive_failures int, last_ok_at timestamp, last_error string")
    o = spark.createDataFrame(outcomes, "source_id string, at timestamp, ok boolean, error string")
    assert {x[0]: tuple(x[1:]) for x in lc.source_health(df, o).select("source_id", "consecutive_failures", "last_ok_at", "last_error").collect()} == model


def test_stale_runs(spark):
    df = spark.createDataFrame([(1, "running", NOW - timedelta(hours=3), None), (2, "running", NOW - timedelta(hours=1), None), (3, "done", T0, T0), (4, None, None, None)], "run_id int, status string, started_at timestamp, finished_at timestamp")
    assert col(lc.start_run(df, now()), "status", "run_id") == {1: "aborted", 2: "running", 3: "done", 4: None}


E = dict(rule_key="k", seq=1, url="https://x.example/a", document_id="d", status="active", excerpt="ex", content_hash="h", custom_provenance=None, then_logic="t", at=T0)


@pytest.mark.parametrize(
    "state,event,want",
    [
        ({}, {"status": "deprecated"}, {"status": "deprecated"}),
        ({"status": "deprecated"}, {}, {"status": "deprecated"}),
        ({"status": "candidate"}, {}, {"status": "active"}),
        ({}, {"url": "https://x.example/a/b", "content_hash": "h2"}, {"source_url": "https://x.example/a/b", "content_hash": "h2", "url_provenance": "extracted"}),
        ({}, {"url": "https://x.example/a/b", "excerpt": None}, {"source_url": "https://x.example/a", "content_hash": "h", "proof": "verified_excerpt"}),
        ({"proof": "unverified", "excerpt": None}, {"url": "https://x.example/a/b", "excerpt": None, "at": NOW}, {"source_url": "https://x.example/a/b", "proof": "unverified", "last_verified": NOW}),
        ({"proof": "unverified"}, {"content_hash": "h2"}, {"proof": "verified_excerpt", "content_hash": "h2"}),
        ({"proof": "unverified"}, {"url": "https://y.example/a", "content_hash": "h2"}, {"proof": "unverified", "content_hash": "h"}),
        ({}, {"content_hash": "h2", "at": NOW}, {"content_hash": "h2", "last_verified": NOW}),
        ({}, {"url": "https://y.example/z", "content_hash": "h2", "at": NOW}, {"content_hash": "h", "last_verified": T0}),
        ({"then_logic": " "}, {"then_logic": "new"}, {"then_logic": "new"}),
        ({"source_url": None}, {"url": None, "content_hash": "h2", "at": NOW}, {"content_hash": "h", "last_verified": T0}),
        ({"source_url": None}, {"url": "", "content_hash": "h2", "at": NOW}, {"content_hash": "h2", "last_verified": NOW}),
        ({"source_url": None, "proof": "source_changed", "status": "superseded"}, {}, {"source_url": "https://x.example/a", "proof": "verified_excerpt", "status": "active"}),
    ],
)
def test_fold_table(state, event, want):
    first = {**lc.fold_step(None, E), **state}
    got = lc.fold_step(first, {**E, **event})
    assert {k: got[k] for k in want} == want and got["n_events"] == 2


def test_fold_of_a_stream_equals_steps(spark):
    rng = random.Random(8)
    events = []
    for i in range(600):
        events.append({**E, "rule_key": f"k{rng.choice([0, 0, 0, *range(40)])}", "seq": i, "url": rng.choice([None, "", "https://x.example/a", "https://x.example/a/b", "https://y.example/c/"]), "status": rng.choice(["active"] * 8 + ["deprecated", "candidate"]),
                       "excerpt": rng.choice([None, "ex"]), "content_hash": rng.choice([None, "h1", "h2"]), "custom_provenance": rng.choice([None, None, "{}"]), "then_logic": rng.choice([None, "", "t"]), "at": T0 + timedelta(hours=i)})
    model = {}
    for e in events:
        model[e["rule_key"]] = lc.fold_step(model.get(e["rule_key"]), e)
    shuffled = events[:]
    rng.shuffle(shuffled)
    got = {x["rule_key"]: {k: x[k] for k in [*lc.STATE_COLUMNS, "n_events"]} for x in lc.upsert_fold(spark.createDataFrame(shuffled, lc.EVENT)).collect()}
    assert got == model
    assert lc.upsert_fold(spark.createDataFrame([], lc.EVENT)).count() == 0


def test_fold_by_columns_equals_steps(spark):
    rng = random.Random(5)
    pick = lambda: {"url": rng.choice([None, "", "https://x.example/a", "https://x.example/a/b", "https://y.example/c/"]), "status": rng.choice(["active", "deprecated", "candidate", None]), "excerpt": rng.choice([None, "", "ex"]), "content_hash": rng.choice([None, "h1"]), "custom_provenance": rng.choice([None, "", "{}"]), "then_logic": rng.choice([None, "", " \u2003", "t"]), "at": T0 + timedelta(hours=rng.randrange(99))}
    events, model = [], {}
    for i in range(900):
        e = {**E, **pick(), "rule_key": f"k{i:04d}"}
        prior = None
        if rng.random() < 0.7:
            prior = lc.fold_step(None, {**E, **pick()})
            prior["source_url"] = rng.choice([None, prior["source_url"]])
            prior["proof"] = rng.choice([None, "source_changed", prior["proof"]])
        model[e["rule_key"]] = lc.fold_step(prior, e)
        events.append({**e, "prior": prior})
    state = ", ".join(f"{c}: {'timestamp' if c == 'last_verified' else 'string'}" for c in lc.STATE_COLUMNS)
    df = spark.createDataFrame(events, f"{lc.EVENT}, prior struct<{state}, n_events: bigint>")
    got = {x["rule_key"]: {k: x[k] for k in [*lc.STATE_COLUMNS, "n_events"]} for x in lc.upsert_fold(df).collect()}
    assert got == model


def test_runs_open_and_finish(spark):
    none = spark.createDataFrame([], "run_id bigint, status string, started_at timestamp, finished_at timestamp, detail string, urls_changed int, extra string")
    one = lc.open_run(none, now())
    assert [(x["run_id"], x["status"]) for x in one.collect()] == [(1, "running")]
    two = lc.open_run(lc.finish_run(one, spark.createDataFrame([(1, "done", "{}", 5)], "run_id int, status string, detail string, urls_changed long"), now()), now())
    assert {x["run_id"]: (x["status"], x["finished_at"], x["urls_changed"]) for x in two.collect()} == {1: ("done", NOW, 5), 2: ("running", None, None)} and two.columns == none.columns


def test_documents(spark):
    docs = spark.createDataFrame([("9000", "old", "u", "o"), ("x1", "y", "v", "o")], "id string, title string, source_url string, source_org string")
    pages = spark.createDataFrame([("u", "new", "o", 2), ("u", "newer", "o", 3), ("b", "B", "o", 2), ("a", "A", "o", 1), ("", "E", "o", 5)], "url string, title string, source_org string, at int")
    got = {x["source_url"]: (x["id"], x["title"]) for x in lc.upsert_documents(docs, pages).collect()}
    assert got == {"u": ("9000", "newer"), "v": ("x1", "y"), "a": ("9001", "A"), "b": ("9002", "B"), "": ("9003", "E")}


def test_numbered_is_consecutive(spark):
    df = spark.createDataFrame([(i * 7919 % 1000,) for i in range(1000)], "k int").repartition(5)
    got = [tuple(x) for x in lookups.numbered(df, 50, [F.col("k")]).orderBy("k").collect()]
    assert got == [(i, 51 + i) for i in range(1000)]


def test_undeprecate_takes_a_table_of_keys(spark):
    rules = spark.range(3000).selectExpr("cast(id AS string) AS id", "if(id % 3 = 0, NULL, concat('k', id)) AS rule_key", "if(id % 2 = 0, 'deprecated', 'retired') AS status", "timestamp'2025-01-01' AS last_verified")
    keys = rules.filter("status = 'deprecated'").selectExpr("coalesce(rule_key, id) AS key")
    un = lc.undeprecate(rules, keys.unionByName(keys).unionByName(spark.createDataFrame([(None,), ("1",)], "key string")), now())
    assert un.columns.count("changed") == 1 and set(un.columns) == {"id", "rule_key", "status", "last_verified", "changed"}
    assert un.count() == 3000 and un.filter("changed").count() == un.filter("status = 'active'").count() == 1500 and un.filter("status = 'deprecated'").count() == 0
