import hashlib
import json
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import lifecycle
from tidemark.plans import jobs
from tidemark.schemas import SCHEMAS, conform, schema
from tidemark.sources import files

T0 = datetime(2025, 1, 1)
now = lambda: F.lit("2026-01-01").cast("timestamp")
h = lambda t: hashlib.sha256(t.encode()).hexdigest()
RULES = "array<struct<name:string,if_condition:string,then_logic:string,source_excerpt:string,domain_tag:string,confidence_score:string,status:string>>"


def one(name, excerpt, conf="0.9"):
    return (name, "if", "then", excerpt, "seo", conf, "active")


def corpus(spark):
    rules = conform(
        spark.createDataFrame(
            [("1", "https://x.example/a", "active", "ingested", "verified_excerpt", "words of the first page", h("old"), T0), ("2", "https://x.example/gone", "active", "ingested", "unverified", None, None, T0), ("3", "https://x.example/still", "active", "ingested", "verified_excerpt", "e", h("still here"), T0)],
            "id string, source_url string, status string, rule_type string, provenance_status string, source_excerpt string, source_content_hash string, last_verified timestamp",
        ),
        schema("rules"),
    )
    state = spark.createDataFrame([("https://x.example/a", "s", h("old"), T0), ("https://x.example/gone", "s", h("g"), T0), ("https://x.example/still", "s", h("still here"), T0)], "url string, source_id string, content_hash string, last_seen_at timestamp")
    changes = conform(spark.createDataFrame([(1, "https://x.example/still", h("still here"), T0, "extracted")], "change_id bigint, url string, new_hash string, detected_at timestamp, extract_status string"), schema("ingest_changes"))
    return jobs.Corpus(rules, conform(state, schema("url_state")).select(*schema("url_state").names), changes)


OBS = [
    ("s", "https://x.example/a?utm_source=q", 200, "now without those words", None, "2025"), ("s", "https://x.example/gone", 404, None, None, None), ("s", "https://x.example/still", 304, None, None, None),
    ("s", "https://x.example/new", 200, "a fresh page with a rule that is quoted here", "e", None), ("s", "https://x.example/fail", 200, "no answer", None, None),
]


def run(spark, monitor=False):
    obs = spark.createDataFrame(OBS, "source_id string, url string, status int, text string, etag string, lastmod string")
    answers = spark.createDataFrame([("https://x.example/new", "Org", [one("n", "a rule that is quoted"), one("m", "never said anywhere")]), ("https://x.example/a", "Org", [])], f"url string, org string, rules {RULES}")
    return jobs.cycle(corpus(spark), obs, answers, now(), 7, monitor)


def test_cycle(spark):
    after, log = run(spark)
    got = {r["url"].rsplit("/", 1)[1]: (r["change_type"], r["extract_status"], r["rules_new"]) for r in log.collect()}
    assert got == {"a": ("modified", "empty", 0), "gone": ("removed", "retired", 0), "new": ("new", "extracted", 1), "fail": ("new", "failed", 0)}
    state = {r["url"].rsplit("/", 1)[1]: r["content_hash"] for r in after.url_state.collect()}
    assert set(state) == {"a", "still", "new"} and state["a"] == h("now without those words")
    rules = {r["id"]: r for r in after.rules.collect()}
    kept = {r["url"].rsplit("/", 1)[1]: r for r in after.url_state.collect()}["still"]
    assert kept["last_seen_at"] == datetime(2026, 1, 1) and kept["content_hash"] == h("still here")  # unchanged pages renew their state
    assert sorted(r["change_id"] for r in after.changes.collect()) == [1, 2, 3, 4, 5]
    assert rules["1"]["status"] == "superseded" and rules["2"]["status"] == "retired" and rules["3"]["last_verified"] == datetime(2026, 1, 1)
    assert after.changes.count() == 5


def test_monitor_mode_freezes_state(spark):
    after, log = run(spark, monitor=True)
    assert {r["extract_status"] for r in log.collect()} == {"skipped_monitor"}  # removals too
    assert {r["id"]: r["status"] for r in after.rules.collect()}["2"] == "retired"
    state = {r["url"].rsplit("/", 1)[1]: r["content_hash"] for r in after.url_state.collect()}
    assert set(state) == {"a", "still"} and state["a"] == h("old")


def test_file_bridge_is_idempotent(spark, tmp_path):
    lines = [{"source_id": "s", "org": "O", "url": "https://x.example/p", "title": "t", "new_hash": "h", "text": "words that prove the rule", "rules": [{"name": "n", "if_condition": "i", "then_logic": "t", "source_excerpt": "words that prove", "confidence_score": 0.9}, {"name": "bad"}]}]
    (tmp_path / "x.jsonl").write_text("\n".join(json.dumps(x) for x in lines) + "\n\n")
    pages = files.read_jsonl_strict(spark, str(tmp_path / "x.jsonl"), "extracted_pages")
    e = jobs.bridge_events(pages, now())
    once = [tuple(r) for r in lifecycle.upsert_fold(e).drop("n_events").collect()]
    twice = [tuple(r) for r in lifecycle.upsert_fold(e.unionByName(e.withColumn("seq", F.lit(1).cast("bigint")))).drop("n_events").collect()]
    assert once == twice and len(once) == 1 and once[0][5] == "verified_excerpt"


def test_observations(spark, tmp_path):
    ok = {"name": "n", "if_condition": "i", "then_logic": "t", "domain_tag": "seo", "prevalence": {"n": 9, "m": 10, "sessions": 4}, "exemplar_url": "https://x.example/e", "observer": "o", "session_ids": [str(i) for i in range(30)]}
    (tmp_path / "o.jsonl").write_text("\n".join([json.dumps(ok), "broken", json.dumps({**ok, "prevalence": {"n": 1, "m": 10}})]))
    events, rejected = jobs.observation_events(files.read_jsonl_counting(spark, str(tmp_path / "o.jsonl"), "observations"), now())
    assert sorted(r["reject_reason"] for r in rejected.collect()) == ["malformed", "rare"]
    s = lifecycle.upsert_fold(events).first()
    assert s["status"] == "candidate" and s["proof"] == "observed" and len(json.loads(s["url_provenance"])["session_ids"]) == 20


def test_relevance_screen(spark):
    pages = spark.createDataFrame([("s", "o", "u", "robots and sitemap", [one("n", "robots and sitemap")]), ("s", "o", "v", "robots robots", [one("n", "robots robots")])], f"source_id string, org string, url string, text string, rules {RULES}")
    assert {r["url"] for r in jobs.extracted_rules(pages, "robots|sitemap").collect()} == {"u"} and jobs.extracted_rules(pages).count() == 2
    assert "rules" in SCHEMAS


def test_cycle_folds_accepted_rules_in(spark):
    c = corpus(spark)
    known = conform(spark.createDataFrame([("9", "k", "if", "retired", "https://x.example/", "unverified", None, lifecycle_key(spark, "k"))], "id string, name string, if_condition string, status string, source_url string, provenance_status string, then_logic string, rule_key string"), schema("rules"))
    docs = conform(spark.createDataFrame([("4", "old", "https://x.example/other")], "id string, title string, source_url string"), schema("documents"))
    reg = conform(spark.createDataFrame([("s", 1), ("t", 2), ("u", 3), ("z", 4)], "source_id string, consecutive_failures int"), schema("source_registry"))
    obs = spark.createDataFrame([*OBS, ("t", "https://y.example/p", 200, "words that stand on a page", None, None)], "source_id string, url string, status int, text string, etag string, lastmod string")
    answers = spark.createDataFrame(
        [("https://x.example/new", "Org", [one("n", "a rule that is quoted"), one("m", "never said anywhere"), one("k", "a fresh page with")]), ("https://x.example/a", "Org", []), ("https://y.example/p", "Two", [one("n", "words that stand")])], f"url string, org string, rules {RULES}"
    )
    unread = spark.createDataFrame([("u", "timeout")], "source_id string, error string")
    c = jobs.Corpus(c.rules.unionByName(known), c.url_state, c.changes, docs, reg)
    after, log = jobs.cycle(c, obs, answers, now(), 7, unread=unread)
    rules = {r["id"]: r for r in after.rules.collect()}
    assert set(rules) == {"1", "2", "3", "9", "10"}
    n, k = rules["10"], rules["9"]
    assert (n["name"], n["status"], n["provenance_status"], n["source_url"], n["source_org"], n["document_id"], n["source_refs_json"]) == ("n", "active", "verified_excerpt", "https://x.example/new", "Org", "5", "[5]")
    assert n["source_content_hash"] == h("a fresh page with a rule that is quoted here") and n["source_excerpt"] == "a rule that is quoted" and n["last_verified"] == datetime(2026, 1, 1)
    assert (k["status"], k["provenance_status"], k["source_url"], k["then_logic"], k["document_id"]) == ("active", "verified_excerpt", "https://x.example/new", "then", "5")
    assert {(r["id"], r["title"], r["source_url"]) for r in after.documents.collect()} == {("4", "old", "https://x.example/other"), ("5", "n", "https://x.example/new"), ("6", "n", "https://y.example/p")}
    counts = {r["url"].rsplit("/", 1)[1]: (r["rules_new"], r["rules_refreshed"]) for r in log.collect()}
    assert counts["new"] == (1, 1) and counts["p"] == (0, 1)
    s = {r["source_id"]: (r["consecutive_failures"], r["last_error"], r["last_crawled_at"] is not None) for r in after.registry.collect()}
    assert s == {"s": (2, "1 extraction failure(s)", False), "t": (0, None, True), "u": (4, "detect: timeout", False), "z": (4, None, False)}
    again, _ = jobs.cycle(c, obs, answers, now(), 7, monitor=True)
    assert {r["id"] for r in again.rules.collect()} == {"1", "2", "3", "9"} and again.documents.count() == 1


def lifecycle_key(spark, name):
    from tidemark.functions.text import rule_key

    return spark.range(1).select(rule_key(F.lit(name), F.lit("if"))).first()[0]


def test_screen_cap_markers_and_the_run(spark):
    reg = conform(spark.createDataFrame([("s", "sitemap", None), ("l", "url_list", None), ("r", "github_release", "v1"), ("q", "github_release", "v1"), ("e", "github_release", "v2")], "source_id string, adapter_type string, last_seen_marker string"), schema("source_registry"))
    c = corpus(spark)
    runs = conform(spark.createDataFrame([(6, "running", T0)], "run_id bigint, status string, started_at timestamp"), schema("ingest_runs")).select(*schema("ingest_runs").names)
    rows = [
        ("s", "https://s.example/1", 200, "robots alone, robots again", None, "1"), ("s", "https://s.example/2", 200, "robots.txt and a sitemap say so", None, "2"), ("s", "https://s.example/3", 200, "", None, "3"), ("s", "https://s.example/4", 200, "cut off by the cap", None, "4"),
        ("l", "https://l.example/1", 200, "robots alone, but listed", None, "5"), ("r", "https://r.example/v2", 200, "notes of the release", "v2", "6"), ("q", "https://q.example/v2", 200, "notes without an answer", "v2", "7"), ("e", "https://e.example/v2", 200, "known", "v2", "8"),
    ]
    obs = spark.createDataFrame(rows, "source_id string, url string, status int, text string, marker string, arrival string").withColumns({"etag": F.lit("e"), "lastmod": F.lit(None).cast("string")})
    texts = {r[1]: r[3] for r in rows}
    answers = spark.createDataFrame([(u, "Org", [one(u, t[:20])]) for u, t in texts.items() if "answer" not in t], f"url string, org string, rules {RULES}")
    c = jobs.Corpus(c.rules, c.url_state, c.changes, None, reg, runs)
    after, log = jobs.cycle(c, obs, answers, now(), cap=3)
    assert {(r["url"][8], r["url"][-1]): (r["signal"], r["extract_status"]) for r in log.collect()} == {
        ("s", "1"): ("content_hash", "irrelevant"), ("s", "2"): ("content_hash", "extracted"), ("s", "3"): ("content_hash", "empty"), ("l", "1"): ("content_hash", "extracted"), ("r", "2"): ("version", "extracted"), ("q", "2"): ("version", "failed"),
    }
    assert {r["source_id"]: r["last_seen_marker"] for r in after.registry.collect()} == {"s": None, "l": None, "r": "v2", "q": "v1", "e": "v2"}
    state = {r["url"] for r in after.url_state.collect()}
    assert "https://s.example/4" not in state and {"https://s.example/1", "https://s.example/3", "https://r.example/v2"} <= state and "https://q.example/v2" not in state
    done = {r["run_id"]: r for r in after.runs.collect()}
    assert done[6]["status"] == "aborted" and (done[7]["status"], done[7]["sources_checked"], done[7]["sources_changed"], done[7]["urls_changed"], done[7]["objects_written"]) == ("partial", 5, 4, 6, 3)
    detail = {x["source_id"]: x for x in json.loads(done[7]["detail"])["sources"]}
    assert detail["q"]["status"] == "extract_failed" and detail["s"]["irrelevant"] == 1 and detail["e"]["changes"] == 0


def test_new_rules_survive_the_next_cycle_and_failures_add_up(spark):
    c, log = corpus(spark), None
    obs = spark.createDataFrame(OBS, "source_id string, url string, status int, text string, etag string, lastmod string")
    answers = spark.createDataFrame([("https://x.example/new", "Org", [one("n", "a rule that is quoted")])], f"url string, org string, rules {RULES}")
    ends = []
    for run_id in (7, 8, 9):
        c, log = jobs.cycle(c, obs, answers, now(), run_id)
        ends.append({r["url"].rsplit("/", 1)[1]: r["extract_status"] for r in log.collect()})
    assert [x.get("fail") for x in ends] == ["failed", "failed", "gave_up"] and "new" not in ends[1]
    assert {r["id"] for r in c.rules.collect()} == {"1", "2", "3", "4"}


def test_bridge_job(spark, tmp_path):
    quote = lambda n, e, tag="seo": {"name": n, "if_condition": "i", "then_logic": "t", "source_excerpt": e, "confidence_score": 0.9, "domain_tag": tag}
    lines = [
        {"source_id": "s", "org": "O", "url": "https://x.example/a", "title": "", "new_hash": "n1", "text": "first words of the page", "rules": [quote("one", "first words of"), quote("two", "words of the page", "geo"), quote("no", "never said here")]},
        {"source_id": "s", "org": "O", "url": "https://x.example/e", "new_hash": "", "text": "nothing", "rules": []},
        {"source_id": "t", "org": "O", "url": "https://x.example/z", "title": "Z", "new_hash": "n3", "text": "second words of a page", "rules": [quote("one", "second words of"), quote("three", "words of a page", "geo")]},
        {"source_id": "s", "org": "O", "url": "https://x.example/a", "title": "Again", "new_hash": "n4", "text": "last words of the page", "rules": None},
    ]
    (tmp_path / "b.jsonl").write_text("\n".join(json.dumps(x) for x in lines))
    pages = files.read_jsonl_strict(spark, str(tmp_path / "b.jsonl"), "extracted_pages")
    c = corpus(spark)
    docs = conform(spark.createDataFrame([("4", "old", "https://x.example/z", "x")], "id string, title string, source_url string, domain_tag string"), schema("documents"))
    reg = conform(spark.createDataFrame([("s", 1), ("t", 2), ("u", 3)], "source_id string, consecutive_failures int"), schema("source_registry"))
    runs = conform(spark.createDataFrame([(3, "done")], "run_id bigint, status string"), schema("ingest_runs")).select(*schema("ingest_runs").names)
    start = jobs.Corpus(c.rules, c.url_state, c.changes, docs, reg, runs)
    after, log = jobs.bridge(start, pages, now())
    assert sorted((r["url"][-1], r["extract_status"], r["rules_new"], r["rules_refreshed"]) for r in log.collect()) == [("a", "empty", 0, 0), ("a", "extracted", 2, 0), ("e", "empty", 0, 0), ("z", "extracted", 1, 1)]
    rules = {r["name"]: r for r in after.rules.collect() if r["name"]}
    assert set(rules) == {"one", "two", "three"} and rules["one"]["source_url"] == "https://x.example/a" and rules["three"]["source_content_hash"] == "n3"
    old = {r["id"]: r for r in after.rules.collect()}["1"]
    assert (old["status"], old["provenance_status"]) == ("superseded", "source_changed")
    got = {r["source_url"]: (r["id"], r["title"], r["domain_tag"]) for r in after.documents.collect()}
    assert got == {"https://x.example/a": ("5", "Again", "seo"), "https://x.example/z": ("4", "Z", "x")}
    state = {r["url"].rsplit("/", 1)[1]: r["content_hash"] for r in after.url_state.collect()}
    assert state["a"] == "n4" and state["z"] == "n3" and "e" not in state
    assert {r["source_id"]: r["last_crawled_at"] is not None for r in after.registry.collect()} == {"s": True, "t": True, "u": False}
    run_row = {r["run_id"]: r for r in after.runs.collect()}[4]
    assert (run_row["status"], run_row["urls_changed"], run_row["objects_written"], run_row["sources_checked"]) == ("done", 4, 3, 2)
    again, _ = jobs.bridge(after, pages, now())
    assert {r["id"] for r in again.rules.collect()} == {r["id"] for r in after.rules.collect()} and again.documents.count() == 2


def test_observe_job(spark, tmp_path):
    ok = {"name": " n ", "if_condition": "i", "then_logic": "t", "domain_tag": "SEO", "prevalence": {"n": 9, "m": 10, "sessions": 4}, "observer": "o"}
    rows = [ok, {**ok, "name": "m"}, {**ok, "name": "x", "exemplar_url": "https://x.example/e"}, {**ok, "prevalence": {"n": "nan", "m": 10, "sessions": 4}}, {**ok, "prevalence": {"n": "1e30", "m": "2e30", "sessions": 4}}, {**ok, "prevalence": {"n": "3.7", "m": 4, "sessions": 4}}]
    (tmp_path / "o.jsonl").write_text("\n".join(json.dumps(x) for x in rows))
    c = corpus(spark)
    docs = conform(spark.createDataFrame([("4", "old", "https://x.example/e")], "id string, title string, source_url string"), schema("documents"))
    after, rejected = jobs.observe(jobs.Corpus(c.rules, c.url_state, c.changes, docs), files.read_jsonl_counting(spark, str(tmp_path / "o.jsonl"), "observations"), now())
    assert [r["reject_reason"] for r in rejected.collect()] == ["invalid prevalence"] * 3
    rules = {r["name"]: r for r in after.rules.collect() if r["name"]}
    assert {k: (v["status"], v["rule_type"], v["confidence_score"], v["provenance_status"], v["domain_tag"], v["source_url"], v["document_id"]) for k, v in rules.items()} == {
        "n": ("candidate", "observed", "0.84", "observed", "seo", "", "5"), "m": ("candidate", "observed", "0.84", "observed", "seo", "", "5"), "x": ("candidate", "observed", "0.84", "observed", "seo", "https://x.example/e", "4"),
    }
    assert json.loads(rules["n"]["url_provenance"])["prevalence"] == {"n": 9, "m": 10, "sessions": 4, "ratio": 0.9}
    assert {r["source_url"]: r["title"] for r in after.documents.collect()} == {"": "Observed pattern: m", "https://x.example/e": "Observed pattern: x"}
    again, _ = jobs.observe(after, files.read_jsonl_counting(spark, str(tmp_path / "o.jsonl"), "observations"), now())
    assert {r["name"]: r["status"] for r in again.rules.collect() if r["name"]} == {"n": "active", "m": "active", "x": "active"}


def test_enrich_exact_takes_listed_sources_whole(spark):
    reg = conform(spark.createDataFrame([("l", "url_list", True), ("s", "sitemap", True), ("o", "url_list", False)], "source_id string, adapter_type string, enabled boolean"), schema("source_registry"))
    rows = [("l", f"https://l.example/{i}", 200, f"page number {i} has these words") for i in range(20)] + [("l", "https://l.example/fail", 200, "x"), ("s", "https://s.example/1", 200, "page number 1 has these words"), ("o", "https://o.example/1", 200, "page number 1 has these words")]
    obs = spark.createDataFrame(rows, "source_id string, url string, status int, text string").withColumns({"etag": F.lit(None).cast("string"), "lastmod": F.lit(None).cast("string")})
    answers = spark.createDataFrame([(u, "Org", [one(u, "has these words")]) for _, u, _, t in rows if t != "x"], f"url string, org string, rules {RULES}")
    c = corpus(spark)
    after, counts = jobs.enrich_exact(jobs.Corpus(c.rules, c.url_state, c.changes, None, reg), obs, answers, now())
    assert tuple(counts.first()) == (21, 20, 0, 1, 3, 23) and after.changes.count() == 1 and after.url_state.count() == 23
    assert {r["source_id"]: (r["consecutive_failures"], r["last_crawled_at"]) for r in after.registry.collect()} == {"l": (1, None), "s": (None, None), "o": (None, None)}
