from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import rollups as ru

NOW = datetime(2026, 1, 1)
now = lambda: F.lit("2026-01-01").cast("timestamp")
T = "id string, name string, domain_tag string, source_url string, confidence_score string, status string, last_verified timestamp, embedding array<float>, source_org string, rule_type string, if_condition string, then_logic string, extracted_at timestamp, provenance_status string, source_excerpt string, source_content_hash string, document_id string"


def rules(spark):
    d = lambda n: NOW - timedelta(days=n)
    rows = [
        ("1", "Add a sitemap", "seo", "u", "0.95", "active", d(1), [1.0], "Moz", "ingested", "x", "y", d(1), "verified_excerpt", "e", "h", "d1"),
        ("2", "b", "seo", "", "high", None, None, None, "moz.com", "observed", None, "use robots.txt", d(100), None, None, None, "d1"),
        ("3", "c", "aeo", None, "0.9", "candidate", d(91), None, "Moz", "ingested", None, None, None, None, None, None, "d1"),
        ("4", "d sitemap", "seo", "u", "0.2", "deprecated", d(1), None, None, "ingested", None, None, d(2), None, None, None, "d2"),
        ("x5", None, None, "u", None, "retired", d(1), None, "", "ingested", "sitemap", None, d(3), None, None, None, None),
    ]
    return spark.createDataFrame(rows, T)


def test_brain_health(spark):
    docs = spark.createDataFrame([("seo", None, None), ("seo", "u", NOW)], "domain_tag string, source_url string, last_verified timestamp")
    got = {(r["tbl"], r["domain_tag"]): tuple(r)[2:] for r in ru.brain_health({"rules": rules(spark), "principles": docs, "playbooks": docs.select("domain_tag", "source_url")}, now()).collect()}
    assert got == {("rules", "seo"): (2, 50.0, 50.0, 1, 1), ("rules", "aeo"): (1, 0.0, 100.0, 1, 1), ("principles", "seo"): (2, 50.0, None, 1, None), ("playbooks", "seo"): (2, 50.0, None, None, None)}


def test_snapshot_and_empty(spark):
    r = rules(spark)
    reg = spark.createDataFrame([("s", None, 7), ("t", NOW, 7)], "source_id string, last_crawled_at timestamp, crawl_cadence_days int")
    runs = spark.createDataFrame([(1, "done"), (2, "degraded")], "run_id int, status string")
    m = ru.snapshot_metrics(r, {"documents": r}, reg, runs, now()).first()
    assert (m["rules_total"], m["rules_url_pct"], m["rules_trusted"], m["aeo_geo_rules"], m["sources_overdue"], m["last_run_status"], m["documents_total"]) == (3, 60.0, 1, 1, 1, "degraded", 5)
    e = ru.snapshot_metrics(r.limit(0), {}, reg.limit(0), runs.limit(0), now()).first()
    assert e["rules_total"] == 0 and e["rules_url_pct"] is None and e["last_run_status"] is None
    assert ru.corpus_totals(r.limit(0)).first()["embedded_pct"] == 0
    t = ru.corpus_totals(r).first()
    assert (t["n"], t["embedded"], t["embedded_pct"], t["url_pct"]) == (5, 1, 20, 60)
    assert ru.corpus_totals(r.drop("embedding")).first()["embedded"] is None


def test_registry_and_hygiene(spark):
    reg = spark.createDataFrame([("s", "Moz", 1, 7, NOW, True), ("t", "None", 1, 7, None, False)], "source_id string, canonical_org string, tier int, crawl_cadence_days int, last_crawled_at timestamp, enabled boolean")
    got = {r["source_id"]: (r["overdue"], r["rules_from_org"]) for r in ru.registry_health(reg, rules(spark), now()).collect()}
    assert got == {"s": (False, 2), "t": (True, 0)}
    assert [tuple(r) for r in ru.org_hygiene(rules(spark)).collect()] == [("moz", ["Moz", "moz.com"], 3)]


def test_canon_probe(spark):
    topics = spark.createDataFrame([("map", "seo", ["%SITEMAP%", "%add a%"], 1, 0.7), ("robots", "seo", ["%robots_txt%"], 1, 0.7), ("none", "seo", [], 0, 0.7), ("never", "seo", ["%zzz%"], 1, 0.5)], "topic string, domain_tag string, patterns array<string>, min_hits int, min_conf double")
    got = {r["topic"]: tuple(r)[1:] for r in ru.canon_probe(topics, rules(spark), now()).collect()}
    assert got == {"map": (1, 1, 1, 0, True), "robots": (1, 0, 0, 1, False), "none": (0, 0, 0, 0, True), "never": (0, 0, 0, 0, False)}


def test_counts_and_modes(spark):
    c = spark.createDataFrame([(1, 1, "s", "extracted", NOW, 2, 1), (2, 1, "s", "failed", NOW - timedelta(9), None, None), (3, 1, "t", "gave_up", NOW, 0, 0), (4, 2, "s", "retired", NOW, 0, 0), (5, None, None, "empty", None, 0, 0)], "change_id int, run_id int, source_id string, extract_status string, detected_at timestamp, rules_new int, rules_refreshed int")
    assert {r[0]: (r[1], r[2]) for r in ru.status_histogram(c, now()).collect()} == {"extracted": (1, 33), "gave_up": (1, 33), "retired": (1, 33)}
    s = {r["run_id"]: r for r in ru.run_summary(c).collect()}
    assert (s[1]["status"], s[1]["failed"], s[1]["failing_sources"], s[1]["rules_written"]) == ("partial", 2, ["s", "t"], 2) and s[2]["status"] == "done" and s[2]["failing_sources"] == []
    assert {r["source_id"]: r["changes"] for r in ru.source_ledger(c).collect()} == {"s": 3, "t": 1}
    assert ru.status_histogram(c.limit(0)).count() == 0
    r = rules(spark)
    assert {x[0]: x[1] for x in ru.tag_mode(r).collect()} == {"d1": "seo", "d2": "seo"}
    tie = spark.createDataFrame([("d", "b", "2"), ("d", "a", "1"), ("d", None, "0")], "document_id string, domain_tag string, id string")
    assert ru.tag_mode(tie).first()["mode"] == "a"
    assert ru.max_numeric_id(r).first()[0] == 4 and ru.max_numeric_id(r.limit(0)).first()[0] == 0
    assert [tuple(x) for x in ru.top_orgs(r, 2).collect()] == [("Moz", 2), ("", 1)]
    assert [x["source_org"] for x in ru.rules_added(r, now(), days=7).collect()] == ["", "Moz", None]


def test_drift(spark):
    h = spark.createDataFrame([(NOW - timedelta(3), 90.0, "done"), (NOW - timedelta(2), 87.9, "failed"), (NOW - timedelta(1), 86.0, "degraded")], "taken_at timestamp, rules_url_pct double, last_run_status string")
    assert [(r[0], r[1]) for r in ru.drift_alerts(h).orderBy("taken_at").collect()] == [(NOW - timedelta(2), "url share fell"), (NOW - timedelta(1), "degraded run")]
    a = spark.createDataFrame([("done", 2), ("done", 3), ("partial", 0), (None, None)], "s string, n int")
    assert [r[0] for r in a.select(ru.alert_needed(F.col("s"), F.col("n"))).collect()] == [False, True, True, True]


def test_canon_probe_patterns_and_many_topics(spark, monkeypatch):
    pats = [["%Sitemap%"], ["add a%"], ["%y"], ["%d_s%", None], ["%100\\%%"], ["%"], None, [], [None], ["%robots%txt%", "%ROBOTS.TXT"]]
    topics = spark.createDataFrame([(f"t{i}", "seo", p, 1, 0.7) for i, p in enumerate(pats)], "topic string, domain_tag string, patterns array<string>, min_hits int, min_conf double")
    r = rules(spark).unionByName(rules(spark).limit(1).withColumns({"id": F.lit("9"), "name": F.lit("100% SITEMAP")}))
    one = {x["topic"]: tuple(x) for x in ru.canon_probe(topics, r, now()).collect()}
    assert {k: v[1] for k, v in one.items()} == {"t0": 2, "t1": 1, "t2": 2, "t3": 0, "t4": 1, "t5": 4, "t6": 0, "t7": 0, "t8": 0, "t9": 1}
    monkeypatch.setattr(ru, "TOPICS", 3)
    assert {x["topic"]: tuple(x) for x in ru.canon_probe(topics, r, now()).collect()} == one
    assert ru.canon_probe(topics.limit(0), r, now()).count() == 0
    assert [x["topic"] for x in ru.ranked_probe(ru.canon_probe(topics, r, now())).orderBy("turn").collect()][:2] == ["t3", "t6"]
