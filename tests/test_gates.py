from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import gates

NOW = datetime(2026, 1, 1)
now = lambda: F.lit("2026-01-01").cast("timestamp")


def flags(df, c, key="id"):
    return {r[0]: r[1] for r in df.select(key, c).collect()}


def test_cadence(spark):
    d = lambda **k: NOW - timedelta(**k)
    rows = [("slack", True, d(days=6, hours=23), 7), ("fresh", True, d(days=2), 7), ("never", True, None, 7), ("off", False, None, 7), ("late", False, d(days=15), 7), ("edge", True, d(days=14), 7)]
    df = spark.createDataFrame(rows, "id string, enabled boolean, last_crawled_at timestamp, crawl_cadence_days int")
    assert flags(df, gates.due(now())) == {"slack": True, "fresh": False, "never": True, "off": False, "late": False, "edge": True}
    assert flags(df, gates.overdue(now())) == {"slack": False, "fresh": False, "never": True, "off": True, "late": True, "edge": False}


SOURCE = "Use  JSON-LD for\nstructured data on every page. " * 3


def test_quality_gate(spark):
    good = dict(id="good", name="n", if_condition="i", then_logic="t", confidence_score="0.9", source_excerpt="JSON-LD for structured data", status="active", text=SOURCE)
    rows = [
        good, {**good, "id": "low", "confidence_score": "0.5"}, {**good, "id": "high", "confidence_score": "5.0"}, {**good, "id": "nan", "confidence_score": "NaN"}, {**good, "id": "text", "confidence_score": "high"},
        {**good, "id": "none", "confidence_score": None}, {**good, "id": "nothen", "then_logic": ""}, {**good, "id": "case", "source_excerpt": "json-ld for structured data"}, {**good, "id": "short", "source_excerpt": "JSON-LD"},
        {**good, "id": "nosource", "text": None}, {**good, "id": "howto", "then_logic": "Add HowTo rich results"}, {**good, "id": "notice", "then_logic": "HowTo rich results are no longer shown"}, {**good, "id": "said", "status": "Sunset"},
    ]
    df = spark.createDataFrame(rows, "id string, name string, if_condition string, then_logic string, confidence_score string, source_excerpt string, status string, text string")
    got = {r["id"]: r for r in gates.quality_gate(df).collect()}
    assert {k: v["reject_reason"] for k, v in got.items() if not v["kept"]} == {
        "low": "confidence", "nan": "confidence", "text": "confidence", "none": "confidence", "nothen": "incomplete", "case": "not verbatim", "short": "short excerpt", "nosource": "not verbatim",
    }
    assert {k for k, v in got.items() if v["new_status"] == "deprecated"} == {"howto", "said"}


def test_observation_gate(spark):
    t = "id string, name string, if_condition string, then_logic string, domain_tag string, prevalence struct<n:string,m:string,sessions:string>"
    ok = ("ok", "n", "i", "t", "SEO", ("8", "10", "3"))
    rows = [ok, ("blank", " ", *ok[2:]), ("rare", *ok[1:5], ("6", "10", "3")), ("few", *ok[1:5], ("8", "10", None)), ("more", *ok[1:5], ("11", "10", "3")), ("zero", *ok[1:5], ("0", "0", "3")), ("word", *ok[1:5], ("x", "10", "3")), ("null", *ok[1:5], None), ("tag", *ok[1:4], None, ("10", "10", "4"))]
    got = {r["id"]: r for r in gates.observation_gate(spark.createDataFrame(rows, t)).collect()}
    assert {k: v["reject_reason"] for k, v in got.items()} == {"ok": None, "blank": "missing text", "rare": "rare", "few": "few sessions", "more": "implausible prevalence", "zero": "implausible prevalence", "word": "invalid prevalence", "null": "invalid prevalence", "tag": None}
    odd = [(x, *ok[1:5], (x, "10", "3")) for x in ("nan", "inf", "1e30", "9.7", "9" * 40, " 9 ", "+9", "")]
    assert {r["id"]: r["reject_reason"] for r in gates.observation_gate(spark.createDataFrame(odd, t)).collect()} == {"nan": "invalid prevalence", "inf": "invalid prevalence", "1e30": "invalid prevalence", "9.7": "invalid prevalence", "9" * 40: "invalid prevalence", "": "invalid prevalence", " 9 ": None, "+9": None}
    numbers = [("whole", *ok[1:5], (9.7, 10.0, 3.0)), ("nan", *ok[1:5], (float("nan"), 10.0, 3.0)), ("huge", *ok[1:5], (1e30, 1e31, 3.0))]
    assert {r["id"]: r["reject_reason"] for r in gates.observation_gate(spark.createDataFrame(numbers, t.replace(":string", ":double"))).collect()} == {"whole": None, "nan": "invalid prevalence", "huge": "invalid prevalence"}
    assert got["ok"]["confidence"] == 0.82 and got["tag"]["confidence"] == 0.84 and got["ok"]["tag"] == "seo" and got["tag"]["tag"] == "general"


def test_citable_and_trusted(spark):
    t = "id string, status string, url_provenance string, rule_type string, provenance_status string, source_excerpt string, source_content_hash string, confidence_score string, source_org string"
    base = ("active", None, "ingested", "verified_excerpt", "x", "h", "0.9", "Org")
    rows = [("a", *base), ("null", None, *base[1:]), ("dep", "deprecated", *base[1:]), ("nb", "active", '{"method":"neighbor"}', *base[2:]), ("obs", *base[:2], "observed", *base[3:]), ("junk", *base[:-1], "Unknown"), ("low", *base[:6], "0.8", "Org"), ("unproven", *base[:3], None, *base[4:])]
    df = spark.createDataFrame(rows, t)
    assert {k for k, v in flags(df, gates.citable(df)).items() if v} == {"a", "null", "obs", "junk", "low", "unproven"}
    assert {k for k, v in flags(df, gates.trusted()).items() if v} == {"a", "null", "nb"}
    assert flags(df.select("id"), gates.citable(df.select("id")))["dep"] is True


def test_locale_and_claims(spark):
    df = spark.createDataFrame([("https://a.example/x?hl=de",), ("https://a.example/x?hl=en-US",), ("https://a.example/ja/x",), ("https://a.example/docs/ja/x",), (None,)], "u string")
    assert [r[0] for r in df.select(gates.locale_variant(F.col("u"))).collect()] == [True, False, True, False, False]
    more = spark.createDataFrame([("https://developer.mozilla.org/en-US/docs/x",), ("https://developer.mozilla.org/fr/docs/x",), ("https://developer.mozilla.org/pt-BR/docs",), ("https://developer.mozilla.org/blog/x",)], "u string")
    assert [r[0] for r in more.select(gates.locale_variant(F.col("u"))).collect()] == [False, True, True, False]
    d = spark.createDataFrame([("FAQ rich results help",), ("FAQ rich results are restricted to some",), (None,)], "t string")
    assert [r[0] for r in d.select(gates.deprecated_claim(F.col("t"))).collect()] == [True, False, False]


def test_backfill_candidate(spark):
    rows = [("a", "Org", "https://x/y", [1.0], None), ("deep", "Org", "https://x/y/z/w", [1.0], None), ("exact", "Org", "https://x/y", [1.0], "exact"), ("novec", "Org", "https://x/y", None, None), ("other", "Else", None, [1.0], "extracted")]
    df = spark.createDataFrame(rows, "id string, source_org string, source_url string, embedding array<float>, url_provenance string")
    assert {k for k, v in flags(df, gates.backfill_candidate(["Org"])).items() if v} == {"a"}
    assert {k for k, v in flags(df, gates.backfill_candidate()).items() if v} == {"a", "other"}
