"""Problem 5 against plain Python."""

import random
from datetime import datetime, timedelta

from tidemark.llm import survivor

T0 = datetime(2025, 1, 1)
DDL = "id string, rule_key string, name string, if_condition string, source_url string, confidence_score string, last_verified timestamp, created_at timestamp, extracted_at timestamp, provenance_status string, field int, value int"


def rows(n=300, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        g = rng.choice([0, 0, *range(n // 3)])
        at = lambda: rng.choice([None, T0 + timedelta(days=rng.randrange(-5, 900))])
        out.append((f"{i:05d}", rng.choice([f"rk_{g}", f"rk_{g}"]), f"n{g}", None, rng.choice([None, "", "N/A", "https://a.example/x//", "https://a.example/x/y", "https://b.example/q/r"]), rng.choice(["0.5", "0.9", "1.2", "x", None]),
                    at(), rng.choice([None, T0]), at(), rng.choice(["verified_excerpt", "observed", None]), 1, 2))
    return out


def brute(data):
    groups = {}
    for r in data:
        groups.setdefault(r[1], []).append(r)
    out = {}
    for k, rs in groups.items():
        if len(rs) < 2:
            continue
        url = [r for r in rs if (r[4] or "").startswith("https://")]
        conf = [r for r in rs if r[5] in ("0.5", "0.9")]
        seen = [r for r in rs if r[6] and r[7] and r[7] <= r[6] <= datetime(2026, 1, 1)]
        pick = lambda x, key: min(x, key=key)[0] if x else None
        late = lambda t: -(t - T0).total_seconds() if t else float("inf")
        out[k] = (pick(url, lambda r: (-r[4].rstrip("/").count("/"), r[0])), pick(conf, lambda r: (r[9] != "verified_excerpt", late(r[8]), r[0])), pick(seen, lambda r: (late(r[6]), r[0])))
    return out


def test_found_equals_plain_python(spark):
    data = rows()
    got = {r["rule_key"]: (r["url_id"], r["score_id"], r["verified_id"]) for r in survivor.found(spark.createDataFrame(data, DDL)).collect()}
    assert got == brute(data)


def test_computed_keys(spark):
    base = ("https://a.example/x", "0.5", T0, T0, T0, None, 1, 2)
    data = [("1", None, " Name\n", "If", *base), ("2", "", "name", " if", *base), ("3", None, None, None, *base), ("4", None, "", "", *base), ("5", None, "alone", None, *base)]
    got = survivor.found(spark.createDataFrame(data, DDL)).collect()
    assert len(got) == 2 and all(r["rule_key"].startswith("rk_") for r in got) and {r["url_id"] for r in got} == {"1", "3"}
    assert survivor.found(spark.createDataFrame([], DDL)).count() == 0 and survivor.golden(spark.createDataFrame([], DDL)).count() == 0


def test_golden_votes(spark):
    old, new = datetime(2023, 1, 1), datetime(2025, 12, 1)
    r = lambda i, url, conf, at, st: (i, "rk_1", "n", None, url, conf, new, T0, at, st, 1, 2)
    data = [r("1", "https://A.example/x", "0.90", new, "verified_excerpt"), r("2", "HTTPS://a.example/x/", "0.9", old, "observed"), r("3", "https://b.example/", "0.5", old, "verified_excerpt"), r("4", "https://b.example", "0.5", old, None), r("5", None, "bad", new, "verified_excerpt")]
    g = survivor.golden(spark.createDataFrame(data, DDL)).first()
    assert (g["source_url"], g["confidence_score"], g["last_verified"], g["n"]) == ("https://a.example/x", "0.9", "2025-12-01", 5)
    none = survivor.golden(spark.createDataFrame([("1", "k", "n", None, None, None, None, None, None, None, 1, 2)] * 2, DDL)).first()
    assert none["source_url"] is None and none["n"] == 2
