"""Problem 1 against plain Python on small tables."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality_profile as qp

T = "id string, run_id bigint, source_url string, confidence_score string, last_verified timestamp, created_at timestamp, value string, field int"
BASE = datetime(2025, 1, 1)


def rows(n=400, seed=0, loads=7):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        run = rng.choice([None, *range(1, loads + 1), *([1] * loads)])
        conf = rng.choice(["0.5", "0.8", "0.80", "1", "1.5", "high", "", None, str(round(rng.random(), 3))]) if run != 3 else rng.choice(["0.1", "0.1", "0.2"])
        url = rng.choice(["https://a.example/x", "https://b.example", "", None, "N/A"]) if run != 4 else None
        seen = rng.choice([None, BASE + timedelta(days=rng.randrange(-3, 500))])
        out.append((str(i), run, url, conf, seen, rng.choice([None, BASE, BASE, BASE]), "clash", 1))
    return out


def brute(data):
    def conf(c):
        try:
            return bool(c) and c.replace(".", "", 1).isdigit() and not c.startswith(".") and not c.endswith(".") and float(c) <= 1
        except ValueError:
            return False

    valid = {"source_url": lambda r: str(r[2]).startswith("https://"), "confidence_score": lambda r: conf(r[3]), "last_verified": lambda r: r[5] is not None and r[5] <= r[4] <= datetime(2026, 1, 1)}
    at = {"source_url": 2, "confidence_score": 3, "last_verified": 4}
    found, figures = set(), defaultdict(dict)
    for f, k in at.items():
        loads = defaultdict(list)
        for r in data:
            if r[k] not in (None, "") and not valid[f](r):
                found.add((f, "value", r[0]))
            if r[1] is not None:
                loads[r[1]].append(r)
        for run, rs in loads.items():
            v = Counter(r[k] for r in rs if r[k] not in (None, ""))
            figures[f, "missing"][run] = sum(r[k] in (None, "") for r in rs) / len(rs)
            figures[f, "top"][run] = max(v.values(), default=0) / len(rs)
            if f == "confidence_score" and (x := [float(r[k]) for r in rs if conf(r[k])]):
                figures[f, "median"][run] = median(x)
    for (f, _), per in figures.items():
        for run, x in per.items():
            rest = [y for r, y in per.items() if r != run]
            if rest and abs(x - median(rest)) >= 0.2 - 1e-9:
                found.add((f, "load", str(run)))
    return found


@pytest.mark.parametrize("seed,loads", [(0, 7), (1, 4), (2, 2), (3, 1)])
def test_found_equals_brute_force(spark, seed, loads):
    data = rows(seed=seed, loads=loads)
    got = {tuple(r) for r in qp.found(spark.createDataFrame(data, T)).collect()}
    assert got == brute(data)


def test_empty_and_null_tables(spark):
    df = spark.createDataFrame([], T)
    assert qp.found(df).count() == 0 and qp.profile(df).count() == 0 and qp.drift(df).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None, None, None, None), ("1", 1, None, None, None, None, None, None)], T)
    assert qp.found(nulls).count() == 0
    p = qp.profile(nulls).collect()
    assert len(p) == 3 and all(r["missing_share"] == 1 and r["top_value"] is None and r["n_invalid"] == 0 for r in p)


def test_weighted_median(spark):
    rng = random.Random(5)
    data = [(g, round(rng.choice([rng.random(), 0.25, 0.7500001]), 4), rng.randrange(1, 5)) for g in range(12) for _ in range(rng.randrange(1, 40))]
    got = {r["g"]: r["median"] for r in qp.weighted_median(spark.createDataFrame(data, "g int, x double, n int"), ["g"], "x", "n").collect()}
    want = {g: median([x for k, x, n in data if k == g for _ in range(n)]) for g in range(12)}
    assert got == pytest.approx(want)


def test_profile_counts_and_ties(spark):
    t = datetime(2025, 2, 1)
    data = [("1", 1, "b", "0.5", t, BASE, "", 0), ("2", 1, "a", "0.5", t, BASE, "", 0), ("3", 1, "", "0.7", None, BASE, "", 0)]
    p = {r["field"]: r for r in qp.profile(spark.createDataFrame(data, T)).collect()}
    u = p["source_url"]
    assert (u["n_rows"], u["n_missing"], u["n_distinct"], u["n_invalid"], u["top_value"], u["top_count"], u["min_value"], u["max_value"]) == (3, 1, 2, 2, "a", 1, "a", "b")
    assert p["confidence_score"]["median_valid"] == 0.5 and p["last_verified"]["top_count"] == 2


def test_drift_is_largest_for_the_odd_load(spark):
    data = [(str(i), i % 5, "https://a.example/x", "0.1" if i % 5 == 2 else str(0.6 + (i % 17) / 50), BASE, BASE, "", 0) for i in range(500)]
    d = qp.drift(spark.createDataFrame(data, T)).filter("field = 'confidence_score'").orderBy(F.desc("psi")).collect()
    assert d[0]["run_id"] == 2 and d[0]["psi"] > 3 * d[1]["psi"] and d[0]["chi2"] > d[1]["chi2"]
    same = qp.drift(spark.createDataFrame(data, T)).filter("field = 'source_url'").collect()
    assert all(abs(r["psi"]) < 1e-9 for r in same)


def test_any_table_column_by_column(spark):
    ddl = "load string, n int, f double, d decimal(5,2), b boolean, t timestamp, day date, bin binary, a array<int>, m map<string,int>, s struct<x:int>, value string, field string"
    rows = [("a", 1, 0.5, None, True, BASE, BASE.date(), b"x", [1], {"k": 1}, (1,), "ok-1", "z" * 600), ("a", 3, float("nan"), None, None, BASE, None, None, [1], None, (1,), "no", "z" * 600), ("b", None, None, None, None, None, None, None, None, None, None, "", None), (None, 9, 9.0, None, None, None, None, None, None, None, None, "lost", None)]
    df = spark.createDataFrame(rows, ddl)
    fields = qp.columns(df, patterns={"value": "ok-[0-9]+"}, ranges={"n": (0, 2), "f": (0, 1)})
    got = {(r["load"], r["field"]): r for r in qp.profile_table(df, F.col("load"), fields).collect()}
    assert len(got) == 2 * len(df.columns)
    assert {k: (v["n_rows"], v["n_missing"], v["n_distinct"], v["n_invalid"], v["median_valid"]) for k, v in got.items() if k[0] == "a"} == {
        ("a", "load"): (2, 0, 1, 0, None), ("a", "n"): (2, 0, 2, 1, 1.0), ("a", "f"): (2, 0, 2, 1, 0.5), ("a", "d"): (2, 2, 0, 0, None), ("a", "b"): (2, 1, 1, 0, None), ("a", "t"): (2, 0, 1, 0, None), ("a", "day"): (2, 1, 1, 0, None),
        ("a", "bin"): (2, 1, 1, 0, None), ("a", "a"): (2, 0, 1, 0, None), ("a", "m"): (2, 1, 1, 0, None), ("a", "s"): (2, 0, 1, 0, None), ("a", "value"): (2, 0, 2, 1, None), ("a", "field"): (2, 0, 1, 0, None),
    }
    assert len(got["a", "field"]["top_value"]) == 265 and got["b", "value"]["n_missing"] == 1
    bad = qp.wrong_values(df, fields, qp.value_counts(df, fields, F.col("load")), F.monotonically_increasing_id())
    assert sorted((r["field"], r["value"]) for r in bad.collect()) == [("f", "9.0"), ("f", "NaN"), ("n", "3"), ("n", "9"), ("value", "lost"), ("value", "no")]
    d = {(r["load"], r["field"]): r["psi"] for r in qp.drift_table(df, F.col("load")).collect()}
    assert d["a", "d"] == 0 and d["a", "n"] > 0
    assert qp.profile_table(df.limit(0), F.col("load")).count() == 0 and qp.profile_table(df).count() == len(df.columns)


def test_whole_tables_are_read_whole(spark, tmp_path):
    """Every column and every row: embedding of rules, and rules without a run."""
    import duckdb

    from tidemark.plans import problems

    odd = [0.1, 1e-7, 1e-45, 3e38, 1.5e10, -0.0, 0.0, 1.0, -2.0, float("nan"), float("inf"), float("-inf"), None]
    vectors = [odd, odd, odd[::-1], [0.5] * 64, [0.5] * 63 + [0.25], [], [None], None, [1.0 / k for k in range(1, 65)]]
    long = ["run_id bigint" if c == "run_id" else f"{c} timestamp" if c in ("created_at", "extracted_at", "last_verified") else f"{c} string" for c in problems._RULES]
    data = [tuple(BASE if " timestamp" in c else (None if i % 4 == 3 else i % 4) if c == "run_id bigint" else f"{c[0]}{i % 5}" for c in long) + (vectors[i % 9],) for i in range(90)]
    df = spark.createDataFrame(data, ", ".join([*long, "embedding array<float>"]))
    df.write.parquet(f"{tmp_path}/rules.parquet")
    got = problems.QUERIES["p1_rules_whole"](spark, str(tmp_path)).collect()
    assert {r["field"] for r in got} == set(df.columns) and {r["load"] for r in got} == {"0", "1", "2", "none"}
    per = Counter()
    for r in got:
        per[r["field"]] += r["n_rows"]
    assert per == {c: 90 for c in df.columns}
    for r in got:
        if r["field"] == "embedding":
            n = Counter(str(d[-1]) for d in data if d[-1] is not None and str("none" if d[-2] is None else d[-2]) == r["load"])
            assert (r["n_missing"], r["n_distinct"], r["top_count"]) == (r["n_rows"] - sum(n.values()), len(n), max(n.values()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW rules AS SELECT * FROM '{tmp_path}/rules.parquet/*.parquet'")
    res = con.execute(problems.ORACLES["p1_rules_whole"])
    at = [x[0] for x in res.description]
    assert sorted((tuple(r[c] for c in at) for r in got), key=str) == sorted(res.fetchall(), key=str)
