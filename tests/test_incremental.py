import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental as inc

T0 = datetime(2025, 1, 1)
now = lambda: F.lit("2026-01-01").cast("timestamp")


def test_classify(spark):
    h = hashlib.sha256(b"same text").hexdigest()
    obs = [("known", 200, "same  text"), ("known2", 200, "other"), ("fresh", 200, "x"), ("c304", 304, None), ("gone", 410, None), ("gone2", 404, None), ("err", 500, "x"), ("empty", 200, None)]
    state = [("known", h), ("known2", h), ("gone", h), ("c304", h), ("err", h)]
    got = {r["url"]: (r["change_type"], r["signal"]) for r in inc.classify(spark.createDataFrame(obs, "url string, status int, text string"), spark.createDataFrame(state, "url string, content_hash string")).collect()}
    assert got == {"known": ("unchanged", None), "known2": ("modified", "content_hash"), "fresh": ("new", "content_hash"), "c304": ("unchanged", None), "gone": ("removed", "gone"), "gone2": (None, None), "err": (None, None), "empty": ("new", "content_hash")}


def test_retries_backstop_consume(spark):
    t = "change_id bigint, source_id string, url string, new_hash string, extract_status string, detected_at timestamp"
    rows = [(i, "s", f"u{i % 25:02d}", "h", "failed", T0) for i in range(25)] + [(99, "s", "u00", "h", "extracted", T0), (100, "s", "u01", None, "failed", T0), (101, "s", "u02", "h", "failed", T0), (101, "s", "u02", "h", "failed", T0), (102, "s", "u03", "h", "detected", T0), (103, "s", None, "h", "failed", T0)]
    c = spark.createDataFrame(rows, t)
    r = [x["url"] for x in inc.pending_retries(c).orderBy("at").collect()]
    assert len(r) == 20 and r[0] == "u01" and "u00" not in r and "u03" not in r
    f = {x["url"]: (x["failures"], x["gave_up"]) for x in inc.failures_by_version(c, now()).collect()}
    assert f["u02"] == (2, True) and f["u03"] == (2, True) and f["u01"] == (1, False)
    out = spark.createDataFrame([("u02", "h", "failed"), ("u01", "h", "failed"), ("z", "h", "extracted"), ("y", None, "irrelevant")], "url string, new_hash string, extract_status string")
    got = {x["url"]: (x["final_status"], x["consumed"]) for x in inc.consume(out, inc.failures_by_version(c, now())).collect()}
    assert got == {"u02": ("gave_up", True), "u01": ("failed", False), "z": ("extracted", True), "y": ("irrelevant", True)}
    assert {x["final_status"] for x in inc.consume(out, inc.failures_by_version(c, now()), monitor=True).collect()} == {"skipped_monitor"}


def test_capped_and_marker(spark):
    c = spark.createDataFrame([(i, 1, "a" if i < 20 else "b", i % 7 != 3) for i in range(25)], "change_id int, run_id int, source_id string, consumed boolean")
    got = inc.capped(c)
    assert got.filter("source_id = 'a'").count() == 15 and got.filter("source_id = 'a' AND NOT truncated").count() == 0
    assert {r[0]: r[1] for r in inc.marker_moves(got.withColumn("consumed", F.lit(True))).collect()} == {"a": False, "b": True}


def test_rotation_and_cursor(spark):
    pages = spark.createDataFrame([("s", i) for i in range(5)] + [("t", i) for i in range(3)], "source_id string, pos int")
    off = spark.createDataFrame([("s", 7)], "source_id string, offset int")
    got = {(r["source_id"], r["pos"]): r["turn"] for r in inc.rotate(pages, off).collect()}
    assert [got["s", i] for i in range(5)] == [3, 4, 0, 1, 2] and [got["t", i] for i in range(3)] == [0, 1, 2]
    cur = spark.createDataFrame([("a", 50, 40, None, False), ("b", 3, None, 2, True), ("c", 0, None, None, False)], "source_id string, n int, offset int, child int, is_index boolean")
    assert {r["source_id"]: (r["offset"], r["child"]) for r in inc.next_cursor(cur).collect()} == {"a": (10, None), "b": (None, 0), "c": (0, None)}


@pytest.mark.parametrize("seed", range(4))
def test_walk_equals_a_loop(spark, seed):
    rng = random.Random(seed)
    pages, state, retries = [], {}, []
    for s in ("s", "t", "u"):
        for turn in range(rng.randrange(5, 60)):
            k = rng.randrange(40)
            pages.append((s, turn, f"https://{s}.example/{rng.choice(['p', 'p', 'p', 'login', 'tags/'])}{k}", rng.choice(["m1", "m2", "", None])))
            if rng.random() < 0.6:
                state[f"https://{s}.example/p{k}"] = rng.choice(["m1", "m2", None])
        retries += [(s, f"https://{s}.example/p{k}") for k in rng.sample(range(50), rng.randrange(4))]
    budget = rng.randrange(3, 15)

    want = set()
    for s in ("s", "t", "u"):
        seen = {u for x, u in retries if x == s}
        want |= {(s, u, -1, "retry") for u in seen}
        left = budget - len(seen)
        for _, turn, loc, mod in sorted(p for p in pages if p[0] == s):
            if loc in seen or "/login" in loc and loc.endswith("/login") or "/tags/" in loc:
                continue
            seen.add(loc)
            if mod and state.get(loc) == mod:
                want.add((s, loc, turn, "unchanged"))
                continue
            if left <= 0:
                break
            left -= 1
            want.add((s, loc, turn, "probe"))
    got = inc.walk(
        spark.createDataFrame(pages, "source_id string, turn int, loc string, lastmod string"), spark.createDataFrame(list(state.items()), "url string, last_modified string"),
        spark.createDataFrame(retries, "source_id string, url string"), budget,
    )
    assert {tuple(r) for r in got.collect()} == want


def test_first_occurrence(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, None), ("a", 1, "y")], "k string, o int, v string")
    assert {tuple(r) for r in inc.first_occurrence(df, ["k"], [F.col("o")]).collect()} == {("a", 1, "y"), ("b", 2, None)}
    assert inc.first_occurrence(df.limit(0), ["k"], [F.col("o")]).count() == 0
