"""Problem 7: the invertible tables against plain comparison."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import snapshot_diff as sd
from tidemark.operators.hashing import xxhash64_longs

T = "snapshot_no int, url string, source_id string, content_hash string, last_seen_at timestamp, pair string, key int"
T0 = datetime(2025, 1, 1)


def deliveries(n=500, seed=0, snaps=(1, 2, 4)):
    rng = random.Random(seed)
    pages, out = {f"https://h{i % 7}.example/p{i}": f"{i:04x}" for i in range(n)}, []
    for s in snaps:
        for u, h in pages.items():
            out.append((s, u + rng.choice(["", "/", "?utm_source=x", "#f"]), "s", rng.choice([h, h.upper()]) if h else None, T0 + timedelta(days=s), "x", 1))
            if rng.random() < 0.1:  # an older capture
                out.append((s, u, "s", "0ld", T0 - timedelta(days=1), "x", 1))
            if rng.random() < 0.05:
                out.append(out[-1])
        pages = {u: (rng.choice([f"{rng.random():.6f}", None]) if rng.random() < 0.2 else h) for u, h in pages.items() if rng.random() > 0.1}
        pages |= {f"https://new.example/{s}/{i}": f"n{s}{i}" for i in range(n // 10)}
    return out + [(snaps[0], None, "s", "x", T0, "x", 1), (None, "https://a.example/", "s", "x", T0, "x", 1)]


def brute(rows):
    by = {}
    for s, u, _, h, at, *_ in rows:
        if s is None or u is None:
            continue
        u = u.split("#")[0].split("?")[0].rstrip("/")
        k = (at, (h or "").lower())
        if k >= by.setdefault(s, {}).get(u, ((datetime.min, ""), None))[0]:
            by[s][u] = (k, h.lower() if h else None)
    out, order = set(), sorted(by)
    for a, b in zip(order, order[1:]):
        old, new = ({u: x[1] for u, x in by[s].items()} for s in (a, b))
        out |= {(b, u, "new") for u in new.keys() - old.keys()} | {(b, u, "removed") for u in old.keys() - new.keys()}
        out |= {(b, u, "modified") for u in new.keys() & old.keys() if old[u] and new[u] and old[u] != new[u]}
    return out


@pytest.mark.parametrize("seed,snaps", [(0, (1, 2, 4)), (1, (1, 2, 3, 4)), (2, (7,))])
def test_equals_plain_comparison(spark, seed, snaps):
    rows = deliveries(seed=seed, snaps=snaps)
    got = [tuple(r) for r in sd.found(spark.createDataFrame(rows, T)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_failed_buckets_are_enlarged(spark, monkeypatch):
    monkeypatch.setattr(sd, "ROWS_PER_BUCKET", 64)
    monkeypatch.setattr(sd.changed_keys, "__defaults__", (12,))
    rows = deliveries(seed=3)
    assert {tuple(r) for r in sd.found(spark.createDataFrame(rows, T)).collect()} == brute(rows)


def test_unchanged_and_empty(spark):
    assert sd.found(spark.createDataFrame([], T)).count() == 0
    same = [(s, "https://a.example/x", "s", "h", T0, "x", 1) for s in (1, 2)]
    assert sd.found(spark.createDataFrame(same, T)).count() == 0


def test_hash_of_longs_equals_the_engine(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(-(2**63), 2**63), rng.randrange(-(2**63), 2**63)) for _ in range(50)] + [(0, -1)]
    got = spark.createDataFrame(rows, "a bigint, b bigint").select(F.xxhash64("a", F.lit(101)), F.xxhash64("a", "b", F.lit(7))).collect()
    assert [tuple(r) for r in got] == [(xxhash64_longs((a,), 101), xxhash64_longs((a, b), 7)) for a, b in rows]
