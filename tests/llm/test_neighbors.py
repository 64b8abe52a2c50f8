"""Problem 6: recall against brute force, copies, hot groups, unusable vectors."""

import numpy as np
import pytest

from tidemark.llm import neighbors as nb

DDL = "id string, embedding array<float>, h int, key string"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(ids[i] if ids else f"{i:06d}", None if v is None else [float(np.float32(x)) for x in v], 1, "clash") for i, v in enumerate(vectors)], DDL)


def clusters(rng, n, size, noise=0.05, dim=64):
    out = []
    for _ in range(n):
        c = rng.normal(size=dim)
        out += [(c + noise * rng.normal(size=dim)) * rng.choice([0.5, 1, 7]) for _ in range(size)]
    return out


def brute(ids, vectors, k=10, least=0.85):
    x = np.array(vectors, np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    pairs = set()
    for i in range(len(ids)):
        for j in sorted(range(len(ids)), key=lambda j: (-round(s[i, j], 12), ids[j]))[:k]:
            if s[i, j] >= least:
                pairs.add((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return pairs


def test_recall(spark):
    rng = np.random.default_rng(0)
    v = clusters(rng, 150, 4) + clusters(rng, 40, 3, 0.25) + list(rng.normal(size=(800, 64)))
    ids = [f"{i:06d}" for i in range(len(v))]
    got, want = {tuple(r) for r in nb.found(frame(spark, v)).collect()}, brute(ids, v)
    assert got <= want | got and len(got & want) / len(want) >= 0.97 and not got - want


def test_copies_and_large_groups(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(2, 64))
    v = [a * s for s in (1, 2, 0.5)] * 10 + [b] * 3 + list(rng.normal(size=(50, 64)))
    near = nb.nearest(frame(spark, v)).toPandas()
    per = near.groupby("id").size()
    assert all(per[f"{i:06d}"] == 10 for i in range(30)) and all(per[f"{i:06d}"] == 2 for i in range(30, 33)) and len(per) == 33
    assert (near["id"] != near["other"]).all() and set(near[near["id"] == "000005"]["other"]) == {f"{i:06d}" for i in range(11)} - {"000005"}


def test_hot_cluster_is_split(spark, monkeypatch):
    monkeypatch.setattr(nb.candidates, "__defaults__", (nb.RADIUS, 32))
    rng = np.random.default_rng(2)
    v = clusters(rng, 1, 400, 0.02) + list(rng.normal(size=(100, 64)))
    per = nb.nearest(frame(spark, v)).toPandas()
    hot = per[per["id"] < "000400"]
    assert hot.groupby("id").size().reindex([f"{i:06d}" for i in range(400)]).min() == 10 and hot["sim"].min() > 0.98


def test_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=64)
    bad = [None, [], [1.0] * 32, [float("nan")] + [1.0] * 63, [0.0] * 64, [float("inf")] + [1.0] * 63]
    df = frame(spark, [a, a * 1.0001, *bad])
    assert [tuple(r) for r in nb.found(df).collect()] == [("000000", "000001")]
    assert [tuple(r) for r in nb.found(df.unionByName(df)).collect()] == [("000000", "000001")]
    assert nb.found(df.limit(0)).count() == 0 and nb.found(frame(spark, [a])).count() == 0
    nulls = spark.createDataFrame([(None, [float(x) for x in a], 1, ""), ("b", [float(x) for x in a], 1, "")], DDL)
    assert nb.found(nulls).count() == 0


def test_rotations_are_orthogonal():
    rng = np.random.default_rng(4)
    r = nb.learn_rotations(rng.normal(size=(500, 16)), 3)
    for i in range(3):
        m = r[:, 16 * i : 16 * (i + 1)].astype(float)
        assert np.allclose(m @ m.T, np.eye(16), atol=1e-4)
    assert nb.learn_rotations(np.zeros((0, 16)), 2).shape == (16, 32)


@pytest.mark.parametrize("n", [1, 5, 700])
def test_blocks_find_every_close_row(n):
    rng = np.random.default_rng(n)
    sketch = rng.integers(-(2**62), 2**62, n)
    sketch[: n // 2] = sketch[0] ^ (1 << rng.integers(0, 60, n // 2))
    h = np.arange(n)
    got = {(int(a), int(b)) for x, y in nb._near_in_block(sketch, h, 4, n) for a, b in zip(x, y)} if n > 1 else set()
    want = {(i, j) for i in range(n) for j in range(n) if i != j and int(sketch[i] ^ sketch[j]).bit_count() <= 4 and (sketch[i] ^ sketch[j]) >= 0}
    assert want <= got


def test_dense_group_has_its_true_neighbours(spark):
    """Distinct vectors around one centre, pairwise cosine near 0.95: sketches cannot rank them, the floats must."""
    rng = np.random.default_rng(11)
    c = rng.normal(size=64)
    v = [c + 0.23 * rng.normal(size=64) for _ in range(1000)] + list(rng.normal(size=(500, 64)))
    ids = [f"{i:06d}" for i in range(len(v))]
    got, want = {tuple(r) for r in nb.found(frame(spark, v)).collect()}, brute(ids, v)
    recall = len(got & want) / len(want)
    print(f"recall in a dense group {recall:.3f} of {len(want)}")
    assert recall >= 0.97


def test_crowd_of_several_tiles_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nb, "TILE", 100)
    rng = np.random.default_rng(12)
    c = rng.normal(size=64)
    v = [c + 0.3 * rng.normal(size=64) for _ in range(450)]
    ids = [f"{i:06d}" for i in range(len(v))]
    vectors = nb.usable(frame(spark, v), "id", "embedding", 64)
    e = nb.crowd_edges(vectors.selectExpr("h", "7L AS key"), vectors, 10, 0.85, 64)
    name = {r["h"]: r["id"] for r in vectors.collect()}
    got = {(min(name[r["a"]], name[r["b"]]), max(name[r["a"]], name[r["b"]])) for r in e.collect()}
    assert got == brute(ids, v)


def test_hit_probability_holds_at_every_size():
    p = 1 - np.arccos(0.85) / np.pi
    for n in (1, 500, 2_000, 240_000, 2_400_000, 10**8):
        bits, tables = nb.plan(n, 0.85)
        assert 1 - (1 - p**bits) ** tables >= 0.9 and n / 2**bits <= 2 * nb.BUCKET


def test_recall_at_the_least_cosine(spark, monkeypatch):
    """Pairs planted at cosines of 0.85 to 0.90, with substrings as long as for a collection 64 times as large."""
    monkeypatch.setattr(nb, "BUCKET", 8, raising=False)
    rng = np.random.default_rng(13)
    x = rng.normal(size=(2500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(2500, 64))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = rng.uniform(0.8501, 0.90, (2500, 1))
    v = np.concatenate([x, c * x + np.sqrt(1 - c * c) * y, rng.normal(size=(3000, 64))])
    got = {tuple(r) for r in nb.found(frame(spark, v)).collect()}
    recall = {b: np.mean([(f"{i:06d}", f"{2500 + i:06d}") in got for i in range(2500) if b <= c[i, 0] < b + 0.01]) for b in (0.85, 0.86, 0.87, 0.88, 0.89)}
    print({b: round(float(r), 3) for b, r in recall.items()})
    assert min(recall.values()) >= 0.97
