"""Problem 6: the most similar vectors for every vector, by multi-index hashing.

Method: several rotations are learned on a bounded sample (alternating between signs and the orthogonal map that best
explains them), each giving one bit per dimension. The bits are cut into substrings and every vector is indexed once
per substring. Substrings grow with the logarithm of the collection, so buckets keep their size; the number of
substrings grows with their length, so that two vectors of the least cosine asked for share a bucket with the same
probability at every size. The substrings are taken in rounds of bounded size. Candidates are filtered by the Hamming
distance of a 128-bit sketch inside the sorted buckets, made distinct, and reranked by the cosine of the floats.

Equal directions (copies, also scaled ones) are taken as one vector and stand for each other afterwards. Sketches cannot
rank the rows of a dense group, so a bucket of more than HOT rows, or with more than KEEP close pairs a row, is searched
by the floats: tile against tile, over as many tasks as it has pairs of tiles, each row keeping its k most similar and all
that equal the last of them. Every pair of the bucket is compared, and no task emits all pairs of a group.

Edge cases: vectors of another length, with null, NaN or infinite numbers, and all-zero ones are left out; null ids too;
equal similarities are ranked by id; repeated ids count once; fewer than two vectors give no rows.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stored

#: Vectors on which the rotations are learned (about so many, by hash of the id), and rounds of learning.
SAMPLE, ROUNDS = 10_000, 12
#: Rows of a bucket on average, and the probability allowed that two vectors of the least cosine never share one.
BUCKET, MISS = 512, 0.02
#: Substrings, i.e. indexed copies of each code, that are shuffled at a time.
ROUND = 12
#: Bits of the sketch, and largest Hamming distance of two that is still reranked: cosine 0.85 differs in 22.6 +- 4.3 bits.
SKETCH, RADIUS = 128, 36
#: Rows of a bucket, and close pairs a row in it, above which it is searched by the floats; rows of a tile there.
HOT, KEEP, TILE = 4096, 48, 4096
#: Rows of a bucket up to which buckets are compared side by side, not one by one.
SMALL = 32


def usable(rows: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """(id, h, embedding) of the vectors that count; h is a 64-bit hash of the id."""
    v = F.col(vec_col)
    good = (F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.filter(F.col(id_col).isNotNull() & good).select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("h"), v.alias("embedding"))


def learn_rotations(sample: np.ndarray, count: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """count orthogonal matrices, each from another start, side by side: dim x (count * dim)."""
    dim, rng, out = sample.shape[1], np.random.default_rng(seed), []
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else sample
    for _ in range(count):
        r = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        for _ in range(rounds if len(x) >= dim else 0):
            u, _, vt = np.linalg.svd(x.T @ np.sign(x @ r))
            r = u @ vt
        out.append(r)
    return np.concatenate(out, axis=1).astype(np.float32)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    y = x.astype(np.float64)
    return y / np.linalg.norm(y, axis=1, keepdims=True)


def directions(vectors: DataFrame, dim: int) -> DataFrame:
    """(id, h, g1, g2): a 128-bit hash of each vector's direction, rounded to four decimals."""

    def run(batches):
        import xxhash

        for b in batches:
            q = np.round(_unit(_matrix(b.column("embedding"), dim)) * 1e4).astype(np.int16) + np.int16(0)
            d = np.array([xxhash.xxh3_128_intdigest(r.tobytes()).to_bytes(16, "little") for r in q], dtype="S16") if len(q) else np.zeros(0, "S16")
            g = np.frombuffer(b"".join(x.ljust(16, b"\0") for x in d.tolist()), "<i8").reshape(-1, 2) if len(q) else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("h"), pa.array(g[:, 0]), pa.array(g[:, 1])], names=["id", "h", "g1", "g2"])

    return vectors.mapInArrow(run, "id string, h long, g1 long, g2 long")


def plan(n: int, least: float) -> tuple[int, int]:
    """(bits, tables) for n vectors: a bit of a random hyperplane differs with the angle's share of a half turn, and as many
    substrings are taken as leave a pair of cosine `least` apart in all of them with a probability of MISS."""
    bits = max(0, round(math.log2(max(n, 1) / BUCKET)))
    share = (1 - math.acos(min(1.0, max(-1.0, least))) / math.pi) ** bits
    return bits, 1 if share >= 1 else math.ceil(math.log(MISS) / math.log1p(-share))


def codes(vectors: DataFrame, rotations: np.ndarray, dim: int) -> DataFrame:
    """(h, code): all bits of each vector, packed."""

    def run(batches):
        for b in batches:
            packed = np.packbits((_matrix(b.column("embedding"), dim) @ rotations) > 0, axis=1)
            flat = pa.py_buffer(np.ascontiguousarray(packed).tobytes())
            ends = pa.py_buffer((np.arange(len(packed) + 1, dtype=np.int32) * packed.shape[1]).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("h"), pa.Array.from_buffers(pa.binary(), len(packed), [None, ends, flat])], names=["h", "code"])

    return vectors.select("h", "embedding").mapInArrow(run, "h long, code binary")


def bucket_rows(coded: DataFrame, width: int, bits: int, first: int, last: int) -> DataFrame:
    """(key, s1, s2, h): one row per vector and substring from first to before last; codes are `width` bits long."""

    def run(batches):
        weights, tables, size = 1 << np.arange(bits, dtype=np.int64), last - first, -(-width // 8)
        for b in batches:
            if not b.num_rows:
                continue
            packed = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(-1, size)
            sketch = np.ascontiguousarray(packed[:, : SKETCH // 8]).view("<i8")
            code = np.unpackbits(packed, axis=1)[:, first * bits : last * bits]
            keys = code.reshape(len(packed), tables, bits).astype(np.int64) @ weights
            keys = (keys * tables + np.arange(tables)).ravel()
            cols = [keys, *(np.repeat(c, tables) for c in (sketch[:, 0], sketch[:, 1], b.column("h").to_numpy()))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "s1", "s2", "h"])

    return coded.mapInArrow(run, "key long, s1 long, s2 long, h long")


def _distance(a: tuple, b: tuple) -> np.ndarray:
    return sum(np.bitwise_count((x ^ y).view(np.uint64)) for x, y in zip(a, b))


def _near_in_runs(key: np.ndarray, sketch: tuple, h: np.ndarray, radius: int):
    """Pairs of rows with equal key (the rows are sorted by it) and close sketches: row i against row i + d."""
    for d in range(1, len(key)):
        i = np.flatnonzero(key[d:] == key[:-d])
        if not len(i):
            return
        i = i[_distance([s[i] for s in sketch], [s[i + d] for s in sketch]) <= radius]
        if len(i):
            yield h[i], h[i + d]


def _near_in_block(sketch: np.ndarray | tuple, h: np.ndarray, radius: int, keep: int):
    """The rows within the radius of each row, block against block; all of them if keep is the number of rows."""
    words = sketch if isinstance(sketch, tuple) else (sketch,)
    for a in range(0, len(h), 128):
        dist = _distance([s[a : a + 128, None] for s in words], [s[None, :] for s in words])
        dist[np.arange(dist.shape[0]), a + np.arange(dist.shape[0])] = 255
        if keep < len(h) - 1:
            dist[dist > np.partition(dist, keep - 1, axis=1)[:, keep - 1 : keep]] = 255
        i, j = np.nonzero(dist <= radius)
        yield h[a + i], h[j]


def candidates(buckets: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """(a, b, crowd): pairs a < b that share a bucket and have close sketches, each once; and, where crowd is true, the
    rows a of each bucket b that is to be searched by the floats."""

    def run(batches):
        def emit(a, b, crowd):
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), crowd))], names=["a", "b", "crowd"])

        def pairs(found):
            for x, y in found:
                a, b = np.minimum(x, y), np.maximum(x, y)
                ok = a != b
                if ok.any():
                    yield emit(a[ok], b[ok], False)

        rest: list[np.ndarray] = [np.zeros(0, np.int64)] * 4
        ended, crowd = object(), None
        for b in _chain(batches, ended):
            if b is not ended:
                rest = [np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, b.columns)]
                if crowd is not None:  # a bucket that was found large before its end
                    m = int(np.searchsorted(rest[0], crowd, "right"))
                    if m:
                        yield emit(rest[3][:m], rest[0][:m], True)
                    rest = [r[m:] for r in rest]
                whole = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0
            else:
                whole = len(rest[0])
            now, rest = [r[:whole] for r in rest], [r[whole:] for r in rest]
            if len(rest[0]) > hot:
                crowd = int(rest[0][0])
                yield emit(rest[3], rest[0], True)
                rest = [r[:0] for r in rest]
            if not whole:
                continue
            key, *sketch, h = now
            starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            sizes = np.diff(starts)
            large = sizes > SMALL
            for s, n in zip(starts[:-1][large], sizes[large]):
                near = list(_near_in_block(tuple(w[s : s + n] for w in sketch), h[s : s + n], radius, n)) if n <= hot else []
                if n > hot or sum(len(x) for x, _ in near) > 2 * KEEP * n:
                    yield emit(h[s : s + n], key[s : s + n], True)
                else:
                    yield from pairs(near)
            fine = np.repeat(~large, sizes)
            yield from pairs(_near_in_runs(key[fine], [w[fine] for w in sketch], h[fine], radius))

    return buckets.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long, crowd boolean").distinct()


def _most_similar(x: np.ndarray, y: np.ndarray, hx: np.ndarray, hy: np.ndarray, k: int, least: float):
    """(i, j): for each row i of x its k most similar rows j of y with a cosine of at least `least`, and perhaps more."""
    wide = len(y) // 16
    for a in range(0, len(x), 512):
        sim = x[a : a + 512] @ y.T
        sim[hx[a : a + 512, None] == hy[None, :]] = -2
        low = np.full((len(sim), 1), least, np.float32)
        if wide > k:  # the k-th largest of the maxima of disjoint sets is never above the k-th largest of all
            top = sim[:, : 16 * wide].reshape(len(sim), 16, wide).max(axis=1)
            low = np.maximum(low, np.partition(top, wide - k, axis=1)[:, wide - k, None])
        i, j = np.nonzero(sim >= low - np.float32(1e-5))
        yield a + i, j


def crowd_edges(crowds: DataFrame, vectors: DataFrame, k: int, least: float, dim: int) -> DataFrame:
    """(a, b, sim) from (h, key): the k most similar rows b of each row a among all rows of its buckets, by the floats in
    double precision; of equal ones all."""

    def run(key, rows):
        p, q = key[1].as_py(), key[2].as_py()
        h, tile = (rows.column(c).to_numpy() for c in ("h", "tile"))
        x = _unit(_matrix(rows.column("embedding").combine_chunks(), dim))
        if len(np.unique(h)) < len(h):
            first = np.unique(np.column_stack([h.view(np.float64), x]).view(np.dtype((np.void, 8 * (dim + 1)))).ravel(), return_index=True)[1]
            h, tile, x = h[first], tile[first], x[first]
        f, out = x.astype(np.float32), [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
        m, n = np.flatnonzero(tile == p), np.flatnonzero(tile == q)
        for s, t in ((m, n),) if p == q else ((m, n), (n, m)):
            for i, j in _most_similar(f[s], f[t], h[s], h[t], k, least):
                i, j = s[i], t[j]
                sim = np.einsum("ij,ij->i", x[i], x[j])
                ok = sim >= least
                out.append((h[i][ok], h[j][ok], sim[ok]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b", "sim"])

    size = crowds.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    rows = crowds.join(size, "key").join(vectors.select("h", "embedding"), "h").withColumn("tile", F.pmod(F.xxhash64("h", F.lit(3)), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("key", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"), "tile", "h", "embedding")
    edges = rows.groupBy("key", "p", "q").applyInArrow(run, "a long, b long, sim double")
    # dense ranks, since a pair may have met in several buckets
    return edges.withColumn("rank", F.dense_rank().over(W.partitionBy("a").orderBy(F.desc("sim")))).filter(F.col("rank") <= k).drop("rank")


def _chain(it, last):
    yield from it
    yield last


def _cosines(pairs: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """(a, b, sim) by the floats themselves, in double precision."""

    def run(batches):
        for b in batches:
            x, y = (_unit(_matrix(b.column(c), dim)) for c in ("x", "y"))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(np.einsum("ij,ij->i", x, y))], names=["a", "b", "sim"])

    v = vectors.select("h", "embedding")
    j = pairs.join(v.select(F.col("h").alias("a"), F.col("embedding").alias("x")), "a").join(v.select(F.col("h").alias("b"), F.col("embedding").alias("y")), "b")
    return j.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, sim double")


def nearest(rows: DataFrame, k: int = 10, least: float = 0.85, id_col: str = "id", vec_col: str = "embedding", dim: int = 64, tables: int | None = None, radius: int = RADIUS) -> DataFrame:
    """(id, other, sim, rank): for every vector its at most k nearest with a cosine of at least `least`.
    The number of tables follows from the number of rows and `least` unless it is given."""
    vectors = usable(rows, id_col, vec_col, dim)
    who = stored(directions(vectors, dim))
    n = who.count()
    bits, enough = plan(n, least)
    tables = tables or enough
    # about SAMPLE rows by their hash: a plain filter, so no task returns more than its share
    limit = min(2**63 - 1, 2**64 * SAMPLE // max(n, 1) - 2**63)
    picked = vectors.filter(F.xxhash64("h", F.lit(5)) <= F.lit(limit)).select("h", "embedding").toPandas().sort_values("h")["embedding"]
    rotations = learn_rotations(np.array([np.asarray(x, np.float64) for x in picked]).reshape(-1, dim), -(-max(tables * bits, SKETCH) // dim))

    groups = who.groupBy("g1", "g2").agg(F.min_by("h", "id").alias("rep"), F.count_distinct("id").alias("n")).filter("n > 1")
    members = stored(who.join(groups, ["g1", "g2"]).select("id", "h", "rep", "n").distinct())
    copies = members.filter("h <> rep").select("h")
    single = vectors.join(copies, "h", "left_anti")
    coded = stored(codes(single, rotations, dim))
    rounds = []
    for first in range(0, tables, ROUND):
        met = stored(candidates(bucket_rows(coded, rotations.shape[1], bits, first, min(first + ROUND, tables)), radius))
        rounds.append(met.withColumn("round", F.lit(first)))
    met = reduce(DataFrame.unionByName, rounds)
    sims = _cosines(met.filter("NOT crowd").select("a", "b").distinct(), vectors, dim).filter(F.col("sim") >= least)
    edges = sims.unionByName(sims.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    crowds = met.filter("crowd").select(F.col("a").alias("h"), (F.col("b") * tables + F.col("round")).alias("key"))
    edges = edges.unionByName(crowd_edges(crowds, vectors, k, least, dim))
    edges = stored(edges.groupBy("a", "b").agg(F.max("sim").alias("sim")))

    # every group by its first k + 1 ids: enough for any row to find k others in it
    first = members.withColumn("i", F.row_number().over(W.partitionBy("rep").orderBy("id"))).filter(F.col("i") <= k + 1)
    ids = who.select("id", "h").distinct()
    stands = ids.join(members.select("h", "rep", "n"), "h", "left").select("id", F.coalesce("rep", "h").alias("rep"), F.coalesce("n", F.lit(1)).alias("n"))
    to = ids.join(copies, "h", "left_anti").join(members.select("h").distinct(), "h", "left_anti").select(F.col("h").alias("b"), F.col("id").alias("other"))
    to = to.unionByName(first.select(F.col("rep").alias("b"), F.col("id").alias("other")))
    named = edges.join(to, "b").select(F.col("a").alias("rep"), "other", "sim")
    # neighbours outside the own group matter only where the group itself has fewer than k others
    outside = stands.filter(F.col("n") <= k).join(named, "rep").select("id", "other", "sim")
    inside = stands.filter("n > 1").join(first.select("rep", F.col("id").alias("other")), "rep").filter("id <> other").select("id", "other", F.lit(1.0).alias("sim"))
    ranked = outside.unionByName(inside).withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy(F.desc("sim"), "other")))
    return ranked.filter(F.col("rank") <= k)


def found(rules: DataFrame) -> DataFrame:
    """p6_found: (id_a, id_b), id_a < id_b, one among the other's ten most similar, cosine at least 0.85."""
    near = nearest(rules)
    return near.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()
