"""Problem 7: what changed between consecutive full snapshots, by invertible Bloom lookup tables (IBLT).

Each delivery is reduced to one row per page (normalised URL; the latest capture counts). Every hash bucket of a
snapshot is summarised by an IBLT: a row adds itself to three cells, each holding a count and the exclusive-or of
key hash, content digest and checksum (`bit_xor`, combined map-side). The tables of consecutive snapshots are
subtracted cell by cell, so equal rows vanish, and what is left is peeled bucket by bucket. Buckets that cannot be
peeled are built again with four times the cells, until all succeed; a bucket whose cells exceed its rows fourfold
is peeled almost surely, so this ends after a few rounds. Recovered key hashes are then joined back to the rows, where
digests are verified, and classified.

Edge cases: null or blank URLs name no page and are left out; captures with equal last_seen_at are settled by the
greater content hash, a null last_seen_at is the oldest; a null content_hash never makes a page `modified`; an empty
table or a single snapshot gives no rows; duplicate deliveries of a row change nothing.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import normalize_url
from ..session import stored

CELLS = 3
ROWS_PER_BUCKET = 2048
FIRST_CELLS = 768
MAX_ROUNDS = 9


def pages(url_state: DataFrame) -> DataFrame:
    """One row per snapshot and page: (snapshot_no, url, content_hash lower-cased)."""
    c = url_state.select("snapshot_no", normalize_url(F.col("url")).alias("url"), F.lower("content_hash").alias("content_hash"), "last_seen_at")
    c = c.filter(F.col("snapshot_no").isNotNull() & F.col("url").isNotNull() & (F.col("url") != "/"))
    last = F.max_by("content_hash", F.struct(F.coalesce(F.col("last_seen_at"), F.lit("0001-01-01").cast("timestamp")), F.coalesce("content_hash", F.lit(""))))
    return c.groupBy("snapshot_no", "url").agg(last.alias("content_hash"))


def _cell(j: int, cells: Column) -> Column:
    """The j-th cell of a (key, digest) pair: each hash has its own third of the table, so the three never coincide.
    The digest takes part, or the two rows of a modified page would share all cells and could never be told apart."""
    third = F.floor(cells / CELLS)
    return (F.lit(j) * third + F.pmod(F.xxhash64("key", "digest", F.lit(101 + j)), third)).cast("int")


def iblt(rows: DataFrame, cells: Column) -> DataFrame:
    """(snapshot_no, bucket, cell, n, key, digest, check): one table per snapshot and bucket. Rows meet by bucket before
    they are multiplied by their cells, so the cells are summed where they arise."""
    r = rows.repartition("bucket").select("snapshot_no", "bucket", "key", "digest", F.xxhash64("key", "digest", F.lit(7)).alias("check"), F.explode(F.array(*[_cell(j, cells) for j in range(CELLS)])).alias("cell"))
    return r.groupBy("snapshot_no", "bucket", "cell").agg(F.count(F.lit(1)).alias("n"), *[F.bit_xor(c).alias(c) for c in ("key", "digest", "check")])


def subtract(tables: DataFrame, order: list[int]) -> DataFrame:
    """Cell by cell, each snapshot's table minus that of the one before; cells that cancel out are dropped."""
    nxt = F.create_map(*[F.lit(x) for a, b in zip(order, order[1:]) for x in (a, b)])
    new = tables.filter(F.col("snapshot_no") != order[0]).withColumn("pair", F.col("snapshot_no"))
    old = tables.filter(F.col("snapshot_no") != order[-1]).withColumn("pair", nxt[F.col("snapshot_no")]).withColumn("n", -F.col("n"))
    both = new.unionByName(old).groupBy("pair", "bucket", "cell").agg(F.sum("n").alias("n"), *[F.bit_xor(c).alias(c) for c in ("key", "digest", "check")])
    return both.filter((F.col("n") != 0) | (F.col("key") != 0) | (F.col("digest") != 0) | (F.col("check") != 0))


PEELED = "pair int, bucket long, side int, key long, digest long, cells int"


def _peeler():
    """The peeling of one bucket; a bucket that fails returns a single row with side 0."""
    from .hashing import xxhash64_longs

    def peel(pdf: pd.DataFrame) -> pd.DataFrame:
        size = int(pdf["cells"].iloc[0])
        third = size // CELLS
        table = {int(c): [int(n), int(k), int(d), int(h)] for c, n, k, d, h in zip(pdf["cell"], pdf["n"], pdf["key"], pdf["digest"], pdf["check"])}
        todo, out = list(table), []
        while todo:
            at = todo.pop()
            if at not in table:
                continue
            n, key, digest, check = table[at]
            if n not in (1, -1) or xxhash64_longs((key, digest), 7) != check:
                continue
            out.append((n, key, digest))
            for j in range(CELLS):
                c = j * third + xxhash64_longs((key, digest), 101 + j) % third
                x = table.get(c)
                if x is None:
                    x = table[c] = [0, 0, 0, 0]
                x[0] -= n
                x[1] ^= key
                x[2] ^= digest
                x[3] ^= check
                if x == [0, 0, 0, 0]:
                    del table[c]
                else:
                    todo.append(c)
        pair, bucket = int(pdf["pair"].iloc[0]), int(pdf["bucket"].iloc[0])
        if table:
            out = [(0, 0, 0)]
        return pd.DataFrame([(pair, bucket, s, k, d, size) for s, k, d in out], columns=["pair", "bucket", "side", "key", "digest", "cells"])

    return peel


def changed_keys(rows: DataFrame, order: list[int], first_cells: int = FIRST_CELLS) -> DataFrame:
    """(pair, side, key, digest) of every row present in only one of two consecutive snapshots."""
    peel = _peeler()
    todo, cells, got = rows, first_cells, []
    for _ in range(MAX_ROUNDS):
        diff = subtract(iblt(todo, F.lit(cells)), order).withColumn("cells", F.lit(cells))
        done = stored(diff.groupBy("pair", "bucket").applyInPandas(peel, PEELED))
        got.append(done.filter("side <> 0").select("pair", "side", "key", "digest"))
        failed = done.filter("side = 0").select("pair", "bucket").distinct()
        if failed.isEmpty():
            return reduce(DataFrame.unionByName, got)
        # pairs share a bucket's rows, so a bucket that failed for one pair is taken again for all
        again = failed.select("bucket").distinct()
        got[-1] = done.join(again, "bucket", "left_anti").select("pair", "side", "key", "digest")
        todo, cells = todo.join(again, "bucket", "left_semi"), cells * 4
    raise RuntimeError("a bucket could not be peeled")


def diff(url_state: DataFrame) -> DataFrame:
    """(snapshot_no, url, change_type, old_hash, new_hash): new, modified and removed pages of every snapshot against
    the one before; change_type `unknown` where only one of the two hashes is null."""
    p = stored(pages(url_state).withColumn("key", F.xxhash64("url")).withColumn("digest", F.xxhash64("url", F.coalesce("content_hash", F.lit("\x00")))))
    order = sorted(r[0] for r in p.select("snapshot_no").distinct().collect())  # one number per delivery
    if len(order) < 2:
        return p.select("snapshot_no", "url", F.lit("").alias("change_type"), F.col("content_hash").alias("old_hash"), F.col("content_hash").alias("new_hash")).limit(0)
    n = p.count()
    buckets = max(1, n // len(order) // ROWS_PER_BUCKET)
    keys = changed_keys(p.select("snapshot_no", "key", "digest", F.pmod(F.hash("key"), F.lit(buckets)).cast("long").alias("bucket")), order)
    before = F.create_map(*[F.lit(x) for a, b in zip(order, order[1:]) for x in (b, a)])
    k = keys.withColumn("snapshot_no", F.when(F.col("side") == 1, F.col("pair")).otherwise(before[F.col("pair")]))
    rows = k.join(p, ["snapshot_no", "key", "digest"])  # verifies the digests
    new, old = F.col("side") == 1, F.col("side") == -1
    d = rows.groupBy("pair", "url").agg(
        F.max(new).alias("in_new"), F.max(old).alias("in_old"), F.max(F.when(old, F.col("content_hash"))).alias("old_hash"), F.max(F.when(new, F.col("content_hash"))).alias("new_hash")
    )
    kind = (
        F.when(~F.col("in_old"), "new").when(~F.col("in_new"), "removed").when(F.col("old_hash").isNotNull() & F.col("new_hash").isNotNull(), "modified").otherwise("unknown")
    )
    return d.select(F.col("pair").cast("int").alias("snapshot_no"), "url", kind.alias("change_type"), "old_hash", "new_hash")


def found(url_state: DataFrame) -> DataFrame:
    """p7_found: the rows of `diff` that are new, modified or removed."""
    return diff(url_state).filter("change_type <> 'unknown'").select("snapshot_no", "url", "change_type")
