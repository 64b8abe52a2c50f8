"""Joins (section 2.3) that are not part of another operator: alias, evidence, excerpts, nearest neighbours, organisations."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import squeeze, strip
from ..functions.urls import host, specificity
from ..session import stored
from . import gates


def apply_aliases(df: DataFrame, aliases: DataFrame, org: str = "source_org") -> DataFrame:
    """J-3: replaces an organisation by the canonical one of its stripped lower-cased spelling; adds nothing else. Of
    several entries for an alias the smallest canonical name counts; null names and null canonical names change nothing."""
    a = aliases.filter("canonical_org IS NOT NULL AND alias IS NOT NULL").groupBy(F.col("alias").alias("_alias")).agg(F.min("canonical_org").alias("_to"))
    j = df.join(a, F.lower(F.trim(F.col(org))) == F.col("_alias"), "left")
    return j.withColumn(org, F.coalesce("_to", org)).drop("_alias", "_to")


def normalize_orgs(df: DataFrame, aliases: DataFrame, with_url: bool = True) -> DataFrame:
    """M-15: alias, derive junk names from the URL's host, alias again, quarantine the rest as unattributed-legacy.
    Idempotent."""
    junk = F.coalesce("source_org", F.lit("")).isin(*gates.JUNK_ORGS)
    out = apply_aliases(df, aliases)
    if with_url:
        plausible = F.coalesce(F.col("source_url").rlike(gates.PLAUSIBLE_HOST), F.lit(False))
        out = out.withColumn("source_org", F.when(junk & plausible, host(F.col("source_url"))).otherwise(F.col("source_org")))
        out = apply_aliases(out, aliases)
    return out.withColumn("source_org", F.when(junk, "unattributed-legacy").otherwise(F.col("source_org")))


def evidence_cutoff(changes: DataFrame) -> DataFrame:
    """J-8, A-11: when each version (url, new_hash) was first seen; null urls or hashes are no version."""
    return changes.filter("url IS NOT NULL AND new_hash IS NOT NULL").groupBy("url", "new_hash").agg(F.min("detected_at").alias("cutoff"))


def excerpt_outcome(rules: DataFrame, pages: DataFrame) -> DataFrame:
    """J-9: rules joined to the pages of their URL: whether the squeezed excerpt still occurs in the page's text. Pages
    (url, content_hash, text) must hold one version per URL."""
    j = rules.join(pages.select(F.col("url").alias("source_url"), F.col("content_hash").alias("page_hash"), squeeze(F.col("text")).alias("page_text")), "source_url")
    return j.withColumn("present", F.contains("page_text", squeeze(F.col("source_excerpt")))).drop("page_text")


def cosine(a: Column, b: Column) -> Column:
    """F-18: cosine similarity in double precision; null if a vector is null, empty, of another length or all zero."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(F.size(a) == F.size(b), F.try_divide(dot, norm(a) * norm(b)))


#: Rows of one bucket that meet in one task of the neighbour search.
TILE = 2048
#: Rows of an organisation up to which it is one bucket, and the probability allowed that two vectors of the least cosine never
#: share one in a larger organisation.
BUCKET, MISS = 4096, 0.02


def hyperplanes(n: Column, least: float) -> tuple[Column, Column]:
    """(bits, tables) for an organisation of n vectors: a random hyperplane parts two vectors with the angle's share of a half
    turn, and so many tables are taken that a pair of cosine `least` is parted in all of them with a probability of MISS."""
    together = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    bits = F.greatest(F.lit(0), F.round(F.log2(n / BUCKET)).cast("int"))
    share = F.pow(F.lit(together), bits)
    return bits, F.when(bits == 0, 1).otherwise(F.ceil(F.lit(math.log(MISS)) / F.log1p(-share)).cast("int"))


def _codes(batches):
    """Adds `codes`, the bucket of each row in every table of its organisation."""
    planes: dict[tuple[int, int], np.ndarray] = {}
    for b in batches:
        size = pc.list_value_length(b.column("embedding")).to_numpy(zero_copy_only=False)
        bits, tables = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_bits", "_tables"))
        codes: list[list[int]] = [[0]] * b.num_rows
        for d, k, t in {(int(d), int(k), int(t)) for d, k, t in zip(size, bits, tables) if k}:
            at = np.flatnonzero((size == d) & (bits == k) & (tables == t))
            if (d, k * t) not in planes:
                planes[d, k * t] = np.random.default_rng(11).standard_normal((d, k * t))
            x = b.column("embedding").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            sides = (x @ planes[d, k * t] > 0).reshape(len(at), t, k)
            for i, c in zip(at, (sides @ (1 << np.arange(k, dtype=np.int64))).tolist()):
                codes[i] = c
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("id", "source_org", "source_url", "embedding", "_spec", "_cand")], pa.array(codes, pa.list_(pa.int64()))], names=["id", "source_org", "source_url", "embedding", "_spec", "_cand", "codes"])


def nearest_citation(rules: DataFrame, least: float = 0.8, candidate: Column | None = None, dim: int | None = None) -> DataFrame:
    """J-2, P-15, F-18: for each candidate the most similar rule of the same organisation with a strictly more specific URL
    and a cosine of at least `least`: (id, nn_id, nn_url, sim); ties, at nine decimals, go to the smaller id.

    Organisations of up to BUCKET rows (to half as many again) are compared whole. Larger ones are hashed by random
    hyperplanes into buckets of about that size, in so many tables that a neighbour at `least` is missed with a
    probability of MISS, a closer one with less; so the work grows with an organisation's rows times the number of its
    tables and not with their square. A bucket is cut into tiles, and every pair of a candidate tile and a neighbour tile
    is one group, so one that stays crowded is spread over many tasks and compared exactly; a tile pair returns at most one
    row per candidate. Vectors with null, NaN or infinite numbers, all zero, or of another length than dim are left out; without dim
    those of one length are compared with each other."""
    v = F.col("embedding")
    good = F.col("id").isNotNull() & F.col("source_org").isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rules.filter(good).withColumns({"_spec": specificity(F.col("source_url")), "_cand": F.coalesce(candidate if candidate is not None else gates.backfill_candidate(), F.lit(False))})
    rows = rows.filter(F.size(v) == dim) if dim else rows
    rows = rows.select("id", "source_org", "source_url", v.cast("array<double>").alias("embedding"), "_spec", "_cand")
    bits, tables = hyperplanes(F.count(F.lit(1)), least)
    orgs = rows.groupBy("source_org").agg(bits.alias("_bits"), tables.alias("_tables"))
    coded = rows.join(orgs, "source_org").mapInArrow(_codes, "id string, source_org string, source_url string, embedding array<double>, _spec int, _cand boolean, codes array<bigint>")
    coded = stored(coded.withColumn("embedding", F.col("embedding").cast("array<float>")))
    coded = coded.select("id", "source_org", "source_url", "embedding", "_spec", "_cand", F.posexplode("codes").alias("_table", "_code"))
    key = ["source_org", "_table", "_code"]
    # only buckets with a candidate and a page to adopt, and of those the rows that are one or the other
    tiles = coded.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("_tiles"), F.bool_or("_cand").alias("_c"), F.bool_or(gates.has_url(F.col("source_url"))).alias("_n")).filter("_c AND _n").select(*key, "_tiles")
    t = coded.join(tiles, key).withColumn("_tile", F.pmod(F.hash("id"), F.col("_tiles")))
    every = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    left = t.filter("_cand").withColumn("_a", F.col("_tile")).withColumn("_b", every).withColumn("_side", F.lit(0))
    right = t.filter(gates.has_url(F.col("source_url"))).withColumn("_b", F.col("_tile")).withColumn("_a", every).withColumn("_side", F.lit(1))

    def best(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        side, size = rows.column("_side").to_numpy(), pc.list_value_length(rows.column("embedding")).to_numpy()
        spec, order = rows.column("_spec").to_numpy(), pc.sort_indices(rows.column("id")).to_numpy()
        found: list[tuple] = []
        for d in np.unique(size[side == 0]):
            c, n = np.flatnonzero((side == 0) & (size == d)), order[(side[order] == 1) & (size[order] == d)]
            if not len(n):
                continue
            x, y = (_unit_rows(rows.column("embedding").take(pa.array(k)), int(d)) for k in (c, n))
            for a in range(0, len(c), 512):
                sim = np.round(x[a : a + 512] @ y.T, 9)
                sim[spec[c[a : a + 512], None] >= spec[n][None, :]] = -2
                k = sim.argmax(1)
                s = sim[np.arange(len(k)), k]
                ok = s >= least
                found.append((c[a : a + 512][ok], n[k[ok]], s[ok]))
        c, n, s = (np.concatenate(z) for z in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        pick = lambda name, at: rows.column(name).take(pa.array(at, pa.int64()))
        return pa.table({"id": pick("id", c), "nn_id": pick("id", n), "nn_url": pick("source_url", n), "sim": pa.array(s, pa.float64())})

    per = left.unionByName(right).groupBy(*key, "_a", "_b").applyInArrow(best, "id string, nn_id string, nn_url string, sim double")
    first = F.min_by(F.struct("nn_id", "nn_url", "sim"), F.struct(-F.col("sim"), F.col("nn_id")))
    return per.groupBy("id").agg(first.alias("n")).select("id", "n.*")


def _unit_rows(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    m = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def adopt_citations(rules: DataFrame, neighbours: DataFrame, now: str, documents: bool = True) -> DataFrame:
    """M-14, J-4, F-23: gives each rule its neighbour's URL, and its document where it has one (not with documents=False, for
    neighbours of another table), with a provenance that says so; last_verified is untouched. One pass over a snapshot:
    adoptions do not feed one another, unlike a row-by-row run."""
    note = F.to_json(F.struct(F.lit("neighbor").alias("method"), F.col("nn_id").alias("from"), F.round("sim", 4).alias("sim"), F.lit(now).alias("at")))
    n = neighbours.select("id", "nn_id", "nn_url", "sim")
    documents = documents and "document_id" in rules.columns
    if documents:
        theirs = rules.filter("id IS NOT NULL AND document_id IS NOT NULL").groupBy(F.col("id").alias("nn_id")).agg(F.min("document_id").alias("_doc"))
        n = n.join(theirs, "nn_id", "left")
    j = rules.join(n, "id", "left")
    hit = F.col("nn_id").isNotNull()
    cols = {"source_url": F.coalesce("nn_url", "source_url"), "url_provenance": F.when(hit, note).otherwise(F.col("url_provenance"))}
    if documents:
        cols["document_id"] = F.coalesce("_doc", "document_id")
    return j.withColumns(cols).drop("nn_id", "nn_url", "sim", "_doc")


def embedding_queue(rules: DataFrame, active_only: bool = True, limit: int | None = 1000) -> DataFrame:
    """P-17, O-5: rules without a vector, latest extraction first, nulls last."""
    q = rules.filter(F.col("embedding").isNull() & ((F.col("status") == "active") if active_only else F.lit(True))).orderBy(F.desc_nulls_last("extracted_at"), "id")
    return q.limit(limit) if limit else q


def names_of(c: Column) -> Column:
    """The stripped lower-cased form under which aliases are stored (M-20)."""
    return F.lower(strip(c))


def upsert_aliases(aliases: DataFrame, seed: DataFrame) -> DataFrame:
    """M-20: seed rows replace those of the same stripped lower-cased alias."""
    s = seed.select(names_of(F.col("alias")).alias("alias"), "canonical_org").dropDuplicates(["alias"])
    return aliases.join(s.select("alias"), "alias", "left_anti").select("alias", "canonical_org").unionByName(s)


def upsert_topics(topics: DataFrame, seed: DataFrame) -> DataFrame:
    """M-19: seed rows replace those of the same topic; the last of several rows for a topic, by its columns, counts."""
    rest = [c for c in topics.columns if c != "topic"]
    s = seed.groupBy("topic").agg(F.max(F.struct(*rest)).alias("r")).select("topic", "r.*")
    return topics.join(s.select("topic"), "topic", "left_anti").select(*topics.columns).unionByName(s.select(*topics.columns))


def numbered(df: DataFrame, start: int, order: list[Column]) -> DataFrame:
    """W-7: consecutive ids from start + 1 in the given order, without a window over all rows: counts per partition of a
    range-partitioned table give the offsets. Equal rows of the order must be settled by it."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    kept = stored(parts)
    sizes = kept.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # one row a partition
    return kept.join(F.broadcast(offsets), "_p").withColumn("new_id", F.lit(start) + F.col("_before") + F.col("_m") - F.col("_first") + 1).drop("_p", "_m", "_n", "_first", "_before")
