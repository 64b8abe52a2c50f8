"""The crawl cycle as micro-batches over tables (sections 2.5 and 2.10): classification of observations, budgets,
rotation, retries, and what a batch consumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..functions.urls import deny_reason, normalize_url, url_allowed
from ..sources.registry import url_filters
from ..sources.web import sitemap_children, sitemap_urls
from .gates import locale_variant

CONSUMED = ("extracted", "empty", "irrelevant", "gave_up")
GIVE_UP = 3


def first_occurrence(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """W-2: the first row of each key by a total order, by min_by with map-side combination."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def requests(pages: DataFrame, state: DataFrame) -> DataFrame:
    """S-14, P-9: what a fetcher is asked for: pages (source_id, url, ...) in English, each with the validators stored for
    it, if_none_match (the etag) and if_modified_since (the stored last_modified); null ones are not sent."""
    known = state.select("url", F.nullif("etag", F.lit("")).alias("if_none_match"), F.nullif("last_modified", F.lit("")).alias("if_modified_since"))
    return pages.filter(F.col("url").isNotNull() & ~locale_variant(F.col("url"))).join(known, "url", "left")


def classify(observations: DataFrame, state: DataFrame, markers: DataFrame | None = None) -> DataFrame:
    """T-5: adds change_type (null: nothing to report), old_hash, new_hash and signal to (url, status, text) by the prior
    state (url, content_hash). 304 and equal hashes are unchanged; 404 and 410 remove a known page and mean nothing for an
    unknown one; any other answer but 200 means nothing.

    S-9, T-4: an observation with a `marker` (a release) is told by it instead of by its text: it is unchanged if its source's
    last_seen_marker in `markers` (source_id, last_seen_marker) is the same, else modified by signal `version`."""
    prior = state.select("url", F.col("content_hash").alias("old_hash"), F.lit(True).alias("_known"))
    j = observations.join(prior, "url", "left").withColumn("new_hash", F.when(F.col("status") == 200, content_hash(F.col("text"))))
    known = F.coalesce("_known", F.lit(False))
    kind = (
        F.when(F.col("status") == 304, "unchanged")
        .when(F.col("status").isin(404, 410), F.when(known, "removed"))
        .when(F.col("status") != 200, F.lit(None).cast("string"))
        .when(F.col("new_hash").eqNullSafe(F.col("old_hash")), "unchanged")
        .when(known, "modified")
        .otherwise("new")
    )
    signal = F.when(kind == "removed", "gone").when(kind.isin("new", "modified"), "content_hash")
    j = j.withColumns({"change_type": kind, "signal": signal}).drop("_known")
    if markers is None or "marker" not in observations.columns:
        return j
    m = markers.select("source_id", F.col("last_seen_marker").alias("_last")).dropDuplicates(["source_id"])
    j = j.join(m, "source_id", "left")
    by = F.col("marker").isNotNull() & (F.col("status") == 200)
    same = F.col("marker").eqNullSafe(F.col("_last"))
    return j.withColumns({
        "change_type": F.when(by, F.when(same, "unchanged").otherwise("modified")).otherwise(F.col("change_type")), "signal": F.when(by, F.when(~same, "version")).otherwise(F.col("signal")),
        "old_hash": F.when(by, F.col("_last")).otherwise(F.col("old_hash")), "new_hash": F.when(by, F.col("marker")).otherwise(F.col("new_hash")),
    }).drop("_last")


def pending_retries(changes: DataFrame, limit: int = 20) -> DataFrame:
    """O-11: per source the URLs whose latest change failed, the first `limit` in order of the URL."""
    last = changes.filter("url IS NOT NULL").groupBy("source_id", "url").agg(F.max_by("extract_status", "change_id").alias("extract_status"))
    w = W.partitionBy("source_id").orderBy("url")
    return last.filter("extract_status = 'failed'").withColumn("at", F.row_number().over(w)).filter(F.col("at") <= limit).select("source_id", "url", "at")


def failures_by_version(changes: DataFrame, now: Column, limit: int = GIVE_UP) -> DataFrame:
    """A-12, T-3: failed attempts per (url, new_hash): failed, given up, or detected more than an hour ago and never
    finished; gave_up says whether the next failure is the last. Null hashes never count."""
    stuck = (F.col("extract_status") == "detected") & (F.col("detected_at") < now - F.make_dt_interval(F.lit(0), F.lit(1)))
    bad = F.coalesce(F.col("extract_status").isin("failed", "gave_up") | stuck, F.lit(False))
    rows = changes.filter("url IS NOT NULL AND new_hash IS NOT NULL").dropDuplicates(["change_id"])
    g = rows.groupBy("url", "new_hash").agg(F.sum(bad.cast("int")).alias("failures")).filter("failures > 0")
    return g.withColumn("gave_up", F.col("failures") + 1 >= limit)


def rotate(pages: DataFrame, offsets: DataFrame, order: str = "pos") -> DataFrame:
    """W-4: positions of each source's URLs when its walk starts at its offset and goes round; adds `turn`, from 0."""
    n = pages.groupBy("source_id").agg(F.count(F.lit(1)).alias("_n"))
    j = pages.join(n, "source_id").join(offsets.select("source_id", F.col("offset").alias("_off")), "source_id", "left")
    return j.withColumn("turn", F.pmod(F.col(order) - F.coalesce("_off", F.lit(0)), F.col("_n"))).drop("_n", "_off")


def next_cursor(sizes: DataFrame, step: int = 20) -> DataFrame:
    """T-6, M-3: the cursor after a walk: offset + step for plain sitemaps, child + 1 for indexes, each going round. From
    (source_id, n, offset, child, is_index)."""
    n = F.greatest(F.col("n"), F.lit(1))
    return sizes.withColumns({"offset": F.when(~F.col("is_index"), F.pmod(F.coalesce("offset", F.lit(0)) + step, n)), "child": F.when(F.col("is_index"), F.pmod(F.coalesce("child", F.lit(0)) + 1, n))})


def listing(files: DataFrame, cursors: DataFrame, stop: int = 300) -> DataFrame:
    """S-12, S-8, W-4: the pages a source's walk goes through, from its sitemap files (source_id, url, parent, xml; parent null
    for the source's own sitemap) and cursor (source_id, offset, child): (source_id, turn, loc, lastmod).

    A plain sitemap is walked round from its offset. Of an index the child files are taken from number `child` on, going
    round, each whole, until `stop` pages are listed; children that were not fetched or cannot be read give none."""
    cur = cursors.select("source_id", F.col("offset").alias("_off"), F.col("child").alias("_child")).dropDuplicates(["source_id"])
    roots = files.filter("parent IS NULL AND source_id IS NOT NULL")
    kids = sitemap_children(roots.select("source_id", "xml"))
    n = kids.groupBy("source_id").agg(F.max("pos").alias("_m"))
    kids = kids.join(n, "source_id").join(cur, "source_id", "left")
    order = F.pmod(F.col("pos") - F.coalesce("_child", F.lit(0)), F.col("_m") + 1)
    pages = sitemap_urls(files.filter("source_id IS NOT NULL").select("source_id", "url", "parent", "xml"))
    size = pages.groupBy("source_id", "url").agg(F.count(F.lit(1)).alias("_n"))
    turned = kids.select("source_id", F.col("child").alias("url"), order.alias("_order")).join(size, ["source_id", "url"])
    before = F.coalesce(F.sum("_n").over(W.partitionBy("source_id").orderBy("_order").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # over the files of an index
    turned = turned.withColumn("_before", before).filter(F.col("_before") < stop).select("source_id", "url", "_before")
    of_index = pages.join(turned, ["source_id", "url"]).withColumn("turn", F.col("_before") + F.row_number().over(W.partitionBy("source_id", "url").orderBy("pos")) - 1)
    plain = pages.filter("parent IS NULL").join(n.select("source_id"), "source_id", "left_anti").select("source_id", "pos", "loc", "lastmod")
    plain = rotate(plain.withColumn("pos", F.row_number().over(W.partitionBy("source_id").orderBy("pos")) - 1), cur.select("source_id", F.col("_off").alias("offset")))
    return of_index.select("source_id", F.col("turn").cast("long").alias("turn"), "loc", "lastmod").unionByName(plain.select("source_id", F.col("turn").cast("long").alias("turn"), "loc", "lastmod"))


def cursor_sizes(files: DataFrame, cursors: DataFrame) -> DataFrame:
    """What next_cursor needs of each fetched source: (source_id, n, offset, child, is_index); n counts the child files of
    an index and the listed pages of a plain sitemap."""
    roots = files.filter("parent IS NULL AND source_id IS NOT NULL").select("source_id", "xml")
    kids = sitemap_children(roots).groupBy("source_id").agg(F.count(F.lit(1)).alias("k"))
    locs = sitemap_urls(roots).groupBy("source_id").agg(F.count(F.lit(1)).alias("p"))
    j = roots.select("source_id").distinct().join(kids, "source_id", "left").join(locs, "source_id", "left").join(cursors.select("source_id", "offset", "child"), "source_id", "left")
    return j.select("source_id", F.coalesce("k", "p", F.lit(0)).alias("n"), "offset", "child", F.col("k").isNotNull().alias("is_index"))


def walk(pages: DataFrame, state: DataFrame, retries: DataFrame, budget: int = 20, filters: DataFrame | None = None) -> DataFrame:
    """T-6, W-3: which URLs a cycle probes. pages: (source_id, turn, loc, lastmod); state: (url, last_modified).

    URLs are normalised, barred and repeated ones dropped. One whose lastmod is the stored one is `unchanged` and costs
    nothing; the others are probed in order of turn until the budget, from which the retries were paid first, is spent;
    whatever follows the first URL that cannot be paid is not looked at. (source_id, loc, turn, action)"""
    p = pages.withColumn("loc", normalize_url(F.col("loc")))
    if filters is not None:
        p = p.join(url_filters(filters), "source_id", "left")
        p = p.filter(url_allowed(F.col("loc"), F.col("url_filter"))).drop("url_filter")
    else:
        p = p.filter(url_allowed(F.col("loc")))
    p = first_occurrence(p, ["source_id", "loc"], [F.col("turn")])
    first = retries.select("source_id", normalize_url(F.col("url")).alias("loc")).distinct()
    paid = first.groupBy("source_id").agg(F.count(F.lit(1)).alias("_paid"))
    p = p.join(first, ["source_id", "loc"], "left_anti").join(paid, "source_id", "left")
    j = p.join(state.select(F.col("url").alias("loc"), "last_modified"), "loc", "left")
    still = F.coalesce((F.col("lastmod") != "") & (F.col("lastmod") == F.col("last_modified")), F.lit(False))
    w = W.partitionBy("source_id").orderBy("turn").rowsBetween(W.unboundedPreceding, W.currentRow)
    cost = F.sum((~still).cast("int")).over(w)
    j = j.withColumn("_cost", cost).filter(F.col("_cost") <= F.lit(budget) - F.coalesce("_paid", F.lit(0)))
    walked = j.select("source_id", "loc", "turn", F.when(still, "unchanged").otherwise("probe").alias("action"))
    return walked.unionByName(first.select("source_id", "loc", F.lit(-1).alias("turn"), F.lit("retry").alias("action")))


def capped(changes: DataFrame, limit: int = 15, order: tuple[str, ...] = ("change_id",)) -> DataFrame:
    """W-5: the first `limit` changes of each source and run; adds `truncated`, whether there were more."""
    n = changes.groupBy(F.col("run_id").alias("_r"), F.col("source_id").alias("_s")).agg((F.count(F.lit(1)) > limit).alias("truncated"))
    w = W.partitionBy("run_id", "source_id").orderBy(*order)
    first = changes.withColumn("_i", F.row_number().over(w)).filter(F.col("_i") <= limit).drop("_i")
    return first.join(n, F.col("run_id").eqNullSafe(F.col("_r")) & F.col("source_id").eqNullSafe(F.col("_s"))).drop("_r", "_s")


def consume(outcomes: DataFrame, prior_failures: DataFrame, limit: int = GIVE_UP, monitor: bool = False) -> DataFrame:
    """T-2, T-3, T-8: the final status of (url, new_hash, extract_status), and whether its page's state advances. A failure
    that is the last allowed becomes gave_up and is consumed; in monitor mode everything is skipped and nothing is."""
    j = outcomes.join(prior_failures.select("url", "new_hash", F.col("failures").alias("_f")), ["url", "new_hash"], "left")
    last = (F.col("extract_status") == "failed") & (F.coalesce("_f", F.lit(0)) + 1 >= limit)
    final = F.lit("skipped_monitor") if monitor else F.when(last, "gave_up").otherwise(F.col("extract_status"))
    return j.withColumn("final_status", final).withColumn("consumed", F.col("final_status").isin(*CONSUMED)).drop("_f")


def marker_moves(consumed: DataFrame) -> DataFrame:
    """T-4: per source whether its version marker may advance: everything was consumed and nothing was cut off."""
    return consumed.groupBy("source_id").agg((F.bool_and("consumed") & ~F.bool_or("truncated")).alias("advance"))


def preflight(pages: DataFrame, registry: DataFrame, state: DataFrame) -> DataFrame:
    """P-22: what a walk would find, without writing anything: per source the listed and distinct pages, those barred by
    each global rule or by the source's own pattern, and of the rest the known and the new ones."""
    p = pages.select("source_id", normalize_url(F.col("loc")).alias("url"))
    g = p.groupBy("source_id", "url").agg(F.count(F.lit(1)).alias("n"))
    j = g.join(url_filters(registry), "source_id", "left").join(state.select("url", F.lit(True).alias("_known")).dropDuplicates(["url"]), "url", "left")
    why = F.coalesce(deny_reason(F.col("url")), F.when(~url_allowed(F.col("url"), F.col("url_filter")), "filter"), F.when(F.col("_known"), "known"), F.lit("new"))
    c = lambda x: F.sum((F.col("_why") == x).cast("int")).cast("long").alias(x)
    return j.withColumn("_why", why).groupBy("source_id").agg(F.sum("n").alias("listed"), F.count(F.lit(1)).alias("pages"), *[c(x) for x in ("root", "path", "query", "filter", "known", "new")])
