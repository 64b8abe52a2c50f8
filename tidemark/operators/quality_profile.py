"""Problem 1: exact column profile per load, wrong values, and loads that deviate from the others.

Method: every profiled field is unpivoted to (load, field, value) rows, which are counted with map-side
combination; frequencies, distinct counts, ranges, pattern violations and the weighted median all come from these counts, so
a load or a value that holds a third of all rows costs one partial count per task. What is wrong with a value is decided once
per distinct value, on the counts; the rows that hold wrong values are found by joining these back. Loads are compared by the
figures' leave-one-out median and, in `drift`, by chi-square and population stability index.

`columns` profiles every column of any table; `Field` describes one: its value as text, what makes it valid, its number if it
has one. RULE_FIELDS are the three fields of problem 1.

Edge cases: a null load belongs to no load (its wrong values are still listed); null and '' are missing; NaN is a value and
no number; an empty table gives empty results; a load without a single valid number has no median and is not compared on it;
with only one load nothing deviates. Extra columns are ignored; arrays, maps and structs are profiled as their JSON text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.urls import valid_url
from ..session import AS_OF, stored

FIELDS = ("source_url", "confidence_score", "last_verified")
#: Comparisons of shares and medians at the limit are made with this much slack for binary fractions.
EPS = 1e-9
#: Characters of a text above which it is counted by a digest.
LONG = 512
#: Width of the bins by which the weighted median finds the counts it has to look at.
MEDIAN_BINS = 1024


@dataclass(frozen=True)
class Field:
    """A field of a profile: `value` is its text (null if missing). `valid` tells from the value's text, and from `beside`, a
    text that belongs to the value (the range a time must lie in, for instance), whether it may be; null for any. `number` is
    the number a valid value's text stands for, null for fields without a median."""

    name: str
    value: Column
    valid: Callable[[Column, Column], Column] | None = None
    beside: Column | None = None
    number: Callable[[Column], Column] | None = None


def valid_confidence(c: Column) -> Column:
    ok = c.rlike(r"\A[0-9]+(\.[0-9]+)?\z") & (c.try_cast("double") <= 1)
    return F.coalesce(ok, F.lit(False))


def valid_verified(c: Column, created: Column, as_of: str) -> Column:
    return F.coalesce((c >= created) & (c <= F.lit(as_of).cast("timestamp")), F.lit(False))


TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def rule_fields(as_of: str = AS_OF) -> list[Field]:
    """The fields of problem 1. A time is wrong by its own row, so what stands beside it is whether it is too early or late."""
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    seen = F.col("last_verified")
    place = F.when(valid_verified(seen, F.col("created_at"), as_of), "in range").otherwise("out of range")
    return [
        Field("source_url", text("source_url"), lambda v, _: valid_url(v)),
        Field("confidence_score", text("confidence_score"), lambda v, _: valid_confidence(v), number=lambda v: v.try_cast("double")),
        Field("last_verified", F.date_format(seen, TIME), lambda _, b: b == "in range", place),
    ]


def columns(df: DataFrame, patterns: dict[str, str] | None = None, ranges: dict[str, tuple[float, float]] | None = None, leave_out: tuple[str, ...] = ()) -> list[Field]:
    """A field for every column of any table. patterns: the regular expression a column's whole text must match; ranges: the
    least and greatest number it may have (NaN is never in range). Numeric columns have a median. A text of more than LONG
    characters in a column without a pattern is counted under its first 200 and a digest of the whole, so that counts and
    distincts stay exact and no long text crosses the network; only its order in the range is that of the first 200."""
    out = []
    for f in df.schema:
        if f.name in leave_out:
            continue
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        number = kind in ("byte", "short", "integer", "long", "float", "double") or kind.startswith("decimal")
        if kind in ("array", "map", "struct", "variant"):
            value = F.to_json(c)
        elif kind in ("timestamp", "timestamp_ntz"):
            value = F.date_format(c, TIME)
        elif kind == "binary":
            value = F.hex(c)
        else:
            value = c.cast("string")
        if kind not in ("boolean", "date") and not number and not (patterns and f.name in patterns):
            value = F.when(F.length(value) > LONG, F.concat(F.left(value, F.lit(200)), F.lit("…"), F.sha2(value, 256))).otherwise(value)
        checks = []
        if patterns and f.name in patterns:
            checks.append(lambda v, p=patterns[f.name]: v.rlike(rf"(?s)\A(?:{p})\z"))
        if ranges and f.name in ranges:
            checks.append(lambda v, r=ranges[f.name]: ~F.isnan(v.try_cast("double")) & v.try_cast("double").between(*r))
        valid = None
        if checks:
            valid = lambda v, _, cs=tuple(checks): F.coalesce(cs[0](v) if len(cs) == 1 else cs[0](v) & cs[1](v), F.lit(False))
        as_number = (lambda v: F.when(~F.isnan(v.try_cast("double")) & (F.abs(v.try_cast("double")) < float("inf")), v.try_cast("double"))) if number else None
        out.append(Field(f.name, F.nullif(value, F.lit("")), valid, number=as_number))
    return out


def _by_field(fields: list[Field], what: Callable[[Field], Column | None], other: Column) -> Column:
    out = other
    for f in fields:
        c = what(f)
        out = out if c is None else F.when(F.col("field") == f.name, c).otherwise(out)
    return out


def unpivoted(df: DataFrame, fields: list[Field], keep: list[Column]) -> DataFrame:
    """One row per row of df and field: the kept columns, field, value and what stands beside it."""
    beside = lambda f: (f.beside if f.beside is not None else F.lit(None).cast("string")).alias("beside")
    long = F.array(*[F.struct(F.lit(f.name).alias("field"), f.value.alias("value"), beside(f)) for f in fields])
    return df.select(*keep, F.explode(long).alias("f")).select(*[c for c in df.select(*keep).columns], "f.*")


def value_counts(df: DataFrame, fields: list[Field], load: Column) -> DataFrame:
    """(load, field, value, beside, n, valid, x): the exact counts everything else is made from; value null = missing, x the
    number of a valid value."""
    n = unpivoted(df, fields, [load.alias("load")]).groupBy("load", "field", "value", "beside").agg(F.count(F.lit(1)).alias("n"))
    valid = F.col("value").isNotNull() & _by_field(fields, lambda f: f.valid(F.col("value"), F.col("beside")) if f.valid else None, F.lit(True))
    n = n.withColumn("valid", F.coalesce(valid, F.lit(False)))
    number = _by_field(fields, lambda f: f.number(F.col("value")) if f.number else None, F.lit(None).cast("double"))
    return n.withColumn("x", F.when(F.col("valid"), number))


def wrong_values(df: DataFrame, fields: list[Field], counts: DataFrame, key: Column) -> DataFrame:
    """(field, key, value): the rows whose value the counts show to be wrong. The distinct wrong values are joined back by
    AQE's choice; a wrong value that holds a third of all rows is one row on its side of the join."""
    bad = counts.filter(F.col("value").isNotNull() & ~F.col("valid")).select("field", "value", F.coalesce("beside", F.lit("")).alias("_b")).distinct()
    rows = unpivoted(df, fields, [key.alias("key")]).filter("value IS NOT NULL").withColumn("_b", F.coalesce("beside", F.lit("")))
    return rows.join(bad, ["field", "value", "_b"]).select("field", "key", "value")


def weighted_median(counts: DataFrame, keys: list[str], x: str, n: str) -> DataFrame:
    """Exact median of x with weights n per key, the mean of the middle two where the total is even.

    Two steps, so that no task ever holds all values of a group: counts per bin give the bins that hold the middle
    ranks, and only the values of those (one or two bins a group) are ranked.
    """
    lo = W.partitionBy(*keys)
    bins = counts.select(*keys, x, n, F.floor(F.col(x) * MEDIAN_BINS).alias("_bin"))
    run = lo.orderBy("_bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    per = bins.groupBy(*keys, "_bin").agg(F.sum(n).alias("_m"))
    per = per.withColumn("_cum", F.sum("_m").over(run)).withColumn("_all", F.sum("_m").over(lo))
    per = per.withColumn("_r1", F.floor((F.col("_all") + 1) / 2)).withColumn("_r2", F.floor((F.col("_all") + 2) / 2))
    before = F.col("_cum") - F.col("_m")
    mid = per.filter(((before < F.col("_r1")) & (F.col("_cum") >= F.col("_r1"))) | ((before < F.col("_r2")) & (F.col("_cum") >= F.col("_r2"))))
    mid = mid.select(*keys, "_bin", before.alias("_before"), "_r1", "_r2")
    v = bins.join(mid, [*keys, "_bin"]).groupBy(*keys, "_bin", x).agg(F.sum(n).alias("_m"), F.first("_before").alias("_before"), F.first("_r1").alias("_r1"), F.first("_r2").alias("_r2"))
    within = W.partitionBy(*keys, "_bin").orderBy(x).rowsBetween(W.unboundedPreceding, W.currentRow)
    v = v.withColumn("_cum", F.col("_before") + F.sum("_m").over(within))
    at = lambda r: (F.col("_cum") >= F.col(r)) & (F.col("_cum") - F.col("_m") < F.col(r))
    return v.groupBy(*keys).agg(((F.max(F.when(at("_r1"), F.col(x))) + F.max(F.when(at("_r2"), F.col(x)))) / 2).alias("median"))


def profile_counts(counts: DataFrame) -> DataFrame:
    """One row per load and field from stored value counts: rows, missing, distinct and invalid counts, range, top value,
    range and median of the valid numbers. Ties of the top value go to the smallest."""
    c = counts.filter("load IS NOT NULL").groupBy("load", "field", "value").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("valid"), F.col("n")).otherwise(0)).alias("n_valid"), F.max("x").alias("x"))
    return _figures(c, c.filter("x IS NOT NULL AND n_valid > 0"))


def _figures(c: DataFrame, numbers: DataFrame) -> DataFrame:
    """`profile_counts` from one count a value, (load, field, value, n, n_valid, x), and from those of them that are valid numbers."""
    here = F.col("value").isNotNull()
    base = c.groupBy("load", "field").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~here, F.col("n"))), F.lit(0)).alias("n_missing"),
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(F.when(here, F.col("n"))) - F.sum("n_valid"), F.lit(0)).alias("n_invalid"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.max(F.when(here, F.col("n"))).alias("top_count"),
        F.min_by("value", F.when(here, F.struct(-F.col("n"), F.col("value")))).alias("top_value"),
        F.min("x").alias("min_number"),
        F.max("x").alias("max_number"),
    )
    med = weighted_median(numbers, ["load", "field"], "x", "n_valid")
    return (
        base.join(med, ["load", "field"], "left")
        .withColumn("missing_share", F.col("n_missing") / F.col("n_rows"))
        .withColumn("top_share", F.coalesce(F.col("top_count"), F.lit(0)) / F.col("n_rows"))
        .withColumnRenamed("median", "median_valid")
    )


def profile_table(df: DataFrame, load: Column | None = None, fields: list[Field] | None = None) -> DataFrame:
    """The profile of every column (or of the given fields) of any table, per load; without a load the table is one.

    Where nothing stands beside a value it has one count already, which is neither stored nor shuffled again; only the
    counts of the fields with a number are, for their medians. df is read twice."""
    one, fields = load if load is not None else F.lit("all"), fields or columns(df)
    if any(f.beside is not None for f in fields):
        return profile_counts(stored(value_counts(df, fields, one)))
    once = lambda fs: value_counts(df, fs, one).filter("load IS NOT NULL").select("load", "field", "value", "n", F.when(F.col("valid"), F.col("n")).otherwise(0).alias("n_valid"), "x")
    numeric = [f for f in fields if f.number]
    c = once(fields)
    return _figures(c, stored(once(numeric).filter("x IS NOT NULL")) if numeric else c.filter("false"))


def profile(rules: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """The profile of the three fields of problem 1 by run_id."""
    p = profile_counts(stored(value_counts(rules, rule_fields(as_of), F.col("run_id"))))
    return p.select(F.col("load").alias("run_id"), "field", "n_rows", "n_missing", "missing_share", "n_distinct", "n_invalid", "min_value", "max_value", "top_value", "top_count", "top_share", "median_valid")


def _others_median(figures: DataFrame) -> DataFrame:
    """Adds, to (run_id, field, figure, x), the median of x over all other rows of the same field and figure.

    One row per load: after sorting, leaving row i out shifts the middle by at most one place, so the three values
    around the middle are enough for all rows."""
    g = W.partitionBy("field", "figure")
    r = figures.withColumn("i", F.row_number().over(g.orderBy("x", "run_id"))).withColumn("m", F.count(F.lit(1)).over(g) - 1)
    a, b = F.floor((F.col("m") + 1) / 2), F.floor((F.col("m") + 2) / 2)
    for k, base in (("a", a), ("b", b)):
        for d in (0, 1):
            r = r.withColumn(f"{k}{d}", F.max(F.when(F.col("i") == base + d, F.col("x"))).over(g))
    pick = lambda k, base: F.when(F.col("i") <= base, F.col(f"{k}1")).otherwise(F.col(f"{k}0"))
    return r.withColumn("others", F.when(F.col("m") > 0, (pick("a", a) + pick("b", b)) / 2))


def deviating_loads(prof: DataFrame, least: float = 0.2) -> DataFrame:
    """(run_id, field, figure, x, others) where a load's figure differs by `least` or more from the median over all
    other loads. Figures: missing share, share of the top value, median of valid confidence scores."""
    figures = prof.select(
        "run_id",
        "field",
        F.explode(F.array(*[F.struct(F.lit(k).alias("figure"), F.col(k).alias("x")) for k in ("missing_share", "top_share", "median_valid")])).alias("f"),
    ).select("run_id", "field", "f.*")
    return _others_median(figures.filter(F.col("x").isNotNull())).filter(F.abs(F.col("x") - F.col("others")) >= least - EPS).select("run_id", "field", "figure", "x", "others")


def found(rules: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """p1_found: wrong values (case_key = id) and deviating loads (case_key = run_id), both from the same value counts."""
    rules, fields = rules.select("id", "run_id", *FIELDS, "created_at"), rule_fields(as_of)
    counts = stored(value_counts(rules, fields, F.col("run_id")))
    values = wrong_values(rules, fields, counts, F.col("id")).select("field", F.lit("value").alias("case_kind"), F.col("key").alias("case_key"))
    prof = profile_counts(counts).withColumnRenamed("load", "run_id")
    loads = deviating_loads(prof).select("field", F.lit("load").alias("case_kind"), F.col("run_id").cast("string").alias("case_key")).distinct()
    return values.unionByName(loads)


def drift(rules: DataFrame, as_of: str = AS_OF, bins: int = 20) -> DataFrame:
    """`drift_counts` of the three fields of problem 1 by run_id. Classes of valid values: the bin of the confidence score, the
    month of last_verified, the scheme and depth of source_url. (run_id, field, psi, chi2, classes)"""
    counts = value_counts(rules.select("id", "run_id", *FIELDS, "created_at"), rule_fields(as_of), F.col("run_id"))
    kind = (
        F.when(F.col("value").isNull(), "missing")
        .when(~F.col("valid"), "invalid")
        .when(F.col("field") == "confidence_score", F.floor(F.col("value").try_cast("double") * bins).cast("string"))
        .when(F.col("field") == "last_verified", F.left("value", F.lit(7)))
        .otherwise(F.concat(F.lower(F.substring_index("value", ":", 1)), F.lit("/"), F.least(F.lit(9), F.size(F.split("value", "/"))).cast("string")))
    )
    return drift_counts(counts, kind).withColumnRenamed("load", "run_id")


def drift_table(df: DataFrame, load: Column, fields: list[Field] | None = None, bins: int = 20) -> DataFrame:
    """`drift_counts` of every column of any table. Classes of valid values: `bins` equal steps between the least and the
    greatest number of the field, or the first two characters of a text."""
    counts = stored(value_counts(df, fields or columns(df), load))
    span = counts.filter("x IS NOT NULL").groupBy("field").agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    step = F.floor(F.coalesce(F.try_divide((F.col("x") - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo")), F.lit(0.0)))
    kind = F.when(F.col("value").isNull(), "missing").when(~F.col("valid"), "invalid").when(F.col("x").isNotNull(), F.least(step, F.lit(bins - 1)).cast("string")).otherwise(F.left("value", F.lit(2)))
    return drift_counts(counts.join(F.broadcast(span), "field", "left"), kind)  # one row a field


def drift_counts(counts: DataFrame, kind: Column) -> DataFrame:
    """Chi-square statistic and population stability index of each load's distribution over the classes `kind` against all
    other loads, from value counts: (load, field, psi, chi2, classes). Half a row is added to every class, so that empty
    classes count without dividing by zero."""
    per = counts.filter("load IS NOT NULL").groupBy("load", "field", kind.alias("kind")).agg(F.sum("n").alias("n"))
    kinds, loads = per.groupBy("field", "kind").agg(F.sum("n").alias("all_n")), per.groupBy("load", "field").agg(F.sum("n").alias("load_n"))
    grid = loads.join(kinds, "field").join(per, ["load", "field", "kind"], "left").fillna(0, ["n"])
    f = W.partitionBy("load", "field")
    k = F.count(F.lit(1)).over(f)
    p = (F.col("n") + 0.5) / (F.col("load_n") + 0.5 * k)
    q = (F.col("all_n") - F.col("n") + 0.5) / (F.sum("all_n").over(f) - F.col("load_n") + 0.5 * k)
    grid = grid.select("load", "field", "load_n", p.alias("p"), q.alias("q"))
    return grid.groupBy("load", "field").agg(
        F.round(F.sum((F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))), 4).alias("psi"),
        F.round(F.sum(F.col("load_n") * (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")) / F.col("q")), 2).alias("chi2"),
        F.count(F.lit(1)).alias("classes"),
    )
