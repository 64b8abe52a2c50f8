"""Problem 5: the best record of every group of records that describe one rule, chosen field by field.

Method: the fields are unpivoted to (key, field, value) rows with a ranking, winners are chosen by min_by / max_by with
map-side combination, and pivoted back. Two rankings share this path: `golden` sums votes (trust in the source times
the decay with age) per normalised value and builds a record of the winning values; `best_ids` takes a stated total
order instead of votes, as the fixed result p5_found does. No group is ever collected: a key with a third of all rows
costs one partial aggregate per task.

Edge cases: the key of a rule is its rule_key, or F-6 of name and if_condition where the column is null or empty; null
names count as ''; fields without any valid value give null; repeated rows count as records; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import rule_key, strip
from ..functions.urls import specificity_upsert, valid_url
from ..operators.quality_profile import valid_confidence, valid_verified
from ..session import AS_OF

FIELDS = ("source_url", "confidence_score", "last_verified")
# Trust in a record by its provenance_status; any other status or none has the last value.
TRUST = {"verified_excerpt": 1.0, "observed": 0.6, "source_change_pending": 0.5, "unverified": 0.4, "source_changed": 0.2, "": 0.3}
HALF_LIFE_DAYS = 180.0


def with_key(rules: DataFrame) -> DataFrame:
    """Adds the column `key`, the rule key, computed where the table has none."""
    return rules.withColumn("key", F.coalesce(F.nullif("rule_key", F.lit("")), rule_key(F.col("name"), F.col("if_condition"))))


def unpivot(rules: DataFrame, as_of: str) -> DataFrame:
    """(key, field, id, value, valid, rank): rank is the stated order of the field, smallest first."""
    url, conf, seen = (F.col(c) for c in FIELDS)
    late = lambda c: F.coalesce(-F.unix_micros(c), F.lit((1 << 63) - 1))
    rank = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"), F.col("id"))
    one = lambda f, v, ok, r: F.struct(F.lit(f).alias("field"), v.alias("value"), ok.alias("valid"), r.alias("rank"))
    long = F.array(
        one("source_url", url, valid_url(url), rank(-specificity_upsert(url), F.lit(0))),
        one("confidence_score", conf, valid_confidence(conf), rank(F.when(F.col("provenance_status") == "verified_excerpt", 0).otherwise(1), late(F.col("extracted_at")))),
        one("last_verified", F.date_format(seen, "yyyy-MM-dd HH:mm:ss.SSSSSS"), valid_verified(seen, F.col("created_at"), as_of), rank(late(seen), F.lit(0))),
    )
    keyed = with_key(rules)
    return keyed.select("key", "id", "provenance_status", "extracted_at", F.explode(long).alias("f")).select("key", "id", "provenance_status", "extracted_at", "f.*")


def _pivot(per_field: DataFrame, value: str, extra: list[Column]) -> DataFrame:
    return per_field.groupBy("key").agg(*[F.max(F.when(F.col("field") == f, F.col(value))).alias(f) for f in FIELDS], *extra)


def best_ids(rules: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """(key, source_url, confidence_score, last_verified, n): per field the id of the record that gives its value."""
    r = rules.select("id", "rule_key", "name", "if_condition", "provenance_status", "extracted_at", "created_at", *FIELDS)
    chosen = unpivot(r, as_of).groupBy("key", "field").agg(F.min_by("id", F.when(F.col("valid"), F.col("rank"))).alias("best"), F.count(F.lit(1)).alias("n"))
    return _pivot(chosen, "best", [F.max("n").alias("n")])


def found(rules: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """p5_found: groups of two or more records."""
    b = best_ids(rules, as_of).filter("n >= 2")
    return b.select(F.col("key").alias("rule_key"), F.col("source_url").alias("url_id"), F.col("confidence_score").alias("score_id"), F.col("last_verified").alias("verified_id"))


def _trust(status: Column) -> Column:
    t = F.lit(TRUST[""])
    for k, v in TRUST.items():
        t = F.when(status == k, v).otherwise(t) if k else t
    return t


def golden(rules: DataFrame, as_of: str = AS_OF, half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """One built record per group of two or more: for each field the normalised value with the most votes, a vote being
    trust * 2^(-age / half life) with the age of extracted_at (a null one counts as four half lives). URLs are
    normalised by lower-casing scheme and host and dropping trailing slashes, scores by their number, times by the
    day. Votes are compared at 9 decimals; ties go to the greatest value. (rule_key, source_url, confidence_score,
    last_verified, n)"""
    r = rules.select("id", "rule_key", "name", "if_condition", "provenance_status", "extracted_at", "created_at", *FIELDS)
    u = unpivot(r, as_of)
    age = (F.lit(as_of).cast("timestamp").cast("double") - F.col("extracted_at").cast("double")) / 86400
    age = F.greatest(F.lit(0.0), F.coalesce(age, F.lit(4 * half_life_days)))
    vote = _trust(F.coalesce("provenance_status", F.lit(""))) * F.pow(F.lit(2.0), -age / half_life_days)
    url = strip(F.col("value"))
    head = F.regexp_extract(url, r"\A[^/]*//[^/?#]*", 0)
    norm = (
        F.when(F.col("field") == "source_url", F.concat(F.lower(head), F.regexp_replace(F.substring(url, F.length(head) + 1, F.length(url)), r"/+\z", "")))
        .when(F.col("field") == "confidence_score", F.col("value").try_cast("double").cast("string"))
        .otherwise(F.left("value", F.lit(10)))
    )
    votes = u.groupBy("key", "field", F.when(F.col("valid"), norm).alias("norm")).agg(F.round(F.sum(vote), 9).alias("votes"), F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("key", "field").agg(F.max_by("norm", F.when(F.col("norm").isNotNull(), F.struct("votes", "norm"))).alias("best"), F.sum("n").alias("n"))
    return _pivot(best, "best", [F.max("n").alias("n")]).filter("n >= 2").withColumnRenamed("key", "rule_key")
