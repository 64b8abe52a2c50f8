"""Predicates and gates that decide which rows count (section 2.2). Each returns a Column or a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import observation_tag, numeric_at_least, prevalence_confidence, rule_status, squeeze, strip
from ..functions.urls import specificity

# Names that attribute a rule to nobody.
JUNK_ORGS = ("", "Personal Blog", "Unknown", "unattributed-legacy")
# States in which a rule may not be cited.
NOT_CITABLE = ("rejected", "retired", "superseded", "deprecated")
# Claims about features that are gone, and wording that says so.
DEPRECATED = r"(?i)how-?to rich results?|how-?to (?:schema|markup|structured data)|faq(?:page)? rich results?"
DEPRECATION_NOTICE = (
    r"(?i)no longer|do(?:es)?n'?t rely|do(?:es)? not rely|deprecat|discontinu|\bretired\b|\bsunset|not (?:be )?supported"
    r"|restricted to|stopp?ed (?:showing|supporting)|will not be shown|avoid(?:ing)? (?:relying|reliance)"
)
# Directories that hold a translated copy of a site.
LANGUAGE_DIRECTORIES = "zh-tw|zh-cn|zh-hans|zh-hant|ja|ko|de|es|fr|pt-br|ru|it|pl|tr|id|vi|th"
# Fixed value: a site whose every language, English too, has a directory.
TRANSLATED_SITE = r"(?i)//developer\.mozilla\.org/(?!en-US/)[a-z]{2}(?:-[A-Za-z]{2,4})?/"
#: P-16: a URL from whose host an organisation can be derived.
PLAUSIBLE_HOST = r"\Ahttps?://[^/]+\.[a-z]{2,}"


def due(now: Column, slack_hours: int = 12) -> Column:
    """P-1: enabled and never crawled, or crawled longer ago than the cadence less the slack."""
    limit = now - F.make_dt_interval(F.col("crawl_cadence_days")) + F.make_dt_interval(F.lit(0), F.lit(slack_hours))
    return F.col("enabled") & (F.col("last_crawled_at").isNull() | (F.col("last_crawled_at") < limit))


def overdue(now: Column) -> Column:
    """P-2: never crawled or crawled more than two cadences ago, enabled or not."""
    return F.col("last_crawled_at").isNull() | F.coalesce(F.col("last_crawled_at") < now - F.make_dt_interval(F.col("crawl_cadence_days") * 2), F.lit(False))


def has_url(c: Column) -> Column:
    """P-3"""
    return F.coalesce(c, F.lit("")) != ""


def citable(df: DataFrame) -> Column:
    """P-5: neither barred by its state nor by a neighbour's URL; a condition counts only if its column exists."""
    ok = F.lit(True)
    if "status" in df.columns:
        ok = ok & ~F.coalesce("status", F.lit("active")).isin(*NOT_CITABLE)
    if "url_provenance" in df.columns:
        ok = ok & ~F.coalesce("url_provenance", F.lit("")).contains("neighbor")
    return ok


def source_faithful() -> Column:
    """P-7: active, with a verified excerpt and the hash of its source."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    return (F.coalesce("status", F.lit("active")) == "active") & F.col("provenance_status").eqNullSafe("verified_excerpt") & filled("source_excerpt") & filled("source_content_hash")


def trusted() -> Column:
    """P-6: source-faithful, not observed, confidence of 0.85 or more, attributed to somebody."""
    return (
        source_faithful() & ~F.col("rule_type").eqNullSafe("observed") & numeric_at_least(F.col("confidence_score"), 0.85)
        & ~F.coalesce("source_org", F.lit("")).isin(*JUNK_ORGS)
    )


def stale(c: Column, now: Column, days: int = 90) -> Column:
    """P-18: null or longer ago than `days`."""
    return c.isNull() | F.coalesce(c < now - F.make_dt_interval(F.lit(days)), F.lit(False))


def recent(c: Column, now: Column, days: int = 7) -> Column:
    """P-20"""
    return F.coalesce(c >= now - F.make_dt_interval(F.lit(days)), F.lit(False))


def locale_variant(url: Column) -> Column:
    """P-9: a page in another language than English, by its hl parameter or a language directory right after the host."""
    hl = url.rlike(r"(?i)[?&]hl=(?!en(?:[-_]|$|&))")
    path = url.rlike(TRANSLATED_SITE) | url.rlike(rf"(?i)//[^/]+/intl/[a-z]{{2}}|//[^/]+/(?:{LANGUAGE_DIRECTORIES})/")
    return F.coalesce(hl | path, F.lit(False))


def deprecated_claim(text: Column) -> Column:
    """P-12: speaks of a feature that is gone without saying so."""
    return F.coalesce(text.rlike(DEPRECATED) & ~text.rlike(DEPRECATION_NOTICE), F.lit(False))


def backfill_candidate(authoritative: list[str] | None = None) -> Column:
    """P-15: of an authoritative organisation (any if none are given), with an embedding, a URL of fewer than four slashes
    and no exact provenance."""
    ok = F.col("embedding").isNotNull() & (specificity(F.col("source_url")) < 4) & ~F.coalesce("url_provenance", F.lit("")).rlike("exact|exact-upgrade|doc-join")
    return ok & F.col("source_org").isin(*authoritative) if authoritative is not None else ok & F.col("source_org").isNotNull()


def quality_gate(rules: DataFrame, source_text: str = "text", least: float = 0.6, excerpt_chars: int = 12) -> DataFrame:
    """P-11, P-12: adds kept, reject_reason (the first check that failed), confidence, new_status and excerpt.

    A rule needs name, condition and action, a confidence of at least `least` (unreadable, null and NaN count as 0) and
    an excerpt of at least `excerpt_chars` squeezed characters that occurs word for word, case included, in the squeezed
    text of its source; a null text contains nothing. There is no upper bound of the confidence."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    conf = F.coalesce(F.nanvl(F.col("confidence_score").try_cast("double"), F.lit(0.0)), F.lit(0.0))
    excerpt = strip(F.coalesce("source_excerpt", F.lit("")))
    norm = squeeze(F.col("source_excerpt"))
    reason = (
        F.when(~filled("name") | ~filled("if_condition") | ~filled("then_logic"), "incomplete")
        .when(conf < least, "confidence")
        .when(F.length(norm) < excerpt_chars, "short excerpt")
        .when(~F.contains(squeeze(F.col(source_text)), norm), "not verbatim")
    )
    claim = deprecated_claim(F.concat_ws(" ", "name", "if_condition", "then_logic"))
    said = rule_status(F.col("status"))
    return rules.withColumns({
        "kept": reason.isNull(), "reject_reason": reason, "confidence": conf, "excerpt": F.left(excerpt, F.lit(1000)),
        "new_status": F.when((said == "active") & claim, "deprecated").otherwise(said),
    })


def observation_gate(obs: DataFrame, prevalence: float = 0.7, sessions: int = 3) -> DataFrame:
    """P-13, F-12, F-25: adds reject_reason (null if accepted), ratio, confidence and tag to observations whose
    prevalence is a struct of n, m and sessions. Text counts only if it is a whole number of at most 18 digits ('3.7', 'nan'
    and '1e30' are invalid); numbers lose their fraction, those that are not finite are invalid; missing sessions are 0."""
    types = {f.name: f.dataType.simpleString() for f in obs.schema["prevalence"].dataType}

    def whole(name: str) -> Column:
        c = F.col(f"prevalence.{name}")
        if types[name] in ("double", "float") or types[name].startswith("decimal"):
            return F.when(F.abs(c.cast("double")) < 1e18, c.try_cast("bigint"))
        t = strip(c.cast("string"))
        return F.when(t.rlike(r"\A[+-]?[0-9]{1,18}\z"), t.try_cast("bigint"))

    n, m, s = whole("n"), whole("m"), F.coalesce(whole("sessions"), F.when(F.col("prevalence.sessions").isNull(), 0))
    filled = lambda c: strip(F.coalesce(c, F.lit(""))) != ""
    ratio = n / F.nullif(m, F.lit(0))
    reason = (
        F.when(~filled("name") | ~filled("if_condition") | ~filled("then_logic"), "missing text")
        .when(n.isNull() | m.isNull() | s.isNull(), "invalid prevalence")
        .when((m <= 0) | (n < 0) | (n > m), "implausible prevalence")
        .when(ratio < prevalence, "rare")
        .when(s < sessions, "few sessions")
    )
    return obs.withColumns({"reject_reason": reason, "ratio": F.round(ratio, 3), "confidence": F.when(reason.isNull(), prevalence_confidence(n, m)), "tag": F.coalesce(observation_tag(F.col("domain_tag")), F.lit("general"))})
