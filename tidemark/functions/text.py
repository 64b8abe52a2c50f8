
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space as the str.strip() of the reference language sees it.
_WS = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    """Trim every kind of Unicode white space at both ends; null stays null."""
    return F.regexp_replace(c, rf"(?U)\A{_WS}+|{_WS}+\z", "")


def squeeze(c: Column) -> Column:
    """F-7: collapse runs of white space to one space and trim; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?U){_WS}+", " "))


def content_hash(c: Column) -> Column:
    """F-2: sha256 hex of the squeezed text; null and '' hash alike."""
    return F.sha2(squeeze(c), 256)


def rule_key(name: Column, if_condition: Column) -> Column:
    """F-6: 'rk_' and 20 hex digits of sha256(lower(strip(name)) | lower(strip(if))); null counts as ''."""
    part = lambda c: F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.concat(F.lit("rk_"), F.left(F.sha2(F.concat(part(name), F.lit("|"), part(if_condition)), 256), F.lit(20)))


# Fixed value: what sets a site's name off from the title of a page.
TITLE_SUFFIX = r"\s*[|–—-]\s{0,2}(?=[A-Z])"
# The tags an observation may have.
TAGS = ("seo", "aeo", "geo", "entity", "content", "performance", "general")


def page_title(html: Column) -> Column:
    """F-5: the first <title>, squeezed, cut before the site suffix, at most 200 characters; '' for null."""
    whole = squeeze(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    head = F.split(whole, TITLE_SUFFIX)[0]
    return F.left(F.when(head != "", head).otherwise(whole), F.lit(200))


def main_text(html: Column) -> Column:
    """S-16: script and style blocks, then tags, each replaced by one space; entities stay as they are."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script.*?</script>|<style.*?</style>", " ")
    return squeeze(F.regexp_replace(bare, r"(?s)<[^>]+>", " "))


def chunks(c: Column, size: int = 12000, least: int = 6000) -> Column:
    """F-9: at most two chunks; the first ends at the last newline before `size` if that lies beyond
    `least`; what follows the second chunk is dropped, as in the contract. Null gives null."""
    head = F.left(c, F.lit(size))
    p = F.locate("\n", F.reverse(head))
    at = F.when(p == 0, -1).otherwise(F.lit(size) - p)
    cut = F.when(at > least, at).otherwise(size)
    two = F.array(F.left(c, cut), F.substring(c, cut + 1, F.lit(size)))
    return F.when(F.length(c) <= size, F.array(c)).when(F.length(c) > size, two)


# Terms that show that a page speaks of how sites are found.
RELEVANCE = (
    r"seo\b|search engine|search ranking|google search|googlebot|bingbot|crawl|index(?:ing|ation)|structured data|schema\.org|json-ld|sitemap|robots\.txt"
    r"|meta description|title tag|\bsnippets?\b|canonical|core web vitals|page experience|\blcp\b|\binp\b|\bcls\b|page ?speed|lighthouse|mobile-friendly"
    r"|ranking|\bserp\b|redirects?\b|rich results?|alt (?:text|attribute)|open graph|\bog:|answer engine|ai overview|featured snippet"
    r"|knowledge (?:graph|panel)|llms?\.txt|gptbot|ai crawler|citation|e-?e-?a-?t|hreflang|backlink"
)


def relevance_hits(c: Column, pattern: str = RELEVANCE) -> Column:
    """P-10: number of distinct lower-cased matches of pattern (one capturing group is not needed)."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"(?i){pattern}"), F.lit(0))
    return F.size(F.array_distinct(F.transform(found, F.lower)))


def rule_status(c: Column) -> Column:
    """F-8: deprecated for the three words that say so, active otherwise, null included."""
    said = F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.when(said.isin("deprecated", "retired", "sunset"), "deprecated").otherwise("active")


def refs(document_id: Column) -> Column:
    """F-22: the reference list of a rule, a JSON list of its document's id; null for none."""
    return F.concat(F.lit("["), document_id, F.lit("]"))


def embed_text_batch(*cols: Column) -> Column:
    """F-15: parts joined by single spaces, empty slots kept, 6000 characters, stripped, ' ' if nothing is left."""
    joined = cols[0] if len(cols) == 1 else F.concat(*[x for c in cols for x in (F.coalesce(c, F.lit("")), F.lit(" "))][:-1])
    out = strip(F.left(joined, F.lit(6000)))
    return F.when(F.coalesce(out, F.lit("")) == "", " ").otherwise(out)


def embed_text_cycle(*cols: Column) -> Column:
    """F-16: non-empty parts joined by ' | ', 4000 characters."""
    kept = F.filter(F.array(*[F.coalesce(c, F.lit("")) for c in cols]), lambda x: x != "")
    return F.left(F.array_join(kept, " | "), F.lit(4000))


def numeric_at_least(c: Column, least: float) -> Column:
    """P-4: text that is digits with an optional fraction and at least `least`; never null."""
    ok = c.rlike(r"\A[0-9]+(\.[0-9]+)?\z") & (c.try_cast("decimal(38,18)") >= F.lit(least).cast("decimal(38,18)"))
    return F.coalesce(ok, F.lit(False))


def prevalence_confidence(n: Column, m: Column) -> Column:
    """F-12: round(min(0.84, 0.5 + 0.4 n/m), 2), halves up."""
    return F.round(F.least(F.lit(0.84), F.lit(0.5) + F.lit(0.4) * n / m), 2)


def observation_tag(c: Column) -> Column:
    """F-25: a known lower-cased tag, else general."""
    t = F.lower(c)
    return F.when(t.isin(*TAGS), t).otherwise("general")
