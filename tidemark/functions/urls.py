"""URL scalars, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

_SPLIT = r"(?s)\A(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(?:\?([^#]*))?"
# Query parameters that never tell pages apart.
JUNK_PARAM = r"(?i)\A(hl|utm_[a-z]+|gclid|fbclid)\z"
# Paths and queries that are never worth a fetch.
DENY_ROOT = (
    r"(?i)\A(?:/[^/]+)?/(?:login|signin|signup|register|account|dashboard|auth|404|about|advertising|careers|jobs"
    r"|privacy|terms|legal|contact|newsletter)(?:[/?#]|\z)"
)
DENY_PATH = (
    r"(?i)\.(?:pdf|jpg|jpeg|png|gif|svg|webp|mp4|mp3|zip|tar|gz|css|js)\z|/page/\d|/tags?/|/tags?\z|/category/"
    r"|/feed/?\z|/rss/?\z|\.atom\z"
)
DENY_QUERY = r"(?i)(?:^|&)(?:q|search)=|(?:^|&)page=\d"


def parts(url: Column) -> dict[str, Column]:
    u = strip(url)
    scheme, netloc, path, query = (F.regexp_extract(u, _SPLIT, i) for i in (1, 2, 3, 4))
    return {"scheme": F.lower(scheme), "netloc": netloc, "path": path, "query": query}


def _form(c: Column, decode: bool) -> Column:
    if decode:
        return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def normalize_url(url: Column) -> Column:
    """F-1: one spelling per page. Trims, lower-cases the scheme (not the host), drops the fragment and junk
    parameters, re-encodes the rest in order, and removes trailing slashes of the path. Null stays null."""
    p = parts(url)
    pairs = F.filter(F.split(p["query"], "&"), lambda x: x != "")
    kv = F.transform(
        pairs,
        lambda x: F.struct(
            _form(F.substring_index(x, "=", 1), True).alias("k"),
            _form(F.when(F.locate("=", x) > 0, F.regexp_replace(x, r"(?s)\A[^=]*=", "")).otherwise(""), True).alias("v"),
        ),
    )
    kept = F.filter(kv, lambda t: ~t["k"].rlike(JUNK_PARAM))
    query = F.array_join(F.transform(kept, lambda t: F.concat(_form(t["k"], False), F.lit("="), _form(t["v"], False))), "&")
    query = F.when(p["query"] == "", "").otherwise(query)
    path = F.regexp_replace(p["path"], r"/+\z", "")
    return F.concat(
        F.when(p["scheme"] != "", F.concat(p["scheme"], F.lit(":"))).otherwise(""),
        p["netloc"],
        F.when(path == "", "/").otherwise(path),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )


def deny_reason(url: Column) -> Column:
    """P-8: which global rule bars the URL (root, path or query), null if none does."""
    p = parts(url)
    return (
        F.when(p["path"].rlike(DENY_ROOT), "root")
        .when(p["path"].rlike(DENY_PATH), "path")
        .when(p["query"].rlike(DENY_QUERY), "query")
    )


def url_allowed(url: Column, url_filter: Column | None = None) -> Column:
    """P-8: not barred, and the source's own path pattern (if any) is found in the path. Patterns must have been
    checked by valid_pattern, which turns unusable ones into null (no filter)."""
    ok = deny_reason(url).isNull()
    if url_filter is not None:
        ok = ok & (F.coalesce(url_filter, F.lit("")).eqNullSafe("") | F.coalesce(F.regexp_like(parts(url)["path"], url_filter), F.lit(False)))
    return ok


def valid_pattern(pattern: Column) -> Column:
    """P-8: a pattern if the JVM can compile it, else null, which means no filter. For columns of small tables: it is
    compiled by reflection."""
    return F.when(pattern != "", F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), pattern))


def host(url: Column) -> Column:
    """F-13: host without scheme and www., lower case; everything before the first slash."""
    return F.lower(F.substring_index(F.regexp_replace(url, r"(?i)\Ahttps?://(www\.)?", ""), "/", 1))


def org_key(org: Column) -> Column:
    """F-14: leading www. and a common ending removed, then lower case."""
    return F.lower(F.regexp_replace(org, r"^(www\.)|\.(com|io|org|ai|co|dev)$", ""))


def specificity(url: Column) -> Column:
    """F-3: number of slashes, -1 for null or ''."""
    c = F.coalesce(url, F.lit(""))
    return F.when(c == "", -1).otherwise(F.length(c) - F.length(F.replace(c, F.lit("/"), F.lit(""))))


def specificity_upsert(url: Column) -> Column:
    """F-4: like F-3 after trailing slashes are dropped; 0 for null or ''."""
    c = F.regexp_replace(F.coalesce(url, F.lit("")), r"/+\z", "")
    return F.length(c) - F.length(F.replace(c, F.lit("/"), F.lit("")))


def url_tail(url: Column) -> Column:
    """F-21: the last path segment."""
    return F.element_at(F.split(F.regexp_replace(url, r"/+\z", ""), "/"), -1)


#: A usable web address: http(s), a host of letters, digits and hyphens with a dot, an optional port, a clean rest.
VALID_URL = r"(?i)\Ahttps?://[a-z0-9\-]+(\.[a-z0-9\-]+)+(:[0-9]+)?([/?#][^\s<>\"]*)?\z"


def valid_url(url: Column) -> Column:
    return F.coalesce(url.rlike("(?U)" + VALID_URL), F.lit(False))
