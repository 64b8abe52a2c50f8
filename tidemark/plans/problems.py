"""Core data-quality queries (problems 1 and 7) and their SQL for the side-by-side check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality_profile, snapshot_diff
from ..session import table

DOCUMENT_PATTERNS = {"lang": "[a-z]{2}", "source": "[a-z]+(-[a-z]+)*", "domain_tag": "[a-z]+"}


def _whole(df: DataFrame, load: Column, patterns: dict | None, ranges: dict | None) -> DataFrame:
    """The profile of every column of a table."""
    p = quality_profile.profile_table(df, load, quality_profile.columns(df, patterns, ranges))
    return p.select(F.col("load").cast("string").alias("load"), "field", "n_rows", "n_missing", "n_distinct", "n_invalid", "top_count", "top_value", "min_value", "max_value", "min_number", "max_number", "median_valid")


def _exact(vector: Column) -> Column:
    """A vector as text that gives every number exactly, in hexadecimal; the decimal digits of JSON differ between versions of Java."""
    return F.concat(F.lit("["), F.array_join(F.transform(vector, lambda x: F.coalesce(F.format_string("%a", x), F.lit("null"))), ","), F.lit("]"))


def _rules_whole(rules: DataFrame) -> DataFrame:
    """The profile of every column and every row of rules; rows without a run are the load `none`."""
    return _whole(rules.withColumn("embedding", _exact(F.col("embedding"))), F.coalesce(F.col("run_id").cast("string"), F.lit("none")), None, None)


QUERIES = {
    "p1_found": lambda s, d: quality_profile.found(table(s, d, "rules")),
    "p1_profile": lambda s, d: quality_profile.profile(table(s, d, "rules")).select(
        "run_id", "field", "n_rows", "n_missing", "n_distinct", "n_invalid", "top_count", "min_value", "max_value", "top_value", "median_valid"
    ),
    "p1_documents": lambda s, d: _whole(table(s, d, "documents"), F.coalesce("lang", F.lit("none")), DOCUMENT_PATTERNS, {"n_chars": (0, 1e6)}),
    "p1_rules": lambda s, d: _whole(table(s, d, "rules").drop("embedding"), F.col("run_id"), None, None),
    # p1_rules gives what its SQL asks for: all columns but embedding, of the rows that have a run
    "p1_rules_whole": lambda s, d: _rules_whole(table(s, d, "rules")),
    "p1_documents_drift": lambda s, d: quality_profile.drift_table(table(s, d, "documents"), F.coalesce("lang", F.lit("none"))),
    "p1_drift": lambda s, d: quality_profile.drift(table(s, d, "rules")),
    "p7_found": lambda s, d: snapshot_diff.found(table(s, d, "url_state")),
}

_CHECKED = r"""
checked AS (
  SELECT id, run_id, 'source_url' AS field, nullif(source_url, '') AS value,
         regexp_full_match(source_url, '(?is)https?://[a-z0-9\-]+(\.[a-z0-9\-]+)+(:[0-9]+)?([/?#][^\s<>"]*)?') AS valid FROM rules
  UNION ALL
  SELECT id, run_id, 'confidence_score', nullif(confidence_score, ''),
         regexp_full_match(confidence_score, '[0-9]+(\.[0-9]+)?') AND try_cast(confidence_score AS DOUBLE) <= 1 FROM rules
  UNION ALL
  SELECT id, run_id, 'last_verified', strftime(last_verified::TIMESTAMPTZ AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f'),
         last_verified >= created_at AND (last_verified::TIMESTAMPTZ AT TIME ZONE 'UTC') <= TIMESTAMP '2026-01-01 00:00:00' FROM rules
),
counts AS (
  SELECT run_id, field, value, count(*) AS n, sum(CASE WHEN valid THEN 1 ELSE 0 END) AS n_valid
  FROM checked WHERE run_id IS NOT NULL GROUP BY ALL
),
med AS (
  SELECT run_id, field, median(value::DOUBLE) AS median_valid FROM checked
  WHERE field = 'confidence_score' AND valid AND run_id IS NOT NULL GROUP BY ALL
),
prof AS (
  SELECT run_id, field, sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (value IS NULL), 0)::BIGINT AS n_missing,
         count(value) AS n_distinct, (coalesce(sum(n) FILTER (value IS NOT NULL), 0) - sum(n_valid))::BIGINT AS n_invalid,
         (max(n) FILTER (value IS NOT NULL))::BIGINT AS top_count, min(value) AS min_value, max(value) AS max_value,
         first(value ORDER BY n DESC, value) FILTER (value IS NOT NULL) AS top_value
  FROM counts GROUP BY ALL
)"""



def _columns(t: str, load: str, kinds: dict[str, str], patterns: dict, ranges: dict) -> str:
    """(load, field, value, valid, x) of every column, by kind: text, number or time."""
    parts = []
    for c, kind in kinds.items():
        v = {"number": f"{c}::VARCHAR", "time": f"strftime({c}::TIMESTAMPTZ AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f')"}.get(kind, f"nullif({c}, '')")
        if kind == "text" and c not in patterns:
            v = f"CASE WHEN len({v}) > 512 THEN left({v}, 200) || '…' || sha256({v}) ELSE {v} END"
        ok = f"regexp_full_match({c}, '{patterns[c]}')" if c in patterns else f"{c} BETWEEN {ranges[c][0]} AND {ranges[c][1]}" if c in ranges else "true"
        parts.append(f"SELECT {load} AS load, '{c}' AS field, {v} AS value, coalesce({v} IS NOT NULL AND {ok}, false) AS valid, {f'CASE WHEN {ok} THEN {c}::DOUBLE END' if kind == 'number' else 'NULL::DOUBLE'} AS x FROM {t}")
    return "v AS (" + " UNION ALL ".join(parts) + ")"


_PROFILED = """, c AS (SELECT load, field, value, count(*) AS n, count(*) FILTER (valid) AS ok FROM v WHERE load IS NOT NULL GROUP BY ALL),
m AS (SELECT load, field, median(x) AS median_valid, min(x) AS min_number, max(x) AS max_number FROM v GROUP BY ALL),
p AS (SELECT load, field, sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (value IS NULL), 0)::BIGINT AS n_missing, count(value) AS n_distinct, coalesce(sum(n - ok) FILTER (value IS NOT NULL), 0)::BIGINT AS n_invalid,
  (max(n) FILTER (value IS NOT NULL))::BIGINT AS top_count, first(value ORDER BY n DESC, value) FILTER (value IS NOT NULL) AS top_value, min(value) AS min_value, max(value) AS max_value FROM c GROUP BY ALL)
SELECT p.* REPLACE (load::VARCHAR AS load), min_number, max_number, median_valid FROM p LEFT JOIN m USING (load, field)"""
_DOCUMENTS = {"doc_id": "number", "text": "text", "lang": "text", "source": "text", "n_chars": "number", "title": "text", "source_url": "text", "domain_tag": "text", "created_at": "time"}
_RULES = {c: "text" for c in ("id", "name", "rule_type", "if_condition", "then_logic", "domain_tag", "confidence_score", "source_refs_json", "status", "source_org", "source_url", "document_id", "rule_key", "superseded_by", "url_provenance", "source_excerpt", "source_content_hash", "provenance_status")}
_RULES |= {"created_at": "time", "extracted_at": "time", "last_verified": "time", "run_id": "number"}
# `rules` with embedding as `_exact` writes it
_RULES_EXACT = r"""(SELECT * REPLACE ('[' || array_to_string(list_transform(embedding, lambda x: CASE WHEN x IS NULL THEN 'null' WHEN isnan(x) THEN 'NaN' WHEN isinf(x) THEN CASE WHEN x > 0 THEN 'Infinity' ELSE '-Infinity' END
  ELSE regexp_replace(replace(printf('%a', x::DOUBLE), 'p+', 'p'), '^(-?0x[01])p', '\1.0p') END), ',') || ']' AS embedding) FROM rules)"""

ORACLES = {
    "p1_documents": "WITH " + _columns("documents", "coalesce(lang, 'none')", _DOCUMENTS, DOCUMENT_PATTERNS, {"n_chars": (0, 1e6)}) + _PROFILED,
    "p1_rules": "WITH " + _columns("rules", "run_id", _RULES, {}, {}) + _PROFILED,
    "p1_rules_whole": "WITH " + _columns(_RULES_EXACT, "coalesce(run_id::VARCHAR, 'none')", _RULES | {"embedding": "text"}, {}, {}) + _PROFILED,
    "p1_documents_drift": "WITH " + _columns("documents", "coalesce(lang, 'none')", _DOCUMENTS, {}, {}) + """,
span AS (SELECT field, min(x) AS lo, max(x) AS hi FROM v GROUP BY 1),
k AS (SELECT load, field, CASE WHEN value IS NULL THEN 'missing' WHEN x IS NOT NULL THEN least(19, CASE WHEN hi > lo THEN floor((x - lo) * 20 / (hi - lo))::BIGINT ELSE 0 END)::VARCHAR ELSE left(value, 2) END AS kind FROM v JOIN span USING (field)),
per AS (SELECT load, field, kind, count(*) AS n FROM k GROUP BY ALL), kinds AS (SELECT field, kind, sum(n) AS all_n FROM per GROUP BY ALL), loads AS (SELECT load, field, sum(n) AS load_n FROM per GROUP BY ALL),
grid AS (SELECT l.load, l.field, load_n, coalesce(n, 0) AS n, all_n, count(*) OVER w AS k, sum(all_n) OVER w AS total FROM loads l JOIN kinds USING (field) LEFT JOIN per USING (load, field, kind) WINDOW w AS (PARTITION BY l.load, l.field)),
pq AS (SELECT load, field, load_n::DOUBLE AS load_n, (n + 0.5)::DOUBLE / (load_n + 0.5 * k)::DOUBLE AS p, (all_n - n + 0.5)::DOUBLE / (total - load_n + 0.5 * k)::DOUBLE AS q FROM grid)
SELECT load, field, round(sum((p - q) * ln(p / q)), 4) AS psi, round(sum(load_n * (p - q) * (p - q) / q), 2) AS chi2, count(*) AS classes FROM pq GROUP BY ALL""",
    "p1_profile": f"""WITH {_CHECKED}
SELECT p.*, m.median_valid FROM prof p LEFT JOIN med m USING (run_id, field)""",
    "p1_found": f"""WITH {_CHECKED},
figures AS (
  SELECT run_id, field, 'missing' AS figure, n_missing / n_rows AS x FROM prof
  UNION ALL SELECT run_id, field, 'top', coalesce(top_count, 0) / n_rows FROM prof
  UNION ALL SELECT run_id, field, 'median', median_valid FROM med
),
others AS (
  SELECT a.run_id, a.field, a.figure, any_value(a.x) AS x, median(b.x) AS m
  FROM figures a JOIN figures b ON a.field = b.field AND a.figure = b.figure AND a.run_id <> b.run_id GROUP BY ALL
)
SELECT field, 'value' AS case_kind, id AS case_key FROM checked WHERE value IS NOT NULL AND NOT coalesce(valid, false)
UNION ALL
SELECT DISTINCT field, 'load', run_id::VARCHAR FROM others WHERE abs(x - m) >= 0.2 - 1e-9""",
    "p1_drift": f"""WITH {_CHECKED},
v AS (
  SELECT run_id, field, CASE WHEN value IS NULL THEN 'missing' WHEN NOT coalesce(valid, false) THEN 'invalid' WHEN field = 'confidence_score' THEN floor(value::DOUBLE * 20)::BIGINT::VARCHAR
    WHEN field = 'last_verified' THEN left(value, 7) ELSE lower(split_part(value, ':', 1)) || '/' || least(9, len(string_split(value, '/')))::VARCHAR END AS kind
  FROM checked WHERE run_id IS NOT NULL
),
per AS (SELECT run_id, field, kind, count(*) AS n FROM v GROUP BY ALL),
kinds AS (SELECT field, kind, sum(n) AS all_n FROM per GROUP BY ALL),
loads AS (SELECT run_id, field, sum(n) AS load_n FROM per GROUP BY ALL),
grid AS (
  SELECT l.run_id, l.field, load_n, coalesce(n, 0) AS n, all_n, count(*) OVER w AS k, sum(all_n) OVER w AS total
  FROM loads l JOIN kinds USING (field) LEFT JOIN per USING (run_id, field, kind) WINDOW w AS (PARTITION BY l.run_id, l.field)
),
pq AS (SELECT run_id, field, load_n::DOUBLE AS load_n, (n + 0.5)::DOUBLE / (load_n + 0.5 * k)::DOUBLE AS p, (all_n - n + 0.5)::DOUBLE / (total - load_n + 0.5 * k)::DOUBLE AS q FROM grid)
SELECT run_id, field, round(sum((p - q) * ln(p / q)), 4) AS psi, round(sum(load_n * (p - q) * (p - q) / q), 2) AS chi2, count(*) AS classes FROM pq GROUP BY ALL""",
    "p7_found": r"""WITH u AS (
  SELECT snapshot_no, regexp_replace(trim(url), '#.*$', '') AS u, lower(content_hash) AS h, last_seen_at FROM url_state WHERE url IS NOT NULL
),
parts AS (
  SELECT *, regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS scheme, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*:([^?]*)', 1) AS rest,
         list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_full_match(split_part(x, '=', 1), '(?i)hl|utm_[a-z]+|gclid|fbclid')) AS kept
  FROM u
),
page AS (
  SELECT snapshot_no, h, last_seen_at,
         lower(scheme) || ':' || CASE WHEN regexp_matches(rest, '^//[^/]+/*$') THEN regexp_replace(rest, '/*$', '/') ELSE regexp_replace(rest, '/+$', '') END
         || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url
  FROM parts
),
one AS (
  SELECT snapshot_no, url, h FROM page
  QUALIFY row_number() OVER (PARTITION BY snapshot_no, url ORDER BY last_seen_at DESC NULLS LAST, coalesce(h, '') DESC) = 1
),
pair AS (SELECT coalesce(b.snapshot_no, a.snapshot_no + 1) AS snapshot_no, coalesce(a.url, b.url) AS url,
                a.url IS NOT NULL AS was, b.url IS NOT NULL AS is_now, a.h AS old_hash, b.h AS new_hash
         FROM one a FULL JOIN one b ON a.url = b.url AND b.snapshot_no = a.snapshot_no + 1)
SELECT snapshot_no::INTEGER AS snapshot_no, url, CASE WHEN NOT was THEN 'new' WHEN NOT is_now THEN 'removed' ELSE 'modified' END AS change_type
FROM pair
WHERE snapshot_no BETWEEN (SELECT min(snapshot_no) + 1 FROM url_state) AND (SELECT max(snapshot_no) FROM url_state)
  AND (NOT was OR NOT is_now OR old_hash <> new_hash)""",
}
