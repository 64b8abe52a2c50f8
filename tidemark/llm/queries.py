"""Registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import table
from . import boilerplate, language, names, neighbors, packing, reading, survivor, tokens

QUERIES = {
    "p2_found": lambda s, d: boilerplate.found(table(s, d, "changed_urls")),
    "p3_found": lambda s, d: names.found(*(table(s, d, t) for t in ("rules", "org_aliases", "source_registry"))),
    "p4_found": lambda s, d: language.found(*(table(s, d, t) for t in ("changed_urls", "rules", "documents"))),
    "p5_found": lambda s, d: survivor.found(table(s, d, "rules")),
    "p5_golden": lambda s, d: survivor.golden(table(s, d, "rules")),
    "p6_found": lambda s, d: neighbors.found(table(s, d, "rules")),
    "p8_ids": lambda s, d: tokens.encode(table(s, d, "documents")),
    "p8_roundtrip": lambda s, d: tokens.decode(tokens.encode(table(s, d, "documents"))).select("doc_id", F.sha2("text", 256).alias("text_hash")),
    "p9_checks": lambda s, d: packing.check_documents(table(s, d, "documents")),
    "p9_containers": lambda s, d: packing.pack_documents(table(s, d, "documents")),
    "p10_found": lambda s, d: reading.grade(table(s, d, "documents"), table(s, d, "reading_labels")),
}

_SPACE = "' ' || " + " || ".join(f"chr({c})" for c in (9, 10, 11, 12, 13, 133, 160))
_P5 = rf"""
keyed AS (
  SELECT *, coalesce(nullif(rule_key, ''), 'rk_' || left(sha256(lower(trim(coalesce(name, ''), {_SPACE})) || '|' || lower(trim(coalesce(if_condition, ''), {_SPACE}))), 20)) AS k,
    coalesce(regexp_full_match(source_url, '(?is)https?://[a-z0-9\-]+(\.[a-z0-9\-]+)+(:[0-9]+)?([/?#][^\s<>"]*)?'), false) AS url_ok,
    coalesce(regexp_full_match(confidence_score, '[0-9]+(\.[0-9]+)?') AND try_cast(confidence_score AS DOUBLE) <= 1, false) AS conf_ok,
    coalesce(last_verified >= created_at AND (last_verified::TIMESTAMPTZ AT TIME ZONE 'UTC') <= TIMESTAMP '2026-01-01 00:00:00', false) AS seen_ok,
    len(rtrim(source_url, '/')) - len(replace(rtrim(source_url, '/'), '/', '')) AS slashes
  FROM rules
)"""

ORACLES: dict[str, str] = {
    "p6_found": """WITH v AS (SELECT DISTINCT id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM rules WHERE id IS NOT NULL AND len(embedding) = 64 AND NOT list_bool_or(list_transform(embedding, lambda x: isnan(x))) AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
p AS (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.e, b.e) AS sim FROM v a JOIN v b ON a.id <> b.id),
n AS (SELECT a, b FROM p WHERE sim >= 0.85 QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) <= 10)
SELECT DISTINCT least(a, b) AS id_a, greatest(a, b) AS id_b FROM n""",
    "p8_roundtrip": "SELECT doc_id, sha256(coalesce(text, '')) AS text_hash FROM documents",
    "p9_checks": "SELECT count(*) AS docs, 0::BIGINT AS over, 0::BIGINT AS torn, 0::BIGINT AS overlapping FROM documents",
    "p5_found": f"""WITH {_P5}
SELECT k AS rule_key, first(id ORDER BY slashes DESC, id) FILTER (url_ok) AS url_id,
  first(id ORDER BY (coalesce(provenance_status, '') = 'verified_excerpt') DESC, extracted_at DESC NULLS LAST, id) FILTER (conf_ok) AS score_id,
  first(id ORDER BY last_verified DESC, id) FILTER (seen_ok) AS verified_id
FROM keyed GROUP BY k HAVING count(*) >= 2""",
    "p5_golden": f"""WITH {_P5},
u AS (
  SELECT k, 'source_url' AS field, CASE WHEN url_ok THEN lower(regexp_extract(trim(source_url), '^[^/]*//[^/?#]*')) || regexp_replace(substr(trim(source_url), len(regexp_extract(trim(source_url), '^[^/]*//[^/?#]*')) + 1), '/+$', '') END AS norm, provenance_status, extracted_at FROM keyed
  UNION ALL SELECT k, 'confidence_score', CASE WHEN conf_ok THEN confidence_score::DOUBLE::VARCHAR END, provenance_status, extracted_at FROM keyed
  UNION ALL SELECT k, 'last_verified', CASE WHEN seen_ok THEN strftime(last_verified::TIMESTAMPTZ AT TIME ZONE 'UTC', '%Y-%m-%d') END, provenance_status, extracted_at FROM keyed
),
w AS (
  SELECT *, CASE provenance_status WHEN 'verified_excerpt' THEN 1.0 WHEN 'observed' THEN 0.6 WHEN 'source_change_pending' THEN 0.5 WHEN 'unverified' THEN 0.4 WHEN 'source_changed' THEN 0.2 ELSE 0.3 END::DOUBLE
    * pow(2.0::DOUBLE, -greatest(0, coalesce(epoch(TIMESTAMP '2026-01-01 00:00:00') - epoch_us(extracted_at) / 1000000.0::DOUBLE, 720.0 * 86400)) / 86400 / 180) AS vote FROM u
),
v AS (SELECT k, field, norm, round(sum(vote), 9) AS votes, count(*) AS n FROM w GROUP BY ALL),
b AS (SELECT k, field, first(norm ORDER BY votes DESC, norm DESC) FILTER (norm IS NOT NULL) AS best, sum(n)::BIGINT AS n FROM v GROUP BY ALL)
SELECT k AS rule_key, max(best) FILTER (field = 'source_url') AS source_url, max(best) FILTER (field = 'confidence_score') AS confidence_score, max(best) FILTER (field = 'last_verified') AS last_verified, max(n) AS n
FROM b GROUP BY k HAVING max(n) >= 2""",
}
