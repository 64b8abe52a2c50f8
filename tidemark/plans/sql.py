"""SQL of the core queries for the side-by-side check. Written for DuckDB; the Spark code is not derived from it."""

from __future__ import annotations

NOW = "TIMESTAMP '2026-01-01 00:00:00'"


def utc(c: str) -> str:
    """A time stamp as UTC without a zone."""
    return f"({c}::TIMESTAMPTZ AT TIME ZONE 'UTC')"


def text(c: str) -> str:
    return f"strftime({utc(c)}, '%Y-%m-%d %H:%M:%S')"


# Terms that show that a page speaks of how sites are found.
RELEVANCE = (
    r"seo\b|search engine|search ranking|google search|googlebot|bingbot|crawl|index(?:ing|ation)|structured data|schema\.org|json-ld|sitemap|robots\.txt"
    r"|meta description|title tag|\bsnippets?\b|canonical|core web vitals|page experience|\blcp\b|\binp\b|\bcls\b|page ?speed|lighthouse|mobile-friendly"
    r"|ranking|\bserp\b|redirects?\b|rich results?|alt (?:text|attribute)|open graph|\bog:|answer engine|ai overview|featured snippet"
    r"|knowledge (?:graph|panel)|llms?\.txt|gptbot|ai crawler|citation|e-?e-?a-?t|hreflang|backlink"
)
WS = " || ".join(["' '", *[f"chr({c})" for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 133, 160)]])
UNI = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def squeeze(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{UNI}+', ' ', 'g'))"


# Query parameters that never tell pages apart, paths and queries never worth a fetch, language directories.
JUNK_PARAMS = "hl|utm_[a-z]+|gclid|fbclid"
DENIED_FIRST = "login|signin|signup|register|account|dashboard|auth|404|about|advertising|careers|jobs|privacy|terms|legal|contact|newsletter"
DENIED_PATH = "\\.(?:pdf|jpg|jpeg|png|gif|svg|webp|mp4|mp3|zip|tar|gz|css|js)$|/page/[0-9]|/tags?/|/tags?$|/category/|/feed/?$|/rss/?$|\\.atom$"
LANGUAGES = "zh-tw|zh-cn|zh-hans|zh-hant|ja|ko|de|es|fr|pt-br|ru|it|pl|tr|id|vi|th"
# Claims about features that are gone, and wording that says so.
GONE = "how-?to rich results?|how-?to (?:schema|markup|structured data)|faq(?:page)? rich results?"
NOTICE = (
    "no longer|do(?:es)?n''?t rely|do(?:es)? not rely|deprecat|discontinu|\\bretired\\b|\\bsunset|not (?:be )?supported|restricted to"
    "|stopp?ed (?:showing|supporting)|will not be shown|avoid(?:ing)? (?:relying|reliance)"
)
# Names that attribute a rule to nobody, states in which it may not be cited.
JUNK = "('', 'Personal Blog', 'Unknown', 'unattributed-legacy')"
NOT_CITABLE = "('rejected', 'retired', 'superseded', 'deprecated')"


def claim(t: str) -> str:
    return f"(regexp_matches({t}, '(?i){GONE}') AND NOT regexp_matches({t}, '(?i){NOTICE}'))"


def coded(c: str) -> str:
    """A part of a query string, decoded and encoded again."""
    return f"replace(url_encode(url_decode(replace({c}, '+', ' '))), '%20', '+')"


def norm(u: str) -> str:
    """F-1"""
    s = f"regexp_replace(trim({u}, {WS}), '#.*$', '', 's')"
    path = f"regexp_replace(regexp_replace({s}, '\\?.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*:', '')"
    scheme = f"lower(regexp_extract({s}, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1))"
    pairs = f"list_filter(string_split(regexp_extract({s}, '\\?(.*)$', 1, 's'), '&'), lambda x: x <> '')"
    named = f"list_filter({pairs}, lambda x: NOT regexp_full_match(url_decode(replace(split_part(x, '=', 1), '+', ' ')), '(?i){JUNK_PARAMS}'))"
    value = coded("CASE WHEN contains(x, '=') THEN substr(x, strpos(x, '=') + 1) ELSE '' END")
    kept = f"array_to_string(list_transform({named}, lambda x: {coded("split_part(x, '=', 1)")} || '=' || {value}), '&')"
    return f"""{scheme} || CASE WHEN regexp_full_match({path}, '(//[^/]*)?/*') THEN regexp_replace({path}, '^((//[^/]*)?)/*$', '\\1/') ELSE regexp_replace({path}, '/+$', '') END
      || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END"""


def path_of(u: str) -> str:
    return f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


def query_of(u: str) -> str:
    return f"regexp_extract({u}, '\\?([^#]*)', 1)"


def deny(u: str) -> str:
    return f"""CASE WHEN regexp_matches({path_of(u)}, '(?i)^(?:/[^/]+)?/(?:{DENIED_FIRST})(?:[/?#]|$)') THEN 'root'
      WHEN regexp_matches({path_of(u)}, '(?i){DENIED_PATH}') THEN 'path'
      WHEN regexp_matches({query_of(u)}, '(?i)(?:^|&)(?:q|search)=|(?:^|&)page=[0-9]') THEN 'query' END"""


LOCALE = f"""coalesce((regexp_matches(source_url, '(?i)[?&]hl=') AND NOT regexp_matches(source_url, '(?i)[?&]hl=en([-_&]|$)'))
  OR regexp_matches(source_url, '(?i)//[^/]+/intl/[a-z]{{2}}|//[^/]+/(?:{LANGUAGES})/')
  OR (regexp_matches(source_url, '(?i)//developer\\.mozilla\\.org/[a-z]{{2}}(?:-[a-z]{{2,4}})?/') AND NOT regexp_matches(source_url, '(?i)//developer\\.mozilla\\.org/en-US/')), false)"""
NUMERIC = "regexp_full_match(confidence_score, '[0-9]+(\\.[0-9]+)?') AND try_cast(confidence_score AS DOUBLE)"
CONTENT_HASH = f"sha256({squeeze('text')})"
FAITHFUL = "coalesce(status, 'active') = 'active' AND coalesce(provenance_status, '') = 'verified_excerpt' AND coalesce(source_excerpt, '') <> '' AND coalesce(source_content_hash, '') <> ''"
TRUSTED = f"{FAITHFUL} AND coalesce(rule_type, '') <> 'observed' AND coalesce({NUMERIC} >= 0.85, false) AND coalesce(source_org, '') NOT IN {JUNK}"
OVERDUE = f"(last_crawled_at IS NULL OR coalesce({utc('last_crawled_at')} < {NOW} - to_days(2 * crawl_cadence_days), false))"
CITABLE = f"coalesce(status, 'active') NOT IN {NOT_CITABLE} AND coalesce(url_provenance, '') NOT LIKE '%neighbor%'"
PCT_URL = "round(100.0 * count(*) FILTER (coalesce(source_url, '') <> '') / count(*), 1)::DOUBLE"
KEY = f"'rk_' || left(sha256(lower(trim(coalesce(name, ''), {WS})) || '|' || lower(trim(coalesce(if_condition, ''), {WS}))), 20)"
CHANGES = "changes AS (SELECT DISTINCT ON (change_id) * FROM ingest_changes)"
FAILURES = f"""failures AS (
  SELECT url, new_hash, sum(CASE WHEN extract_status IN ('failed', 'gave_up') OR (extract_status = 'detected' AND {utc('detected_at')} < {NOW} - INTERVAL 1 HOUR) THEN 1 ELSE 0 END)::BIGINT AS failures
  FROM changes WHERE url IS NOT NULL AND new_hash IS NOT NULL GROUP BY ALL HAVING failures > 0)"""
LAST = "(SELECT max(snapshot_no) FROM url_state)"
BEFORE = "(SELECT max(snapshot_no) FROM url_state WHERE snapshot_no < (SELECT max(snapshot_no) FROM url_state))"
PRIOR = f"""prior AS (
  SELECT {norm('url')} AS url, url AS raw, lower(content_hash) AS content_hash, last_seen_at, last_modified FROM url_state
  WHERE snapshot_no = {LAST}),
state AS (SELECT url, content_hash, last_seen_at FROM prior WHERE url IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY last_seen_at DESC NULLS LAST, raw DESC, coalesce(content_hash, '') DESC) = 1)"""
LISTED = f"""listed AS (
  SELECT source_id, loc, lastmod, row_number() OVER (PARTITION BY source_id ORDER BY loc) - 1 AS pos
  FROM (SELECT source_id, url AS loc, max(last_modified) AS lastmod FROM url_state WHERE snapshot_no = {LAST} AND url IS NOT NULL AND source_id IS NOT NULL GROUP BY ALL))"""
OFFSETS = "offsets AS (SELECT source_id, url_filter, adapter_type, try_cast(json_extract_string(crawl_cursor, '$.offset') AS BIGINT) AS off, try_cast(json_extract_string(crawl_cursor, '$.child') AS BIGINT) AS child FROM source_registry)"
TURNS = """turns AS (SELECT source_id, loc, lastmod, (((pos - coalesce(off, 0)) % n) + n) % n AS turn FROM (
  SELECT l.*, o.off, count(*) OVER (PARTITION BY l.source_id) AS n FROM listed l LEFT JOIN offsets o USING (source_id)))"""
RETRIES = """retries AS (
  SELECT source_id, url, row_number() OVER (PARTITION BY source_id ORDER BY url) AS nth FROM (
    SELECT source_id, url, first(extract_status ORDER BY change_id DESC) AS st FROM ingest_changes WHERE url IS NOT NULL AND source_id IS NOT NULL GROUP BY ALL)
  WHERE st = 'failed' QUALIFY nth <= 20)"""
VERSIONS = f"""versions AS (
  SELECT url, {squeeze('text')} AS body, sha256({squeeze('text')}) AS h FROM changed_urls WHERE url IS NOT NULL AND coalesce(text, '') <> ''
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY coalesce(run_id, 0) DESC, page_id DESC) = 1)"""
ALIAS = "al AS (SELECT alias, min(canonical_org) AS can FROM org_aliases WHERE alias IS NOT NULL AND canonical_org IS NOT NULL GROUP BY alias)"

ORACLES: dict[str, str] = {
    "page_change_detect": f"""WITH {PRIOR},
p AS (SELECT {norm('url')} AS norm_url, page_id, run_id, title, {CONTENT_HASH} AS h FROM changed_urls WHERE text IS NOT NULL AND url IS NOT NULL),
f AS (SELECT * FROM p WHERE {deny('norm_url')} IS NULL QUALIFY row_number() OVER (PARTITION BY norm_url ORDER BY coalesce(run_id, 0), page_id) = 1)
SELECT page_id, norm_url, title, h AS content_hash,
  CASE WHEN s.url IS NULL THEN 'new' WHEN s.content_hash = h THEN 'unchanged' ELSE 'modified' END AS change_type
FROM f LEFT JOIN state s ON s.url = norm_url""",
    "url_normalize": f"SELECT DISTINCT change_id, url, {norm('url')} AS norm_url FROM ingest_changes",
    "url_hygiene": f"""WITH u AS (SELECT DISTINCT source_id, {norm('url')} AS url FROM ingest_changes WHERE url IS NOT NULL)
SELECT source_id, url, {deny('url')} AS deny_reason,
  {deny('url')} IS NULL AND (coalesce(url_filter, '') = '' OR coalesce(regexp_matches({path_of('url')}, url_filter), false)) AS allowed
FROM u LEFT JOIN source_registry USING (source_id)""",
    "url_specificity": """SELECT id, CASE WHEN coalesce(source_url, '') = '' THEN -1 ELSE len(source_url) - len(replace(source_url, '/', '')) END::INTEGER AS spec_backfill,
  (len(rtrim(coalesce(source_url, ''), '/')) - len(replace(rtrim(coalesce(source_url, ''), '/'), '/', '')))::INTEGER AS spec_upsert,
  coalesce(lower(split_part(regexp_replace(source_url, '(?i)^https?://(www\\.)?', ''), '/', 1)), '') AS host,
  coalesce(list_extract(string_split(rtrim(source_url, '/'), '/'), -1), '') AS tail FROM rules""",
    "page_title": """WITH t AS (SELECT page_id, trim(regexp_replace(coalesce(title, '') || ' | ' || array_to_string(list_transform(string_split(source_id, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' '), '[\\s\\p{Z}]+', ' ', 'g')) AS w FROM changed_urls),
h AS (SELECT *, regexp_matches(w, '\\s*[|–—-]\\s{0,2}[A-Z]') AS cuts, regexp_extract(w, '^(.*?)\\s*[|–—-]\\s{0,2}[A-Z]', 1) AS head FROM t)
SELECT page_id, left(CASE WHEN NOT cuts OR head = '' THEN w ELSE head END, 200) AS title FROM h""",
    "page_main_text": f"""WITH h AS (SELECT page_id, '<html><style>p {{x: y}}</style><body><p>' || replace(text, chr(10), '</p><p class=''x''>') || '</p><script>let a = 1;</script></body></html>' AS h FROM changed_urls WHERE text IS NOT NULL),
t AS (SELECT page_id, {squeeze("regexp_replace(regexp_replace(h, '(?is)<script.*?</script>|<style.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g')")} AS t FROM h)
SELECT page_id, len(t)::INTEGER AS n_chars, sha256(t) AS text_hash FROM t""",
    "doc_content_hash": f"SELECT doc_id, {CONTENT_HASH} AS content_hash FROM documents",
    "doc_dedupe_first": f"SELECT {CONTENT_HASH} AS content_hash, min(doc_id) AS doc_id, count(*) AS dup_count FROM documents GROUP BY 1",
    "relevance_screen": f"""WITH h AS (SELECT doc_id, len(list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '(?i){RELEVANCE}', 0), lambda x: lower(x))))::INTEGER AS hits FROM documents)
SELECT doc_id, hits, hits >= 2 AS relevant FROM h""",
    "doc_chunks": """WITH c AS (SELECT doc_id, text, left(text, 12000) AS a FROM documents WHERE text IS NOT NULL),
p AS (SELECT *, CASE WHEN strpos(reverse(a), chr(10)) = 0 THEN -1 ELSE 12000 - strpos(reverse(a), chr(10)) END AS nl FROM c),
k AS (SELECT *, CASE WHEN nl > 6000 THEN nl ELSE 12000 END AS cut FROM p),
parts AS (SELECT doc_id, 0 AS chunk_no, CASE WHEN len(text) <= 12000 THEN text ELSE left(text, cut) END AS chunk FROM k
  UNION ALL SELECT doc_id, 1, substr(text, cut + 1, 12000) FROM k WHERE len(text) > 12000)
SELECT doc_id, chunk_no::INTEGER AS chunk_no, len(chunk)::INTEGER AS n_chars, sha256(chunk) AS chunk_hash FROM parts""",
    "rule_key": f"SELECT id, {KEY} AS rule_key FROM rules",
    "numeric_text_guard": f"SELECT id, coalesce({NUMERIC} >= 0.6, false) AS at_least_60, coalesce({NUMERIC} >= 0.9, false) AS at_least_90 FROM rules",
    "embed_text": f"""WITH t AS (SELECT id, trim(left(coalesce(name, '') || ' ' || coalesce(if_condition, '') || ' ' || coalesce(then_logic, ''), 6000), {WS}) AS b,
  left(array_to_string(list_filter([coalesce(name, ''), coalesce(if_condition, ''), coalesce(then_logic, '')], lambda x: x <> ''), ' | '), 4000) AS c FROM rules)
SELECT id, sha256(CASE WHEN b = '' THEN ' ' ELSE b END) AS batch_hash, sha256(c) AS cycle_hash FROM t""",
    "rule_status": f"""WITH t AS (SELECT *, concat_ws(' ', name, if_condition, then_logic) AS t FROM rules)
SELECT id, CASE WHEN lower(trim(coalesce(status, ''), {WS})) IN ('deprecated', 'retired', 'sunset') THEN 'deprecated' ELSE 'active' END AS status,
  {claim('t')} AS deprecated_claim,
  '[' || coalesce(document_id, '') || ']' AS refs FROM t""",
    "brain_health": f"""SELECT 'rules' AS tbl, domain_tag, count(*) AS n, {PCT_URL} AS url_pct, round(100.0 * count(*) FILTER (coalesce({NUMERIC} >= 0.9, false)) / count(*), 1)::DOUBLE AS hi_conf_pct,
  count(*) FILTER (last_verified IS NULL OR {utc('last_verified')} < {NOW} - INTERVAL 90 DAY) AS stale_90d, count(*) FILTER (embedding IS NULL) AS missing_embedding
FROM rules WHERE coalesce(status, 'active') IN ('active', 'candidate') GROUP BY ALL
UNION ALL SELECT 'documents', domain_tag, count(*), {PCT_URL}, NULL, NULL, NULL FROM documents GROUP BY ALL""",
    "trusted_rules": f"SELECT id, rule_key FROM rules WHERE {TRUSTED}",
    "citable_rules": f"""SELECT id, {CITABLE} AS citable, {FAITHFUL} AS faithful,
  {LOCALE} AS locale FROM rules""",
    "registry_health": f"""SELECT source_id, canonical_org, tier, crawl_cadence_days, {text('last_crawled_at')} AS last_crawled_at, {OVERDUE} AS overdue,
  (SELECT count(*) FROM rules r WHERE r.source_org = s.canonical_org) AS rules_from_org, enabled FROM source_registry s""",
    "overdue_sources": f"SELECT source_id, tier, {text('last_crawled_at')} AS last_crawled, row_number() OVER (ORDER BY tier NULLS LAST, source_id)::INTEGER AS turn FROM source_registry WHERE {OVERDUE}",
    "due_sources": f"""SELECT source_id, row_number() OVER (ORDER BY tier, last_crawled_at NULLS FIRST, source_id)::INTEGER AS turn FROM source_registry
WHERE enabled AND (last_crawled_at IS NULL OR {utc('last_crawled_at')} < {NOW} - to_days(crawl_cadence_days) + INTERVAL 12 HOUR)""",
    "org_hygiene": """SELECT lower(regexp_replace(source_org, '^(www\\.)|\\.(com|io|org|ai|co|dev)$', '', 'g')) AS org_key, array_to_string(array_agg(DISTINCT source_org ORDER BY source_org), '|') AS variants, count(*) AS n
FROM rules WHERE coalesce(source_org, '') <> '' GROUP BY 1 HAVING count(DISTINCT source_org) > 1""",
    "health_snapshot": f"""SELECT (SELECT count(*) FROM rules WHERE coalesce(status, 'active') IN ('active', 'candidate')) AS rules_total, (SELECT {PCT_URL} FROM rules) AS rules_url_pct,
  (SELECT count(*) FROM rules WHERE {TRUSTED}) AS rules_trusted, (SELECT count(*) FROM rules WHERE {FAITHFUL}) AS rules_source_faithful,
  (SELECT count(*) FROM rules WHERE domain_tag IN ('aeo', 'geo')) AS aeo_geo_rules, (SELECT count(*) FROM rules WHERE embedding IS NULL) AS rules_missing_embedding,
  (SELECT count(*) FROM documents) AS documents_total, (SELECT {PCT_URL} FROM documents) AS documents_url_pct,
  (SELECT count(*) FROM source_registry WHERE {OVERDUE}) AS sources_overdue, (SELECT status FROM ingest_runs ORDER BY run_id DESC LIMIT 1) AS last_run_status""",
    "drift": f"""WITH h AS (SELECT r.run_id, i.started_at, i.status, {PCT_URL.replace('source_url', 'r.source_url')} AS pct FROM rules r JOIN ingest_runs i USING (run_id) GROUP BY ALL),
d AS (SELECT *, pct - lag(pct) OVER (ORDER BY started_at) AS delta FROM h)
SELECT {text('started_at')} AS taken_at, 'url share fell' AS alert FROM d WHERE delta < -2 UNION ALL SELECT {text('started_at')}, 'degraded run' FROM d WHERE status = 'degraded'""",
    "status_histogram": "SELECT extract_status, count(*) AS n, floor(100 * count(*) / sum(count(*)) OVER ())::BIGINT AS pct FROM ingest_changes GROUP BY 1",
    "scorecard_runs": f"SELECT run_id, strftime({utc('started_at')}, '%Y-%m-%d') AS day, status, urls_changed, objects_written FROM ingest_runs ORDER BY run_id DESC LIMIT 5",
    "recent_changes": f"WITH {CHANGES} SELECT change_id, source_id, change_type, extract_status FROM changes ORDER BY change_id DESC LIMIT 25",
    "source_health_list": "SELECT source_id, enabled, consecutive_failures, left(coalesce(last_error, ''), 60) AS error, coalesce(consecutive_failures, 0) >= 3 AS alert, row_number() OVER (ORDER BY coalesce(consecutive_failures, 0) DESC, source_id)::INTEGER AS turn FROM source_registry",
    "rules_added": f"""SELECT source_org, count(*) AS n, count(*) FILTER (coalesce(source_url, '') <> '') AS with_url FROM rules
WHERE {utc('extracted_at')} >= {NOW} - INTERVAL 180 DAY GROUP BY 1 ORDER BY n DESC, source_org NULLS LAST LIMIT 8""",
    "top_orgs_with_url": "SELECT coalesce(source_org, '(null)') AS org, count(*) AS n FROM rules GROUP BY 1 ORDER BY n DESC, org LIMIT 12",
    "coverage_totals": f"""SELECT count(*) AS n, strftime({utc('max(last_verified)')}, '%Y-%m-%d') AS verified_through, count(embedding) AS embedded, (100 * count(embedding) // greatest(count(*), 1))::BIGINT AS embedded_pct,
  count(*) FILTER (coalesce(source_url, '') <> '') AS with_url, (100 * count(*) FILTER (coalesce(source_url, '') <> '') // greatest(count(*), 1))::BIGINT AS url_pct FROM rules""",
    "tag_mode": """WITH c AS (SELECT document_id, domain_tag, count(*) AS c, min(id) AS f FROM rules WHERE document_id IS NOT NULL AND domain_tag IS NOT NULL GROUP BY ALL)
SELECT document_id, first(domain_tag ORDER BY c DESC, f) AS mode, sum(c)::BIGINT AS n FROM c GROUP BY 1""",
    "max_rule_id": "SELECT coalesce(max(CASE WHEN regexp_full_match(id, '[0-9]+') THEN try_cast(id AS BIGINT) END), 0) AS max_id FROM rules",
    "run_summary": f"""WITH {CHANGES} SELECT run_id, count(DISTINCT source_id) AS sources_changed, count(*) AS urls_changed, coalesce(sum(rules_new), 0)::BIGINT AS rules_written, coalesce(sum(rules_refreshed), 0)::BIGINT AS refreshed,
  count(*) FILTER (extract_status = 'retired') AS retired, count(*) FILTER (extract_status IN ('failed', 'gave_up')) AS failed,
  coalesce(array_to_string(array_agg(DISTINCT source_id ORDER BY source_id) FILTER (extract_status IN ('failed', 'gave_up') AND source_id IS NOT NULL), ','), '') AS failing_sources,
  CASE WHEN count(*) FILTER (extract_status IN ('failed', 'gave_up')) = 0 THEN 'done' ELSE 'partial' END AS status FROM changes WHERE run_id IS NOT NULL GROUP BY 1""",
    "source_ledger": f"""WITH {CHANGES} SELECT source_id, count(*) AS changes, count(*) FILTER (extract_status = 'extracted') AS extracted, count(*) FILTER (extract_status IN ('failed', 'gave_up')) AS failed,
  coalesce(sum(rules_new), 0)::BIGINT AS rules_new, {text('max(detected_at)')} AS last_detected FROM changes WHERE source_id IS NOT NULL GROUP BY 1""",
    "canon_probe": f"""WITH t(topic, p, min_hits, min_conf) AS (VALUES ('sitemaps', ['%sitemap%', '%crawl log%'], 3, 0.7), ('snippets', ['%answer box%', '%snippet%'], 5, 0.8), ('structure', ['%schema block%', '%json-ld%'], 3, 0.9), ('speed', ['%loads in _ seconds%'], 3, 0.7), ('absent', ['%quantum blockchain%'], 1, 0.7)),
pat AS (SELECT *, unnest(p) AS pat FROM t),
r AS (SELECT *, name || ' ' || coalesce(if_condition, '') || ' ' || coalesce(then_logic, '') AS txt FROM rules WHERE status IS DISTINCT FROM 'deprecated'),
h AS (SELECT DISTINCT topic, min_conf, id, confidence_score, last_verified, extracted_at, rule_type FROM pat JOIN r ON txt ILIKE pat)
SELECT *, row_number() OVER (ORDER BY ok, hits, topic)::INTEGER AS turn FROM (SELECT t.topic, count(h.id) AS hits, count(h.id) FILTER (coalesce({NUMERIC} >= h.min_conf::DOUBLE, false)) AS hi_conf_hits,
  count(h.id) FILTER ({utc('coalesce(last_verified, extracted_at)')} > {NOW} - INTERVAL 90 DAY) AS fresh_hits, count(h.id) FILTER (rule_type = 'observed') AS observed_hits,
  count(h.id) FILTER (coalesce({NUMERIC} >= h.min_conf::DOUBLE, false)) >= t.min_hits AS ok
FROM t LEFT JOIN h USING (topic) GROUP BY t.topic, t.min_hits)""",
    "neighbor_adopt": """WITH r AS (SELECT id, source_org, source_url, list_transform(embedding, lambda x: x::DOUBLE) AS v, CASE WHEN coalesce(source_url, '') = '' THEN -1 ELSE len(source_url) - len(replace(source_url, '/', '')) END AS spec
  FROM rules WHERE source_org IS NOT NULL AND len(embedding) = 64 AND NOT list_bool_or(list_transform(embedding, lambda x: isnan(x))) AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
p AS (SELECT a.id, b.id AS nn_id, list_cosine_similarity(a.v, b.v) AS sim FROM r a JOIN r b ON a.source_org = b.source_org AND b.spec > a.spec AND coalesce(b.source_url, '') <> '')
SELECT id, first(nn_id ORDER BY round(sim, 9) DESC, nn_id) AS nn_id, round(first(sim ORDER BY round(sim, 9) DESC, nn_id), 5) AS sim FROM p WHERE sim >= 0.8 GROUP BY id""",
    "alias_normalize": f"WITH {ALIAS} SELECT id, coalesce(can, source_org) AS source_org FROM rules LEFT JOIN al ON lower(trim(source_org)) = alias",
    "org_normalize_pipeline": f"""WITH {ALIAS}, a AS (SELECT id, coalesce(can, source_org) AS o, source_url AS u FROM rules LEFT JOIN al ON lower(trim(source_org)) = alias),
b AS (SELECT id, u, CASE WHEN coalesce(o, '') IN {JUNK} AND coalesce(regexp_matches(u, '^https?://[^/]+\\.[a-z]{{2,}}'), false) THEN lower(regexp_replace(regexp_replace(u, '(?i)^https?://(www\\.)?', ''), '/.*$', '')) ELSE o END AS o FROM a),
c AS (SELECT id, coalesce(can, o) AS o FROM b LEFT JOIN al ON lower(trim(o)) = alias)
SELECT id, CASE WHEN coalesce(o, '') IN {JUNK} THEN 'unattributed-legacy' ELSE o END AS source_org FROM c""",
    "evidence_cutoff": f"SELECT url, new_hash, {text('min(detected_at)')} AS cutoff FROM ingest_changes WHERE url IS NOT NULL AND new_hash IS NOT NULL GROUP BY ALL",
    "latest_change_per_url": "SELECT url, max(change_id) AS change_id, first(extract_status ORDER BY change_id DESC) AS extract_status, first(change_type ORDER BY change_id DESC) AS change_type FROM (SELECT DISTINCT url, change_id, extract_status, change_type FROM ingest_changes WHERE url IS NOT NULL) GROUP BY url",
    "pending_retries": f'WITH {RETRIES} SELECT source_id, url, nth::INTEGER AS "at" FROM retries',
    "failure_backstop": f"WITH {CHANGES}, {FAILURES} SELECT url, new_hash, failures, failures + 1 >= 3 AS gave_up FROM failures",
    "failure_streak": """WITH ok AS (SELECT source_id, max(change_id) FILTER (extract_status NOT IN ('failed', 'gave_up')) AS last_ok FROM ingest_changes WHERE source_id IS NOT NULL GROUP BY 1)
SELECT source_id, last_ok, (SELECT count(DISTINCT change_id) FROM ingest_changes c WHERE c.source_id = ok.source_id AND extract_status IN ('failed', 'gave_up') AND (last_ok IS NULL OR change_id > last_ok)) AS failures FROM ok""",
    "capped_changes": f"WITH {CHANGES} SELECT change_id, run_id, source_id, count(*) OVER (PARTITION BY run_id, source_id) > 15 AS truncated FROM changes WHERE run_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id, source_id ORDER BY change_id) <= 15",
    "consume": f"""WITH {CHANGES}, {FAILURES}, f AS (SELECT c.change_id, CASE WHEN extract_status = 'failed' AND coalesce(failures, 0) + 1 >= 3 THEN 'gave_up' ELSE extract_status END AS final_status FROM changes c LEFT JOIN failures USING (url, new_hash))
SELECT change_id, final_status, final_status IN ('extracted', 'empty', 'irrelevant', 'gave_up') AS consumed FROM f""",
    "marker_moves": f"""WITH all_changes AS (SELECT DISTINCT ON (change_id) * FROM ingest_changes), changes AS (SELECT *, count(*) OVER (PARTITION BY run_id, source_id) > 15 AS truncated FROM all_changes WHERE run_id IS NOT NULL AND source_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run_id, source_id ORDER BY change_id) <= 15), {FAILURES},
f AS (SELECT source_id, truncated, CASE WHEN extract_status = 'failed' AND coalesce(failures, 0) + 1 >= 3 THEN 'gave_up' ELSE extract_status END AS s FROM changes LEFT JOIN failures USING (url, new_hash))
SELECT source_id, bool_and(s IN ('extracted', 'empty', 'irrelevant', 'gave_up')) AND NOT bool_or(truncated) AS advance FROM f GROUP BY 1""",
    "rotation_window": f"WITH {LISTED}, {OFFSETS}, {TURNS} SELECT source_id, loc, turn FROM turns",
    "probe_budget": f"""WITH {LISTED}, {OFFSETS}, {TURNS}, {RETRIES},
before AS (SELECT url, max(last_modified) AS last_modified FROM (SELECT {norm('url')} AS url, last_modified FROM url_state WHERE snapshot_no = {BEFORE}) WHERE url IS NOT NULL GROUP BY 1),
n AS (SELECT t.source_id, {norm('loc')} AS loc, lastmod, turn, url_filter FROM turns t LEFT JOIN offsets USING (source_id)),
ok AS (SELECT * FROM n WHERE {deny('loc')} IS NULL AND (coalesce(url_filter, '') = '' OR coalesce(regexp_matches({path_of('loc')}, url_filter), false))
  QUALIFY row_number() OVER (PARTITION BY source_id, loc ORDER BY turn) = 1),
first AS (SELECT DISTINCT source_id, {norm('url')} AS loc FROM retries),
p AS (SELECT o.*, coalesce(lastmod <> '' AND lastmod = b.last_modified, false) AS still, coalesce((SELECT count(*) FROM first f WHERE f.source_id = o.source_id), 0) AS paid
  FROM ok o LEFT JOIN before b ON b.url = o.loc WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.source_id = o.source_id AND f.loc = o.loc)),
w AS (SELECT *, sum(CASE WHEN still THEN 0 ELSE 1 END) OVER (PARTITION BY source_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS cost FROM p)
SELECT source_id, loc, turn, CASE WHEN still THEN 'unchanged' ELSE 'probe' END AS action FROM w WHERE cost <= 20 - paid UNION ALL SELECT source_id, loc, -1, 'retry' FROM first""",
    "preflight": f"""WITH {LISTED}, before AS (SELECT DISTINCT {norm('url')} AS url FROM url_state WHERE snapshot_no = {BEFORE}),
g AS (SELECT source_id, {norm('loc')} AS url, count(*) AS n FROM listed GROUP BY ALL),
w AS (SELECT source_id, n, coalesce({deny('g.url')}, CASE WHEN NOT (coalesce(url_filter, '') = '' OR coalesce(regexp_matches({path_of('g.url')}, url_filter), false)) THEN 'filter' WHEN b.url IS NOT NULL THEN 'known' ELSE 'new' END) AS why
  FROM g LEFT JOIN source_registry r USING (source_id) LEFT JOIN before b ON b.url = g.url)
SELECT source_id, sum(n)::BIGINT AS listed, count(*) AS pages, count(*) FILTER (why = 'root') AS root, count(*) FILTER (why = 'path') AS path, count(*) FILTER (why = 'query') AS query, count(*) FILTER (why = 'filter') AS "filter", count(*) FILTER (why = 'known') AS known, count(*) FILTER (why = 'new') AS "new" FROM w GROUP BY 1""",
    "next_cursor": f"""WITH {LISTED}, {OFFSETS}, n AS (SELECT source_id, count(*) AS n FROM listed GROUP BY 1)
SELECT source_id, CASE WHEN child IS NULL THEN (coalesce(off, 0) + 20) % greatest(coalesce(n, 0), 1) END AS "offset", CASE WHEN child IS NOT NULL THEN (child + 1) % greatest(coalesce(n, 0), 1) END AS child
FROM offsets LEFT JOIN n USING (source_id) WHERE adapter_type = 'sitemap'""",
    "sitemap_parse": f"WITH {LISTED} SELECT source_id, (pos // 300)::BIGINT AS part, (pos % 300)::INTEGER AS pos, trim(loc) AS loc, nullif(trim(lastmod), '') AS lastmod FROM listed",
    "seed_url_list": f"""WITH s AS (SELECT source_id, CASE WHEN seed_urls LIKE '[%' THEN from_json(seed_urls, '["VARCHAR"]') ELSE string_split(seed_urls, ',') END AS u FROM source_registry WHERE adapter_type = 'url_list' AND seed_urls IS NOT NULL),
e AS (SELECT source_id, unnest(u) AS u, generate_subscripts(u, 1) AS pos FROM s), n AS (SELECT source_id, {norm('u')} AS url, min(pos) AS pos FROM e WHERE trim(u) <> '' GROUP BY 1, 2)
SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY pos)::INTEGER AS "at", url FROM n QUALIFY "at" <= 60""",
    "adapter_dispatch": "SELECT source_id, CASE WHEN adapter_type IN ('url_list', 'github_release', 'changelog') THEN adapter_type ELSE 'sitemap' END AS adapter, CASE WHEN lower(root_url) LIKE '%.pdf' THEN 'pdf' ELSE 'html' END AS kind, coalesce(consecutive_failures, 0) >= 3 AS alert FROM source_registry",
    "harvest": f"""SELECT page_id, source_id, coalesce(title, '') AS title, len(left(text, 12000))::INTEGER AS n_chars FROM changed_urls WHERE source_id IS NOT NULL AND len(trim(coalesce(text, ''), {WS})) >= 200
QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY page_id) <= 25""",
    "reconcile_excerpts": f"""WITH {VERSIONS}, r AS (SELECT r.*, v.h, contains(v.body, {squeeze('source_excerpt')}) AS there FROM rules r JOIN versions v ON v.url = r.source_url
  WHERE coalesce(status, 'active') = 'active' AND coalesce(rule_type, '') <> 'observed' AND provenance_status IN ('verified_excerpt', 'source_change_pending') AND coalesce(source_excerpt, '') <> ''),
o AS (SELECT *, CASE WHEN there THEN 'rebound' WHEN source_content_hash IS DISTINCT FROM h THEN 'superseded' ELSE 'kept' END AS outcome FROM r)
SELECT id, outcome, CASE WHEN outcome = 'superseded' THEN 'superseded' ELSE status END AS status, CASE WHEN outcome = 'superseded' THEN 'source_changed' ELSE provenance_status END AS provenance_status,
  CASE WHEN outcome = 'rebound' THEN h ELSE source_content_hash END AS source_content_hash FROM o""",
    "quality_gate": f"""WITH d AS (SELECT doc_id::VARCHAR AS document_id, {squeeze('text')} AS body FROM documents),
r AS (SELECT r.*, coalesce(CASE WHEN isnan(try_cast(confidence_score AS DOUBLE)) THEN 0 ELSE try_cast(confidence_score AS DOUBLE) END, 0) AS conf, {squeeze('source_excerpt')} AS ex, coalesce(body, '') AS body,
  concat_ws(' ', name, if_condition, then_logic) AS t, lower(trim(coalesce(status, ''), {WS})) IN ('deprecated', 'retired', 'sunset') AS dep FROM rules r LEFT JOIN d USING (document_id)),
g AS (SELECT *, CASE WHEN coalesce(name, '') = '' OR coalesce(if_condition, '') = '' OR coalesce(then_logic, '') = '' THEN 'incomplete' WHEN conf < 0.6 THEN 'confidence' WHEN len(ex) < 12 THEN 'short excerpt' WHEN NOT contains(body, ex) THEN 'not verbatim' END AS reject_reason FROM r)
SELECT id, reject_reason IS NULL AS kept, reject_reason,
  CASE WHEN dep OR {claim('t')} THEN 'deprecated' ELSE 'active' END AS new_status FROM g""",
    "reverify_stamp": f"""WITH v AS (SELECT url, new_hash, min(detected_at) AS cutoff FROM ingest_changes WHERE url IS NOT NULL AND new_hash IS NOT NULL GROUP BY ALL),
c AS (SELECT url, min(cutoff) AS cutoff FROM v JOIN (SELECT DISTINCT url, lower(content_hash) AS new_hash FROM url_state WHERE snapshot_no = {LAST} AND content_hash IS NOT NULL) USING (url, new_hash) GROUP BY url)
SELECT id, coalesce(last_verified >= cutoff AND {utc('last_verified')} < {NOW} - INTERVAL 1 HOUR, false) AND {CITABLE} AS stamped FROM rules LEFT JOIN c ON url = source_url""",
    "retire_removed": "SELECT id, CASE WHEN status = 'active' AND source_url IN (SELECT url FROM ingest_changes WHERE change_type = 'removed' AND url IS NOT NULL) THEN 'retired' ELSE status END AS status FROM rules",
    "state_after_removal": f"SELECT url, count(*) AS n FROM url_state WHERE snapshot_no = {LAST} AND (url IS NULL OR url NOT IN (SELECT url FROM ingest_changes WHERE change_type = 'removed' AND url IS NOT NULL)) GROUP BY url",
    "mark_pending": "SELECT id, CASE WHEN coalesce(status, 'active') = 'active' AND provenance_status = 'verified_excerpt' AND source_url IN (SELECT url FROM ingest_changes WHERE change_type = 'modified' AND url IS NOT NULL) THEN 'source_change_pending' ELSE provenance_status END AS provenance_status FROM rules",
    "url_state_rekey": f"""WITH s AS (SELECT {norm('url')} AS n, * FROM url_state WHERE snapshot_no = {LAST})
SELECT n AS url, first(content_hash ORDER BY last_seen_at DESC NULLS LAST, url DESC, coalesce(content_hash, '') DESC) AS content_hash, {text("first(last_seen_at ORDER BY last_seen_at DESC NULLS LAST, url DESC, coalesce(content_hash, '') DESC)")} AS last_seen_at, count(DISTINCT url) AS spellings FROM s WHERE n IS NOT NULL GROUP BY n""",
    "url_state_upsert": f"""WITH l AS (SELECT * FROM url_state WHERE snapshot_no IN ({LAST}, {BEFORE}) AND url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY snapshot_no, url ORDER BY last_seen_at DESC NULLS LAST, coalesce(content_hash, '') DESC, coalesce(source_id, '') DESC) = 1)
SELECT coalesce(a.url, b.url) AS url, coalesce(a.source_id, b.source_id) AS source_id, CASE WHEN b.url IS NOT NULL THEN b.content_hash ELSE a.content_hash END AS content_hash
FROM (SELECT * FROM l WHERE snapshot_no = {BEFORE}) a FULL JOIN (SELECT * FROM l WHERE snapshot_no = {LAST}) b ON a.url = b.url""",
    "source_upsert": f"""SELECT source_id, CASE WHEN len(source_id) % 2 = 0 THEN upper(canonical_org) ELSE canonical_org END AS canonical_org, enabled, CASE WHEN len(source_id) % 2 = 0 THEN 1 ELSE tier END::SMALLINT AS tier, 'v' || tier AS last_seen_marker, '2026-01-01 00:00:00' AS last_crawled_at FROM source_registry
UNION ALL SELECT source_id || '-new', upper(canonical_org), false, 1::SMALLINT, NULL, NULL FROM source_registry""",
    "source_health_fold": f"""WITH {CHANGES}, o AS (SELECT source_id, detected_at AS t, bool_and(extract_status IS NULL OR extract_status NOT IN ('failed', 'gave_up')) AS ok, left(max(url), 300) AS err FROM changes WHERE source_id IS NOT NULL AND detected_at IS NOT NULL GROUP BY ALL),
g AS (SELECT source_id, max(t) FILTER (ok) AS ok_at, max(t) FILTER (NOT ok) AS bad_at, first(err ORDER BY t DESC) FILTER (NOT ok) AS err FROM o GROUP BY 1),
n AS (SELECT source_id, count(*) AS fails FROM o JOIN g USING (source_id) WHERE NOT ok AND (ok_at IS NULL OR t > ok_at) GROUP BY 1)
SELECT s.source_id, CASE WHEN g.source_id IS NULL THEN consecutive_failures ELSE (CASE WHEN ok_at IS NULL THEN coalesce(consecutive_failures, 0) ELSE 0 END + coalesce(fails, 0)) END::INTEGER AS consecutive_failures, {text('greatest(last_ok_at, ok_at)')} AS last_ok_at,
  CASE WHEN g.source_id IS NULL THEN last_error WHEN bad_at IS NOT NULL AND (ok_at IS NULL OR bad_at > ok_at) THEN err END AS last_error FROM source_registry s LEFT JOIN g USING (source_id) LEFT JOIN n USING (source_id)""",
    "upsert_fold": f"""WITH RECURSIVE e AS (SELECT coalesce(nullif(rule_key, ''), {KEY}) AS k, row_number() OVER (PARTITION BY coalesce(nullif(rule_key, ''), {KEY}) ORDER BY created_at, id) AS i, source_url AS url, status AS st,
  left(nullif(trim(source_excerpt, {WS}), ''), 1000) AS ex, nullif(source_content_hash, '') AS h, CASE WHEN rule_type = 'observed' THEN url_provenance END AS custom, extracted_at AS t,
  len(rtrim(coalesce(source_url, ''), '/')) - len(replace(rtrim(coalesce(source_url, ''), '/'), '/', '')) AS depth FROM rules),
p AS (SELECT *, CASE WHEN coalesce(custom, '') <> '' THEN 'observed' WHEN ex IS NOT NULL AND h IS NOT NULL THEN 'verified_excerpt' ELSE 'unverified' END AS proof FROM e),
f AS (
  SELECT k, i, url, depth, CASE WHEN coalesce(custom, '') <> '' THEN custom ELSE 'extracted' END AS prov, st, proof, h, t FROM p WHERE i = 1
  UNION ALL
  SELECT k, i, CASE WHEN full_write THEN n_url ELSE url END, CASE WHEN full_write THEN n_depth ELSE depth END, CASE WHEN full_write THEN 'extracted' ELSE prov END,
    CASE WHEN n_st = 'deprecated' OR st = 'deprecated' THEN 'deprecated' ELSE 'active' END,
    CASE WHEN full_write OR refresh THEN n_proof ELSE proof END, CASE WHEN full_write OR refresh THEN n_h ELSE h END, CASE WHEN full_write OR refresh THEN n_t ELSE t END
  FROM (SELECT f.k, p.i, f.url, f.depth, f.prov, f.st, f.proof, f.h, f.t, p.url AS n_url, p.depth AS n_depth, p.st AS n_st, p.proof AS n_proof, p.h AS n_h, p.t AS n_t,
      (coalesce(p.url, '') <> '' AND (coalesce(f.url, '') = '' OR p.depth > f.depth) AND (p.proof = 'verified_excerpt' OR f.proof <> 'verified_excerpt'))
      OR (p.proof = 'verified_excerpt' AND f.proof <> 'verified_excerpt' AND (coalesce(f.url, '') = '' OR coalesce(coalesce(f.url, '') = p.url, false))) AS full_write,
      p.proof = 'verified_excerpt' AND f.proof = 'verified_excerpt' AND coalesce(coalesce(f.url, '') = p.url, false) AS refresh
    FROM f JOIN p ON p.k = f.k AND p.i = f.i + 1))
SELECT k AS rule_key, url AS source_url, prov AS url_provenance, st AS status, proof, h AS content_hash, {text('t')} AS last_verified, i AS n_events FROM f QUALIFY row_number() OVER (PARTITION BY k ORDER BY i DESC) = 1""",
    "undeprecate": "SELECT id, 'active' AS status FROM rules WHERE status = 'deprecated' AND id IS NOT NULL",
    "stale_runs": f"""WITH s AS (SELECT *, coalesce(status = 'running' AND {utc('started_at')} < {NOW} - INTERVAL 2 HOUR, false) AS late FROM ingest_runs)
SELECT run_id, CASE WHEN late THEN 'aborted' ELSE status END AS status, CASE WHEN late THEN '2026-01-01 00:00:00' ELSE {text('finished_at')} END AS finished_at FROM s""",
    "run_detail": "SELECT run_id, json_extract_string(detail, '$.sources[0].status') AS first_status, json_extract_string(detail, '$.host_no') AS host_no FROM ingest_runs",
    "embedding_queue": "SELECT id FROM rules WHERE embedding IS NULL AND status = 'active' ORDER BY extracted_at DESC NULLS LAST, id LIMIT 1000",
    "document_upsert": """WITH d AS (SELECT source_url, min(doc_id)::VARCHAR AS id, 'old' AS title FROM documents WHERE source_url IS NOT NULL GROUP BY 1),
p AS (SELECT url, title, coalesce(run_id, 0) * 1000000 + page_id AS t FROM changed_urls WHERE url IS NOT NULL UNION ALL SELECT source_url, 'again', 0 FROM d WHERE len(source_url) % 2 = 0),
g AS (SELECT url, first(title ORDER BY t DESC) AS title, min(t) AS t FROM p GROUP BY 1)
SELECT d.id, coalesce(g.title, d.title) AS title, source_url FROM d LEFT JOIN g ON url = source_url
UNION ALL SELECT ((SELECT max(id::BIGINT) FROM d) + row_number() OVER (ORDER BY t, url))::VARCHAR, title, url FROM g WHERE url NOT IN (SELECT source_url FROM d)""",
    "observe_gate": """WITH g AS (SELECT source_org, count(*) AS m, count(*) FILTER (provenance_status = 'verified_excerpt') AS n, count(DISTINCT run_id) AS s, max(name) AS name, max(if_condition) AS i, max(then_logic) AS t, max(domain_tag) AS tag FROM rules WHERE source_org IS NOT NULL GROUP BY 1),
r AS (SELECT *, CASE WHEN coalesce(trim(name), '') = '' OR coalesce(trim(i), '') = '' OR coalesce(trim(t), '') = '' THEN 'missing text' WHEN n IS NULL OR m IS NULL OR s IS NULL THEN 'invalid prevalence' WHEN m <= 0 OR n < 0 OR n > m THEN 'implausible prevalence' WHEN n / m < 0.7 THEN 'rare' WHEN s < 3 THEN 'few sessions' END AS reject_reason FROM g)
SELECT source_org, reject_reason, CASE WHEN reject_reason IS NULL THEN round(least(0.84::DOUBLE, 0.5::DOUBLE + 0.4::DOUBLE * n / m), 2) END AS confidence, CASE WHEN lower(tag) IN ('seo', 'aeo', 'geo', 'entity', 'content', 'performance', 'general') THEN lower(tag) ELSE 'general' END AS tag FROM r""",
    "snapshot_delta": """WITH c AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT day, event_type, n, lag(n) OVER w AS previous, n - lag(n) OVER w AS delta FROM c WINDOW w AS (PARTITION BY event_type ORDER BY day)""",
    "event_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL",
    "numbered_rules": "SELECT id, (SELECT max(id::BIGINT) FROM rules) + row_number() OVER (ORDER BY created_at, id) AS new_id FROM rules",
}
