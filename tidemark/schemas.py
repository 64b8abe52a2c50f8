"""Explicit schemas of the tables, and additive migration (S-21, U-3): missing columns are added as typed nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: As DDL, so that the module can be imported without a session.
SCHEMAS: dict[str, str] = {
    "source_registry": (
        "source_id string, canonical_org string, adapter_type string, tier smallint, root_url string, sitemap_url string, seed_urls string, url_filter string,"
        " crawl_cadence_days int, last_crawled_at timestamp, last_seen_marker string, enabled boolean, notes string, consecutive_failures int,"
        " last_ok_at timestamp, last_error string, crawl_cursor string"
    ),
    "ingest_runs": (
        "run_id bigint, started_at timestamp, finished_at timestamp, sources_checked int, sources_changed int, urls_changed int, objects_written int, status string, detail string"
    ),
    "ingest_changes": (
        "change_id bigint, run_id bigint, source_id string, url string, change_type string, signal string, old_hash string, new_hash string,"
        " detected_at timestamp, extract_status string, rules_new int, rules_refreshed int"
    ),
    "url_state": ("url string, source_id string, etag string, last_modified string, content_hash string, last_seen_at timestamp"),
    "rules": (
        "id string, name string, rule_type string, if_condition string, then_logic string, domain_tag string, confidence_score string, source_refs_json string,"
        " status string, created_at timestamp, source_org string, source_url string, document_id string, extracted_at timestamp, last_verified timestamp,"
        " rule_key string, superseded_by string, url_provenance string, source_excerpt string, source_content_hash string, provenance_status string, embedding array<float>"
    ),
    "documents": ("id string, title string, source_type string, domain_tag string, source_url string, source_org string, created_at timestamp"),
    "org_aliases": ("alias string, canonical_org string"),
    "canon_topics": ("topic string, domain_tag string, patterns array<string>, min_hits int, min_conf double"),
    "extracted_pages": (
        "source_id string, org string, url string, title string, new_hash string, text string,"
        " rules array<struct<name:string,if_condition:string,then_logic:string,source_excerpt:string,domain_tag:string,confidence_score:string,status:string>>"
    ),
    "observations": (
        "name string, if_condition string, then_logic string, domain_tag string, prevalence struct<n:string,m:string,sessions:string>, exemplar_url string,"
        " observer string, session_ids array<string>"
    ),
}


def schema(name: str) -> T.StructType:
    """The schema of a table; needs a session."""
    return T.StructType.fromDDL(SCHEMAS[name])


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """U-3: what schema has and df lacks, column by column."""
    have = set(df.columns)
    return [f.name for f in schema if f.name not in have]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """S-21: df with every column of schema (typed null where it is missing); columns it has besides are kept."""
    lacking = set(missing_columns(df, schema))
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name in lacking})
