"""X-7: python -m tidemark.cli <command> <folder> ...

Queries: `list`, or a query's name and a folder of tables (--show N, --out PATH). Reports (S-22): status, changes, health,
scorecard, brain-health, critic TOPICS, probe-source ID SITEMAPS. Maintenance, each writing the new version of its table
to --out: seed SEEDS [--force], set-source ID KEY=VALUE..., add-source ID KEY=VALUE..., enable ID, disable ID,
undeprecate ID-OR-KEY, migrate-url-state; observe FILE [--dry-run] and ingest FILE write all tables they change. A folder
holds <table>.parquet; paths may be on any file system Spark reads. Nothing is overwritten."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import lifecycle
from .plans import job_queries, jobs, problems, queries, reports
from .schemas import conform, schema
from .session import AS_OF, build_session, scope
from .sources import files, registry

REPORTS = ("status", "changes", "health", "scorecard", "brain-health", "critic", "probe-source")
WRITES = ("seed", "set-source", "add-source", "enable", "disable", "undeprecate", "migrate-url-state", "observe", "ingest")


def registered() -> dict:
    """The library's queries, or all that the entry module registers where it can be imported."""
    try:
        return importlib.import_module("__spark_entry__").queries()
    except ModuleNotFoundError as e:
        if e.name != "__spark_entry__":
            raise
        return {**queries.QUERIES, **job_queries.QUERIES, **problems.QUERIES}


def report(name: str, read, args: list[str], now) -> dict[str, DataFrame]:
    if name == "status":
        return reports.status(read("source_registry"), read("ingest_runs"))
    if name == "changes":
        return reports.changes(read("ingest_changes"))
    if name == "health":
        return reports.health(read("source_registry"))
    if name == "scorecard":
        return reports.scorecard(read("source_registry"), read("ingest_runs"), read("ingest_changes"), read("rules"), now)
    if name == "brain-health":
        return reports.brain_health({"rules": read("rules"), "documents": read("documents")}, read("source_registry"), read("ingest_runs"), now)
    spark = read("rules").sparkSession
    if name == "critic":
        return reports.critic(spark.read.json(args[0]), read("rules"), now)
    return reports.probe_source(spark.read.parquet(args[1]), read("source_registry"), lifecycle.rekey_url_state(read("url_state").drop("snapshot_no")), args[0])


def maintain(name: str, read, args: list[str], now, force: bool = False) -> dict[str, DataFrame]:
    """The tables a maintenance command changes; ValueError if it cannot be done."""
    if name == "undeprecate":
        return {"rules": reports.undeprecated(read("rules"), args[0], now)}
    if name == "migrate-url-state":
        return {"url_state": lifecycle.rekey_url_state(read("url_state")).drop("spellings")}
    if name in ("observe", "ingest"):
        rules = conform(read("rules"), schema("rules"))
        corpus = jobs.Corpus(rules, read("url_state"), read("ingest_changes"), conform(read("documents"), schema("documents")), read("source_registry"), read("ingest_runs"))
        spark = rules.sparkSession
        if name == "observe":
            after, rejected = jobs.observe(corpus, files.read_jsonl_counting(spark, args[0], "observations"), now)
            return {"rules": after.rules, "documents": after.documents, "rejected": rejected}
        after, _ = jobs.bridge(corpus, files.read_jsonl_strict(spark, args[0], "extracted_pages"), now)
        return {"rules": after.rules, "documents": after.documents, "url_state": after.url_state, "ingest_changes": after.changes, "source_registry": after.registry, "ingest_runs": after.runs}
    r = read("source_registry")
    if name == "seed":
        return {"source_registry": registry.upsert_sources(r, registry.seeds_from_json(r.sparkSession, args[0]), force)}
    known = not r.filter(F.col("source_id") == args[0]).isEmpty()
    if name == "add-source":
        given = registry.parse_settings(args[1:])
        if not given.get("canonical_org") or not given.get("root_url"):
            raise ValueError("a source needs canonical_org and root_url")
        return {"source_registry": registry.add_source(r, {"source_id": args[0], "adapter_type": "sitemap", **given})}
    if not known:
        raise ValueError(f"no source is called {args[0]!r}")
    if name == "set-source":
        return {"source_registry": registry.set_source(r, args[0], registry.parse_settings(args[1:]))}
    return {"source_registry": registry.enable(r, args[0], name == "enable")}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command")
    p.add_argument("folder", nargs="?")
    p.add_argument("args", nargs="*")
    p.add_argument("--show", type=int, default=20)
    p.add_argument("--out")
    p.add_argument("--force", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--as-of", default=AS_OF)
    a = p.parse_args(argv)
    if a.command == "list":
        print("\n".join(sorted(registered())))
        return 0
    known = registered() if a.command not in REPORTS + WRITES else {}
    if not a.folder or a.command not in (*REPORTS, *WRITES, *known):
        p.error("a known command and a folder are needed; `list` shows the queries")
    if a.command in WRITES and not a.out and not a.dry_run:
        p.error("--out is needed")
    spark = build_session()
    now = F.lit(a.as_of).cast("timestamp")
    read = lambda name: spark.read.parquet(f"{a.folder.rstrip('/')}/{name}.parquet")
    with scope(spark):
        try:
            if a.command in known:
                got = {a.command: known[a.command](spark, a.folder)}
            elif a.command in REPORTS:
                got = report(a.command, read, a.args, now)
            else:
                got = maintain(a.command, read, a.args, now, a.force)
        except (ValueError, IndexError) as e:
            print(f"{a.command}: {e}")
            return 1
        for name, df in got.items():
            if a.out and not a.dry_run:
                df.write.parquet(a.out if a.command in known else f"{a.out.rstrip('/')}/{name}.parquet")
            else:
                print(f"{name}:")
                df.show(a.show, truncate=60)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
