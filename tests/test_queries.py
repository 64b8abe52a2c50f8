"""Every core query with SQL against DuckDB on the smallest data; the others at least run."""

import glob
import math
import os
import re
import subprocess
import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from tidemark.plans import job_queries, problems, queries

ROOT = Path(__file__).resolve().parents[1]
QUERIES = {**queries.QUERIES, **job_queries.QUERIES, **problems.QUERIES}
ORACLES = {**queries.ORACLES, **job_queries.ORACLES, **problems.ORACLES}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return tuple(plain(x) for x in v) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    if name in ORACLES:
        res = duck.execute(ORACLES[name])
        have = [x[0] for x in res.description]
        want = sorted((tuple(plain(r[have.index(c)]) for c in cols) for r in res.fetchall()), key=str)
        assert sorted(have) == cols and got == want


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) - len(ORACLES) <= 2


def test_entry_imports_without_a_session_and_without_the_llm_part(tmp_path):
    code = "import sys; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e; q = e.queries(); assert 'page_change_detect' in q and set(e.oracle_sql()) <= set(q); print(len(q))"
    assert int(subprocess.run([sys.executable, "-c", code, str(ROOT)], capture_output=True, text=True, cwd=tmp_path, check=True).stdout) >= len(QUERIES)
    for p in ("tidemark", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", str(ROOT / p), str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "tidemark/llm")], check=True)
    assert int(subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, cwd=tmp_path, check=True).stdout) == len(QUERIES)


def test_nothing_outside_the_subpackage_imports_it():
    for p in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"\bllm\b", p.read_text()), p  # llms.txt is a file of web sites


def test_cli(capsys):
    from tidemark import cli

    assert cli.main(["list"]) == 0 and "brain_health" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["nothing"])


def test_cli_reports_and_maintenance(spark, data, tmp_path, capsys, monkeypatch):
    from tidemark import cli

    monkeypatch.setattr(cli, "build_session", lambda: spark)
    for name in ("status", "changes", "health", "scorecard", "brain-health"):
        assert cli.main([name, data]) == 0
    out = capsys.readouterr().out
    assert "sources:" in out and "corpus:" in out and "overdue:" in out
    (tmp_path / "topics.json").write_text('{"topic":"t","domain_tag":"seo","patterns":["%sitemap%"],"min_hits":1,"min_conf":0.7}')
    assert cli.main(["critic", data, str(tmp_path / "topics.json")]) == 0
    first = spark.read.parquet(f"{data}/source_registry.parquet").selectExpr("min(source_id)").first()[0]
    new = lambda n: spark.read.parquet(f"{tmp_path}/{n}/source_registry.parquet")
    assert cli.main(["set-source", data, first, "tier=3", "--out", f"{tmp_path}/a"]) == 0 and new("a").filter(f"source_id = '{first}'").first()["tier"] == 3
    assert cli.main(["disable", data, first, "--out", f"{tmp_path}/b"]) == 0 and new("b").filter(f"source_id = '{first}'").first()["enabled"] is False
    assert cli.main(["add-source", data, "zz", "canonical_org=Z", "root_url=https://z.example", "--out", f"{tmp_path}/c"]) == 0 and new("c").count() == 241
    for wrong in (["set-source", data, "nobody", "tier=1"], ["add-source", data, "zy"], ["undeprecate", data, "nothing"], ["enable", data], ["set-source", data, first, "enabled=1"]):
        assert cli.main([*wrong, "--out", f"{tmp_path}/x"]) == 1
    dep = spark.read.parquet(f"{data}/rules.parquet").filter("status = 'deprecated'").first()["id"]
    assert cli.main(["undeprecate", data, dep, "--out", f"{tmp_path}/d"]) == 0
    assert spark.read.parquet(f"{tmp_path}/d/rules.parquet").filter(f"id = '{dep}'").first()["status"] == "active"
    assert cli.main(["brain_health", data, "--out", f"{tmp_path}/e"]) == 0 and spark.read.parquet(f"{tmp_path}/e").count() > 0
    with pytest.raises(SystemExit):
        cli.main(["enable", data, first])


def test_tables_of_a_scope_are_removed(spark):
    from tidemark import session

    before = len(session._STORED)
    with session.scope(spark):
        df = session.stored(spark.range(3).toDF("x"))
        path = session._STORED[-1].removeprefix("file:").replace("///", "/")
        assert df.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path) and len(session._STORED) == before
