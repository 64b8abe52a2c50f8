import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookups
from tidemark.plans import external


def test_ask_and_answers(spark):
    pages = spark.createDataFrame([("u", "o", "short"), ("long", "o", "x" * 13000), ("bad", "o", "fail"), ("cut", "o", "cut"), ("none", "o", None)], "url string, org string, text string")

    def call(text, org, url):
        if text == "fail":
            raise RuntimeError
        return '[{"name":"a"},{"na' if text == "cut" else json.dumps([{"name": f"{len(text)}"}])

    got = {r["url"]: None if r["rules"] is None else [x["name"] for x in r["rules"]] for r in external.answers(external.ask(pages, call)).collect()}
    assert got == {"u": ["5"], "long": ["12000", "1000"], "bad": None, "cut": ["a"]}


def test_embed(spark):
    rows = spark.createDataFrame([(str(i), "x" * i) for i in range(7)], "id string, t string")
    got = {r["id"]: r["embedding"] for r in external.embed(rows, "t", lambda ts: [[float(len(t)), 1.0] for t in ts], 2, batch=3).collect()}
    assert got["6"] == [6.0, 1.0] and len(got) == 7
    with pytest.raises(Exception):  # noqa: B017
        external.embed(rows, "t", lambda ts: [[1.0] for _ in ts], 2).collect()


def test_notify(spark):
    reg = spark.createDataFrame([("s", 1)], "source_id string, consecutive_failures int")
    runs = spark.createDataFrame([(1, "partial"), (2, "done")], "run_id int, status string")
    seen = []
    assert external.notify(runs, reg, seen.append) is False
    assert external.notify(runs, reg.withColumn("consecutive_failures", F.lit(3)), seen.append) is True and seen[0]["run_id"] == 2
    assert external.notify(runs.filter("run_id = 1"), reg, seen.append) is True
    assert external.notify(runs.filter("run_id = 1"), reg, lambda r: 1 / 0) is False and external.notify(runs.limit(0), reg, seen.append) is False


def test_topics(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "topic string, min_hits int")
    assert {tuple(r) for r in lookups.upsert_topics(t, spark.createDataFrame([("b", 5), ("c", 3), ("c", 4)], "topic string, min_hits int")).collect()} == {("a", 1), ("b", 5), ("c", 4)}
