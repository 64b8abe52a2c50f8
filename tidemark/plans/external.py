"""Where a model or a messenger is plugged in (X-1, X-4, S-23). The engine never calls one by itself."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.salvage import rules_from_answer
from ..functions.text import chunks
from ..operators.rollups import alert_needed


def ask(pages: DataFrame, call: Callable[[str, str, str], str]) -> DataFrame:
    """X-1: (url, org, chunk_no, answer): call(text, org, url) for each chunk of each page, batch by batch on the executors.
    A call that raises gives a null answer, which counts as a failed extraction. Evaluated once per chunk only if the
    result is stored; store it before filtering on it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for url, org, no, text in zip(b["url"], b["org"], b["chunk_no"], b["chunk"]):
                try:
                    answer = call(text, org, url)
                except Exception:  # noqa: BLE001 - whatever the model's client raises
                    answer = None
                out.append((url, org, no, answer))
            yield pd.DataFrame(out, columns=["url", "org", "chunk_no", "answer"])

    parts = pages.filter("text IS NOT NULL").select("url", "org", F.posexplode(chunks(F.col("text"))).alias("chunk_no", "chunk"))
    return parts.mapInPandas(run, "url string, org string, chunk_no int, answer string")


def answers(asked: DataFrame) -> DataFrame:
    """(url, org, rules): the rules of all chunks of a page in order; null if a chunk failed or could not be read."""
    r = asked.withColumn("rules", rules_from_answer(F.col("answer")))
    ok = F.bool_and(F.col("rules").isNotNull())
    rules = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "rules"))), lambda x: x["rules"]))
    return r.groupBy("url").agg(F.max("org").alias("org"), F.when(ok, rules).alias("rules"))


def embed(rows: DataFrame, text: str, call: Callable[[list[str]], list[list[float]]], dim: int, batch: int = 96) -> DataFrame:
    """X-4: (id, embedding): call(texts) in batches; vectors of another length than dim are an error of the model's set-up
    and fail the job before anything is written."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), batch):
                part = b.iloc[i : i + batch]
                got = call(part[text].tolist())
                if any(len(v) != dim for v in got) or len(got) != len(part):
                    raise ValueError(f"vectors of {dim} numbers were expected")
                yield pd.DataFrame({"id": part["id"].to_numpy(object), "embedding": pd.Series([[float(x) for x in v] for v in got], dtype=object).to_numpy()})

    return rows.select("id", text).mapInPandas(run, "id string, embedding array<float>")


def notify(summary: DataFrame, registry: DataFrame, post: Callable[[Row], None]) -> bool:
    """S-23: posts the newest run of a summary (run_id, status, ...) if it is not done or a source keeps failing; never
    raises. Returns whether something was posted."""
    try:
        streak = registry.agg(F.max("consecutive_failures").alias("streak"))
        last = summary.orderBy(F.desc("run_id")).limit(1).join(F.broadcast(streak))  # one row each
        row = last.withColumn("alert", alert_needed(F.col("status"), F.col("streak"))).first()
        if row is None or not row["alert"]:
            return False
        post(row)
        return True
    except Exception:  # noqa: BLE001 - an alert must not break a run
        return False
