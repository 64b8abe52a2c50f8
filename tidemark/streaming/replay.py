"""Structured Streaming over append-only logs: windowed counts, deduplication, and a fold that keeps state per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_table(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """The files of one table as a stream. folder holds <name>.parquet, as a file or a directory of files."""
    ndjson = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    return ndjson.parquet(f"{folder.rstrip('/')}/{{{name}.parquet,{name}.parquet/*}}")


def windowed_counts(events: DataFrame, at: str = "ts", keys: tuple[str, ...] = ("event_type",), window: str = "1 day", late: str = "1 hour", value: str = "value") -> DataFrame:
    """Counts and sums per tumbling window and key; rows later than the watermark are dropped."""
    return (
        events.withWatermark(at, late)
        .groupBy(F.window(at, window).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 6).alias("total"))
        .select(F.col("w.start").alias("window_start"), *keys, "n", "total")
    )


def open_windows(events: DataFrame, emitted: DataFrame, keys: tuple[str, ...] = ("event_type",), **how: str) -> DataFrame:
    """At the end of a bounded log: the windows of windowed_counts over all its events (as a batch) that a replay did not
    emit, since the watermark has not passed them."""
    done = emitted.select("window_start", *keys).alias("d")
    same = F.lit(True)
    for c in ("window_start", *keys):
        same = same & F.col(f"w.{c}").eqNullSafe(F.col(f"d.{c}"))
    return windowed_counts(events, keys=keys, **how).alias("w").join(done, same, "left_anti")


def first_versions(changes: DataFrame, late: str = "7 days") -> DataFrame:
    """The first row of each (url, new_hash) within the watermark."""
    return changes.withWatermark("detected_at", late).dropDuplicatesWithinWatermark(["url", "new_hash"])


def failure_counts(changes: DataFrame) -> DataFrame:
    """The failure streak per source, kept as state: (source_id, failures) whenever a batch brings rows of the source. A batch's
    rows may come in any order and in any number of chunks: only the failures after the last success among all of them
    count, repeated change_ids once. Batches must follow one another in order of change_id."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, last_ok = state.get if state.exists else (0, -1)
        bad: set[int] = set()
        before = last_ok
        for pdf in batches:
            failed = pdf["extract_status"].isin(("failed", "gave_up"))
            ok = pdf.loc[~failed, "change_id"]
            last_ok = max(last_ok, int(ok.max())) if len(ok) else last_ok
            bad.update(int(x) for x in pdf.loc[failed, "change_id"] if x > last_ok)
        n = (n if last_ok == before else 0) + sum(x > last_ok for x in bad)
        state.update((n, last_ok))
        yield pd.DataFrame({"source_id": [key[0]], "failures": [n]})

    return changes.groupBy("source_id").applyInPandasWithState(step, "source_id string, failures long", "failures long, last_ok long", "update", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """T-1: processes what there is as micro-batches and stops; the checkpoint folder keeps the offsets."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()


def replay_to_folder(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Like run_available, appending each batch to a folder of Parquet files by batch number, so a replayed batch
    overwrites itself."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch}")

    run_available(stream, write, checkpoint, mode)
