from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.streaming import replay

T0 = datetime(2025, 1, 1)


def write(spark, folder, rows, ddl, name, n):
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{folder}/{name}.parquet/batch{n}")


def test_windows_equal_batch_up_to_the_watermark(spark, tmp_path):
    rows = [(T0 + timedelta(hours=i), "ab"[i % 2], float(i)) for i in range(96)]
    ddl = "ts timestamp, event_type string, value double"
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    stream = replay.stream_table(spark, str(tmp_path), "events", spark.read.parquet(f"{tmp_path}/events.parquet").schema)
    replay.replay_to_folder(replay.windowed_counts(stream), f"{tmp_path}/out", f"{tmp_path}/offsets")
    got = {(r["window_start"], r["event_type"]): (r["n"], r["total"]) for r in spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/out").collect()}
    want = {}
    for ts, e, v in rows:
        k = (datetime(ts.year, ts.month, ts.day), e)
        want[k] = (want.get(k, (0, 0))[0] + 1, want.get(k, (0, 0))[1] + v)
    closed = {k: v for k, v in want.items() if k[0] + timedelta(days=1) <= rows[-1][0] - timedelta(hours=1)}
    assert got == closed and len(closed) == 6


def test_first_versions(spark, tmp_path):
    rows = [("u", "h", T0), ("u", "h", T0 + timedelta(hours=1)), ("u", "h2", T0), ("v", "h", T0)]
    ddl = "url string, new_hash string, detected_at timestamp"
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/c.parquet")
    s = replay.first_versions(replay.stream_table(spark, str(tmp_path), "c", spark.read.parquet(f"{tmp_path}/c.parquet").schema))
    replay.replay_to_folder(s, f"{tmp_path}/out", f"{tmp_path}/offsets")
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/out").select("url", "new_hash").distinct().count() == 3


def test_failure_state(spark, tmp_path):
    rows = [(1, "a", "failed"), (2, "a", "extracted"), (3, "a", "gave_up"), (4, "b", "failed"), (5, "b", "failed")]
    spark.createDataFrame(rows, "change_id int, source_id string, extract_status string").coalesce(1).write.parquet(f"{tmp_path}/c.parquet")
    s = replay.failure_counts(replay.stream_table(spark, str(tmp_path), "c", spark.read.parquet(f"{tmp_path}/c.parquet").schema))
    replay.replay_to_folder(s, f"{tmp_path}/out", f"{tmp_path}/offsets", mode="update")
    got = {r["source_id"]: r["failures"] for r in spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/out").orderBy(F.col("failures")).collect()}
    assert got == {"a": 1, "b": 2}


def test_open_windows_complete_a_bounded_replay(spark, tmp_path):
    rows = [(T0 + timedelta(hours=i), ("a", "b", None)[i % 3], float(i)) for i in range(100)] + [(None, "a", 1.0)]
    spark.createDataFrame(rows, "ts timestamp, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    events = spark.read.parquet(f"{tmp_path}/events.parquet")
    replay.replay_to_folder(replay.windowed_counts(replay.stream_table(spark, str(tmp_path), "events", events.schema)), f"{tmp_path}/out", f"{tmp_path}/offsets")
    emitted = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/out")
    rest = replay.open_windows(events, emitted)
    assert {r["window_start"] for r in rest.collect()} == {T0 + timedelta(days=4)}
    whole = sorted(map(str, replay.windowed_counts(events).collect()))
    assert sorted(map(str, emitted.unionByName(rest).collect())) == whole and len(whole) == 15


def test_failure_state_does_not_depend_on_chunks(spark, tmp_path):
    """One source with far more rows than a chunk holds, out of order: the last success decides."""
    n = 25_000
    df = spark.range(n).selectExpr("cast(id AS int) AS change_id", "'s' AS source_id", "if(id % 5000 = 4321, 'extracted', 'failed') AS extract_status")
    df.orderBy(F.xxhash64("change_id")).coalesce(1).write.parquet(f"{tmp_path}/c.parquet/b1")
    schema = spark.read.parquet(f"{tmp_path}/c.parquet/b1").schema
    s = replay.failure_counts(replay.stream_table(spark, str(tmp_path), "c", schema))
    replay.replay_to_folder(s, f"{tmp_path}/out", f"{tmp_path}/offsets", mode="update")
    last = max(i for i in range(n) if i % 5000 == 4321)
    assert [r["failures"] for r in spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/out").collect()] == [n - 1 - last]
