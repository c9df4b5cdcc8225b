"""Published versions, positions, the saved scaler, versioned groups, event-time streams."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning, lifecycle, monitoring, quality, scaling, search
from millrace.operators.scaler_stage import load_scaler, save_scaler
from millrace.session import scratch_path
from millrace.sources.published import align_positions, positioned, publish, published, withdraw
from millrace.sources.tables import table
from millrace.streaming import monitor
from millrace.streaming.jobs import stream_folder
from millrace.streaming.versions import VersionedTable


def rows_of(df, *columns):
    return sorted(((tuple(r)) for r in df.select(*columns).collect()), key=repr)


# ---------------------------------------------------------------- published tables


def test_a_repeated_job_replaces_its_own_partition(spark):
    path = scratch_path(spark, "published")
    schema = "key long, value double, version string"
    publish(spark.createDataFrame([(1, 1.0, "1"), (2, 2.0, "1"), (3, 3.0, None)], schema), path, ["version"])
    publish(spark.createDataFrame([(1, 10.0, "2")], schema), path, ["version"])
    publish(spark.createDataFrame([(1, 1.5, "1")], schema), path, ["version"])
    frame = spark.createDataFrame([], schema).schema
    read = published(spark, path, frame)
    assert rows_of(read, "key", "value", "version") == sorted([(1, 1.5, "1"), (1, 10.0, "2"), (3, 3.0, None)], key=repr)
    one = published(spark, path, frame, version="2")
    assert rows_of(one, "key", "version") == [(1, "2")] and len(one.inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan and "version" in plan
    assert rows_of(published(spark, path, frame, version=None), "key") == [(3,)]
    publish(spark.createDataFrame([], schema), path, ["version"])
    assert published(spark, path, frame).count() == 3
    withdraw(spark, path, version="2")
    assert rows_of(published(spark, path, frame), "key") == [(1,), (3,)]


def test_positions_over_files_and_row_groups(spark, tmp_path):
    """Files of different sizes with several row groups: the position is that of the rows one after another."""
    path, n = f"file://{tmp_path}/t.parquet", 0
    for i, size in enumerate((3000, 1, 0, 1700)):
        part = f"{tmp_path}/part{i}"
        spark.range(n, n + size).coalesce(1).withColumn("text", F.repeat(F.lit("x"), 50)).write.option("parquet.block.size", 4096).parquet(f"file://{part}")
        os.makedirs(f"{tmp_path}/t.parquet", exist_ok=True)
        own = [f for f in os.listdir(part) if f.endswith(".parquet")]
        for f in own:
            os.symlink(f"{part}/{f}", f"{tmp_path}/t.parquet/{i:03d}.parquet")
        n += size
    got = positioned(spark.read.parquet(path).select("id"))
    assert got.columns == ["id", "position"] and got.count() == n and got.where("id <> position").count() == 0
    y = spark.read.parquet(f"file://{tmp_path}/part0").select(F.col("id").alias("other"))
    both = align_positions(spark.read.parquet(path).select("id"), y)
    assert both.count() == 3000 and both.where("id <> other").count() == 0


def test_registry_appends_once(spark):
    path = scratch_path(spark, "registry")
    runs = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 1, "c"), (None, 1, "d")], "name long, version long, status string")
    records = lifecycle.registry_record(runs, F.col("name"), F.col("version"), F.lit("s3://m"), status=F.col("status"))
    for _ in range(2):
        lifecycle.append_records(records, path)
    lifecycle.append_records(records.withColumn("version", F.col("version") + 5), path)
    latest = lifecycle.registry_latest(spark.read.parquet(path))
    assert rows_of(latest, "name", "version", "versions") == sorted([(1, 7, 4), (2, 6, 2), (None, 6, 2)], key=repr)


# ---------------------------------------------------------------- the saved scaler


def test_scaler_survives_its_storage(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), 7.0, None) for a, b in rng.normal(3, 2, (500, 2))] + [(None, 1.0, 7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, flat double, gone double")
    names = ["a", "b", "flat", "gone"]
    stage = load_scaler(save_scaler(df, names, scratch_path(spark, "scaler")))
    assert stage.getOrDefault("features") == names
    direct = scaling.standardize(df, names, scaling.scaler_table(df, names))
    scaled = [f"{n}_scaled" for n in names]
    assert rows_of(stage.transform(df), *scaled) == rows_of(direct, *scaled)
    side = {r.feature: r for r in stage.scaled_table(spark).collect()}
    a = np.array([r[0] for r in rows[:500]])
    z = (a - a.mean()) / a.std()
    assert np.allclose([side["a"][k] for k in ("mean", "std", "min", "max", "median")], [0, z.std(ddof=1), z.min(), z.max(), np.median(z)], atol=1e-9)
    assert (side["flat"]["min"], side["flat"]["max"], side["flat"]["std"]) == (0.0, 0.0, 0.0)
    assert all(side["gone"][k] is None for k in ("mean", "std", "min", "max", "median"))
    assert rows_of(stage.outliers(df, 2.0), "a", "has_outliers") == rows_of(scaling.outliers(df, names, scaling.scaler_table(df, names), 2.0), "a", "has_outliers")


# ---------------------------------------------------------------- sketches, fingerprints, latest values


def test_sketches_merge_over_any_chunks(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("chunk"), (F.col("id") % 5000).alias("v"), F.lit(None).cast("string").alias("none"))
    held = quality.distinct_sketches(df, ["chunk"], ["v", "none"])
    whole = {r.column: r.estimate for r in quality.sketched_distinct(held).collect()}
    assert whole["none"] == 0 and abs(whole["v"] - 5000) < 150
    reqs = spark.range(5000).select(F.lit(1).alias("k"), (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=F.col("id").cast("int"))).alias("ts"), F.when(F.col("id") != 3, F.col("id").cast("double")).alias("latency_ms"))
    sketches = monitoring.latency_sketches(reqs, ["k"])
    tail = monitoring.sketched_tails(sketches, ["k"], {"p95": 0.95}).first()
    assert sketches.count() == 84 and tail.n == 4999 and abs(tail.p95 - 4750) < 60


def test_fingerprints_take_any_number(spark):
    rows = [(1, 1e14, "a"), (2, float("nan"), "b"), (3, float("inf"), None), (4, None, "b"), (5, 0.1 + 0.2, "c")]
    df = spark.createDataFrame(rows, "id long, v double, s string")
    one = quality.fingerprint_sum(df).first()
    assert one == quality.fingerprint_sum(df.repartition(3)).first() and one.rows == 5
    assert one.fingerprint != quality.fingerprint_sum(df.withColumn("v", F.when(F.col("id") == 5, 0.3).otherwise(F.col("v")))).first().fingerprint
    assert quality.fingerprint_sum(df.where("id > 9")).first().rows == 0


def test_latest_line_of_one_step(spark):
    rows = [("t", "m", 0.5, 3, 1), ("t", "m", 0.4, 3, 2), ("t", "m", 0.9, 2, 3), ("u", "m", 0.1, None, 1), ("u", "m", 0.2, None, 2)]
    df = spark.createDataFrame(rows, "trial string, name string, value double, step int, line int")
    assert {r.trial: r.latest for r in search.latest_metrics(df, line="line").collect()} == {"t": 0.4, "u": 0.2}
    assert {r.trial: r.latest for r in search.latest_metrics(df).collect()} == {"t": 0.5, "u": 0.2}


def test_a_rung_ranks_only_survivors(spark):
    """Trial 9 would win the second rung but was eliminated in the first; NaN and null never go on."""
    schedule = search.halving_schedule(9)
    trials = search.deal_brackets(spark.range(9).select(F.col("id").alias("trial"), F.col("id").alias("rank")), schedule)
    first = {0: 0.9, 1: 0.8, 2: 0.7, 3: float("nan"), 4: None, 5: 0.1, 6: 0.1, 7: 0.1, 8: 0.05}
    metrics = [(t, 1, v) for t, v in first.items()] + [(t, 3, 0.5 if t != 8 else 1.0) for t in range(9)] + [(0, 9, 0.6)]
    out = search.halving_brackets(trials, spark.createDataFrame(metrics, "trial long, step long, value double"), schedule)
    got = {(r.rung, r.trial): r.promoted for r in out.where("bracket = 2").collect()}
    assert [t for (rung, t), p in got.items() if rung == 0 and p] == [0, 1, 2]
    assert sorted(t for rung, t in got if rung == 1) == [0, 1, 2] and got[(1, 0)] and not got[(1, 1)]
    assert [(k, p) for k, p in got.items() if k[0] == 2] == [((2, 0), False)]


# ---------------------------------------------------------------- versioned groups


def test_versions_read_only_what_a_batch_touches(spark):
    """Twelve batches of two groups each, one group in all of them: reads are bounded, buckets are
    compacted, a repeated batch changes nothing, and every row is there."""
    path, deltas = scratch_path(spark, "versions"), 3

    def batch(e):
        rows = [(1000 * e + i, "hot" if i % 2 else f"g{e}", None if i == 3 else float(i), float(i)) for i in range(20)]
        return spark.createDataFrame(rows, "id long, batch_id string, f1 double, f2 double")

    process = lambda whole: cleaning.process_batches(whole, "batch_id")
    store = VersionedTable(spark, path, "batch_id", buckets=16, deltas=deltas)
    for e in range(12):
        read = store.merge(batch(e), e, process)
        assert len(read) <= 2 * (deltas + 1) and len(spark.read.parquet(*read).inputFiles() if read else []) <= 2 * (deltas + 1)
        if e in (0, 5):
            assert len(store.merge(batch(e), e, process)) == len(read)  # repeated
    live = store._log(11)
    assert max(map(len, live.values())) <= deltas + 1
    whole = batch(0)
    for e in range(1, 12):
        whole = whole.unionByName(batch(e))
    want = rows_of(process(whole).withColumn("f1_processed", F.round("f1_processed", 9)), "id", "batch_id", "f1_processed")
    assert rows_of(store.read().withColumn("f1_processed", F.round("f1_processed", 9)), "id", "batch_id", "f1_processed") == want
    assert store.read().where("batch_id = 'hot'").select("epoch").distinct().count() == 1
    assert len(store._epochs()) <= 3


def test_versions_of_null_groups_and_empty_batches(spark):
    store = VersionedTable(spark, scratch_path(spark, "versions"), "g", buckets=4, deltas=1)
    rows = lambda *r: spark.createDataFrame(list(r), "g long, v long")
    for e, own in enumerate([rows((None, 1), (1, 1)), rows(), rows((None, 2)), rows((1, 3), (None, 3))]):
        store.merge(own, e, lambda whole: whole)
    assert rows_of(store.read(), "g", "v") == sorted([(None, 1), (None, 2), (None, 3), (1, 1), (1, 3)], key=repr)


# ---------------------------------------------------------------- state per key


def files_of(spark, tmp_path, name, *parts, schema):
    path = f"file://{tmp_path}/{name}"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def test_edges_and_failures_of_awkward_keys(spark, tmp_path):
    """Null keys and orders, a hot key, integers beside nulls, in files of any order."""
    rng = np.random.default_rng(2)
    big = 2**60
    rows = [(None if i % 5 == 0 else i % 3, None if i % 50 == 7 else big + i, float(i % 11) if i % 4 else None, "error" if rng.random() < 0.5 else "ok") for i in range(3000)]
    rng.shuffle(rows)
    rows = [(None if k is None else int(k), None if o is None else int(o), None if v is None else float(v), str(s)) for k, o, v, s in rows]
    path = files_of(spark, tmp_path, "edges", rows[:900], rows[900:1000], rows[1000:], schema="k long, o long, v double, s string")
    batch = spark.read.parquet(path)
    state = monitor.window_state(stream_folder(spark, path), ["v"], ["k"], "o")
    for kind, latest in (("first", False), ("recent", True)):
        edge = monitoring.latest_rows if latest else monitoring.first_rows
        n = monitoring.WINDOW_SIZE if latest else monitoring.BASELINE_REQUESTS
        want = edge(batch.where("o is not null"), ["k"], "o", n)
        got = state.where(F.col("kind") == kind).where("o is not null")
        assert rows_of(got, "k", "o", "v") == rows_of(want, "k", "o", "v")

    def flags(df):
        return df.where("o is not null").select("k", (F.col("o") - big).alias("o"), (F.col("s") == "error").cast("int").alias("error"))

    got = monitor.circuit_states(flags(stream_folder(spark, path)), ["k"], "o")
    fields = ("k", "total_failures", "consecutive_failures", "state")
    want = monitoring.circuit_state(flags(batch).withColumn("k", F.coalesce("k", F.lit(-1))), ["k"], "o").withColumn("k", F.when(F.col("k") >= 0, F.col("k")))
    assert rows_of(got, *fields) == rows_of(want, *fields)


def test_a_batch_updates_only_its_keys(spark, tmp_path):
    path = files_of(spark, tmp_path, "keys", [(k, k, 1) for k in range(50)], [(7, 100, 1), (7, 101, 0), (60, 1, 1)], schema="k long, o long, error int")
    folder = f"file://{tmp_path}/work"
    monitor.circuit_states(stream_folder(spark, path), ["k"], "o", folder)
    import json

    with open(f"{tmp_path}/work/checkpoint/commits/1") as f:
        assert f.read()
    changed = spark.read.format("statestore").option("stateVarName", "head").option("batchId", 1).load(f"{folder}/checkpoint")
    assert changed.count() == 51
    before = spark.read.format("statestore").option("stateVarName", "head").option("batchId", 0).load(f"{folder}/checkpoint")
    same = changed.select(F.to_json("key").alias("k"), F.to_json("value").alias("v")).intersect(before.select(F.to_json("key"), F.to_json("value")))
    assert same.count() == 49 and json.loads(same.first().k)


# ---------------------------------------------------------------- event time


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double"


def minute(m):
    import datetime as dt

    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)


def test_sessions_close_and_late_events_are_counted(spark, tmp_path):
    """The second file moves the watermark on; the third has a late event and one that still joins."""
    files = [
        [(1, minute(0), 1, "a", 1.0), (2, minute(20), 1, "a", 1.0), (3, minute(10), 2, "a", 1.0), (4, minute(300), 1, "a", 1.0)],
        [(5, minute(310), 2, "a", 1.0), (6, minute(600), 3, "a", 1.0)],
        [(7, minute(5), 1, "a", 1.0), (8, minute(595), 3, "a", 1.0), (9, minute(2000), 4, "a", 1.0)],
        [(10, minute(30), 1, "a", 1.0), (11, minute(2001), 4, "a", 1.0)],
    ]
    path, folder = files_of(spark, tmp_path, "sessions", *files, schema=EVENTS), f"file://{tmp_path}/work"
    closed = monitor.user_sessions(stream_folder(spark, path), ["user_id"], "30 minutes", "10 minutes", folder)
    assert rows_of(closed, "user_id", "events") == [(1, 1), (1, 2), (2, 1), (2, 1), (3, 2)]
    assert tuple(monitor.event_accounts(spark.read.parquet(path), closed, folder).first()) == (11, 7, 2, 2)
    tumbling = monitor.hourly_events(stream_folder(spark, path), folder=f"{folder}2")
    total = monitor.event_accounts(spark.read.parquet(path), tumbling, f"{folder}2").first()
    assert total.events == 11 and total.late == 2 and total.closed + total.open == 9


def test_copies_within_the_delay_are_dropped(spark, sf, tmp_path):
    path, events = f"file://{tmp_path}/copies", table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    for part in range(4):
        own = events.where(F.floor(F.col("event_id") / 250) == part)
        own.union(own.where("event_id % 3 = 0")).union(events.where(F.col("event_id") == 250 * part - 1)).coalesce(1).write.mode("append").parquet(path)
    once = monitor.distinct_events(stream_folder(spark, path), ["event_id"], "2 days")
    assert rows_of(once, "event_id", "value") == rows_of(spark.read.parquet(path).distinct(), "event_id", "value")


def test_sliding_windows_hold_an_event_each(spark, tmp_path):
    path = files_of(spark, tmp_path, "sliding", [(i, minute(30 * i), 1, "a", 1.0) for i in range(40)], schema=EVENTS)
    folder = f"file://{tmp_path}/work"
    out = monitor.hourly_events(stream_folder(spark, path), folder=folder, window="3 hours", slide="1 hour")
    assert out.agg(F.max("events")).first()[0] == 6
    total = monitor.event_accounts(spark.read.parquet(path), out, folder, windows=3).first()
    assert total.events == 120 and total.late == 0 and total.closed + total.open == 120


@pytest.mark.parametrize("name", ["user_sessions", "distinct_events"])
def test_no_data_no_rows(spark, tmp_path, name):
    path = f"file://{tmp_path}/none"
    spark.createDataFrame([], EVENTS).coalesce(1).write.parquet(path)
    stream = stream_folder(spark, path)
    out = monitor.user_sessions(stream, ["user_id"], "1 hour") if name == "user_sessions" else monitor.distinct_events(stream, ["event_id"], "1 hour")
    assert out.count() == 0
