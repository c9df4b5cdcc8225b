"""Streams over several files give the same result as the batch operators."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning, monitoring
from millrace.plans.fixtures import feat_from, reqs_from
from millrace.session import scratch_path
from millrace.sources.tables import table
from millrace.streaming import monitor
from millrace.streaming.jobs import epoch_path, fold_stream, stream_folder, work_folders


@pytest.fixture(scope="module")
def event_files(spark, sf):
    """The events in four files, one per 250 ids, in time order."""
    path = scratch_path(spark, "event-files")
    events = table(spark, sf, "events")
    for part in range(4):
        events.where(F.floor(F.col("event_id") / 250) == part).coalesce(1).write.mode("append").parquet(path)
    return path


def same(a, b):
    columns = sorted(a.columns)

    def rows(df):
        found = df.select(*columns).collect()
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in found), key=repr)

    return rows(a) == rows(b)


def test_window_state_over_files(spark, event_files):
    batch = reqs_from(spark.read.parquet(event_files))
    state = monitor.window_state(reqs_from(stream_folder(spark, event_files)), ["feature_0"], ["endpoint"], "request_id")
    got = monitor.state_stats(state, "recent", ["feature_0"], ["endpoint"])
    assert same(got, monitoring.recent_window_stats(batch, ["feature_0"], ["endpoint"], "request_id"))
    drift = monitor.drift_from_state(state, ["feature_0"], ["endpoint"])
    assert drift.count() > 0
    assert same(drift, monitoring.drift_by_feature(batch, ["feature_0"], ["endpoint"], "request_id"))


def test_circuit_state_over_files(spark, event_files):
    def rows(df):
        return df.select("user_id", "event_id", (F.col("event_type") == "error").cast("int").alias("error"))

    got = monitor.circuit_states(rows(stream_folder(spark, event_files)), ["user_id"], "event_id")
    want = monitoring.circuit_state(rows(spark.read.parquet(event_files)), ["user_id"], "event_id")
    assert same(got, want)


def test_prediction_totals_over_files(spark, event_files):
    got = monitor.prediction_totals(reqs_from(stream_folder(spark, event_files)), ["endpoint"])
    assert same(got, monitoring.prediction_distribution(reqs_from(spark.read.parquet(event_files)), ["endpoint"]))


def test_checkpointed_batches_and_progress(spark, event_files):
    def rows(df):
        return feat_from(df).drop("ts").withColumn("batch_id", F.floor(F.col("id") / 125))

    got, progress = monitor.process_checkpointed(rows(stream_folder(spark, event_files)))
    assert same(got, cleaning.process_batches(rows(spark.read.parquet(event_files)), "batch_id"))
    per_epoch = progress.groupBy("epoch").agg(F.sum("rows_in_batch").alias("n"), F.count("*").alias("b")).collect()
    assert len(per_epoch) == 4 and sum(r.n for r in per_epoch) == 1000 and all(r.b == 2 for r in per_epoch)


def test_a_failed_batch_is_resumed_and_not_counted_twice(spark, event_files):
    path, checkpoint = work_folders(spark, "resume")
    seen = []

    def fold(state, batch):
        n = batch.groupBy().agg(F.count("*").alias("n"))
        out = n if state is None else n.unionByName(state).agg(F.sum("n").alias("n"))
        if len(seen) == 2:
            out.write.mode("overwrite").parquet(epoch_path(path, 2))
            seen.append("crash")
            raise RuntimeError("lost")
        seen.append("ok")
        return out

    with pytest.raises(Exception, match="lost"):
        fold_stream(stream_folder(spark, event_files), path, checkpoint, fold)
    assert seen == ["ok", "ok", "crash"]
    assert fold_stream(stream_folder(spark, event_files), path, checkpoint, fold).first().n == 1000
    assert seen == ["ok", "ok", "crash", "ok", "ok"]


def test_streams_go_on_and_take_files_in_any_order(spark, sf, tmp_path):
    """Two runs over the same folders: files of mixed ids, batch ids across files, a restart
    with new files, and one without."""
    source, events = f"file://{tmp_path}/source", table(spark, sf, "events")

    def add(part):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(source)

    def flags(df):
        return df.select("user_id", "event_id", (F.col("event_type") == "error").cast("int").alias("error"))

    def batches(df):
        return feat_from(df).drop("ts").withColumn("batch_id", F.floor(F.col("id") / 125))

    folder = f"file://{tmp_path}/work"
    for part in (3, 1):
        add(part)
    for fresh in ((), (0, 2), ()):
        for part in fresh:
            add(part)
        whole = spark.read.parquet(source)
        got = monitor.circuit_states(flags(stream_folder(spark, source)), ["user_id"], "event_id", f"{folder}/circuits")
        assert same(got, monitoring.circuit_state(flags(whole), ["user_id"], "event_id"))
        rows, progress = monitor.process_checkpointed(batches(stream_folder(spark, source)), folder=f"{folder}/batches")
        assert same(rows, cleaning.process_batches(batches(whole), "batch_id"))
        assert same(progress.drop("epoch"), batches(whole).groupBy("batch_id").agg(F.count("*").alias("rows_in_batch")))
        totals = monitor.prediction_totals(reqs_from(stream_folder(spark, source)), ["endpoint"], f"{folder}/totals")
        assert same(totals, monitoring.prediction_distribution(reqs_from(whole), ["endpoint"]))
        log = monitor.log_requests(reqs_from(stream_folder(spark, source)), f"{folder}/log")
        assert log.count() == whole.count()
