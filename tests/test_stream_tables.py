"""A table stored as a folder of part files is streamed whole, as a single file is."""

import pytest
from pyspark.sql import functions as F

from millrace.plans import streams
from millrace.session import scratch_path
from millrace.sources.tables import table
from millrace.streaming.jobs import append_to_parquet, stream_table, work_folders


@pytest.fixture(scope="module")
def in_parts(spark, sf):
    """The events as a table of five files, and beside it a table that is not events."""
    path = scratch_path(spark, "tables")
    events = table(spark, sf, "events")
    events.repartition(5, "event_id").write.parquet(f"{path}/events.parquet")
    events.limit(3).write.parquet(f"{path}/other.parquet")
    return path


def streamed(spark, folder, **options):
    out, checkpoint = work_folders(spark, "stream-table")
    append_to_parquet(stream_table(spark, folder, "events", **options), out, checkpoint)
    return sorted(r.event_id for r in spark.read.parquet(out).select("event_id").collect())


def test_every_row_of_every_part(spark, sf, in_parts):
    want = sorted(r.event_id for r in table(spark, sf, "events").select("event_id").collect())
    assert streamed(spark, in_parts) == want
    assert streamed(spark, in_parts, files_per_batch=2) == want
    assert streamed(spark, sf) == want


def test_a_table_partitioned_by_a_column(spark, sf):
    path, events = scratch_path(spark, "tables"), table(spark, sf, "events")
    events.write.partitionBy("event_type").parquet(f"{path}/events.parquet")
    out, checkpoint = work_folders(spark, "stream-table")
    append_to_parquet(stream_table(spark, path, "events"), out, checkpoint)
    got = spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, events.groupBy("event_type").agg(F.count("*").alias("n")).collect()))


QUERIES = "request_log recent_window_stream drift_stream prediction_distribution alerts_stream events_hourly circuit_stream checkpointed_process".split()


@pytest.mark.parametrize("name", QUERIES)
def test_queries_over_parts(spark, sf, in_parts, name):
    build = getattr(streams, name)
    want = build(spark, sf)
    columns = sorted(want.columns)

    def rows(df):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    expected = rows(want)
    assert expected and rows(build(spark, in_parts)) == expected
