"""Fixed-size chunks: assignment, per-chunk profiles, progress totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.prefix import id_order_bucket, prefix_sums, rank_in_group
from millrace.functions.scalars import ratio


def assign_chunks(df: DataFrame, key: str, size: int) -> DataFrame:
    """Add the 1-based `chunk_number` and the 0-based `streaming_id` inside the chunk, by
    position in key order. Positions come from bucket totals, not from a global sort."""
    ranked = rank_in_group(df, [], [F.col(key)], id_order_bucket(F.col(key)), "__pos")
    return ranked.withColumns(
        {
            "chunk_number": F.floor(F.col("__pos") / size) + 1,
            "streaming_id": F.col("__pos") % size,
        }
    ).drop("__pos", "__pos_total")


def grouped_profile(df: DataFrame, keys: Sequence[str], aggs: dict[str, Sequence[str]]) -> DataFrame:
    """Several aggregates per column in one pass, named `<column>_<function>`."""
    functions = {"mean": F.avg, "std": F.stddev_samp, "count": F.count, "max": F.max, "min": F.min, "sum": F.sum}
    return df.groupBy(*keys).agg(*[functions[f](c).alias(f"{c}_{f}") for c, names in aggs.items() for f in names])


def chunk_profile(df: DataFrame, chunk: str, key: str, mean_of: str, std_of: str, target: str) -> DataFrame:
    return df.groupBy(chunk).agg(
        F.min(key).alias("start_row"),
        F.max(key).alias("end_row"),
        F.count("*").alias("rows"),
        F.avg(mean_of).alias(f"{mean_of}_mean"),
        F.stddev_samp(std_of).alias(f"{std_of}_std"),
        F.avg(target).alias("target_ratio"),
    )


def chunk_summary(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count("*").alias("chunks_processed"),
        F.sum("rows").alias("total_rows"),
        F.max("rows").alias("peak_chunk_rows"),
        F.avg("rows").alias("average_chunk_rows"),
        F.max("target_ratio").alias("peak_target_ratio"),
    )


def batch_progress(df: DataFrame, batch: str, seconds: Column) -> DataFrame:
    """One row per batch with running totals. There is one batch per few thousand rows,
    so the running totals use bucket offsets as well."""
    stats = df.groupBy(batch).agg(F.count("*").alias("rows_in_batch"), F.sum(seconds).alias("processing_seconds"))
    running = prefix_sums(
        stats,
        [],
        [F.col(batch)],
        id_order_bucket(F.col(batch), 4096),
        {"rows": F.col("rows_in_batch"), "done": F.lit(1).cast("long")},
        totals=True,
    )
    return running.select(
        batch,
        "rows_in_batch",
        "processing_seconds",
        (F.col("rows_before") + F.col("rows_in_batch")).alias("cumulative_rows"),
        (F.col("done_before") + 1).alias("batches_completed"),
        ratio((F.col("rows_before") + F.col("rows_in_batch")).cast("double"), F.col("rows_total").cast("double")).alias("share_done"),
    )


def progress_totals(progress: DataFrame) -> DataFrame:
    return progress.agg(
        F.sum("rows_in_batch").alias("processed_rows"),
        F.count("*").alias("batches"),
        F.sum("processing_seconds").alias("total_seconds"),
        ratio(F.sum("processing_seconds"), F.count("*").cast("double")).alias("average_seconds"),
    )
