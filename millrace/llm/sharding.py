"""Two-pass external shuffle into shards (operator 7).

Pass one scatters whole records uniformly into buckets by a seeded hash of key and text; the
number of buckets follows from the measured bytes, so that a bucket fits in memory. Pass two
shuffles each bucket by Fisher-Yates with a generator seeded by (seed, bucket) over its rows
in a fixed order, and gives every record its place in the whole shuffled sequence: the rows
of the buckets before it, plus its place in its own. The sequence is cut into `shards`
stretches whose counts are at most one apart (law `rows`), which are written shard by shard.

Deterministic: the same rows, seed and bucket size give the same shards, on any cluster and
after any repeated task. Defined cases: null key or text are hashed like values, a null text
has size 16 and checksum 0; repeated rows each get a place; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch_path

BUCKET_BYTES = 32 << 20
ROW_BYTES = 16


def record_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def record_checksum(text: str = "text") -> Column:
    return F.coalesce(F.crc32(text), F.lit(0)).cast("long")


def external_shuffle(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 40, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Key, text and their shard and slot; columns key, text, size, text_crc32, shard, slot."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.withColumns({"size": record_size(), "text_crc32": record_checksum()})
    total = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "key", "text"), F.lit(buckets)))
    # One row per bucket: few enough to be summed up in order by one task.
    counted = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counted.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("before"))
    whole, longer = divmod(total["rows"], shards)

    def shuffle(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("text_crc32", "ascending"), ("size", "ascending"), ("text", "ascending")])
        bucket = group.column("bucket")[0].as_py()
        order = np.arange(group.num_rows)
        np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)  # Fisher-Yates
        at = group.column("before")[0].as_py() + np.arange(group.num_rows)
        head = longer * (whole + 1)  # the first shards have one row more
        shard = np.where(at < head, at // (whole + 1), longer + (at - head) // max(whole, 1))
        slot = at - (shard * whole + np.minimum(shard, longer))
        return group.take(pa.array(order)).drop_columns(["bucket", "before"]).append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(slot))

    kind = rows.schema["key"].dataType.simpleString()
    return rows.join(before, "bucket").groupBy("bucket").applyInArrow(shuffle, f"key {kind}, text string, size long, text_crc32 long, shard int, slot long")


def write_shards(shuffled: DataFrame, folder: str | None = None) -> str:
    """Write the records as Parquet, a folder for each shard; returns the folder. The slot
    orders the records of a shard, whose files come from one or a few buckets."""
    folder = folder or scratch_path(shuffled.sparkSession, "shards")
    shuffled.write.partitionBy("shard").parquet(folder)
    return folder
