"""State per key: streams whose batches write only the keys they touch.

State lives in Spark's state store (RocksDB), one list or value per key, and a batch changes the
entries of its own keys only. What cannot matter is dropped per Arrow batch before the shuffle,
so a hot key sends few rows per task. A Python worker then runs once per task and is called per
key with that key's rows of the batch; results are read from the store's own tables.

Keys travel as text that is never null (`plain_key`), rows as JSON: pandas would turn integers
beside a null into floats."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import ArrayType, DataType, LongType, StructField, StructType

from millrace.functions.prefix import plain_key

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def key_names(keys: Sequence[str]) -> list[str]:
    return [f"k{i}" for i in range(len(keys))]


def own_keys(keys: Sequence[str], schema: StructType) -> list[Column]:
    """The keys of a state row in their own types."""
    return [F.when(F.col(f"key.{k}") != "null", F.substr(f"key.{k}", F.lit(2))).cast(schema[name].dataType).alias(name) for k, name in zip(key_names(keys), keys, strict=True)]


def keep_state(rows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, combine: Callable, checkpoint: str, combined: dict[str, DataType] | None = None) -> None:
    """Feed everything available to the state of `rows` by key. `combine` takes pandas batches of
    any keys, before the shuffle, and returns rows of the same columns, some in types of their
    own (`combined`)."""
    spark, names = rows.sparkSession, key_names(keys)
    plain = rows.withColumns({n: plain_key(k) for n, k in zip(names, keys, strict=True)}).drop(*keys)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield combine(batch, names)

    schema = StructType([StructField(f.name, (combined or {}).get(f.name, f.dataType)) for f in plain.schema])
    state = plain.mapInPandas(each, schema).groupBy(*names).transformWithStateInPandas(processor, "touched long", "update", "none")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:  # a query keeps the settings of its start
        query = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """Rows of a state variable after the last batch, of this or an earlier run."""
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    if not commits.getFileSystem(spark._jsc.hadoopConfiguration()).exists(commits):
        raise ValueError("the stream had no data")
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)


class EdgeRows(StatefulProcessor):
    """The first and the last rows of a key, in lists that end at their limits."""

    def __init__(self, first: int, last: int):
        self.limits = {"first": first, "recent": last}

    def init(self, handle) -> None:
        self.lists = {kind: handle.getListState(kind, "missing boolean, ord long, row string") for kind in self.limits}

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows))
        new = list(zip(new["missing"].tolist(), new["ord"].tolist(), new["row"].tolist(), strict=True))
        for kind, sign in (("first", 1), ("recent", -1)):
            held = [tuple(r) for r in self.lists[kind].get()]
            best = sorted(held + new, key=lambda r: (r[0], sign * r[1], r[2]))[: self.limits[kind]]
            if best != held:
                self.lists[kind].put(best)
        yield pd.DataFrame({"touched": [len(new)]})

    def close(self) -> None:
        pass

    def combine(self, batch: pd.DataFrame, names: list[str]) -> pd.DataFrame:
        """The rows of a batch that may be among the first or the last of their key."""
        ordered = batch.sort_values(["missing", "ord", "row"])
        first = ordered.groupby(names, sort=False).cumcount() < self.limits["first"]
        known = ordered[~ordered["missing"]].iloc[::-1]
        last = known.groupby(names, sort=False).cumcount() < self.limits["recent"]
        missing = ordered["missing"] & (ordered.groupby([*names, "missing"], sort=False).cumcount() < self.limits["recent"])
        return ordered[first | last.reindex(ordered.index, fill_value=False) | missing]


def edge_state(rows: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], first: int, last: int, checkpoint: str) -> DataFrame:
    """kind ('first', 'recent'), keys, order and values: the first and last rows of every key by an
    integer order; rows without an order come last in both."""
    payload = rows.select(*keys, F.col(order).isNull().alias("missing"), F.coalesce(F.col(order).cast("long"), F.lit(0)).alias("ord"), F.to_json(F.struct(*values)).alias("row"))
    edges = EdgeRows(first, last)
    keep_state(payload, keys, edges, edges.combine, checkpoint)
    schema = StructType([rows.schema[v] for v in values])
    parts = []
    for kind in edges.limits:
        held = read_state(rows.sparkSession, checkpoint, kind)
        entry = F.col("list_element")
        ord_ = F.when(~entry["missing"], entry["ord"]).cast(rows.schema[order].dataType).alias(order)
        parts.append(held.select(F.lit(kind).alias("kind"), *own_keys(keys, rows.schema), ord_, F.from_json(entry["row"], schema).alias("v")).select("kind", *keys, order, "v.*"))
    return parts[0].unionByName(parts[1])


class OpenFailures(StatefulProcessor):
    """Failures of a key so far, its last success, and the failures after that."""

    def init(self, handle) -> None:
        self.head = handle.getValueState("head", "failures long, success long, open long")
        self.open = handle.getListState("open", "ord long")

    def handleInputRows(self, key, rows, timerValues):
        parts = [(r["success"].to_numpy(), r["failures"].to_numpy(), r["failed"].to_numpy()) for r in rows]
        failures, success, count = self.head.get() or (0, None, 0)
        latest = max([*(int(p[0].max()) for p in parts), -1 if success is None else success])
        later = [f for p in parts for own in p[2] for f in own.tolist() if f > latest]
        if count and latest >= 0 and latest != success:  # a later success ends failures held so far
            later += [r[0] for r in self.open.get() if r[0] > latest]
            self.open.clear()
            count = 0
        if later:
            self.open.appendList([(f,) for f in later])
        self.head.update((failures + sum(int(p[1].sum()) for p in parts), latest if latest >= 0 else None, count + len(later)))
        yield pd.DataFrame({"touched": [sum(len(p[0]) for p in parts)]})

    def close(self) -> None:
        pass

    def combine(self, batch: pd.DataFrame, names: list[str]) -> pd.DataFrame:
        """One row per key of a batch: failures, last success, and the failures after it. For all
        keys at once: a batch may have as many keys as rows."""
        own, ord_ = batch.groupby(names, sort=False).ngroup().to_numpy(), batch["failed"].to_numpy(np.int64)
        first = np.unique(own, return_index=True)[1]
        success = np.full(len(first), -1, np.int64)
        np.maximum.at(success, own, batch["success"].to_numpy(np.int64))
        later = (batch["failures"].to_numpy() > 0) & (ord_ > success[own])
        ends = np.cumsum(np.bincount(own[later], minlength=len(first)))
        failed = np.split(ord_[later][np.argsort(own[later], kind="stable")], ends[:-1]) if len(first) else []
        failures = np.bincount(own, weights=batch["failures"], minlength=len(first)).astype(np.int64)
        return batch[names].iloc[first].assign(success=success, failures=failures, failed=failed)


def open_failures(rows: DataFrame, keys: Sequence[str], order: str, error: str, checkpoint: str) -> DataFrame:
    """total_failures and consecutive_failures (those after the last success) per key, for events
    with an integer order from 0 on that may come in any order of files."""
    failed = F.col(error) == 1
    ord_ = F.col(order).cast("long")
    known = F.coalesce(ord_, F.raise_error(F.lit("a failure without an order")).cast("long"))
    marks = rows.select(*keys, F.when(~failed, F.coalesce(ord_, F.lit(-1))).otherwise(-1).alias("success"), F.when(failed, 1).otherwise(0).cast("long").alias("failures"), F.when(failed, known).otherwise(-1).alias("failed"))
    processor = OpenFailures()
    keep_state(marks, keys, processor, processor.combine, checkpoint, {"failed": ArrayType(LongType())})
    head = read_state(rows.sparkSession, checkpoint, "head")
    return head.select(*own_keys(keys, rows.schema), F.col("value.failures").alias("total_failures"), F.col("value.open").alias("consecutive_failures"))
