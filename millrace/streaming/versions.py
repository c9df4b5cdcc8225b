"""A table of versioned groups: each batch writes the groups it touches, readers see the newest.

Rows are dealt to `buckets` by a hash of their group. A batch writes one folder with a file set
per touched bucket, and a log entry: the folders that are live for each bucket. A group's rows in
a later folder replace those in an earlier one. A bucket that has more than `deltas` live folders
is written whole into the batch's folder, which then is its only one. So a batch reads the
folders of its own buckets, at most `deltas` + 1 each, and in them only the row groups whose
groups lie between the least and largest it touches; and what was replaced is removed two batches later.

The log entry is written last. A batch that is repeated finds the entry of the batch before,
writes the same folder again and replaces its own entry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.streaming.jobs import drop_epoch, epoch_path, last_epoch

VERSION, BUCKET = "epoch", "__bucket"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, group: str, buckets: int = 64, deltas: int = 8):
        self.spark, self.path, self.group, self.buckets, self.deltas = spark, path, group, buckets, deltas

    def _log(self, epoch: int | None) -> dict[int, list[int]]:
        """Live folders (epochs) of each bucket after an epoch: at most a row per bucket."""
        if epoch is None:
            return {}
        return {r["bucket"]: list(r["live"]) for r in self.spark.read.parquet(epoch_path(f"{self.path}/log", epoch)).collect()}

    def last(self) -> int | None:
        return last_epoch(self.spark, f"{self.path}/log")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.group), F.lit(self.buckets)).cast("int")

    def folders(self, live: dict[int, list[int]]) -> list[str]:
        return [f"{epoch_path(f'{self.path}/data', e)}/{BUCKET}={b}" for b, epochs in sorted(live.items()) for e in epochs]

    def _newest(self, folders: list[str], where: Column | None = None) -> DataFrame | None:
        if not folders:
            return None
        rows = self.spark.read.parquet(*folders)
        rows = rows if where is None else rows.where(where)
        versions = rows.groupBy(F.col(self.group).alias("__id")).agg(F.max(VERSION).alias("__epoch"))
        return rows.join(versions, F.col(self.group).eqNullSafe(F.col("__id")) & (F.col(VERSION) == F.col("__epoch"))).drop("__id", "__epoch")

    def read(self) -> DataFrame:
        """The newest version of every group, with its epoch."""
        last = self.last()
        if last is None:
            raise ValueError("the stream had no data")
        return self._newest(self.folders(self._log(last)))

    def merge(self, batch: DataFrame, epoch: int, process: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Process the batch's rows with the earlier rows of their groups, and store the result.
        `process` keeps the input columns and may add others. Returns the folders that were read."""
        last = self.last()
        if last is not None and last >= epoch:
            last = epoch - 1 if epoch > 0 else None
        live, columns = self._log(last), batch.columns
        stats = batch.agg(F.collect_set(self._bucket()).alias("buckets"), F.min(self.group).alias("least"), F.max(self.group).alias("most")).first()
        touched = sorted(stats["buckets"])
        if not touched:
            return []
        earlier = {b: live[b] for b in touched if b in live}
        read, id_ = self.folders(earlier), F.col(self.group)
        span = id_.isNull() | id_.between(stats["least"], stats["most"]) if stats["least"] is not None else id_.isNull()
        whole, before = batch, self._newest(read, span)
        if before is not None:
            ids = batch.select(id_.alias("__touched")).distinct()
            whole = batch.unionByName(before.join(ids, id_.eqNullSafe(F.col("__touched")), "left_semi").select(*columns))
        out = process(whole).withColumn(VERSION, F.lit(epoch).cast("long")).withColumn(BUCKET, self._bucket())

        full = {b: e for b, e in earlier.items() if len(e) >= self.deltas}
        if full:  # what the batch leaves of these buckets goes into the same folder
            ids = batch.select(id_.alias("__touched")).distinct()
            rest = self._newest(self.folders(full)).join(ids, id_.eqNullSafe(F.col("__touched")), "left_anti")
            out = out.unionByName(rest.withColumn(BUCKET, self._bucket()))
        target = epoch_path(f"{self.path}/data", epoch)
        out.repartition(BUCKET, self.group).sortWithinPartitions(BUCKET, self.group).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        now = live | {b: [epoch] if b in full or b not in live else [*live[b], epoch] for b in touched}
        log = self.spark.createDataFrame([(b, e) for b, e in sorted(now.items())], "bucket int, live array<long>")
        log.coalesce(1).write.mode("overwrite").parquet(epoch_path(f"{self.path}/log", epoch))
        self._clean(last, epoch)
        return read

    def _clean(self, last: int | None, epoch: int) -> None:
        """Remove folders that neither this log entry nor the one before needs, and older entries."""
        if last is None:
            return
        system_path = self.spark._jvm.org.apache.hadoop.fs.Path
        known = {(b, e) for at in (last, epoch) for b, epochs in self._log(at).items() for e in epochs}
        for entry in self._epochs():
            if entry < last:
                gone = {(b, e) for b, epochs in self._log(entry).items() for e in epochs} - known
                for b, e in gone:
                    folder = system_path(self.folders({b: [e]})[0])
                    folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
                drop_epoch(self.spark, f"{self.path}/log", entry)

    def _epochs(self) -> list[int]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        names = [f.getPath().getName() for f in root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("epoch="))
