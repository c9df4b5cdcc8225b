"""Tables published by version, and rows by their position in stored files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 4


def publish(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write the partitions that `rows` holds, each in place of what it held before; all other
    partitions stay. A job that is repeated replaces its own rows. Partitions appear when the
    job commits, so readers see the old rows or the new ones. A task keeps a file open for each of
    its first `OPEN_FILES` partitions; its rows are sorted by partition only if it has more."""
    spark = rows.sparkSession
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, OPEN_FILES)
    try:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    finally:
        spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)


def published(spark: SparkSession, path: str, schema: StructType, **values: object) -> DataFrame:
    """Rows of a published table, in the types of `schema`. Values given for partition columns
    (None: null) prune the folders that are read."""
    rows = spark.read.schema(schema).parquet(path)
    for name, value in values.items():
        rows = rows.where(F.col(name).isNull() if value is None else F.col(name) == value)
    return rows


def withdraw(spark: SparkSession, path: str, **values: object) -> None:
    """Remove the partition of these values, in the order of the partition columns."""
    folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in values.items())]))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def positioned(rows: DataFrame, name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in a stored Parquet table: files in the order of their
    names, rows in the order of the file. `rows` comes from the reader, also after column
    selection, but before any filter or shuffle. The reader knows a row's place in its file; the
    files' counts, a row per file, give the offsets. Those are broadcast: joined by a shuffle, all rows
    of a file would meet in one task. So no row is sorted or shuffled to get its position."""
    file, place = "__file", "__place"
    own = rows.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    counts = own.groupBy(file).agg((F.max(place) + 1).alias("__rows"))
    before = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(file, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    return own.join(F.broadcast(offsets), file).withColumn(name, F.col("__offset") + F.col(place)).select(*rows.columns, name)


def align_positions(x: DataFrame, y: DataFrame, name: str = "position") -> DataFrame:
    """The rows of two stored tables side by side by position, as long as the shorter one. Both
    sides name their columns differently."""
    return positioned(x, name).join(positioned(y, name), name)
