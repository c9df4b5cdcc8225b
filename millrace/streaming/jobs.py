"""Running streams: file sinks, and state folded batch by batch in written tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_path

Fold = Callable[[DataFrame | None, DataFrame], DataFrame]


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table (file or folder) as a stream, with the schema of the stored table. A
    single file is streamed as its folder with the file's name as the filter; the filter looks at
    the names of files only, so a table of part files is streamed as the folder it is."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def stream_folder(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream, a fixed number of files per batch."""
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def append_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available into an exactly-once Parquet sink, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def for_each_batch(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    query = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def epoch_path(path: str, epoch: int) -> str:
    return f"{path}/epoch={epoch}"


def last_epoch(spark: SparkSession, path: str) -> int | None:
    """The newest batch that was written completely below `path`, also by an earlier run."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return None
    names = [f.getPath().getName() for f in system.listStatus(root)]
    done = [int(n.partition("=")[2]) for n in names if n.startswith("epoch=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return max(done, default=None)


def drop_epoch(spark: SparkSession, path: str, epoch: int) -> None:
    old = spark._jvm.org.apache.hadoop.fs.Path(epoch_path(path, epoch))
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def fold_stream(stream: DataFrame, path: str, checkpoint: str, fold: Fold) -> DataFrame:
    """Fold every batch into a state table and return the last state.

    Each batch reads the state written by the batch before it and writes its own folder.
    A batch repeated after a failure reads the same input state and overwrites the same
    folder, so nothing is counted twice; states older than that are removed. With the paths
    of an earlier run the stream goes on where that run ended, and without new data its
    state is returned. The fold sees whole DataFrames, so a hot key is pre-aggregated like
    in any batch job.
    """
    spark = stream.sparkSession

    def handle(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        state = session.read.parquet(epoch_path(path, epoch - 1)) if epoch > 0 else None
        batch.persist()
        try:
            fold(state, batch).write.mode("overwrite").parquet(epoch_path(path, epoch))
        finally:
            batch.unpersist()
        if epoch > 1:
            drop_epoch(session, path, epoch - 2)

    for_each_batch(stream, checkpoint, handle)
    last = last_epoch(spark, path)
    if last is None:
        raise ValueError("the stream had no data")
    return spark.read.parquet(epoch_path(path, last))


def work_folders(spark: SparkSession, purpose: str, folder: str | None = None) -> tuple[str, str]:
    """Output and checkpoint folder of a stream: below `folder`, where a later run goes on, or
    a new one below the shared folder for a single run."""
    base = folder.rstrip("/") if folder else scratch_path(spark, purpose)
    return f"{base}/out", f"{base}/checkpoint"
