"""Session settings and the shared scratch folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on: AQE with skew handling
    and a fixed UTC zone. On a cluster leave `master` and sizes to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    if session.conf.get(CHECKPOINT_KEY, None) or session.sparkContext.master.startswith("local"):
        ship_package(session)
    return session


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the folder the cluster shares for checkpoints.

    A local session without that setting gets a folder of its own, once, as the setting; on
    a cluster, where the executors would not see it, the setting is required.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set(CHECKPOINT_KEY, base)
    return f"{base.rstrip('/')}/millrace/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result that several branches read to the shared folder and read it back: it
    is computed once, its lineage ends there, and losing an executor costs no recomputation."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that `materialize` stored, once all that reads it is stored as well."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if "/millrace/" not in folder.toString():
            raise ValueError("only tables below the scratch folder are discarded")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables below the shared folder. For the end of a job: results
    that have not been written yet may still read them."""
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if base:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/millrace")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application, from the shared
    folder: a driver started elsewhere has it on its own path only."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here, held = os.path.dirname(os.path.abspath(__file__)), io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                whole = os.path.join(folder, name)
                out.write(whole, os.path.relpath(whole, os.path.dirname(here)))
    path = f"{scratch_path(spark, 'package')}/millrace.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(held.getvalue())
    stream.close()
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
