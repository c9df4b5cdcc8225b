"""File readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDEX_COLUMN = "_c0"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, index_column: bool = False) -> DataFrame:
    """Headed CSV. Without a schema the types are inferred, which reads the data twice:
    give one for large inputs. `index_column` drops the unnamed leading row index."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
    return df.drop(INDEX_COLUMN) if index_column else df


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files holding one JSON document each: an object gives one row, an array its items."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_rows(df: DataFrame, document: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Documents in a column: an object gives one row, an array its items."""
    return df.select(*keep, F.inline(F.from_json(document, T.ArrayType(schema))))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, corrupt: str = "_corrupt_record") -> DataFrame:
    """JSON lines; a malformed line becomes a row with its text in `corrupt`."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return spark.read.schema(with_corrupt).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).json(path)


def tag_corrupt(df: DataFrame, corrupt: str = "_corrupt_record") -> DataFrame:
    """Good rows with status 'ok', malformed ones with status 'error' and their text."""
    return df.withColumn("status", F.when(F.col(corrupt).isNull(), "ok").otherwise("error")).withColumnRenamed(corrupt, "error_line")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def report_json(df: DataFrame, name: str = "report") -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct("*")).alias(name))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def append_lines(df: DataFrame, line: str, path: str) -> str:
    """Append text lines, one folder per value of the other columns."""
    others = [c for c in df.columns if c != line]
    df.withColumnRenamed(line, "value").write.mode("append").partitionBy(*others).text(path)
    return path
