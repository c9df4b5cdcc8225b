"""The corpus pipeline: quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and is
written and read again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.jaccard import similar_groups
from millrace.llm.packing import pack
from millrace.llm.quality import fit_quality, score_quality
from millrace.llm.queries import training_rows
from millrace.llm.suffixes import remove_repeats
from millrace.session import scratch_path
from millrace.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field calls good; the labels are those of documents."""
    name = f"score_{uuid.uuid4().hex}"  # no column of the table has this name
    field = fit_quality(docs, training_rows(table(spark, sf_dir, "labels")))
    return score_quality(docs, field, out=name).where(F.col(name) >= 0.5).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays: that with the smallest doc_id, and among
    its texts that with the smallest hash, once. Different texts of one doc_id are documents of
    their own; of rows equal in both, that with the smallest hash of all columns stays.
    Documents without doc_id stay."""
    node = f"node_{uuid.uuid4().hex}"  # no column of the table has this name
    named = docs.where("doc_id is not null").withColumn(node, F.xxhash64("doc_id", "text"))
    groups = similar_groups(named, key=node).select(F.col(node).alias("member"), "component_id").distinct()
    met = groups.join(named.select("doc_id", node).distinct(), F.col("member") == F.col(node))
    kept = met.groupBy("component_id").agg(F.min(F.struct("doc_id", "member")).alias("least")).select(F.col("least.member").alias("kept_node"))
    rows = named.join(kept, F.col(node) == F.col("kept_node"), "left_semi")
    once = rows.groupBy(node).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")).select("row.*")
    return once.union(docs.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 400 bytes that are elsewhere too; n_chars follows the text."""
    kept = remove_repeats(docs, with_text=True)
    changed = {"text": F.col("kept_text"), "n_chars": F.coalesce(F.length("kept_text").cast("long"), F.col("others.n_chars"))}
    return kept.select(*(changed.get(c, F.col(f"others.{c}")).alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), special=True).withColumnRenamed("key", "doc_id")
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeated_passages), ("packing", packing)]

# The classifier is trained and ids come from a tokenizer: SQL can't state the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
