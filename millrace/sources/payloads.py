"""Scoring payloads: tensor JSON to instance rows and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TENSOR_SCHEMA = "struct<inputs: array<struct<name: string, shape: array<int>, datatype: string, data: string>>, instances: string>"


def decode_payloads(df: DataFrame, payload: str, keep: Sequence[str] = (), names: Sequence[str] = ()) -> DataFrame:
    """One row per instance: (keep..., instance, features, error). All tensors of a request are
    read, one after the other; their data may be flat, cut by the shape, or nested. Plain
    `instances` may be lists of numbers, or objects, of which `names` are read in that order,
    0 where one is missing. A request without a readable instance is one row with an error."""
    parsed = df.select(*keep, F.from_json(payload, TENSOR_SCHEMA).alias("p"))

    def rows_of(tensor: Column) -> Column:
        flat = F.from_json(tensor["data"], "array<double>")
        width = F.try_element_at(tensor["shape"], F.lit(-1))
        whole = (F.size(flat) > 0) & (width > 0) & (F.size(flat) % width == 0)
        starts = F.sequence(F.lit(1), F.greatest(F.size(flat), F.lit(1)), F.greatest(width, F.lit(1)))
        cut = F.when(whole, F.transform(starts, lambda at: F.slice(flat, at, width)))
        return F.when(tensor["data"].startswith("[["), F.from_json(tensor["data"], "array<array<double>>")).otherwise(cut)

    tensors = F.transform("p.inputs", rows_of)
    lists = F.from_json("p.instances", "array<array<double>>")
    objects = F.transform(
        F.from_json("p.instances", "array<map<string,double>>"),
        lambda m: F.when(m.isNotNull(), F.array(*[F.coalesce(F.try_element_at(m, F.lit(n)), F.lit(0.0)) for n in names])),
    )
    listed = F.when(F.col("p.instances").rlike(r"^\s*\[\s*\{"), objects if names else F.lit(None)).otherwise(lists)
    read = F.when(F.size("p.inputs") > 0, F.flatten(tensors)).otherwise(listed)
    good = F.coalesce((F.size(read) > 0) & ~F.exists(read, lambda r: r.isNull()), F.lit(False))
    rows = parsed.select(*keep, F.when(good, read).alias("__rows"), F.when(~good, F.lit("no readable instances in the request")).alias("error"))
    return rows.select(*keep, "error", F.posexplode_outer("__rows").alias("instance", "features")).select(*keep, "instance", "features", "error")


def encode_payloads(df: DataFrame, key: str, features: str, rows_per_payload: int, name: str = "input-0") -> DataFrame:
    """Groups of at most `rows_per_payload` consecutive keys as flat tensor JSON, in key order.
    Keys are unique integers, so a group is bounded by that count."""
    grouped = df.groupBy(F.floor(F.col(key) / rows_per_payload).alias("request")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(features).alias("f")))).alias("rows")
    )
    tensor = F.struct(
        F.lit(name).alias("name"),
        F.array(F.size("rows"), F.size(F.get("rows", 0)["f"])).alias("shape"),
        F.lit("FP32").alias("datatype"),
        F.flatten(F.transform("rows", lambda r: r["f"])).alias("data"),
    )
    return grouped.select("request", F.to_json(F.struct(F.array(tensor).alias("inputs"))).alias("payload"))
