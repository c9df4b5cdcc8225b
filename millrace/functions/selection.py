"""Exact selection from groups of any size: first or last rows, top share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.hashing import key_hash
from millrace.functions.prefix import hash_order_bucket, plain_key, prefix_sums, rank_in_group, value_cuts, with_value_bucket
from millrace.functions.scalars import single_row


def edge_rows(df: DataFrame, keys: Sequence[str], order: str, n: int, latest: bool = True, salts: int = 64) -> DataFrame:
    """The last (or first) n rows of each group; rows without an order value come last.

    Each group is cut by a hash of the order value into `salts` parts, and the best n rows of
    every part are kept, then the best n of the group. Spark limits the rows per part before
    the first shuffle, so a group of any size sends n rows per part and task, and its last
    task holds at most salts * n rows. Null keys are a group."""
    keys = list(keys)
    by = F.col(order).desc_nulls_last() if latest else F.col(order).asc_nulls_last()
    if not keys:
        return df.orderBy(by).limit(n)
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    for part in ([*keys, "__salt"], keys):
        salted = salted.withColumn("__rn", F.row_number().over(Window.partitionBy(*part).orderBy(by))).where(F.col("__rn") <= n)
    return salted.select(*df.columns)


def top_share(
    df: DataFrame, key: str, groups: Sequence[str], value: str, divisor: int, maximize: bool = True, name: str = "kept"
) -> DataFrame:
    """Flag the best floor(n / divisor) of the n rows of each group that have a value; equal
    values are taken in hash order of the key. Rows without a value (null or NaN) are never
    flagged, and null groups are a group like any other.

    Values are counted first. Their running counts give each group's cut value and how
    many of the rows at the cut fit; only those tied rows are ranked, in hash buckets.
    """
    groups = list(groups)
    plain = {f"__g{i}": plain_key(g) for i, g in enumerate(groups)}
    number = F.col(value).cast("double")
    signed = df.withColumns({"__s": F.when(~F.isnan(number), -number if maximize else number), **plain})
    valid = signed.where(F.col("__s").isNotNull())
    cuts = value_cuts(valid, "__s")
    counts = valid.groupBy(*plain, "__s").agg(F.count("*").alias("__n"))
    placed = prefix_sums(
        with_value_bucket(counts, "__s", cuts, "__vb"), list(plain), [F.col("__s")], F.col("__vb"), {"__run": F.col("__n")}, totals=True
    )
    limit = F.floor(F.col("__run_total") / divisor)
    at_cut = placed.where((F.col("__run_before") <= limit) & (F.col("__run_before") + F.col("__n") > limit)).select(
        *plain, F.col("__s").alias("__cut"), (limit - F.col("__run_before")).alias("__fits")
    )
    if groups:
        joined = valid.join(at_cut, list(plain), "left")
    else:
        whole = single_row(at_cut.select(F.struct("__cut", "__fits").alias("c")))
        joined = valid.withColumns({c: whole["c"][c] for c in ("__cut", "__fits")})
    tied = F.col("__s") == F.col("__cut")
    clear = joined.where(~F.coalesce(tied, F.lit(False))).withColumn(
        name, F.coalesce(F.col("__s") < F.col("__cut"), F.lit(True))
    )
    hashed = joined.where(tied).withColumn("__h", key_hash(key))
    order = [F.col("__h"), F.col(key)]
    ranked = rank_in_group(hashed, list(plain), order, hash_order_bucket(F.col("__h")), "__pos")
    chosen = ranked.withColumn(name, F.col("__pos") < F.col("__fits"))
    without = signed.where(F.col("__s").isNull()).withColumn(name, F.lit(False))
    out = clear.select(*df.columns, name).unionByName(chosen.select(*df.columns, name))
    return out.unionByName(without.select(*df.columns, name))
