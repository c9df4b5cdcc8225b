"""Cleaning, features, chunks and table profiles over the feature view."""

from pyspark.sql import functions as F

from millrace.functions.scalars import lookup, single_row, ts_text
from millrace.operators import chunks, cleaning, features, quality, splits
from millrace.plans.fixtures import feat, sql_hash, vec
from millrace.plans.registry import query
from millrace.sources.tables import table


def r6(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


@query(
    "drop_nulls",
    "SELECT id, f1, f2, cat, target, batch_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM feat WHERE f1 IS NOT NULL",
    views=("feat",),
)
def drop_nulls(spark, sf):
    return cleaning.drop_nulls(feat(spark, sf)).withColumn("ts", ts_text(F.col("ts")))


@query("impute_global_mean", "SELECT id, round(coalesce(f1, (SELECT avg(f1) FROM feat)), 6) AS f1 FROM feat", views=("feat",))
def impute_global_mean(spark, sf):
    return cleaning.impute_global_mean(feat(spark, sf), "f1").select("id", *r6("f1"))


@query(
    "impute_batch_mean",
    "SELECT id, round(coalesce(f1, avg(f1) OVER (PARTITION BY batch_id)), 6) AS f1 FROM feat",
    views=("feat",),
)
def impute_batch_mean(spark, sf):
    return cleaning.impute_batch_mean(feat(spark, sf).select("id", "f1", "batch_id"), "f1", "batch_id").select("id", *r6("f1"))


@query("impute_zero", "SELECT id, coalesce(f1, 0) AS f1 FROM feat", views=("feat",))
def impute_zero(spark, sf):
    return cleaning.impute_zero(feat(spark, sf), ["f1"]).select("id", "f1")


@query(
    "clamp_sqrt",
    """
    SELECT id, round(sqrt(CASE WHEN f2 > 0 THEN f2 ELSE 0.001 END), 6) AS f2_sqrt,
           round(coalesce(f1, avg(f1) OVER (PARTITION BY batch_id)) * sqrt(CASE WHEN f2 > 0 THEN f2 ELSE 0.001 END), 6) AS interaction
    FROM feat
    """,
    views=("feat",),
)
def clamp_sqrt(spark, sf):
    rows = feat(spark, sf).select("id", "f1", "f2", "batch_id")
    return cleaning.process_batches(rows, "batch_id").select("id", *r6("f2_sqrt", "interaction"))


FILLED = ", g AS (SELECT * REPLACE (coalesce(f1, (SELECT avg(f1) FROM feat)) AS f1) FROM feat)"
FIT = """, s AS (SELECT avg(f1) AS m1, stddev_pop(f1) AS s1, avg(f2) AS m2, stddev_pop(f2) AS s2,
                       min(f1) AS lo1, max(f1) AS hi1, min(f2) AS lo2, max(f2) AS hi2 FROM g)"""


@query(
    "features_v1",
    FILLED + " SELECT id, round(f1 * 2, 6) AS f1_v1, round(f2 + 1, 6) AS f2_v1, 'v1_basic' AS version_marker FROM g",
    views=("feat",),
)
def features_v1(spark, sf):
    out = features.versioned_features(feat(spark, sf), "1.0", "f1", "f2")
    return out.select("id", *r6("f1_v1", "f2_v1"), "version_marker")


@query(
    "features_v2",
    FILLED + FIT + """
    SELECT id, round((f1 - m1) / s1, 6) AS f1_v2, round((f2 - m2) / s2, 6) AS f2_v2, round(f1 / (f2 + 0.001::DOUBLE), 4) AS feature_ratio,
           round(f1 * f2, 4) AS feature_product, round(f1 * f1 + f2 * f2, 4) AS feature_polynomial, 'v2_advanced' AS version_marker
    FROM g, s
    """,
    views=("feat",),
)
def features_v2(spark, sf):
    out = features.versioned_features(feat(spark, sf), "2.1", "f1", "f2")
    return out.select(
        "id", *r6("f1_v2", "f2_v2"),
        *[F.round(c, 4).alias(c) for c in ("feature_ratio", "feature_product", "feature_polynomial")], "version_marker",
    )


@query(
    "features_v3",
    FILLED + FIT + """
    SELECT id, round((f1 - lo1) / (hi1 - lo1), 6) AS f1_v3, round((f2 - lo2) / (hi2 - lo2), 6) AS f2_v3,
           round(f1 * f1, 6) AS f1_squared, round(sqrt(abs(f2)), 6) AS f2_sqrt,
           round(ln(1 + abs(f1)) / ln(1 + abs(f2) + 1), 6) AS feature_log_ratio, 'v3_experimental' AS version_marker
    FROM g, s
    """,
    views=("feat",),
)
def features_v3(spark, sf):
    out = features.versioned_features(feat(spark, sf), "3.0", "f1", "f2")
    return out.select("id", *r6("f1_v3", "f2_v3", "f1_squared", "f2_sqrt", "feature_log_ratio"), "version_marker")


@query(
    "features_default",
    FILLED + " SELECT id, round(f1 + f2, 6) AS feature_default, 'default' AS version_marker FROM g",
    views=("feat",),
)
def features_default(spark, sf):
    out = features.versioned_features(feat(spark, sf), "0.9", "f1", "f2")
    return out.select("id", *r6("feature_default"), "version_marker")


VERSION_OF = {"click": "1.2", "view": "1.0", "error": "2.0", "purchase": "3.1", "signup": "0.9"}


@query(
    "version_dispatch",
    FILLED + FIT + """
    , v AS (SELECT *, CASE cat WHEN 'click' THEN '1.2' WHEN 'view' THEN '1.0' WHEN 'error' THEN '2.0'
                               WHEN 'purchase' THEN '3.1' ELSE '0.9' END AS version FROM g)
    SELECT id, version,
           CASE WHEN version LIKE '1.%' THEN 'basic_scaling' WHEN version LIKE '2.%' THEN 'standardized_with_engineering'
                WHEN version LIKE '3.%' THEN 'minmax_with_experimental' ELSE 'fallback_default' END AS transformation_type,
           round(CASE WHEN version LIKE '1.%' THEN f1 * 2 WHEN version LIKE '2.%' THEN (f1 - m1) / s1
                WHEN version LIKE '3.%' THEN (f1 - lo1) / (hi1 - lo1) ELSE f1 + f2 END, 6) AS feature_a,
           round(CASE WHEN version LIKE '1.%' THEN f2 + 1 WHEN version LIKE '2.%' THEN (f2 - m2) / s2
                WHEN version LIKE '3.%' THEN (f2 - lo2) / (hi2 - lo2) END, 6) AS feature_b
    FROM v, s
    """,
    views=("feat",),
)
def version_dispatch(spark, sf):
    rows = feat(spark, sf).withColumn("version", lookup(VERSION_OF, F.col("cat")))
    out = features.dispatch_versions(rows, "version", "f1", "f2")
    return out.select("id", "version", "transformation_type", *r6("feature_a", "feature_b"))


@query(
    "lineage_columns",
    """
    SELECT id, batch_id, '2024-02-01T00:00:00' AS processed_at, '2.1' AS processing_version,
           'standardized_with_engineering' AS transformation_type, 'events' AS source FROM feat
    """,
    views=("feat",),
)
def lineage_columns(spark, sf):
    out = features.lineage_columns(feat(spark, sf), "2024-02-01T00:00:00", "2.1", "events")
    return out.select("id", "batch_id", "processed_at", "processing_version", "transformation_type", "source")


@query(
    "chunk_assign",
    """
    SELECT id, (row_number() OVER (ORDER BY id) - 1) // 800 + 1 AS chunk_number,
           (row_number() OVER (ORDER BY id) - 1) % 800 AS streaming_id FROM feat
    """,
    views=("feat",),
)
def chunk_assign(spark, sf):
    return chunks.assign_chunks(feat(spark, sf).select("id"), "id", 800)


@query(
    "map_encode",
    """
    SELECT id, round((f1 + f2) / 2, 6) AS processed_feature,
           CAST(CASE cat WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'view' THEN 3 END AS INTEGER) AS category_encoded FROM feat
    """,
    views=("feat",),
)
def map_encode(spark, sf):
    rows = feat(spark, sf).withColumn("processed_feature", (F.col("f1") + F.col("f2")) / 2)
    out = features.map_encode(rows, "cat", {"click": 1, "purchase": 2, "view": 3}, "category_encoded")
    return out.select("id", *r6("processed_feature"), "category_encoded")


@query(
    "label_encode",
    "SELECT id, cat, dense_rank() OVER (ORDER BY cat) - 1 AS cat_code FROM feat",
    views=("feat",),
)
def label_encode(spark, sf):
    return features.label_encode(feat(spark, sf).select("id", "cat"), "cat")


@query(
    "quantile_band_filter",
    """
    , b AS (SELECT batch_id, quantile_cont(f1, 0.25) AS lo, quantile_cont(f2, 0.75) AS hi FROM feat GROUP BY batch_id)
    SELECT id, f1, round(f2, 6) AS f2, batch_id FROM feat JOIN b USING (batch_id) WHERE f1 > lo AND f2 < hi
    """,
    views=("feat",),
)
def quantile_band_filter(spark, sf):
    rows = feat(spark, sf).select("id", "f1", "f2", "batch_id")
    return cleaning.quantile_band(rows, "batch_id", "f1", "f2").withColumn("f2", F.round("f2", 6))


@query("dev_sample", "SELECT id, f1, cat FROM feat ORDER BY id LIMIT 1000", views=("feat",))
def dev_sample(spark, sf):
    return splits.dev_sample(feat(spark, sf).select("id", "f1", "cat"), "id", 1000)


@query(
    "dataset_metadata",
    """
    SELECT count(*) AS rows, CAST(7 AS INTEGER) AS columns, 'id,f1,f2,cat,target,ts,batch_id' AS column_names,
           count(*) - count(f1) AS missing, '1.0' AS version FROM feat
    """,
    views=("feat",),
)
def dataset_metadata(spark, sf):
    return quality.dataset_metadata(feat(spark, sf), "1.0")


@query(
    "null_profile",
    """
    SELECT u.column, CASE u.column WHEN 'f1' THEN n - nn ELSE 0 END AS nulls, n AS rows
    FROM (SELECT count(*) AS n, count(f1) AS nn FROM feat),
         (VALUES ('id'), ('f1'), ('f2'), ('cat'), ('target'), ('ts'), ('batch_id')) u("column")
    """,
    views=("feat",),
)
def null_profile(spark, sf):
    return quality.null_profile(feat(spark, sf))


@query(
    "grouped_multi_agg",
    """
    , p AS (SELECT batch_id, cat, target, coalesce(f1, avg(f1) OVER (PARTITION BY batch_id)) AS f1_processed,
                   sqrt(CASE WHEN f2 > 0 THEN f2 ELSE 0.001 END) AS f2_sqrt FROM feat)
    SELECT batch_id, cat, round(avg(f1_processed), 6) AS f1_processed_mean, round(stddev_samp(f1_processed), 6) AS f1_processed_std,
           count(f1_processed) AS f1_processed_count, round(avg(f2_sqrt), 6) AS f2_sqrt_mean, round(max(f2_sqrt), 6) AS f2_sqrt_max,
           round(min(f2_sqrt), 6) AS f2_sqrt_min, CAST(sum(target) AS BIGINT) AS target_sum
    FROM p GROUP BY batch_id, cat
    """,
    views=("feat",),
)
def grouped_multi_agg(spark, sf):
    rows = cleaning.process_batches(feat(spark, sf).drop("ts"), "batch_id")
    out = chunks.grouped_profile(
        rows,
        ["batch_id", "cat"],
        {"f1_processed": ["mean", "std", "count"], "f2_sqrt": ["mean", "max", "min"], "target": ["sum"]},
    )
    rounded = ["f1_processed_mean", "f1_processed_std", "f2_sqrt_mean", "f2_sqrt_max", "f2_sqrt_min"]
    return out.select("batch_id", "cat", *r6(*rounded), "f1_processed_count", "target_sum")


PROFILE = """, p AS (SELECT batch_id, min(id) AS start_row, max(id) AS end_row, count(*) AS rows, avg(f1) AS f1_mean,
                           stddev_samp(f2) AS f2_std, avg(target) AS target_ratio FROM feat GROUP BY batch_id)"""


@query(
    "chunk_profile",
    PROFILE + """ SELECT batch_id, start_row, end_row, rows, round(f1_mean, 6) AS f1_mean, round(f2_std, 6) AS f2_std,
                         round(target_ratio, 6) AS target_ratio FROM p""",
    views=("feat",),
)
def chunk_profile(spark, sf):
    out = chunks.chunk_profile(feat(spark, sf), "batch_id", "id", "f1", "f2", "target")
    return out.select("batch_id", "start_row", "end_row", "rows", *r6("f1_mean", "f2_std", "target_ratio"))


@query(
    "chunk_summary",
    PROFILE + """ SELECT count(*) AS chunks_processed, CAST(sum(rows) AS BIGINT) AS total_rows, max(rows) AS peak_chunk_rows,
                         round(avg(rows), 6) AS average_chunk_rows, round(max(target_ratio), 6) AS peak_target_ratio FROM p""",
    views=("feat",),
)
def chunk_summary(spark, sf):
    out = chunks.chunk_summary(chunks.chunk_profile(feat(spark, sf), "batch_id", "id", "f1", "f2", "target"))
    return out.select("chunks_processed", "total_rows", "peak_chunk_rows", *r6("average_chunk_rows", "peak_target_ratio"))


@query(
    "union_chunks",
    """
    SELECT id, cat, CASE WHEN cat IN ('click', 'view') THEN f1 * 2 END AS f1_v1, CASE WHEN cat NOT IN ('click', 'view') THEN f2 + 1 END AS f2_v1
    FROM feat
    """,
    views=("feat",),
)
def union_chunks(spark, sf):
    rows = feat(spark, sf)
    browse = F.col("cat").isin("click", "view")
    first = rows.where(browse).select("id", "cat", (F.col("f1") * 2).alias("f1_v1"))
    second = rows.where(~browse).select("id", "cat", (F.col("f2") + 1).alias("f2_v1"))
    return quality.union_chunks([first, second])


@query(
    "batch_progress",
    """
    , b AS (SELECT batch_id, count(*) AS n, sum(CAST(f2 + 20 AS DECIMAL(18,2))) AS s FROM feat GROUP BY batch_id)
    SELECT batch_id, n AS rows_in_batch, CAST(s AS DOUBLE) AS processing_seconds,
           CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS cumulative_rows,
           row_number() OVER (ORDER BY batch_id) AS batches_completed,
           round(CAST(sum(n) OVER (ORDER BY batch_id) AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE), 6) AS share_done
    FROM b
    """,
    views=("feat",),
)
def batch_progress(spark, sf):
    out = chunks.batch_progress(feat(spark, sf), "batch_id", (F.col("f2") + 20).cast("decimal(18,2)"))
    return out.withColumns(
        {"processing_seconds": F.col("processing_seconds").cast("double"), "share_done": F.round("share_done", 6)}
    )


@query(
    "progress_totals",
    """
    SELECT count(*) AS processed_rows, count(DISTINCT batch_id) AS batches,
           CAST(sum(CAST(f2 + 20 AS DECIMAL(18,2))) AS DOUBLE) AS total_seconds,
           round(CAST(sum(CAST(f2 + 20 AS DECIMAL(18,2))) AS DOUBLE) / count(DISTINCT batch_id), 4) AS average_seconds
    FROM feat
    """,
    views=("feat",),
)
def progress_totals(spark, sf):
    rows = chunks.batch_progress(feat(spark, sf), "batch_id", (F.col("f2") + 20).cast("decimal(18,2)"))
    out = chunks.progress_totals(rows.withColumn("processing_seconds", F.col("processing_seconds").cast("decimal(28,2)")))
    return out.select(
        "processed_rows", "batches", F.col("total_seconds").cast("double").alias("total_seconds"),
        F.round(F.col("average_seconds").cast("double"), 4).alias("average_seconds"),
    )


def fingerprint_holds(fingerprint, rows):
    """A fingerprint is the same for the rows in another order and partitioning, and another one
    when the last digit of a cell changes."""
    touched = F.when(F.col("id") == 0, F.col("f2") + 1e-12).otherwise(F.col("f2"))
    others = {"order_free": rows.repartition(7, "f2").sortWithinPartitions("f2"), "sees_change": rows.withColumn("f2", touched)}
    out = fingerprint(rows)
    one = {name: single_row(fingerprint(other))["fingerprint"] for name, other in others.items()}
    return out.select("rows", (F.col("fingerprint") == one["order_free"]).alias("order_free"), (F.col("fingerprint") != one["sees_change"]).alias("sees_change"))


FINGERPRINT = "SELECT count(*) AS rows, true AS order_free, true AS sees_change FROM feat"


@query("fingerprint_sum", FINGERPRINT, views=("feat",))
def fingerprint_sum(spark, sf):
    return fingerprint_holds(quality.fingerprint_sum, feat(spark, sf))


@query("fingerprint_rows", FINGERPRINT, views=("feat",))
def fingerprint_rows(spark, sf):
    return fingerprint_holds(quality.fingerprint_rows, feat(spark, sf))


@query(
    "columns_by_type",
    """
    SELECT 'number' AS kind, 'c_custkey' AS name, count(c_custkey) AS filled, min(CAST(c_custkey AS DOUBLE)) AS least FROM customer
    UNION ALL SELECT 'number', 'c_nationkey', count(c_nationkey), min(CAST(c_nationkey AS DOUBLE)) FROM customer
    UNION ALL SELECT 'number', 'c_acctbal', count(c_acctbal), min(CAST(c_acctbal AS DOUBLE)) FROM customer
    UNION ALL SELECT 'text', 'c_mktsegment', count(c_mktsegment), NULL FROM customer
    """,
)
def columns_by_type(spark, sf):
    """Columns chosen by their type, one pass over the table."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    chosen = [("number", c) for c in features.numeric_columns(rows)] + [("text", c) for c in features.text_columns(rows)]
    least = lambda kind, c: F.min(F.col(c).cast("double")) if kind == "number" else F.lit(None).cast("double")
    wide = rows.agg(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).alias("name"), F.count(c).alias("filled"), least(k, c).alias("least")) for k, c in chosen]).alias("cells"))
    return wide.select(F.inline("cells"))


@query(
    "columns_by_pattern",
    "SELECT id, round(coalesce(f1, avg(f1) OVER (PARTITION BY batch_id)), 6) AS f1_processed FROM feat",
    views=("feat",),
)
def columns_by_pattern(spark, sf):
    """Of processed rows, the columns whose name holds a pattern."""
    rows = cleaning.process_batches(feat(spark, sf), "batch_id")
    return rows.select("id", *[F.round(c, 6).alias(c) for c in features.feature_columns(rows)])


@query("target_discovery", "SELECT 'target' AS name, target AS label, count(*) AS n FROM feat GROUP BY target", views=("feat",))
def target_discovery(spark, sf):
    rows = feat(spark, sf)
    _, target = features.split_target(rows)
    return quality.class_counts(rows, target).select(F.lit(target).alias("name"), F.col(target).alias("label"), "n")


@query(
    "fallback_fill",
    f"""
    , p AS (SELECT c_custkey, CASE WHEN b % 10 = 1 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment, b
            FROM (SELECT *, {sql_hash('c_custkey')} AS b FROM customer))
    SELECT c_custkey, CASE WHEN b % 10 = 0 THEN 0.0 ELSE coalesce(c_acctbal, 0.0) END AS c_acctbal, c_mktsegment,
           CASE WHEN b % 10 = 0 THEN 'fallback' WHEN b % 10 = 1 THEN 'filled' ELSE 'primary' END AS source FROM p
    """.replace(", p AS", "WITH p AS", 1),
)
def fallback_fill(spark, sf):
    from millrace.functions.hashing import key_hash

    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    damaged = customer.withColumn("c_acctbal", F.when(key_hash("c_custkey") % 10 != 1, F.col("c_acctbal")))
    primary = damaged.where(key_hash("c_custkey") % 10 != 0)
    fallback = customer.withColumn("c_acctbal", F.lit(0.0))
    return quality.fallback_fill(primary, fallback, "c_custkey", ["c_acctbal", "c_mktsegment"])


@query(
    "row_features",
    """
    , m AS (SELECT id, features AS e, list_avg(features) AS mu, list_stddev_pop(features) AS sd FROM vec)
    SELECT id, round(mu, 6) AS mean, round(sd, 6) AS std, round(list_min(e), 6) AS min, round(list_max(e), 6) AS max,
           round(list_max(e) - list_min(e), 6) AS range,
           round(list_sum(list_transform(e, lambda x: pow((x - mu) / sd, 3))) / len(e), 6) AS skewness,
           round(list_sum(list_transform(e, lambda x: pow((x - mu) / sd, 4))) / len(e) - 3, 6) AS kurtosis,
           CAST(len(list_filter(e, lambda x: x = 0)) AS INTEGER) AS num_zeros,
           CAST(len(list_filter(e, lambda x: x < 0)) AS INTEGER) AS num_negative FROM m
    """,
    views=("vec",),
)
def row_features(spark, sf):
    out = features.add_row_statistics(vec(spark, sf))
    return out.select("id", *r6("mean", "std", "min", "max", "range", "skewness", "kurtosis"), "num_zeros", "num_negative")
