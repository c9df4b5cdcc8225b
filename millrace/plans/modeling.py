"""Splits, scaling, outliers and linear explanations over lineitem."""

from pyspark.sql import functions as F

from millrace.functions.hashing import key_hash
from millrace.operators import explain, quality, scaling, splits
from millrace.operators.scaler_stage import load_scaler, save_scaler
from millrace.plans.fixtures import LI_FEATURES, li, sql_hash
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources.published import align_positions, publish, published
from millrace.sources.tables import table

LINEAR_WEIGHTS = {"l_quantity": 0.08, "l_extendedprice": 0.00004, "l_discount": 20.0, "l_tax": 5.0}


def r6(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


@query("split_random", "SELECT key, split FROM li_split", views=("li_split",))
def split_random(spark, sf):
    return splits.random_split(li(spark, sf).select("key"), ["key"])


RANKED = f"""
    , r AS (SELECT key, y, row_number() OVER (PARTITION BY y ORDER BY {sql_hash('key')}, key) - 1 AS rk,
                   count(*) OVER (PARTITION BY y) AS n FROM li)
"""


@query(
    "split_stratified",
    RANKED + "SELECT key, y, CASE WHEN rk < round(0.2::DOUBLE * n) THEN 'test' ELSE 'train' END AS split FROM r",
    views=("li",),
)
def split_stratified(spark, sf):
    return splits.stratified_split(li(spark, sf).select("key", "y"), ["key"], "y")


@query("kfold_assign", RANKED + "SELECT key, y, CAST(rk % 5 AS INTEGER) AS fold FROM r", views=("li",))
def kfold_assign(spark, sf):
    return splits.stratified_folds(li(spark, sf).select("key", "y"), ["key"], "y")


@query(
    "split_semi_check",
    "SELECT key, y FROM li_split WHERE split = 'test'",
    views=("li_split",),
)
def split_semi_check(spark, sf):
    rows = li(spark, sf).select("key", "y")
    saved = splits.random_split(rows, ["key"]).where("split = 'test'")
    return splits.rows_of_saved_split(rows, saved, ["key"])


@query(
    "align_counts",
    f"""
    SELECT count(*) FILTER ({sql_hash('key')} % 50 <> 0) AS matched, count(*) FILTER ({sql_hash('key')} % 50 = 0) AS x_only,
           CAST(0 AS BIGINT) AS y_only FROM li
    """,
    views=("li",),
)
def align_counts(spark, sf):
    rows = li(spark, sf)
    return splits.align_counts(rows, rows.where(key_hash("key") % 50 != 0), ["key"])


@query(
    "align_xy",
    """
    WITH x AS (SELECT row_number() OVER () - 1 AS position, l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem),
    y AS (SELECT row_number() OVER () - 1 AS position, o_orderkey, o_orderstatus FROM orders)
    SELECT position, l_orderkey, l_partkey, l_quantity, l_extendedprice, o_orderkey, o_orderstatus FROM x JOIN y USING (position)
    """,
)
def align_xy(spark, sf):
    """Two stored tables row by row, as long as the shorter one."""
    x = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    y = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return align_positions(x, y)


@query(
    "standardize",
    """
    , s AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS s2,
                   avg(l_discount) AS m3, stddev_pop(l_discount) AS s3, avg(l_tax) AS m4, stddev_pop(l_tax) AS s4
            FROM li_split WHERE split = 'train')
    SELECT key, split, round((l_quantity - m1) / s1, 6) AS l_quantity_scaled, round((l_extendedprice - m2) / s2, 6) AS l_extendedprice_scaled,
           round((l_discount - m3) / s3, 6) AS l_discount_scaled, round((l_tax - m4) / s4, 6) AS l_tax_scaled
    FROM li_split, s
    """,
    views=("li_split",),
)
def standardize(spark, sf):
    """Scaled by the saved and reloaded stage."""
    rows = splits.random_split(li(spark, sf), ["key"])
    path = save_scaler(rows.where("split = 'train'"), LI_FEATURES, scratch_path(spark, "scaler"))
    return load_scaler(path).transform(rows).select("key", "split", *r6(*[f"{f}_scaled" for f in LI_FEATURES]))


@query(
    "minmax_scale",
    """
    , s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, min(l_tax) AS lo4, max(l_tax) AS hi4 FROM li)
    SELECT key, round((l_quantity - lo) / (hi - lo), 6) AS l_quantity_scaled, round((l_tax - lo4) / (hi4 - lo4), 6) AS l_tax_scaled FROM li, s
    """,
    views=("li",),
)
def minmax_scale(spark, sf):
    rows = li(spark, sf)
    out = scaling.minmax_scale(rows, ["l_quantity", "l_tax"], scaling.scaler_table(rows, ["l_quantity", "l_tax"]))
    return out.select("key", *r6("l_quantity_scaled", "l_tax_scaled"))


TRAIN_CELLS = """
    , t AS (SELECT * FROM li_split WHERE split = 'train'),
    u AS (SELECT 'l_quantity' AS feature, l_quantity AS v FROM t UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM t
          UNION ALL SELECT 'l_discount', l_discount FROM t UNION ALL SELECT 'l_tax', l_tax FROM t)
"""


def train_rows(spark, sf):
    return splits.random_split(li(spark, sf), ["key"]).where("split = 'train'")


@query(
    "column_stats",
    TRAIN_CELLS + """
    SELECT feature, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, max(v) AS max,
           round(quantile_cont(v, 0.5), 6) AS median FROM u GROUP BY feature
    """,
    views=("li_split",),
)
def column_stats(spark, sf):
    return scaling.feature_stats(train_rows(spark, sf), LI_FEATURES).select("feature", "min", "max", *r6("mean", "std", "median"))


@query(
    "feature_stats",
    TRAIN_CELLS + """
    , m AS (SELECT feature, avg(v) AS mean, stddev_pop(v) AS std FROM u GROUP BY feature),
    z AS (SELECT feature, (v - mean) / std AS v FROM u JOIN m USING (feature))
    SELECT feature, round(avg(v), 6) + 0.0 AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max,
           round(quantile_cont(v, 0.5), 6) + 0.0 AS median FROM z GROUP BY feature
    """,
    views=("li_split",),
)
def feature_stats(spark, sf):
    """Statistics of the scaled training columns, as the saved and reloaded scaler has them."""
    path = save_scaler(train_rows(spark, sf), LI_FEATURES, scratch_path(spark, "scaler"))
    return load_scaler(path).scaled_table(spark).select("feature", *r6("mean", "std", "min", "max"), (F.round("median", 6) + 0.0).alias("median"))


@query("class_counts", "SELECT y, count(*) AS n FROM li GROUP BY y", views=("li",))
def class_counts(spark, sf):
    return quality.class_counts(li(spark, sf), "y")


@query(
    "class_weights",
    """
    SELECT y, count(*) AS n, round((SELECT count(*) FROM li) / ((SELECT count(DISTINCT y) FROM li) * count(*)), 6) AS weight
    FROM li GROUP BY y
    """,
    views=("li",),
)
def class_weights(spark, sf):
    return scaling.class_weights(li(spark, sf), "y").select("y", "n", *r6("weight"))


@query(
    "zscore_outliers",
    """
    , s AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS s2,
                   avg(l_discount) AS m3, stddev_pop(l_discount) AS s3, avg(l_tax) AS m4, stddev_pop(l_tax) AS s4 FROM li)
    SELECT key, concat_ws(',', CASE WHEN abs((l_quantity - m1) / s1) > 1.5 THEN 'l_quantity' END,
               CASE WHEN abs((l_extendedprice - m2) / s2) > 1.5 THEN 'l_extendedprice' END,
               CASE WHEN abs((l_discount - m3) / s3) > 1.5 THEN 'l_discount' END,
               CASE WHEN abs((l_tax - m4) / s4) > 1.5 THEN 'l_tax' END) AS outlier_features,
           abs((l_quantity - m1) / s1) > 1.5 OR abs((l_extendedprice - m2) / s2) > 1.5
             OR abs((l_discount - m3) / s3) > 1.5 OR abs((l_tax - m4) / s4) > 1.5 AS has_outliers
    FROM li, s
    """,
    views=("li",),
)
def zscore_outliers(spark, sf):
    rows = li(spark, sf)
    out = load_scaler(save_scaler(rows, LI_FEATURES, scratch_path(spark, "scaler"))).outliers(rows, threshold=1.5)
    return out.select("key", F.array_join("outlier_features", ",").alias("outlier_features"), "has_outliers")


CONTRIBUTIONS = """
    , s AS (SELECT avg(l_quantity) AS m1, avg(l_extendedprice) AS m2, avg(l_discount) AS m3, avg(l_tax) AS m4 FROM li),
    b AS (SELECT 0.08::DOUBLE * m1 + 0.00004::DOUBLE * m2 + 20.0::DOUBLE * m3 + 5.0::DOUBLE * m4 - 3.0::DOUBLE AS base FROM s),
    c AS (SELECT key, 0 AS ord, 'l_quantity' AS feature, l_quantity AS value, 0.08::DOUBLE * (l_quantity - m1) AS shap FROM li, s
          UNION ALL SELECT key, 1, 'l_extendedprice', l_extendedprice, 0.00004::DOUBLE * (l_extendedprice - m2) FROM li, s
          UNION ALL SELECT key, 2, 'l_discount', l_discount, 20.0::DOUBLE * (l_discount - m3) FROM li, s
          UNION ALL SELECT key, 3, 'l_tax', l_tax, 5.0::DOUBLE * (l_tax - m4) FROM li, s),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY abs(shap) DESC, ord) AS INTEGER) AS rank FROM c),
    pv AS (SELECT key, any_value(base) + sum(shap) AS value FROM c, b GROUP BY key)
"""


def ranked_contributions(spark, sf):
    return explain.rank_contributions(explain.linear_contributions(li(spark, sf), LINEAR_WEIGHTS, intercept=-3.0))


@query(
    "shap_linear",
    """
    , s AS (SELECT avg(l_quantity) AS m1, avg(l_extendedprice) AS m2, avg(l_discount) AS m3, avg(l_tax) AS m4 FROM li),
    c AS (SELECT key, 0.08::DOUBLE * m1 + 0.00004::DOUBLE * m2 + 20.0::DOUBLE * m3 + 5.0::DOUBLE * m4 - 3.0::DOUBLE AS base,
                 0.08::DOUBLE * (l_quantity - m1) AS a, 0.00004::DOUBLE * (l_extendedprice - m2) AS b,
                 20.0::DOUBLE * (l_discount - m3) AS c, 5.0::DOUBLE * (l_tax - m4) AS d FROM li, s)
    SELECT key, round(base, 6) AS base_value, round(base + a + b + c + d, 6) AS prediction_value,
           round(a, 6) AS phi_quantity, round(b, 6) AS phi_price, round(c, 6) AS phi_discount, round(d, 6) AS phi_tax FROM c
    """,
    views=("li",),
)
def shap_linear(spark, sf):
    phi = [F.col("contributions")[i]["shap_value"] for i in range(4)]
    names = ["phi_quantity", "phi_price", "phi_discount", "phi_tax"]
    return ranked_contributions(spark, sf).select(
        "key", *r6("base_value", "prediction_value"), *[F.round(p, 6).alias(n) for p, n in zip(phi, names)]
    )


def _stored_sql(version: str, weights: dict) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{version}' AS model_version, key, '{f}' AS feature, round({f}, 6) AS value,
                   round({w}::DOUBLE * ({f} - (SELECT avg({f}) FROM li)), 6) AS contribution FROM li"""
        for f, w in weights.items()
    )


# The weights of an earlier version of the linear model.
EARLIER_WEIGHTS = {"l_quantity": 0.0531, "l_extendedprice": 0.0000317, "l_discount": 18.37, "l_tax": 4.13}


@query("explanations_stored", "\n    , e AS (" + _stored_sql("v1", EARLIER_WEIGHTS) + " UNION ALL " + _stored_sql("v2", LINEAR_WEIGHTS) + ") SELECT * FROM e", views=("li",))
def explanations_stored(spark, sf):
    """Contributions of two model versions, published. The job of the second version runs twice,
    first with the wrong weights: its second run replaces its own rows and no others."""
    path, rows = scratch_path(spark, "explanations"), li(spark, sf)
    for version, weights in (("v1", EARLIER_WEIGHTS), ("v2", EARLIER_WEIGHTS), ("v2", LINEAR_WEIGHTS)):
        stored = explain.stored_rows(explain.linear_contributions(rows, weights), "key", version)
        publish(stored, path, ["model_version"])
    parts = [published(spark, path, stored.schema, model_version=v) for v in ("v1", "v2")]
    cells = explain.stored_cells(parts[0].union(parts[1]), "key")
    return cells.select("model_version", "key", "feature", *r6("value", "contribution"))


@query(
    "explain_rows",
    CONTRIBUTIONS + """
    SELECT key, rank, feature, value, round(shap, 6) AS shap_value, round(abs(shap), 6) AS abs_shap_value,
           CASE WHEN shap > 0 THEN 'increases fraud risk' ELSE 'decreases fraud risk' END AS contribution FROM r
    """,
    views=("li",),
)
def explain_rows(spark, sf):
    rows = explain.explanation_rows(ranked_contributions(spark, sf), "key")
    return rows.select("key", "rank", "feature", "value", *r6("shap_value", "abs_shap_value"), "contribution")


@query("topk_contrib", CONTRIBUTIONS + "SELECT key, rank, feature FROM r WHERE rank <= 3", views=("li",))
def topk_contrib(spark, sf):
    return explain.explanation_rows(ranked_contributions(spark, sf), "key", 3).select("key", "rank", "feature")


@query(
    "explain_text",
    CONTRIBUTIONS + """
    , p AS (SELECT key, value, 1.0 / (1.0 + exp(-value)) AS prob FROM pv),
    t AS (SELECT key, string_agg(printf('%d. %s (value: %.3f) %s by %.3f', rank, feature, value,
                 CASE WHEN shap > 0 THEN 'increases fraud risk' ELSE 'decreases fraud risk' END, abs(shap)) || chr(10), '' ORDER BY rank) AS lines
          FROM r WHERE rank <= 3 GROUP BY key)
    SELECT key, printf('This transaction is predicted as %s with %.1f%% confidence. The most influential factors are:',
                CASE WHEN prob >= 0.5 THEN 'FRAUD' ELSE 'LEGITIMATE' END, CASE WHEN prob >= 0.5 THEN prob ELSE 1 - prob END * 100)
           || chr(10) || lines AS text
    FROM p JOIN t USING (key)
    """,
    views=("li",),
)
def explain_text(spark, sf):
    scored = ranked_contributions(spark, sf).withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("prediction_value"))))
    prediction = F.when(F.col("p") >= 0.5, 1).otherwise(0)
    return scored.select("key", explain.explanation_text(prediction, F.col("p")).alias("text"))


@query(
    "explain_series",
    CONTRIBUTIONS + """
    SELECT key, string_agg(feature, ',' ORDER BY rank) AS waterfall_features, string_agg(printf('%.4f', shap), ',' ORDER BY rank) AS force_values,
           string_agg(printf('%.4f', abs(shap)), ',' ORDER BY rank) AS bar_values, round((SELECT base FROM b), 6) AS base_value
    FROM r GROUP BY key
    """,
    views=("li",),
)
def explain_series(spark, sf):
    def joined(column):
        return F.array_join(F.transform(column, lambda x: F.format_string("%.4f", x)), ",")

    series = explain.chart_series(ranked_contributions(spark, sf))
    return series.select(
        "key",
        F.array_join("waterfall.feature", ",").alias("waterfall_features"),
        joined("force.shap_value").alias("force_values"),
        joined("bar.abs_shap_value").alias("bar_values"),
        F.round("force.base_value", 6).alias("base_value"),
    )
