"""Spark ML queries over the embedding table. Trained numbers differ between engines, so the
queries return what must hold whatever was learnt (counts, sums, orders, ranges), which SQL states."""

from pyspark.sql import functions as F

from millrace.operators import evaluation, explain, search, splits, training, treeshap
from millrace.plans.fixtures import sql_hash, vec
from millrace.plans.registry import query
from millrace.session import materialize, scratch_path

NAMES = [f"f{i}" for i in range(64)]


def parts(spark, sf, label="y"):
    rows = splits.stratified_split(vec(spark, sf), ["id"], label)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def report_sql(label: str, classes: int) -> str:
    """Support of every class among the test rows, and of all."""
    return f"""
    , r AS (SELECT {label} AS c, row_number() OVER (PARTITION BY {label} ORDER BY {sql_hash('id')}, id) - 1 AS rk, count(*) OVER (PARTITION BY {label}) AS n FROM vec),
    t AS (SELECT c FROM r WHERE rk < round(0.2::DOUBLE * n))
    SELECT CAST(c AS VARCHAR) AS label, (SELECT count(*) FROM t WHERE t.c = k.c) AS support, true AS sound FROM range({classes}) k(c)
    UNION ALL SELECT unnest(['macro avg', 'weighted avg']), (SELECT count(*) FROM t), true
    """


def report(model, test, classes, label="y"):
    """Class report: support, and whether the scores are shares that fit each other."""
    out = evaluation.class_report(training.score(model, test, keep=("id", label)), classes, (), label)
    p, r, f1 = F.col("precision"), F.col("recall"), F.col("f1")
    shares = p.between(0, 1) & r.between(0, 1) & f1.between(0, 1)
    fits = F.col("label").contains("avg") | (F.abs(f1 * (p + r) - 2 * p * r) < 1e-9)
    return out.select(F.col("label").cast("string").alias("label"), "support", (shares & fits).alias("sound"))


@query("train_forest", report_sql("y", 2), views=("vec",))
def train_forest(spark, sf):
    train, test = parts(spark, sf)
    model = training.fit(training.forest(20, 6, weight="weight"), training.balanced(train))
    return report(model, test, [0, 1])


@query("train_gbt", report_sql("y", 2), views=("vec",))
def train_gbt(spark, sf):
    train, test = parts(spark, sf)
    return report(training.fit(training.boosted(8, 3), train), test, [0, 1])


@query("train_logreg", report_sql("label", 10), views=("vec",))
def train_logreg(spark, sf):
    train, test = parts(spark, sf, "label")
    return report(training.fit(training.logistic(label="label"), train), test, list(range(10)), "label")


def small_forest(spark, sf, trees=10, depth=5):
    train, test = parts(spark, sf)
    return training.fit(training.forest(trees, depth), train), test


@query("score_batch", "SELECT id, true AS sums_to_one, true AS follows FROM vec", views=("vec",))
def score_batch(spark, sf):
    """Every row scored: its probabilities sum to one, and the class follows the threshold."""
    model, _ = small_forest(spark, sf)
    p = F.col("probabilities")
    scored = training.score(model, vec(spark, sf), threshold=0.5)
    return scored.select("id", (F.abs(p[0] + p[1] - 1) < 1e-9).alias("sums_to_one"), (F.col("pred") == (p[1] >= 0.5).cast("int")).alias("follows"))


@query(
    "model_roundtrip",
    f"""
    , r AS (SELECT id, row_number() OVER (PARTITION BY y ORDER BY {sql_hash('id')}, id) - 1 AS rk, count(*) OVER (PARTITION BY y) AS n FROM vec)
    SELECT id, true AS same_score FROM r WHERE rk < round(0.2::DOUBLE * n)
    """,
    views=("vec",),
)
def model_roundtrip(spark, sf):
    """Scores of the saved and reloaded model against those of the original."""
    model, test = small_forest(spark, sf)
    loaded = training.load_model(training.save_model(model, scratch_path(spark, "model")))
    before = training.score(model, test).select("id", F.col("probabilities").alias("before"))
    after = training.score(loaded, test).select("id", F.col("probabilities").alias("after"))
    return before.join(after, "id").select("id", (F.col("before") == F.col("after")).alias("same_score"))


@query("shap_additivity", "SELECT id, true AS adds_up FROM vec", views=("vec",))
def shap_additivity(spark, sf):
    """Base value plus contributions equals the forest's probability for every row."""
    model, _ = small_forest(spark, sf)
    rows = vec(spark, sf)
    explained = explain.rank_contributions(treeshap.explain_forest(model, rows, NAMES)).select("id", "prediction_value")
    scored = training.score(model, rows).select("id", F.col("probabilities")[1].alias("p"))
    return explained.join(scored, "id").select("id", (F.abs(F.col("prediction_value") - F.col("p")) < 1e-9).alias("adds_up"))


@query("feature_importance", "SELECT CAST(i AS INTEGER) AS rank, true AS in_order, true AS known FROM range(1, 6) t(i), (SELECT count(*) AS n FROM vec) WHERE n > 0", views=("vec",))
def feature_importance(spark, sf):
    """The five features of most importance: ranked shares of one, each a feature of the table."""
    model, _ = small_forest(spark, sf)
    whole = training.importance_table(spark, model, NAMES)
    top = training.top_importance(whole).agg(F.collect_list(F.struct("importance", "feature")).alias("top"))
    total = whole.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("t")).scalar()
    least = F.get("top", F.col("i") + 1)["importance"]
    rows = top.select("top", F.posexplode("top").alias("i", "row"))
    in_order = F.coalesce(F.col("row.importance") >= least, F.lit(True)) & F.col("row.importance").between(0, 1) & total
    return rows.select((F.col("i") + 1).alias("rank"), in_order.alias("in_order"), F.col("row.feature").isin(NAMES).alias("known"))


@query("cross_validate", "SELECT CAST(5 AS BIGINT) AS folds, true AS sound FROM (SELECT count(*) AS n FROM vec) WHERE n > 0", views=("vec",))
def cross_validate(spark, sf):
    """Folds of a stratified cross-validation, and whether mean and deviation can be those of shares."""
    out = training.fold_summary(training.cross_validate(vec(spark, sf), training.forest(5, 4), k=5))
    return out.select("folds", (F.col("mean_accuracy").between(0, 1) & F.col("std_accuracy").between(0, 0.5)).alias("sound"))


@query(
    "staged_metrics",
    "SELECT CAST(i AS INTEGER) AS step, CAST(2 * i AS INTEGER) AS trees, true AS sound, true AS ends_whole FROM range(1, 6) t(i), (SELECT count(*) AS n FROM vec) WHERE n > 0",
    views=("vec",),
)
def staged_metrics(spark, sf):
    """The curve over prefixes of a forest; its last step has the accuracy of the whole forest."""
    model, test = small_forest(spark, sf)
    whole = evaluation.accuracy(training.score(model, test, keep=("id", "y"))).first()["accuracy"]
    out = training.staged_metrics(model, test, [0, 1], epochs=5)
    sound = F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)
    ends = (F.col("trees") < 10) | (F.abs(F.col("accuracy") - whole) < 1e-9)
    return out.select(F.col("step").cast("int").alias("step"), F.col("trees").cast("int").alias("trees"), sound.alias("sound"), ends.alias("ends_whole"))


TRIAL_SPACE = [
    search.Param("n_estimators", "int", 4, 8, 4),
    search.Param("max_depth", "int", 3, 5, 2),
    search.Param("criterion", "categorical", values=("gini", "entropy")),
]


@query(
    "run_trials",
    """
    SELECT CAST(i AS BIGINT) AS trial, CAST(4 + 4 * (i // 4) AS BIGINT) AS n_estimators, CAST(3 + 2 * (i // 2 % 2) AS BIGINT) AS max_depth, ['gini', 'entropy'][i % 2 + 1] AS criterion,
           true AS sound, true AS best_is_most
    FROM range(6) t(i), (SELECT count(*) AS n FROM vec) WHERE n > 0
    """,
    views=("vec",),
)
def run_trials(spark, sf):
    """The first trials of a grid table, fitted and scored; the best has the largest accuracy."""
    train, test = parts(spark, sf)
    grid = search.grid_space(spark, TRIAL_SPACE, max_trials=6)
    done = materialize(training.run_trial_table(train, test, grid, [p.name for p in TRIAL_SPACE]), "trials")
    best = search.best_trial(done, [], "accuracy").first()["accuracy"]
    most = done.agg(F.max("accuracy").alias("m")).scalar()
    sound = F.greatest("accuracy", "precision", "recall", "f1") <= 1
    return grid.join(done.select("trial", sound.alias("sound")), "trial").withColumn("best_is_most", F.lit(best) == most)


@query("shap_forest", "SELECT id, CAST(r AS INTEGER) AS rank, true AS in_order, true AS known FROM vec, range(1, 11) t(r)", views=("vec",))
def shap_forest(spark, sf):
    """The ten strongest contributions of every row, ranked by size."""
    model, _ = small_forest(spark, sf)
    ranked = explain.rank_contributions(treeshap.explain_forest(model, vec(spark, sf), NAMES))
    rows = ranked.select("id", F.col("all_features").alias("every"), F.inline_outer(explain.top_features(10)))
    before = F.get("every", F.col("rank") - 2)["abs_shap_value"]
    in_order = (F.col("abs_shap_value") == F.abs("shap_value")) & F.coalesce(before >= F.col("abs_shap_value"), F.lit(True))
    return rows.select("id", "rank", in_order.alias("in_order"), F.col("feature").isin(NAMES).alias("known"))
