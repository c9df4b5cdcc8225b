"""Edge cases and library functions that no registered query covers."""

import json
import math
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.prefix import id_order_bucket, rank_in_group
from millrace.functions.selection import edge_rows, top_share
from millrace.operators import cleaning, ensemble, evaluation, features, lifecycle, monitoring, quality, runs, scaling, search, serving, splits, validation
from millrace.session import scratch_path
from millrace.sources import files, payloads, synth, uris


def test_all_null_batch_stays_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 4.0), (2, None)], "b int, v double")
    out = sorted((r.b, r.v) for r in cleaning.impute_batch_mean(df, "v", "b").where("b = 2").collect())
    assert out == [(2, 4.0), (2, 4.0)]
    assert cleaning.impute_batch_mean(df, "v", "b").where("b = 1 and v is null").count() == 2


def test_clamped_sqrt_of_missing_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-4.0,), (0.0,), (9.0,)], "v double")
    got = [r[0] for r in df.select(cleaning.clamped_sqrt(F.col("v"))).collect()]
    assert got == pytest.approx([math.sqrt(0.001)] * 4 + [3.0])


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, x double")
    table = scaling.scaler_table(df, ["x"])
    assert [r.x_scaled for r in scaling.standardize(df, ["x"], table).collect()] == [0.0, 0.0]
    assert [r.x_scaled for r in scaling.minmax_scale(df, ["x"], table).collect()] == [0.0, 0.0]
    assert [r.has_outliers for r in scaling.outliers(df, ["x", "id"], table, 0.1).select("has_outliers").collect()] == [False, False]


def test_saved_scaler_gives_the_same_scaling(spark):
    df = spark.range(100).select("id", (F.col("id") * 3.0).alias("x"))
    path = files.write_parquet(scaling.scaler_table(df, ["x"]), scratch_path(spark, "scaler"))
    loaded = scaling.standardize(df, ["x"], spark.read.parquet(path))
    stats = loaded.agg(F.avg("x_scaled").alias("m"), F.stddev_pop("x_scaled").alias("s")).first()
    assert stats.m == pytest.approx(0, abs=1e-12) and stats.s == pytest.approx(1)


def test_row_statistics_of_constant_row(spark):
    df = spark.createDataFrame([([2.0, 2.0, 2.0],)], "features array<double>")
    row = features.add_row_statistics(df).first()
    assert (row["mean"], row["std"], row["skewness"], row["kurtosis"]) == (2.0, 0.0, 0.0, 0.0)


def test_column_selection(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 3.0)], "id int, f_processed double, name string, g_v2 double")
    assert features.numeric_columns(df) == ["id", "f_processed", "g_v2"]
    assert features.text_columns(df) == ["name"]
    assert features.feature_columns(df) == ["f_processed", "g_v2"]
    assert features.feature_columns(df.select("id", "name"), default=["id"]) == ["id"]
    assert features.discover_target(df) == "g_v2"
    assert features.split_target(df.withColumnRenamed("name", "label")) == (["id", "f_processed", "g_v2"], "label")


def test_fingerprints_ignore_row_order(spark):
    df = spark.range(500).select("id", (F.col("id") / 7).alias("x"), F.when(F.col("id") % 5 != 0, 1).alias("n"))
    shuffled = df.repartition(7).orderBy(F.desc("x"))
    assert quality.fingerprint_rows(df).collect() == quality.fingerprint_rows(shuffled).collect()
    assert quality.fingerprint_sum(df).collect() == quality.fingerprint_sum(shuffled).collect()
    assert quality.fingerprint_rows(df).collect() != quality.fingerprint_rows(df.where("id > 0")).collect()


def votes(spark, rows):
    schema = "key int, votes array<struct<model: string, prediction: int, probabilities: array<double>>>"
    return spark.createDataFrame(rows, schema)


def test_ensemble_ties_defaults_and_errors(spark):
    df = votes(spark, [(1, [("a", 1, [0.5, 0.5]), ("b", 0, [0.5, 0.5])]), (2, [("a", 1, None), ("x", 1, None), ("b", 0, None)])])
    major = {r.key: (r.prediction, r.confidence) for r in ensemble.combine(df, "majority_vote").collect()}
    assert major == {1: (0, 0.5), 2: (1, pytest.approx(2 / 3))}
    mean = {r.key: (r.prediction, r.confidence) for r in ensemble.combine(df, "weighted_average", {"a": 0.5, "b": 1.5}).collect()}
    assert mean == {1: (0, 0.5), 2: (0, 0.5)}
    best = {r.key: (r.prediction, r.selected_model, r.confidence) for r in ensemble.combine(df, "max_confidence").collect()}
    assert best == {1: (1, "a", 0.5), 2: (1, "a", 0.5)}
    with pytest.raises(ValueError):
        ensemble.combine(df, "median")


def test_zero_total_weight_gives_null(spark):
    df = votes(spark, [(1, [("a", 1, [0.1, 0.9])])])
    assert ensemble.weighted_average(df, {"a": 0.0}).first().mean_probabilities == [None, None]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id long, y int, pred int, p1 double, batch_id long, f1 double, f2 double")
    assert cleaning.process_batches(empty, "batch_id").count() == 0
    assert evaluation.confusion_matrix(empty, [0, 1]).agg(F.sum("n")).first()[0] in (0, None)
    assert evaluation.roc_auc(empty, []).first().auc == 0.0
    assert splits.stratified_split(empty, ["id"], "y").count() == 0
    report = lifecycle.retention_report(spark.createDataFrame([], "type string, age_days int, size_mb double"), 30).first()
    assert (report.total_artifacts, report.storage_reduction_percent) == (0, 0.0)


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, pred int")
    rows = {r.label: r for r in evaluation.class_report(df, [0, 1]).collect()}
    assert (rows["0"].precision, rows["0"].recall, rows["0"].f1, rows["0"].support) == (0.0, 0.0, 0.0, 0)
    assert rows["weighted avg"].f1 == 1.0 and rows["macro avg"].f1 == 0.5
    cells = {(r.actual, r.predicted): r.n for r in evaluation.confusion_matrix(df, [0, 1]).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_risk_limits(spark):
    df = spark.createDataFrame([(0.8,), (0.5,), (0.49,), (None,)], "p double")
    assert [r[0] for r in df.select(serving.risk_level(F.col("p"))).collect()] == ["high", "medium", "low", None]


def test_instances_that_are_not_instances(spark):
    rows = [("{broken",), ("3",), (None,), ("[1, 2]",), ('{"a": 1, "b": 2, "c": "x"}',), ("[1, true]",), ("[]",)]
    df = validation.validate_instances(spark.createDataFrame(rows, "instance string"), "instance", ["a", "b"])
    assert [r.error for r in df.collect()] == [
        "Invalid input type: expected dict or list",
        "Invalid input type: expected dict or list",
        "Invalid input type: expected dict or list",
        "",
        "",
        "All features must be numbers",
        "Expected 2 features, got 0",
    ]


def test_missing_names_are_cut_at_five(spark):
    df = validation.validate_instances(spark.createDataFrame([("{}",)], "i string"), "i", list("abcdefg"))
    assert df.first().error == "Missing features: a, b, c, d, e"


def test_strict_rules_fail_the_job(spark):
    df = spark.createDataFrame([(0.95, -1.0)], "split double, seed double")
    rules = [validation.in_range("split", "split", 0.1, 0.9), validation.at_least("seed", "seed", 0)]
    lenient = validation.apply_rules(df, rules).first()
    assert lenient.violation_text == "split must be 0.1-0.9, got 0.95; seed must be at least 0, got -1.00"
    with pytest.raises(PySparkException, match="Validation failed"):
        validation.apply_rules(df, rules, strict=True).collect()
    assert validation.apply_rules(df.select(F.lit(0.5).alias("split"), F.lit(1.0).alias("seed")), rules, strict=True).first().validation_status == "PASSED"


def test_column_migration(spark):
    df = spark.createDataFrame([("x", "simple")], "old_dataset string, model_type string")
    out = validation.migrate_columns(df, {"old_dataset": "dataset_name", "absent": "y"})
    assert out.columns == ["dataset_name", "model_type"]


def test_payload_forms(spark):
    rows = [
        (1, json.dumps({"inputs": [{"name": "n", "shape": [2, 2], "datatype": "FP32", "data": [1, 2, 3, 4]}]})),
        (2, json.dumps({"inputs": [{"name": "n", "shape": [1, 2], "datatype": "FP32", "data": [[5, 6]]}]})),
        (3, json.dumps({"instances": [[7, 8], [9, 10]]})),
    ]
    out = payloads.decode_payloads(spark.createDataFrame(rows, "r int, p string"), "p", ["r"])
    assert sorted((x.r, x.instance, x.features) for x in out.collect()) == [
        (1, 0, [1.0, 2.0]), (1, 1, [3.0, 4.0]), (2, 0, [5.0, 6.0]), (3, 0, [7.0, 8.0]), (3, 1, [9.0, 10.0]),
    ]


def test_payload_kinds_and_errors(spark):
    two = {"inputs": [{"name": "a", "shape": [1, 2], "datatype": "FP32", "data": [1, 2]}, {"name": "b", "shape": [2, 2], "datatype": "FP32", "data": [[3, 4], [5, 6]]}]}
    rows = [
        (1, json.dumps(two)), (2, json.dumps({"instances": [{"x": 1, "y": 2}, {"y": 3}]})), (3, "{broken"), (4, json.dumps({"instances": []})), (5, None),
        (6, json.dumps({"inputs": [{"name": "a", "shape": [1, 2], "datatype": "FP32", "data": [1, 2, 3]}]})), (7, json.dumps({"inputs": [{"name": "a", "shape": [0, 2], "datatype": "FP32", "data": []}]})),
        (8, json.dumps({"other": 1})),
    ]
    out = payloads.decode_payloads(spark.createDataFrame(rows, "r int, p string"), "p", ["r"], ["x", "y"]).collect()
    good = sorted((x.r, x.instance, x.features) for x in out if x.error is None)
    assert good == [(1, 0, [1.0, 2.0]), (1, 1, [3.0, 4.0]), (1, 2, [5.0, 6.0]), (2, 0, [1.0, 2.0]), (2, 1, [0.0, 3.0])]
    assert sorted((x.r, x.instance, x.features) for x in out if x.error) == [(r, None, None) for r in (3, 4, 5, 6, 7, 8)]


def test_payload_round_trip(spark):
    df = spark.createDataFrame([(i, [float(i), i / 3]) for i in range(7)], "k long, f array<double>")
    text = payloads.encode_payloads(df, "k", "f", 3)
    assert json.loads(text.where("request = 2").first().payload)["inputs"][0]["shape"] == [1, 2]
    back = payloads.decode_payloads(text, "payload", ["request"]).selectExpr("request * 3 + instance as k", "features as f")
    assert back.exceptAll(df).count() == 0 and back.count() == 7


def test_storage_addresses(spark):
    df = spark.createDataFrame([("/minio/bucket/a/b.pkl",), ("//bucket",), ("bucket/x",)], "p string")
    p = F.col("p")
    got = [tuple(r) for r in df.select(uris.storage_uri(p), uris.bucket_of(p), uris.key_of(p)).collect()]
    assert got == [("s3://bucket/a/b.pkl", "bucket", "a/b.pkl"), ("s3://bucket", "bucket", ""), ("s3://bucket/x", "bucket", "x")]


def test_json_documents_on_disk(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"id": 1,\n "v": 2.5}')
    (tmp_path / "many.json").write_text('[{"id": 2, "v": 1}, {"id": 3, "v": null}]')
    out = files.read_json_documents(spark, str(tmp_path), "id long, v double")
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, 2.5), (2, 1.0), (3, None)]


def test_csv_inference_and_json_sink(spark):
    path = files.write_csv(spark.range(3).select("id", (F.col("id") / 2).alias("v")), scratch_path(spark, "csv"))
    assert [f.dataType.simpleString() for f in files.read_csv(spark, path).schema] == ["int", "double"]
    target = files.write_json(spark.range(3), scratch_path(spark, "json"))
    assert spark.read.json(target).count() == 3


def test_metric_lines_and_failed_trials(spark):
    lines = spark.createDataFrame([(1, "epoch=3 loss=0.5 accuracy=0.25"), (1, "f1-score=-1"), (1, "no metric here")], "trial int, line string")
    rows = search.parse_metric_lines(lines, "line", ["trial"])
    assert sorted((r.step or 0, r.name, r.value) for r in rows.collect()) == [(0, "f1-score", -1.0), (3, "accuracy", 0.25), (3, "loss", 0.5)]
    out = search.with_failed_objective(rows, spark.createDataFrame([(9,)], "trial int"), "accuracy")
    assert out.where("trial = 9").first().value == 0.0


def test_search_spaces(spark):
    assert search.grid_size(search.GRID_SPACE) == 288
    grid = search.grid_space(spark, search.GRID_SPACE)
    assert grid.count() == 288 and grid.drop("trial").distinct().count() == 288
    assert search.grid_space(spark, search.GRID_SPACE, 50).count() == 50
    assert sorted(r[0] for r in grid.select("max_features_ratio").distinct().collect()) == [0.3, 0.6, 0.9]
    drawn = search.random_space(spark.range(3000).withColumnRenamed("id", "trial"), "trial", search.RANDOM_SPACE)
    low, high, kinds = drawn.agg(F.min("max_depth"), F.max("max_depth"), F.count_distinct("criterion")).first()
    assert (low, high, kinds) == (3, 20, 3)


def test_halving_schedule():
    rows = search.halving_schedule(27, 1, 3)
    assert max(r["bracket"] for r in rows) == 3
    assert [(r["configurations"], r["resource"]) for r in rows if r["bracket"] == 3] == [(27, 1), (9, 3), (3, 9), (1, 27)]


def test_best_trial_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(2, 0.9), (1, 0.9), (3, None)], "trial int, accuracy double")
    assert search.best_trial(df, [], "accuracy").first().trial == 1
    assert search.best_trial(df, [], "accuracy", maximize=False).first().trial == 1
    with pytest.raises(ValueError):
        search.cleanup_candidates(df, "some")


def test_cost_and_cause_defaults(spark):
    nodes = spark.createDataFrame([("r", "cuda-step", 3600.0), ("r", "prep", 1800.0), ("r", "skip", None)], "run string, component string, duration double")
    row = runs.run_cost(nodes).first()
    assert (row.cpu_hours, row.gpu_hours, row.memory_gb_hours) == (1.0, 1.0, 20.0)
    assert row.estimated_cost == pytest.approx(2.75)
    df = spark.createDataFrame([("disk full", "Deadline exceeded"), (None, None)], "logs string, message string")
    causes = [r[0] for r in df.select(runs.failure_cause(F.col("logs"), F.col("message"))).collect()]
    assert causes == ["Component timeout - increase timeout or optimize code", runs.UNKNOWN_CAUSE]
    assert spark.range(1).select(runs.valid_status(F.lit("Omitted")), runs.valid_status(F.lit("Gone"))).first() == (True, False)


def test_bad_timestamps_become_null(spark):
    doc = json.dumps({"status": {"nodes": {"n1": {"displayName": "a", "phase": "Failed", "startedAt": "bad", "finishedAt": "2024-01-01T00:00:05"}}}})
    manifests = spark.createDataFrame([("r1", doc), ("r2", "not json")], "run string, manifest string")
    records = spark.createDataFrame([("r1", "Failed", None), ("r2", "Failed", "boom")], "run string, state string, error string")
    records = records.withColumns({"created": F.lit(None).cast("timestamp"), "ended": F.lit(None).cast("timestamp")})
    rows = {r.run: r for r in runs.run_timeline(manifests, records).collect()}
    assert rows["r1"].started is None and rows["r1"].duration is None and rows["r1"].component == "a"
    assert rows["r2"].component == "Pipeline" and rows["r2"].message == "boom"


def test_cache_key_ignores_and_depends(spark):
    def key(**params):
        columns = {k: F.lit(v) for k, v in params.items()}
        return spark.range(1).select(lifecycle.cache_key(F.lit("d"), F.lit("c"), columns, F.lit("2024-01-01"))).first()[0]

    assert key(a="1", cache_experiment_id="7") == key(cache_experiment_id="8", a="1")
    assert key(a="1") != key(a="2") and len(key(a="1")) == 32
    assert spark.range(1).select(lifecycle.shown_key(F.lit(key(a="1")))).first()[0] == key(a="1")[:8]


def test_registry_appends_and_latest(spark):
    path = scratch_path(spark, "registry")
    for version, accuracy in ((1, 0.8), (2, 0.9)):
        run = spark.createDataFrame([(version, accuracy)], "v int, acc double")
        record = lifecycle.registry_record(run, F.lit("fraud"), F.col("v"), F.concat(F.lit("s3://m/"), F.col("v")), accuracy=F.col("acc"))
        files.write_parquet(record, path, mode="append")
    row = lifecycle.registry_latest(spark.read.parquet(path)).first()
    assert (row.version, row.versions, json.loads(row.metadata)["accuracy"]) == (2, 2, 0.9)


def test_circuit_opens_at_three(spark):
    rows = [(1, i, e) for i, e in enumerate([1, 0, 1, 1, 1])] + [(2, i, e) for i, e in enumerate([1, 1, 1, 0])] + [(3, 0, 1), (4, 0, 0)]
    out = monitoring.circuit_state(spark.createDataFrame(rows, "k int, o int, error int"), ["k"], "o")
    assert {r.k: (r.consecutive_failures, r.state) for r in out.collect()} == {
        1: (3, "open"), 2: (0, "closed"), 3: (1, "closed"), 4: (0, "closed"),
    }


def test_no_drift_without_full_baseline(spark):
    df = spark.range(100).select(F.lit("e").alias("k"), "id", F.rand(1).alias("x"))
    assert monitoring.drift_by_feature(df, ["x"], ["k"], "id").count() == 0
    flat = spark.range(300).select(F.lit("e").alias("k"), "id", F.lit(1.0).alias("x"))
    assert monitoring.drift_by_feature(flat, ["x"], ["k"], "id").first().drifted is False


def test_synthetic_tables(spark):
    one = synth.feature_table(synth.keys(spark, 4000, 1), wide=True)
    many = synth.feature_table(synth.keys(spark, 4000, 9), wide=True)
    assert one.exceptAll(many).count() == 0
    stats = one.agg(
        F.count_if(F.col("feature_1").isNull()).alias("nulls"), F.avg("feature_1").alias("m"), F.stddev("feature_1").alias("s"),
        F.avg("feature_2").alias("e"), F.avg("feature_5").alias("g"), F.avg("target").alias("t"),
    ).first()
    assert stats.nulls == 200
    assert stats.m == pytest.approx(0, abs=0.06) and stats.s == pytest.approx(1, abs=0.05)
    assert stats.e == pytest.approx(2, abs=0.15) and stats.g == pytest.approx(4, abs=0.2) and stats.t == pytest.approx(0.3, abs=0.03)
    flips = synth.rule_label_table(synth.keys(spark, 1000)).where("label <> clean_label").count()
    assert flips == 100
    batch = synth.uniform_batch(synth.keys(spark, 50)).select(F.explode("features").alias("v")).agg(F.min("v"), F.max("v"), F.count("v")).first()
    assert batch[0] >= 2 and batch[1] <= 5 and batch[2] == 1500
    assert synth.imbalanced_table(synth.keys(spark, 5000)).agg(F.avg("Class")).first()[0] == pytest.approx(0.03, abs=0.01)


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "id int, x int"), spark.createDataFrame([(2, 3)], "id int, y int")
    assert sorted(tuple(r) for r in quality.union_chunks([a, b]).collect()) == [(1, 2, None), (2, None, 3)]


def test_scratch_folder_follows_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path.startswith(base) if base else os.path.isdir(path.split("/millrace/")[0])


def test_corrupt_lines_keep_their_text(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n{"id": \n')
    schema = T.StructType([T.StructField("id", T.LongType())])
    rows = files.tag_corrupt(files.read_json_lines(spark, str(tmp_path), schema)).collect()
    assert sorted((r.status, r.error_line) for r in rows) == [("error", '{"id": '), ("ok", None)]


def test_no_row_is_lost(spark):
    rows = [(1, "a", 1.0, 5), (2, None, 3.0, 6), (3, None, None, 7), (4, "a", None, None), (5, "a", float("nan"), 8)]
    df = spark.createDataFrame(rows, "id int, g string, v double, o int")
    filled = {r.id: r.v for r in cleaning.impute_batch_mean(df.where("id < 5"), "v", "g").collect()}
    assert filled == {1: 1.0, 2: 3.0, 3: 3.0, 4: 1.0}
    ranks = {r.id: (r["rank"], r.rank_total) for r in rank_in_group(df, ["g"], [F.col("o")], id_order_bucket(F.col("o"), 2)).collect()}
    assert ranks == {4: (0, 3), 1: (1, 3), 5: (2, 3), 2: (0, 2), 3: (1, 2)}
    assert sorted(r.id for r in edge_rows(df, ["g"], "o", 2).collect()) == [1, 2, 3, 5]
    assert {r.id: r.kept for r in top_share(df, "id", ["g"], "v", 1).collect()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert {r.id: r.kept for r in top_share(df, "id", [], "v", 2).collect()} == {1: False, 2: True, 3: False, 4: False, 5: False}


def test_fallback_keeps_primary_rows(spark):
    primary = spark.createDataFrame([(1, 5.0), (2, None), (9, None)], "k int, v double")
    out = quality.fallback_fill(primary, spark.createDataFrame([(2, 7.0), (3, 8.0)], "k int, v double"), "k", ["v"])
    assert sorted((r.k, r.v or 0, r.source) for r in out.collect()) == [(1, 5.0, "primary"), (2, 7.0, "filled"), (3, 8.0, "fallback"), (9, 0, "primary")]


def test_third_class_and_unknown_classes(spark):
    votes = "key int, votes array<struct<model:string,prediction:int,probabilities:array<double>>>"
    df = spark.createDataFrame([(1, [("a", 2, [0.1, 0.15, 0.75]), ("b", 2, None)])], votes)
    got = ensemble.combine(df, "weighted_average").first()
    assert got.prediction == 2 and abs(got.confidence - 0.875) < 1e-9
    with pytest.raises(Exception, match="no predictions"):
        ensemble.combine(spark.createDataFrame([(1, [])], votes), "majority_vote").collect()
    rows = spark.createDataFrame([(1, "x", 0, [1.0])], "i int, model string, prediction int, probabilities array<double>")
    with pytest.raises(Exception, match="not in the list"):
        ensemble.votes_from_rows(rows, "i", ["a"]).collect()
    scored = spark.createDataFrame([(0, 0, 0.1), (1, 2, 0.9), (2, 1, 0.5)], "y int, pred int, p1 double")
    for metric in (evaluation.class_report, evaluation.confusion_matrix):
        with pytest.raises(Exception, match="not in the list"):
            metric(scored, [0, 1]).collect()
        assert metric(scored, [0, 1, 2]).count() > 0
    assert evaluation.roc_auc(scored).first().auc == 0.0


def test_search_on_awkward_rows(spark):
    df = spark.createDataFrame([("t-1", 0.5), ("t-2", float("nan")), ("t-10", 0.5), ("t-3", None)], "trial string, accuracy double")
    assert search.best_trial(df, [], "accuracy").first().trial == "t-1"
    lines = spark.createDataFrame([("t", "loss=1.5e-05 lr = +1e-3"), ("t", "acc=.5")], "trial string, line string")
    assert sorted((r.name, r.value) for r in search.parse_metric_lines(lines, "line").collect()) == [("acc", 0.5), ("loss", 1.5e-05), ("lr", 0.001)]
    metrics = spark.createDataFrame([("a", 2, "m", 1.0), ("b", None, "m", 2.0)], "trial string, step int, name string, value double")
    assert {r.trial: r.stop_step for r in search.median_stop(metrics).collect()} == {"a": None, "b": None}
    assert {r.trial: r.latest for r in search.latest_metrics(metrics).collect()} == {"a": 1.0, "b": 2.0}


def test_labels_with_a_common_beginning(spark):
    df = spark.createDataFrame([(f"label-{i:03d}",) for i in range(300)] + [(None,)], "c string")
    codes = {r.c: r.c_code for r in features.label_encode(df, "c").collect()}
    assert codes[None] is None and [codes[f"label-{i:03d}"] for i in range(300)] == list(range(300))
