"""Bucketed helpers against plain Python, with a hot group, ties and narrow buckets."""

import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from millrace.functions.prefix import id_order_bucket, prefix_sums, rank_in_group
from millrace.functions.quantiles import exact_quantiles
from millrace.functions.selection import edge_rows, top_share
from millrace.operators import evaluation, explain, splits
from millrace.sources.published import WRITERS, positioned, publish, published
from millrace.streaming.keyed import OpenFailures


@pytest.fixture(scope="module")
def skewed(spark):
    """2000 rows; group 0 holds more than a third, values repeat often."""
    rng = random.Random(7)
    rows = [(i, 0 if rng.random() < 0.4 else rng.randrange(1, 6), float(rng.randrange(-30, 30))) for i in range(2000)]
    return rows, spark.createDataFrame(rows, "id long, g int, v double").repartition(6)


def grouped(rows):
    out = defaultdict(list)
    for row in sorted(rows):
        out[row[1]].append(row)
    return out


def test_prefix_sums_and_ranks(skewed):
    rows, df = skewed
    got = {
        r.id: (r.s_before, r.s_total)
        for r in prefix_sums(df, ["g"], [F.col("id")], id_order_bucket(F.col("id"), 64), {"s": F.col("v")}, totals=True).collect()
    }
    ranks = {r.id: r["rank"] for r in rank_in_group(df, ["g"], [F.col("id")], id_order_bucket(F.col("id"), 64)).collect()}
    for members in grouped(rows).values():
        total, before = sum(m[2] for m in members), 0.0
        for position, (i, _, v) in enumerate(members):
            assert got[i] == (before, total)
            assert ranks[i] == position
            before += v


def test_prefix_sums_with_null_key(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1)], "id long, g int")
    ranks = {r.id: r["rank"] for r in rank_in_group(df, ["g"], [F.col("id")], id_order_bucket(F.col("id"), 1)).collect()}
    assert ranks == {1: 0, 2: 1, 3: 0}


@pytest.mark.parametrize("buckets", [2, 16, 500])
def test_exact_quantiles(skewed, buckets):
    rows, df = skewed
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, buckets).collect()}
    for g, members in grouped(rows).items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.percentile([m[2] for m in members], p * 100), abs=1e-9)


def test_exact_quantiles_global_nulls_and_constant(spark):
    df = spark.createDataFrame([(None,), (5.0,), (5.0,)], "v double")
    assert exact_quantiles(df, [], "v", {"m": 0.5}).collect()[0].m == 5.0
    assert exact_quantiles(df.where("v is null"), [], "v", {"m": 0.5}).collect()[0].m is None
    assert exact_quantiles(df.where("v is null").withColumn("g", F.lit(1)), ["g"], "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("latest", [True, False])
@pytest.mark.parametrize("width", [8, 65536])
def test_edge_rows(skewed, latest, width):
    rows, df = skewed
    got = defaultdict(list)
    for r in edge_rows(df, ["g"], "id", 25, latest, width).collect():
        got[r.g].append(r.id)
    for g, members in grouped(rows).items():
        ids = [m[0] for m in members]
        assert sorted(got[g]) == (ids[-25:] if latest else ids[:25])
    whole = sorted(r.id for r in edge_rows(df, [], "id", 25, latest, width).collect())
    assert whole == (list(range(1975, 2000)) if latest else list(range(25)))


@pytest.mark.parametrize("maximize", [True, False])
def test_top_share_counts_and_order(skewed, maximize):
    rows, df = skewed
    out = top_share(df, "id", ["g"], "v", 3, maximize).collect()
    assert len(out) == len(rows)
    by_group = defaultdict(list)
    for r in out:
        by_group[r.g].append(r)
    for members in by_group.values():
        kept, rest = [m.v for m in members if m.kept], [m.v for m in members if not m.kept]
        assert len(kept) == len(members) // 3
        assert (min(kept) >= max(rest)) if maximize else (max(kept) <= min(rest))


def brute_auc(pairs):
    pos, neg = [s for y, s in pairs if y == 1], [s for y, s in pairs if y != 1]
    if not pos or not neg:
        return 0.0
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [2, 40])
def test_auc_with_ties_and_one_class(spark, buckets):
    rng = random.Random(3)
    rows = [(m, int(rng.random() < 0.3), rng.randrange(12) / 12) for m in "ab" for _ in range(300)]
    rows += [("c", 1, 0.4), ("c", 1, 0.6)]
    df = spark.createDataFrame(rows, "m string, y int, p1 double")
    got = {r.m: r.auc for r in evaluation.roc_auc(df, ["m"], buckets=buckets).collect()}
    for m in "abc":
        assert got[m] == pytest.approx(brute_auc([(y, s) for k, y, s in rows if k == m]), abs=1e-12)


def test_stratified_split_sizes_and_stability(spark):
    df = spark.range(5000).withColumn("y", (F.col("id") % 17 == 0).cast("int"))
    first = splits.stratified_split(df, ["id"], "y")
    again = splits.stratified_split(df.repartition(7), ["id"], "y")
    counts = {(r.y, r.split): r["count"] for r in first.groupBy("y", "split").count().collect()}
    sizes = {r.y: r["count"] for r in df.groupBy("y").count().collect()}
    for y, n in sizes.items():
        assert counts[(y, "test")] == round(0.2 * n)
        assert counts[(y, "train")] == n - round(0.2 * n)
    assert first.exceptAll(again).count() == 0


def test_folds_are_balanced(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    sizes = defaultdict(list)
    for r in splits.stratified_folds(df, ["id"], "y", 5).groupBy("y", "fold").count().collect():
        sizes[r.y].append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())


def test_exact_sample_size(spark):
    out = splits.exact_sample(spark.range(2001), ["id"], 0.05)
    assert out.where("sampled").count() == 100


def test_one_third_hot_key_is_not_one_task(spark):
    """Rows of a hot class are ranked in many window partitions."""
    df = spark.range(40000).withColumn("y", F.lit(1))
    ranked = splits.hash_rank(df, ["id"], ["y"])
    assert ranked.agg(F.countDistinct("rank"), F.min("rank"), F.max("rank")).first() == (40000, 0, 39999)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "__bucket" in plan


def test_positions_need_no_shuffle_of_rows(spark, tmp_path):
    """All rows of a file would meet in one task."""
    path = str(tmp_path / "rows")
    spark.range(40).coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = positioned(spark.read.parquet(path))
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.id, r.position) for r in got.collect()) == [(i, i) for i in range(40)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_explanations_are_published_unsorted_with_one_key_each(spark, tmp_path, monkeypatch):
    """More partitions than files a task keeps open are written right too."""
    seen, write, before = [], DataFrameWriter.parquet, spark.conf.get(WRITERS)

    def parquet(self, *args, **kwargs):
        seen.append(spark.conf.get(WRITERS))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    rows = spark.createDataFrame([(i, float(i), None if i == 3 else 2.0) for i in range(60)], "key long, a double, b double").coalesce(1)
    scored = explain.linear_contributions(rows, {"a": 2.0, "b": 1.0})
    stored = explain.stored_rows(scored, "key", "v").withColumn("model_version", F.concat(F.lit("v"), F.col("key") % 9))
    publish(stored, f"{tmp_path}/cells", ["model_version"])
    assert int(seen[0]) > 0 and spark.conf.get(WRITERS) == before and stored.count() == 60
    got = explain.stored_cells(published(spark, f"{tmp_path}/cells", stored.schema), "key").collect()
    want = [(f"v{i % 9}", i, f, v, c) for i in range(60) for f, v, c in (("a", float(i), 2 * (i - 29.5)), ("b", None if i == 3 else 2.0, None if i == 3 else 0.0))]
    assert sorted((r.model_version, r.key, r.feature, r.value, r.contribution) for r in got if r.key != 3) == sorted(w for w in want if w[1] != 3)
    assert sorted(((r.feature, r.value, r.contribution) for r in got if r.key == 3), key=str) == sorted((w[2:] for w in want if w[1] == 3), key=str)


def test_failures_of_many_keys_are_combined_at_once():
    rows = [(k, o, 1) for k in "abc" for o in (5, 1, 9)] + [("a", 6, 0), ("b", 9, 0), ("d", 2, 0), ("e", 0, 1)]
    batch = pd.DataFrame([(f"={k}", -1 if e else o, e, o if e else -1) for k, o, e in rows], columns=["k0", "success", "failures", "failed"])
    got = OpenFailures().combine(batch, ["k0"])
    assert {r.k0: (r.success, r.failures, list(r.failed)) for r in got.itertuples()} == {"=a": (6, 3, [9]), "=b": (9, 3, []), "=c": (-1, 3, [5, 1, 9]), "=d": (2, 0, []), "=e": (-1, 1, [0])}
    assert len(OpenFailures().combine(batch[:0], ["k0"])) == 0
