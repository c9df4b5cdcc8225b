"""Experiment tables: search spaces, trials, stop rules, best trial."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import seeded_uniform
from millrace.functions.quantiles import exact_quantiles
from millrace.functions.selection import top_share
from millrace.session import materialize


@dataclass(frozen=True)
class Param:
    """One search parameter; bounds are inclusive, `step` is needed for grids."""

    name: str
    kind: str
    low: float = 0
    high: float = 0
    step: float = 1
    values: tuple = field(default_factory=tuple)

    def grid_size(self) -> int:
        if self.kind == "categorical":
            return len(self.values)
        return math.floor((self.high - self.low) / self.step + 1e-9) + 1

    def grid_value(self, index: Column) -> Column:
        if self.kind == "categorical":
            return F.get(F.array(*[F.lit(v) for v in self.values]), index.cast("int"))
        if self.kind == "int":
            return F.lit(int(self.low)) + F.lit(int(self.step)) * index
        return F.round(F.lit(float(self.low)) + F.lit(float(self.step)) * index, 6)

    def random_value(self, uniform: Column) -> Column:
        if self.kind == "categorical":
            return F.get(F.array(*[F.lit(v) for v in self.values]), F.floor(uniform * len(self.values)).cast("int"))
        if self.kind == "int":
            return F.floor(uniform * (int(self.high) - int(self.low) + 1)) + int(self.low)
        return F.lit(float(self.low)) + uniform * (float(self.high) - float(self.low))


# The two search spaces of the experiments.
RANDOM_SPACE = [
    Param("n_estimators", "int", 50, 300),
    Param("max_depth", "int", 3, 20),
    Param("min_samples_split", "int", 2, 20),
    Param("min_samples_leaf", "int", 1, 10),
    Param("max_features_ratio", "double", 0.1, 1.0),
    Param("criterion", "categorical", values=("gini", "entropy", "log_loss")),
    Param("bootstrap", "categorical", values=("true", "false")),
]
GRID_SPACE = [
    Param("n_estimators", "int", 50, 200, 50),
    Param("max_depth", "int", 5, 20, 5),
    Param("min_samples_split", "int", 2, 10, 4),
    Param("max_features_ratio", "double", 0.3, 0.9, 0.3),
    Param("criterion", "categorical", values=("gini", "entropy")),
]


def grid_size(space: Sequence[Param]) -> int:
    return math.prod(p.grid_size() for p in space)


def with_grid_point(df: DataFrame, index: Column, space: Sequence[Param]) -> DataFrame:
    """Add the parameters of grid point `index`, the last parameter varying fastest. The
    index is decoded digit by digit, so the product of the value lists is never joined."""
    columns, stride = {}, grid_size(space)
    for p in space:
        stride //= p.grid_size()
        columns[p.name] = p.grid_value(F.floor(index / stride) % p.grid_size())
    return df.withColumns(columns)


def grid_space(spark: SparkSession, space: Sequence[Param], max_trials: int | None = None) -> DataFrame:
    """All grid points, at most `max_trials` of them."""
    size = grid_size(space)
    return with_grid_point(spark.range(min(size, max_trials or size)).withColumnRenamed("id", "trial"), F.col("trial"), space)


def random_space(trials: DataFrame, key: str, space: Sequence[Param], seed: int = 42) -> DataFrame:
    """Add one random assignment per trial, a pure function of the trial key and the seed."""
    return trials.withColumns({p.name: p.random_value(seeded_uniform(key, f"{seed}/{p.name}")) for p in space})


def assignments(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Wide parameters as rows (key, name, value), values as text."""
    cells = [F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in names]
    return df.select(key, F.inline(F.array(*cells)))


def halving_schedule(max_resource: int, min_resource: int = 1, eta: int = 3) -> list[dict]:
    """Brackets and rungs: configurations kept and resource given at each rung."""
    levels = 0
    while min_resource * eta ** (levels + 1) <= max_resource:
        levels += 1
    rows = []
    for bracket in range(levels, -1, -1):
        n = math.ceil((levels + 1) / (bracket + 1) * eta**bracket)
        for rung in range(bracket + 1):
            rows.append(
                {
                    "bracket": bracket,
                    "rung": rung,
                    "configurations": n // eta**rung,
                    "resource": max_resource * eta**rung // eta**bracket,
                }
            )
    return rows


def halving_rungs(metrics: DataFrame, eta: int = 3, trial: str = "trial", rung: str = "step", value: str = "value", maximize: bool = True) -> DataFrame:
    """Flag the best floor(n / eta) trials of each rung, which go on to the next. The metrics
    are read several times: pass a stored table."""
    return top_share(metrics, trial, [rung], value, eta, maximize, "promoted")


def deal_brackets(trials: DataFrame, schedule: Sequence[dict], rank: str = "rank") -> DataFrame:
    """Add `round` and `bracket`: trials in the order of `rank` (from 0) fill the brackets of a
    schedule one after another, then those of the next round."""
    starts, total = [], 0
    for step in schedule:
        if step["rung"] == 0:
            starts.append((total, step["bracket"]))
            total += step["configurations"]
    place = F.col(rank) % total
    bracket = F.lit(starts[0][1])
    for at, number in starts[1:]:
        bracket = F.when(place >= at, number).otherwise(bracket)
    return trials.withColumns({"round": F.floor(F.col(rank) / total), "bracket": bracket})


def halving_brackets(trials: DataFrame, metrics: DataFrame, schedule: Sequence[dict], eta: int = 3, trial: str = "trial", step: str = "step", value: str = "value", maximize: bool = True) -> DataFrame:
    """Iterated elimination: round, bracket, rung, resource, trial, value and promoted of every
    trial that is alive at a rung. `trials` holds round, bracket and trial, `metrics` a value per
    trial and step (the resource). A rung ranks only what the rung before kept: the best
    floor(alive / eta) with a value, the smaller trial on ties. Null and NaN values, and trials
    that never reached the resource, are alive but not promoted; the last rung promotes none.

    One stored table per rung, as many as the schedule's longest bracket."""
    number = F.col(value).cast("double")
    valid = F.when(~F.isnan(number), -number if maximize else number)
    reached = metrics.groupBy(F.col(trial).alias("trial"), F.col(step).alias("resource")).agg(F.max(F.struct(valid.isNotNull(), -valid, number.alias("value")))["value"].alias("value"))
    reached = materialize(reached, "metrics")
    alive, rungs = trials.select("round", "bracket", F.col(trial).alias("trial")), []
    last = {s["bracket"]: max(t["rung"] for t in schedule if t["bracket"] == s["bracket"]) for s in schedule}
    for rung in range(max(last.values()) + 1):
        steps = [s for s in schedule if s["rung"] == rung]
        resource = F.create_map(*(F.lit(v) for s in steps for v in (s["bracket"], s["resource"])))[F.col("bracket")]
        ends = F.col("bracket").isin([b for b, r in last.items() if r == rung])
        here = alive.withColumn("resource", resource.cast("long")).withColumnRenamed("trial", "own")
        met = here.join(reached, (F.col("own") == F.col("trial")) & (here["resource"] == reached["resource"]), "left").select("round", "bracket", here["resource"], F.col("own").alias("trial"), "value")
        signed = F.when(~F.isnan("value"), -F.col("value") if maximize else F.col("value"))
        group = Window.partitionBy("round", "bracket")
        place = F.row_number().over(group.orderBy(signed.asc_nulls_last(), "trial"))
        kept = signed.isNotNull() & (place <= F.floor(F.count("*").over(group) / eta)) & ~ends
        ranked = met.select("round", "bracket", F.lit(rung).alias("rung"), "resource", "trial", "value", kept.alias("promoted"))
        rungs.append(materialize(ranked, "rung"))
        alive = rungs[-1].where("promoted").select("round", "bracket", "trial")
    return reduce(DataFrame.union, rungs)


def median_stop(
    metrics: DataFrame,
    start_step: int = 2,
    min_trials: int = 3,
    trial: str = "trial",
    step: str = "step",
    value: str = "value",
    maximize: bool = True,
) -> DataFrame:
    """First step at which each trial is worse than the median of that step, null when it
    is never stopped. Rows without a step or a value stop nothing, but their trial stays."""
    medians = exact_quantiles(metrics, [step], value, {"median": 0.5})
    sizes = metrics.groupBy(step).agg(F.count("*").alias("__trials"))
    rows = metrics.join(medians, step, "left").join(sizes, step, "left")
    worse = F.col(value) < F.col("median") if maximize else F.col(value) > F.col("median")
    stopped = worse & (F.col(step) >= start_step) & (F.col("__trials") >= min_trials)
    return rows.groupBy(trial).agg(F.min(F.when(stopped, F.col(step))).alias("stop_step"))


def latest_metrics(metrics: DataFrame, trial: str = "trial", name: str = "name", value: str = "value", step: str = "step", line: str | None = None) -> DataFrame:
    """The value of the last step; lines without a step come before any step. Of several lines of
    one step that with the largest `line` (its place in the log) counts, and without such a
    column, or on equal places, that with the largest value (NaN over numbers, null last)."""
    order = [F.coalesce(F.col(step), F.lit(-1)), *([F.col(line)] if line else []), F.col(value)]
    return metrics.groupBy(trial, name).agg(F.max_by(value, F.struct(*order)).alias("latest"), F.max(step).alias("last_step"))


def best_trial(trials: DataFrame, groups: Sequence[str], objective: str, trial: str = "trial", maximize: bool = True) -> DataFrame:
    """The trial with the best objective per group, the smallest trial on ties, with all its
    columns. Trials may be named by text or number; null and NaN objectives never win. One
    aggregate of the smallest (objective, trial): no group is sorted."""
    record = F.struct(*[c for c in trials.columns if c not in groups])
    signed = -F.col(objective) if maximize else F.col(objective)
    rank = F.struct(signed.alias("o"), F.col(trial).alias("t"))
    scored = trials.where(F.col(objective).isNotNull() & ~F.isnan(F.col(objective).cast("double")))
    return scored.groupBy(*groups).agg(F.min_by(record, rank).alias("r")).select(*groups, "r.*")


def trial_progress(trials: DataFrame, experiment: str, max_trials: int, status: str = "status") -> DataFrame:
    """Trials per state and the whole percentage that is finished."""
    done = F.count_if(F.col(status).isin("Succeeded", "Failed"))
    return trials.groupBy(experiment).agg(
        *[F.count_if(F.col(status) == s).alias(s.lower()) for s in ("Succeeded", "Failed", "Running", "Pending")],
        F.floor(done * 100 / max_trials).alias("progress"),
    )


def experiment_status(
    trials: DataFrame, experiment: str, objective: str, goal: float, max_trials: int, max_failed: int, maximize: bool = True
) -> DataFrame:
    """Which stop rule holds for each experiment and the resulting state."""
    best = F.max(objective) if maximize else F.min(objective)
    flags = trials.groupBy(experiment).agg(
        best.alias("best"),
        F.count_if(F.col("status").isin("Succeeded", "Failed")).alias("finished"),
        F.count_if(F.col("status") == "Failed").alias("failed"),
    )
    reached = F.col("best") >= goal if maximize else F.col("best") <= goal
    return flags.withColumns(
        {
            "goal_reached": F.coalesce(reached, F.lit(False)),
            "max_trials_reached": F.col("finished") >= max_trials,
            "max_failures_reached": F.col("failed") > max_failed,
        }
    ).withColumn(
        "state",
        F.when(F.col("max_failures_reached"), "Failed")
        .when(F.col("goal_reached") | F.col("max_trials_reached"), "Succeeded")
        .otherwise("Running"),
    )


def cleanup_candidates(experiments: DataFrame, which: str, state: str = "state") -> DataFrame:
    """Experiments a cleanup would remove: 'all', 'completed' or 'failed'."""
    wanted = {"all": None, "completed": "Succeeded", "failed": "Failed"}
    if which not in wanted:
        raise ValueError(f"unknown filter: {which}")
    return experiments if wanted[which] is None else experiments.where(F.col(state) == wanted[which])


def recent_trials(trials: DataFrame, n: int = 8, created: str = "created", trial: str = "trial") -> DataFrame:
    return trials.orderBy(F.col(created).desc(), F.col(trial)).limit(n)


def _pairs(names: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.col(n.replace("-", "_")).cast("string").alias("value")) for n in names])


def render_params(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The parameters (dashed names) as JSON, shell exports, YAML lines and options."""
    pairs = _pairs(names)

    def lines(make, sep: str) -> Column:
        return F.array_join(F.transform(pairs, make), sep)

    return df.withColumns(
        {
            "as_json": F.to_json(F.map_from_entries(pairs)),
            "as_env": lines(
                lambda p: F.concat(F.lit("export "), F.upper(F.replace(p["name"], F.lit("-"), F.lit("_"))), F.lit('="'), p["value"], F.lit('"')),
                "\n",
            ),
            "as_yaml": lines(lambda p: F.concat(F.lit("  "), p["name"], F.lit(": "), p["value"]), "\n"),
            "as_cli": lines(lambda p: F.concat(F.lit("--"), p["name"], F.lit("="), p["value"]), " "),
        }
    )


def camel_case(name: str) -> str:
    head, *rest = name.split("-")
    return head + "".join(part.capitalize() for part in rest)


def render_template(df: DataFrame, template: str, names: Sequence[str], out: str = "command") -> DataFrame:
    """Fill ${trialParameters.camelName} in a command template with each row's values."""
    text = F.lit(template)
    for name in names:
        marker = F.lit("${trialParameters." + camel_case(name) + "}")
        text = F.replace(text, marker, F.col(name.replace("-", "_")).cast("string"))
    return df.withColumn(out, text)


# Patterns of the metric log lines.
PAIR_PATTERN = r"([\w|-]+)\s*=\s*([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)"
STEP_PATTERN = r"epoch\s*=\s*(\d+)"


def parse_metric_lines(lines: DataFrame, line: str, keep: Sequence[str] = (), pattern: str = PAIR_PATTERN) -> DataFrame:
    """Rows (keep..., step, name, value) from `name=value` and `epoch=N name=value` lines."""
    text = F.col(line)
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), 1).alias("name"), F.regexp_extract_all(text, F.lit(pattern), 2).alias("value")
    )
    step = F.regexp_extract(text, STEP_PATTERN, 1)
    rows = lines.select(*keep, F.when(step != "", step).try_cast("int").alias("step"), F.explode(pairs).alias("p"))
    return rows.select(*keep, "step", F.col("p.name").alias("name"), F.col("p.value").try_cast("double").alias("value")).where(
        F.col("name") != "epoch"
    )


def with_failed_objective(metrics: DataFrame, failed: DataFrame, objective: str, trial: str = "trial") -> DataFrame:
    """Add an objective of 0.0 for every failed trial."""
    rows = failed.select(trial, F.lit(None).cast("int").alias("step"), F.lit(objective).alias("name"), F.lit(0.0).alias("value"))
    return metrics.unionByName(rows)


def metric_lines(metrics: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Log lines in the format the parser reads."""
    text = F.concat(
        F.when(F.col("step").isNotNull(), F.format_string("epoch=%d ", F.col("step"))).otherwise(""),
        F.col("name"),
        F.format_string("=%.6f", F.col("value")),
    )
    return metrics.select(*keep, text.alias("line"))
