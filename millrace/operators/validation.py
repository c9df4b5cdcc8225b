"""Instance checks, row rules, value migration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import lookup

NUMERIC_VARIANT = "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
MAX_NAMES = 5


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _is_number(value: Column) -> Column:
    return _kind(value).rlike(NUMERIC_VARIANT)


def _first_names(names: Column) -> Column:
    return F.array_join(F.slice(names, 1, MAX_NAMES), ", ")


def validate_instances(df: DataFrame, instance: str, feature_names: Sequence[str]) -> DataFrame:
    """Check one JSON instance per row, an object or a list. Adds `is_valid` and `error`,
    the first failed check; booleans do not count as numbers."""
    parsed = df.withColumn("__v", F.try_parse_json(instance))
    parsed = parsed.withColumns(
        {
            "__list": F.try_variant_get("__v", "$", "array<variant>"),
            "__map": F.try_variant_get("__v", "$", "map<string,variant>"),
        }
    )
    names = F.array(*[F.lit(n) for n in feature_names])
    missing = F.filter(names, lambda n: ~F.map_contains_key("__map", n))
    nulls = F.map_keys(F.map_filter("__map", lambda k, v: _kind(v) == "VOID"))
    odd = F.filter(names, lambda n: ~_is_number(F.try_element_at("__map", n)))
    expected = len(feature_names)
    object_error = (
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing features: "), _first_names(missing)))
        .when(F.size(nulls) > 0, F.concat(F.lit("Null values in features: "), _first_names(nulls)))
        .when(F.size(odd) > 0, F.concat(F.lit("Invalid type for feature "), F.get(odd, 0), F.lit(": expected number")))
    )
    list_error = F.when(
        F.size("__list") != expected, F.format_string(f"Expected {expected} features, got %d", F.size("__list"))
    ).when(F.exists("__list", lambda x: ~_is_number(x)), "All features must be numbers")
    error = (
        F.when(F.col("__map").isNotNull(), object_error)
        .when(F.col("__list").isNotNull(), list_error)
        .otherwise("Invalid input type: expected dict or list")
    )
    return (
        parsed.withColumn("error", F.coalesce(error, F.lit("")))
        .withColumn("is_valid", F.col("error") == "")
        .withColumn("n_features", F.coalesce(F.size("__map"), F.size("__list"), F.lit(0)))
        .drop("__v", "__list", "__map")
    )


def shape_check(features: Column, expected: int) -> Column:
    """Null when the feature count fits, else the error text."""
    return F.when(F.size(features) != expected, F.format_string(f"Expected {expected} features, got %d", F.size(features)))


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column
    message: Column


def in_range(name: str, column: str, low: float, high: float) -> Rule:
    text = F.format_string(f"{name} must be {low}-{high}, got %.2f", F.col(column))
    return Rule(name, F.col(column).between(low, high), text)


def one_of(name: str, column: str, allowed: Sequence[str]) -> Rule:
    text = F.concat(F.lit(f"{name} must be {'/'.join(allowed)}, got '"), F.col(column), F.lit("'"))
    return Rule(name, F.col(column).isin(*allowed), text)


def at_least(name: str, column: str, low: float) -> Rule:
    text = F.format_string(f"{name} must be at least {low}, got %.2f", F.col(column))
    return Rule(name, F.col(column) >= low, text)


def apply_rules(df: DataFrame, rules: Sequence[Rule], strict: bool = False) -> DataFrame:
    """Collect every violation of each row. Lenient mode tags the rows; strict mode makes
    the job fail on the first row with a violation."""
    found = F.array_compact(F.array(*[F.when(~F.coalesce(r.holds, F.lit(False)), r.message) for r in rules]))
    out = df.withColumn("violations", found)
    text = F.array_join("violations", "; ")
    if strict:
        failed = F.raise_error(F.concat(F.lit("Validation failed: "), text)).cast("string")
        status = F.when(F.size("violations") > 0, failed).otherwise("PASSED")
    else:
        status = F.when(F.size("violations") > 0, "WARNING").otherwise("PASSED")
    return out.withColumns({"violation_text": text, "violation_count": F.size("violations"), "validation_status": status})


def migrate_values(df: DataFrame, column: str, mapping: Mapping[str, str], name: str | None = None) -> DataFrame:
    """Replace legacy values, keep the others."""
    return df.withColumn(name or column, F.coalesce(lookup(mapping, F.col(column)), F.col(column)))


def migrate_columns(df: DataFrame, renamed: Mapping[str, str]) -> DataFrame:
    """Rename legacy columns, unless the new name already exists."""
    return df.withColumnsRenamed({old: new for old, new in renamed.items() if old in df.columns and new not in df.columns})


def record_rows(df: DataFrame, key: Sequence[str], columns: Sequence[str], status: str, environment: str) -> DataFrame:
    """A wide record as (parameter, value, validation_status, environment) rows."""
    text = df.select(*key, *[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot(list(key), list(columns), "parameter", "value")
    return long.withColumns({"validation_status": F.lit(status), "environment": F.lit(environment)})
