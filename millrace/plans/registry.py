"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Build], Build]:
    """Register a query; `views` names the fixture views its SQL reads."""

    def register(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        text = None
        if sql is not None:
            from millrace.plans.fixtures import with_views

            text = with_views(views, sql)
        REGISTRY[name] = Query(name, build, text)
        return build

    return register
