"""Registry of queries: a Spark plan and, where SQL can say it, the same result in SQL.

Queries run on views that are composed from the given tables. The view texts are written in
SQL that both engines read; ``with_views`` puts the ones a text names in front of it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


class Inputs:
    """Tables of one scale folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")

    def sql(self, text: str) -> DataFrame:
        whole = with_views(text)
        for name in TABLES:
            if re.search(rf"\b{name}\b", whole):
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(whole)


def with_views(text: str, kept: str = "") -> str:
    """``text`` behind the definitions of all views it names, in dependency order.

    ``kept`` is what the other engine writes before views that are worked out once (those that
    start with ox); without it, a view is worked out wherever it is named.
    """
    ordered: list[str] = []

    def visit(body: str) -> None:
        for name in re.findall(r"\b(?:fx|ox)_\w+\b", body):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(text)
    if not ordered:
        return text
    recursive = ""
    body = text.strip()
    own = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    if own:
        recursive = "RECURSIVE " if own.group(1) else ""
        body = ", " + body[own.end():]
    definitions = ", ".join(f"{name} AS {kept if name.startswith('ox_') else ''}({VIEWS[name]})" for name in ordered)
    return f"WITH {recursive}{definitions} {body}"


def query(name: str, sql: str | None = None):
    """Register a plan that takes ``Inputs``."""

    def register(plan: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: plan(Inputs(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register
