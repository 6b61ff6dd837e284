"""Registry of runnable queries and the plain SQL each one is checked against.

A query binds an operator to the benchmark tables. ``derive`` runs SELECT text that both engines
accept, to shape those tables like event tables; the operator's own SQL is written separately.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.session import ensure_defaults
from chartloom.sources.vocabulary import vocabulary

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


class Tables:
    """The benchmark tables of one folder, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = ensure_defaults(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def derive(self, select: str) -> DataFrame:
        words = set(re.findall(r"\w+", select))
        for name in TABLES:
            if name in words:
                getattr(self, name).createOrReplaceTempView(name)
        return self.spark.sql(select)


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(lambda t: plain(fn(t)), sql)
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Wall-clock timestamps and doubles, so results compare independent of session settings."""

    def col(f: T.StructField):
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.FloatType):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        return F.col(f"`{f.name}`")

    return df.select(*[col(f) for f in df.schema])


class Vocabulary:
    """A small literal dimension, as DataFrame and as SQL."""

    def __init__(self, schema: str, rows: Sequence[Sequence]):
        self.schema, self.rows = schema, rows

    def df(self, t: Tables) -> DataFrame:
        return vocabulary(t.spark, self.schema, self.rows)

    @property
    def sql(self) -> str:
        fields = [f.split() for f in self.schema.split(",")] + [["_ordinal", "bigint"]]

        def lit(v) -> str:
            return "NULL" if v is None else str(v) if not isinstance(v, str) else "'" + v.replace("'", "''") + "'"

        selects = [
            "SELECT " + ", ".join(f"CAST({lit(v)} AS {t}) AS {n}" for (n, t), v in zip(fields, [*row, i]))
            for i, row in enumerate(self.rows)
        ]
        return " UNION ALL ".join(selects)


def with_ctes(body: str, **ctes: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({text})" for name, text in ctes.items()) + " " + body
