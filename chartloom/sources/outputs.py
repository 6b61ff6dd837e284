"""Harmonised tables on storage, by name and version.

A table is written to a new folder of its own; readers find it through the release's log, a Parquet table with one row per published
table. Publishing appends one file to the log, for all tables of a build at once, so readers see the whole build or none of it, and a
build that fails or is killed leaves what was published before readable. One build of a release publishes at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chartloom.operators.quality import TableRules, observed_rules, report_of
from chartloom.sources.catalog import delete_path, path_exists

LOG = "table string, path string, build bigint, published_at timestamp"


@dataclass(frozen=True)
class OutputStore:
    """Folder layout ``<root>/<name or release-version>/<table>/<part>``, and ``_log`` beside the tables."""

    root: str
    version: str = "2.1"
    name: str = ""

    @property
    def release(self) -> str:
        return f"{self.root}/{self.name or 'release-' + self.version}"

    @property
    def log(self) -> str:
        return f"{self.release}/_log"


@dataclass(frozen=True)
class Staged:
    """A table that is written but not published: what was checked while it was written is in ``report``."""

    table: str
    path: str
    rows: int | None
    report: Sequence[tuple]


def stage_output(
    df: DataFrame, store: OutputStore, table: str, cluster_by: str | None = None, partitions: int | None = None,
    rules: TableRules | None = None,
) -> Staged:
    """Write a table as part files of a new folder.

    ``cluster_by`` range-partitions and sorts by that column, so later reads of one encounter skip most row groups; equal keys may
    span files, so a hot key is not one task. With ``rules`` the rows are counted and checked in the tasks that write them (after
    the last shuffle, which is where each row passes once), so nothing is read a second time.
    """
    if cluster_by:
        keys = [F.col(cluster_by), *[F.col(c) for c in df.columns if c.endswith("_dttm")][:1]]
        df = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
        df = df.sortWithinPartitions(*keys)
    path = f"{store.release}/{table}/{uuid.uuid4().hex}"
    if rules is None:
        df.write.parquet(path)
        return Staged(table, path, None, ())
    seen, metrics = Observation(), observed_rules(df, rules)
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c for m in metrics for c in m.columns()]).write.parquet(path)
    found = seen.get
    return Staged(table, path, found["rows"], report_of(df, table, rules, metrics, found))


def published(spark: SparkSession, store: OutputStore) -> DataFrame:
    """The log: every table ever published, with the number of its build."""
    return spark.read.schema(LOG).parquet(store.log) if path_exists(spark, store.log) else spark.createDataFrame([], LOG)


def publish(spark: SparkSession, store: OutputStore, staged: Sequence[Staged]) -> int:
    """Make staged tables the current ones, all in one step; returns the build's number."""
    last = published(spark, store).agg(F.max("build")).first()[0] or 0
    rows = spark.createDataFrame([(s.table, s.path, last + 1) for s in staged], "table string, path string, build bigint")
    rows.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(store.log)
    return last + 1


def write_output(
    df: DataFrame, store: OutputStore, table: str, cluster_by: str | None = None, partitions: int | None = None
) -> str:
    """Write and publish one table; returns its folder."""
    staged = stage_output(df, store, table, cluster_by, partitions)
    publish(df.sparkSession, store, [staged])
    return staged.path


def output_path(spark: SparkSession, store: OutputStore, table: str, build: int | None = None) -> str:
    """The folder of the current table, or of the table as of a build."""
    log = published(spark, store).filter(F.col("table") == table)
    row = (log if build is None else log.filter(F.col("build") <= build)).orderBy(F.desc("build")).first()
    if row is None:
        raise FileNotFoundError(f"{table} is not published in {store.release}")
    return row["path"]


def read_output(spark: SparkSession, store: OutputStore, table: str, build: int | None = None) -> DataFrame:
    return spark.read.parquet(output_path(spark, store, table, build))


def expire(spark: SparkSession, store: OutputStore, table: str, keep: int = 1) -> list[str]:
    """Delete the folders of all but the ``keep`` last published versions of a table; returns them. Earlier builds lose it."""
    rows = published(spark, store).filter(F.col("table") == table).orderBy(F.desc("build")).select("path").collect()
    kept = list(dict.fromkeys(r["path"] for r in rows))[:keep]
    gone = [p for p in dict.fromkeys(r["path"] for r in rows) if p not in kept]
    for path in gone:
        delete_path(spark, path)
    return gone
