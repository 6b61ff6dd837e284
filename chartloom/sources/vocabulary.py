"""Vocabulary files: mapping CSVs and permissible-value lists."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_mapping(
    spark: SparkSession,
    path: str,
    *,
    columns: str | None = None,
    types: Mapping[str, str] | None = None,
    strip_prefix: str | None = None,
) -> DataFrame:
    """Read a vocabulary CSV as text, with ``_ordinal`` giving the row order.

    ``columns`` keeps the columns whose name contains a match of the regex; ``types`` casts some
    columns (by their name in the file); ``strip_prefix`` removes a regex prefix from column names. Repeated column names
    get a position suffix (Spark's default), so spreadsheet leftovers are harmless.
    """
    df = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        .option("encoding", "UTF-8").csv(path)
    )
    df = df.toDF(*[c.lstrip("\ufeff") for c in df.columns])
    keep = [c for c in df.columns if columns is None or re.search(columns, c)]
    out = df.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("_ordinal"))
    for c, t in (types or {}).items():
        # ids written as "123.0" by spreadsheets go through decimal, never double
        cast = F.col(c).try_cast("decimal(38,10)").cast(t) if t in ("int", "bigint", "long") else F.col(c).try_cast(t)
        out = out.withColumn(c, cast)
    if strip_prefix:
        out = out.toDF(*[re.sub(strip_prefix, "", c) for c in out.columns])
    return out


# Spark type name → Arrow type, for literal vocabularies.
_ARROW = {
    "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
}


def vocabulary(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """A small literal vocabulary. ``schema`` is "name type, name type"; row order is ``_ordinal``.

    Built as a local relation, whose size Catalyst knows when it decides on a broadcast.
    """
    fields = [f.split() for f in schema.split(",")]
    data = {name: pa.array([r[i] for r in rows], _ARROW[t]) for i, (name, t) in enumerate(fields)}
    data["_ordinal"] = pa.array(range(len(rows)), pa.int64())
    return spark.createDataFrame(pa.table(data))
