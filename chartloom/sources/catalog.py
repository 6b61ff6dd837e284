"""Source tables by name, in parquet or compressed CSV."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---- fixed values: source tables per module ----
MODULES = {
    "hosp": [
        "admissions", "d_hcpcs", "d_icd_diagnoses", "d_icd_procedures", "d_labitems", "diagnoses_icd", "drgcodes",
        "emar_detail", "emar", "hcpcsevents", "labevents", "microbiologyevents", "omr", "patients", "pharmacy",
        "poe_detail", "poe", "prescriptions", "procedures_icd", "provider", "services", "transfers",
    ],
    "icu": [
        "caregivers", "chartevents", "d_items", "datetimeevents", "icustays", "ingredientevents", "inputevents",
        "outputevents", "procedureevents",
    ],
}
NEEDED = [
    "admissions", "d_labitems", "labevents", "patients", "transfers", "chartevents", "d_items", "datetimeevents",
    "icustays", "ingredientevents", "inputevents", "outputevents", "procedureevents", "hcpcsevents",
    "procedures_icd", "diagnoses_icd",
]
FORMATS = ["parquet", "csv"]
# ---- end of fixed values ----


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on whatever file system the path names, so it works for cluster storage too."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@dataclass(frozen=True)
class Catalog:
    """Where the source tables live.

    Parquet may be split into module folders or lie flat; CSV always has module folders. An empty
    ``parquet_dir`` means a ``parquet`` folder beside the CSV modules.
    """

    csv_dir: str = ""
    parquet_dir: str = ""

    @property
    def parquet_root(self) -> str:
        return self.parquet_dir or f"{self.csv_dir}/parquet"

    @staticmethod
    def module_of(table: str) -> str:
        for module, tables in MODULES.items():
            if table in tables:
                return module
        raise ValueError(f"unknown source table: {table}")

    def has_modules(self, spark: SparkSession) -> bool:
        return all(path_exists(spark, f"{self.parquet_root}/{m}") for m in MODULES)

    def path(self, spark: SparkSession, table: str, fmt: str = "parquet") -> str:
        module = self.module_of(table)
        if fmt == "parquet":
            folder = f"{self.parquet_root}/{module}" if self.has_modules(spark) else self.parquet_root
            return f"{folder}/{table}.parquet"
        if fmt == "csv":
            return f"{self.csv_dir}/{module}/{table}.csv.gz"
        raise ValueError(f"unsupported format {fmt!r}; one of {FORMATS}")


def read_source(
    spark: SparkSession, catalog: Catalog, table: str, fmt: str = "parquet", schema: T.StructType | str | None = None
) -> DataFrame:
    path = catalog.path(spark, table, fmt)
    if fmt == "parquet":
        return spark.read.parquet(path)
    return read_csv(spark, path, schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; types are inferred (an extra pass) only when no schema is given."""
    reader = spark.read.option("header", True).option("multiLine", False).option("escape", '"')
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def csv_to_parquet(
    spark: SparkSession,
    catalog: Catalog,
    table: str,
    overwrite: bool = False,
    schema: T.StructType | str | None = None,
    partitions: int | None = None,
    cluster_by: Sequence[str] = (),
) -> str:
    """Convert one table; an existing target is an error unless ``overwrite``.

    ``cluster_by`` sorts the files by these columns (for event tables: the item id), so that a
    pushed-down item filter skips most row groups.
    A gzip file cannot be split, so it is read by one task and then spread over ``partitions`` files
    (default: AQE's advisory size).
    """
    target = catalog.path(spark, table, "parquet")
    if not overwrite and path_exists(spark, target):
        raise FileExistsError(f"{target} exists; set overwrite=True to replace it")
    df = read_source(spark, catalog, table, "csv", schema)
    if cluster_by:
        df = df.repartitionByRange(*([partitions] if partitions else []), *cluster_by).sortWithinPartitions(*cluster_by)
    else:
        df = df.repartition(partitions) if partitions else df.hint("rebalance")
    df.write.mode("overwrite" if overwrite else "error").parquet(target)
    return target


def csv_to_parquet_many(
    spark: SparkSession, catalog: Catalog, tables: Iterable[str] | None = None, overwrite: bool = False, **kw
) -> dict[str, str]:
    """Convert several tables (all by default), skipping those that exist. Returns table → outcome."""
    tables = list(tables) if tables is not None else [t for ts in MODULES.values() for t in ts]
    outcome = {}
    for table in tables:
        try:
            outcome[table] = f"written {csv_to_parquet(spark, catalog, table, overwrite, **kw)}"
        except FileExistsError:
            outcome[table] = "skipped, exists"
    return outcome
