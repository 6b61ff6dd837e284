"""Helpers the corpus operators share: text columns, Arrow scans, written intermediates."""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.session import shared_folder

#: The white space of all contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows per Arrow batch: bounds what a Python worker holds when texts are long.
BATCH_ROWS = 1000


def text_of(column: str) -> Column:
    """The column as text, NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def quoted(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the rows do not have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, lineage cut, readable by every executor.

    What was shuffled for it is garbage from then on. Spark deletes shuffle files when the driver collects its own garbage, which a
    driver with little to do does too rarely for jobs of many steps, so it is asked to.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan(df: DataFrame, per_task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of few rows, so that long texts do not pile up in a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(key)) > BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))

    def frugal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from per_task(batches)
        release()

    return df.mapInArrow(frugal, schema)


def release() -> None:
    """Gives memory that a Python worker no longer uses back to the machine: workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A text column as UTF-8 bytes, NULL as the empty text."""
    col = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [v or b"" for v in col.cast(kind).to_pylist()]


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) if not isinstance(c, pa.Array) else c for c, t in zip(columns, schema)], schema=schema)


class WordHash(dict):
    """64-bit hash of a word; remembers the words of a task, up to a bound."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words, by their words in order."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - n + 1 + k]
    return mixed(out)


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
