"""Cut harmonised tables down to a cohort, or scale them up with suffixed copies."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from chartloom.operators.joins import replicate, right_join_cohort, semi_join_cohort

# Id columns, the narrower one first.
ID_COLUMNS = ["hospitalization_id", "patient_id"]


def cohort_ids(hospitalization: DataFrame, listed: DataFrame, listed_id: str) -> DataFrame:
    """Patient and hospitalization ids of an external patient list (NULL ids where there is no stay)."""
    return right_join_cohort(
        hospitalization.select("patient_id", "hospitalization_id"), listed, "patient_id", listed_id
    ).select("patient_id", "hospitalization_id")


def extract(
    tables: Mapping[str, DataFrame], cohort: DataFrame, ids: Sequence[str] = tuple(ID_COLUMNS)
) -> dict[str, DataFrame]:
    """Rows of the cohort: by hospitalization where a table has that id, else by patient."""
    out = {}
    for name, df in tables.items():
        key = next((i for i in ids if i in df.columns), None)
        if key is None:
            raise ValueError(f"{name} has none of the id columns {list(ids)}")
        out[name] = semi_join_cohort(df, cohort, key)
    return out


def letters(i: int) -> str:
    """A, B, ..., Z, AA, AB, ... for 0, 1, ..."""
    out = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        out = string.ascii_uppercase[rest] + out
    return out


def scale_up(
    tables: Mapping[str, DataFrame], copies: int = 4, ids: Sequence[str] = (*ID_COLUMNS, "organism_id")
) -> dict[str, DataFrame]:
    """Every row ``copies`` times, with a suffix of letters on each id the table has."""
    suffixes = [letters(i) for i in range(copies)]
    return {name: replicate(df, suffixes, [i for i in ids if i in df.columns]) for name, df in tables.items()}
