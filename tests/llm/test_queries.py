"""Registered corpus queries against their SQL, and the pipeline against brute force, on the smallest benchmark tables."""

from __future__ import annotations

import hashlib
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from chartloom.llm import language_id, packing
from chartloom.llm.queries import LLM_QUERIES, LLM_SQL
from tests.llm.test_dedup_and_mix import brute_components, norm, water
from tests.llm.test_text_operators import check_pieces
from tools.check import rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.mark.parametrize("name", list(LLM_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for name_of in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{FOLDER}/{name_of}.parquet'")
    df = LLM_QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(LLM_SQL[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_all_are_registered():
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names
    assert set(LLM_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op4_mixing", "op7_licenses"])
def test_native_plans_hold_no_python(spark, name):
    plan = LLM_QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, rows = docs.columns, [tuple(r) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)

    def run(name, rows):
        out = stages[name](spark, spark.createDataFrame(rows, docs.schema), FOLDER)
        return out.columns, [tuple(r) for r in out.collect()]

    # language ID: plain nearest centroid, text by text
    from pyspark.sql import functions as F

    model = language_id.fit(language_id.training_rows(docs, F.lit(True), "doc_id", "text", "lang"))
    vector = lambda t: language_id.weighted(language_id.counts([t.encode()]), model.idf)[0]
    want = []
    for r in rows:
        v = vector(r[1])
        c = model.centroids @ v
        if any(ch.isalpha() for ch in r[1]) and c.max() >= model.bound[c.argmax()] * min(400, np.count_nonzero(v)) ** 0.5:
            want.append(r)
    got_columns, got = run("language ID", rows)
    assert got_columns == columns and sorted(got) == sorted(want) and len(got) >= 0.95 * len(rows)

    best = {}
    for r in got:
        best[norm(r[1])] = max(best.get(norm(r[1]), (-1, 0, None)), (len(r[1]), -r[0], r), key=lambda x: x[:2])
    got_columns, unique = run("exact dedup", got)
    assert got_columns == columns and sorted(unique) == sorted(b[2] for b in best.values())

    parts = brute_components([(r[0], r[1]) for r in unique], 5, (8, 10))
    got_columns, kept = run("n-gram Jaccard join", unique)
    assert got_columns == columns and sorted(kept) == sorted(r for r in unique if parts[r[0]][1] == r[0])

    size = {}
    for r in kept:
        size[r[3]] = size.get(r[3], 0) + len(r[1].encode().split())
    target = water(size, {s: i % 3 + 1 for i, s in enumerate(sorted(size))})
    want = []
    for r in kept:
        rate = target[r[3]] / size[r[3]]
        draw = int(hashlib.sha256(f"mix-1:{r[0]}".encode()).hexdigest()[:13], 16) / 2**52
        want += [r] * (int(rate) + (draw < rate - int(rate)))
    got_columns, mixed = run("mixing", kept)
    assert got_columns == columns and sorted(mixed) == sorted(want)

    out = stages["packing"](spark, spark.createDataFrame(mixed, docs.schema), FOLDER)
    pieces = [r.asDict() | {"id": r["doc_id"]} for r in out.collect()]
    check_pieces([(r[0], r[1]) for r in mixed], pieces, packing.WINDOW)
    total, source = sum(p["length"] for p in pieces), {}
    for p in pieces:
        source[p["source"]] = source.get(p["source"], 0) + p["length"]
    for k in range(total // packing.WINDOW):
        own = {s: sum(p["length"] for p in pieces if p["sequence_id"] == k and p["source"] == s) for s in source}
        assert all(abs(own[s] - packing.WINDOW * n / total) <= 2 for s, n in source.items())
    assert np.isclose(sum(source.values()), total)
