"""Whitening by spectrum slicing, periodic runs and WARC archives."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import os
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom.llm import periodic_runs, warc, whitening
from chartloom.llm.queries import LLM_QUERIES

FOLDER = "/root/testdata/sf0.001"

# whitening


def covariances():
    rng = np.random.default_rng(0)
    for k in range(40):
        d, n = int(rng.integers(1, 40)), int(rng.integers(1, 120))
        x = rng.normal(size=(n, d)) * rng.uniform(0.1, 20, size=d)
        if k % 5 == 1:  # one direction far above the others
            x = np.repeat(rng.normal(size=(n, 1)), d, axis=1) + rng.normal(size=(n, d)) * 1e-4
        if k % 5 == 2:  # all eigenvalues equal
            x = np.vstack([np.eye(d) * 8, -np.eye(d) * 8])
        if k % 5 == 3:  # columns that repeat
            x[:, : d // 2] = x[:, d - d // 2 :]
        if k % 5 == 4:  # close neighbours
            x = np.vstack([np.eye(d), -np.eye(d)]) * (1 + 1e-9 * np.arange(d))
        x = x - x.mean(0)
        yield x.T @ x / len(x)


def test_slicing_against_a_dense_solver():
    for v in covariances():
        s, want = whitening.leading(v, 16), np.linalg.eigvalsh(v)[::-1]
        k = len(s.values)
        assert s.certified and np.allclose(s.values, want[:k], rtol=1e-9, atol=1e-12 * want[0])
        assert k == 0 or np.abs(s.vectors.T @ s.vectors - np.eye(k)).max() < 1e-12
        assert k == 0 or np.abs(v @ s.vectors - s.vectors * s.values).max() < 1e-11 * want[0]
        for cut in (want[0] / 3, want[0] * 0.9999, want[0] * 1.1):
            assert whitening.above(v, cut) == (want > cut).sum()


def brute_whiten(rows):
    size = max((len(v) for _, v in rows if v), default=0)
    good = [(i, v) for i, v in rows if v and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in good]
    points = sorted(set(map(tuple, x)))
    n, sums = len(points), [sum(c) for c in zip(*points)]
    p = np.array(points, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(p.T @ p / n)
    out = {}
    for (i, _), row in zip(good, x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        out.setdefault(i, []).append((deviation, (np.array(row) - np.array(sums) / n) @ vectors[:, ::-1] / np.sqrt(np.abs(values[::-1]))))
    return n, values[::-1], out


def check_whitened(rows, got, k):
    n, values, want = brute_whiten(rows)
    assert len(got) == k * sum(map(len, want.values()))
    signs = {}
    by = {}
    for r in got:
        by.setdefault(r["id"], {}).setdefault(r["component"], []).append(r)
    for i, places in want.items():
        for c in range(1, k + 1):
            for (deviation, w), r in zip(sorted(places, key=lambda p: p[0]), sorted(by[i][c], key=lambda r: r["deviation"])):
                assert r["n"] == n and r["deviation"] == deviation and r["identity_error"] < 1e-8
                assert math.isclose(r["explained"], values[c - 1] / values.sum(), rel_tol=1e-9)
                sign = signs.setdefault(c, 1 if r["whitened"] * w[c - 1] >= 0 else -1) if abs(w[c - 1]) > 1e-3 else signs.get(c, 1)
                assert math.isclose(r["whitened"], sign * w[c - 1], abs_tol=1e-7) or abs(w[c - 1]) < 1e-3 > abs(r["whitened"])


def test_whiten_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.1 * (j + 1)) for j in range(6)]) for i in range(200)]
    rows += [(500 + i, rows[7][1]) for i in range(40)]  # repeated vectors count once
    rows += [(None, rows[3][1]), (3, rows[4][1]), (900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [1.0, 2.0])]
    rows += [(904, [float("nan")] + [0.0] * 5), (905, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS x", "'a' AS id", "2 AS component")
    check_whitened(rows, whitening.whiten(df).collect(), 6)


def test_whiten_without_variance(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [0.5, 0.5])]) == [] and run([(1, [0.5]), (2, [0.5])]) == []
    flat = run([(1, [0.5, 1.0]), (2, [0.25, 1.0])])  # one of two dimensions varies
    assert sorted((r["id"], r["component"], r["explained"]) for r in flat) == [(1, 1, 1.0), (2, 1, 1.0)]
    assert {round(r["whitened"], 9) for r in flat} == {1.0, -1.0} and {r["deviation"] for r in flat} == {256}


def test_whiten_large_entries(spark):
    rows = [(i, [1e30 * (-1) ** i, float(i), 3e7 * i]) for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got} == {None}  # the sum of squares does not fit a long
    assert all(math.isfinite(r["whitened"]) for r in got)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")
def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = [r.asDict() | {"id": r["vec_id"]} for r in LLM_QUERIES["op11_whitening"](spark, FOLDER).collect()]
    check_whitened(rows, got, 16)


# periodic runs


def brute_runs(w, shortest=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_maximal_pairs_are_the_runs():
    rng = random.Random(1)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 8)):
            k, n = rng.choice([1, 2, 3, 5]), rng.choice([0, 1, 5, 20, 60, 150])
            w = [b"%d" % rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            docs.append(w)
        for shortest in (12, 7, 2, 1):
            assert periodic_runs.runs_of(docs, shortest) == [brute_runs(w, shortest) for w in docs]


def test_runs_of_long_documents():
    assert periodic_runs.runs_of([[b"a"] * 20_000]) == [[(0, 20_000, 1)]]
    block = [b"w%d" % i for i in range(3_000)]
    assert periodic_runs.runs_of([block * 8, [b"x"] + block * 2 + [b"y"]]) == [[(0, 24_000, 3_000)], [(1, 6_000, 3_000)]]


def digest_row(words):
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    sha = lambda t: hashlib.sha256(t).hexdigest()
    return (
        len(runs), best and best[1], best and -best[0], best and best[2], best and 1000 * -best[0] // best[2],
        sha(b"".join(b"%d,%d,%d\n" % r for r in runs)), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def planted(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_periodic_runs_odd_rows(table):
    from chartloom.llm.queries import op12

    line = "one two three four five six seven "
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 12), (5, line * 3), (5, line * 3), (6, "x " + line * 2 + "y"), (7, "ü é " * 500)]
    rows += [(None, line * 4), (11, "a b " * 5), (12, "a b " * 6)]
    got = op12(table(rows).selectExpr("*", "1 AS runs", "2 AS w", "3 AS n", "4 AS a", "5 AS h", "6 AS best")).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *digest_row(planted(i, t))) for i, t in rows), key=str)
    assert op12(table([])).collect() == []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")
def test_periodic_runs_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in LLM_QUERIES["op12_periodic_runs"](spark, FOLDER).select(*COLUMNS).collect()}
    assert len(got) == len(docs) and sum(r[0] > 0 for r in got.values()) >= 5
    for r in docs:
        words = planted(r["doc_id"], r["text"])
        if len(words) <= 2_000:
            assert got[r["doc_id"]] == digest_row(words)


# WARC


def b32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


ODD = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, "", ""), (4, None, None), (5, "http://a/ 5\r\nX: y", "two\r\n"),
    (6, "u", "\r\n\r\n"), (7, "u", "\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"), (8, "u", "ü\x00\r\r\n\r\n\n\r"),
    (9, "u", "z" * 300_000), (10, "u", "z" * 300_000), (11, "u", "<p>one</p>"), (12, "u", "two\r\n"), (12, "u", "three"),
    (13, "u", "four"), (13, "u", "four"), (None, "u", "four"), (None, "u", "alone"),
]


def brute_pages(rows, min_bytes=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        original = max(same) if same and len(data) >= min_bytes else None
        again = original is not None and i != original
        out.append((i, len(data), b32(data), "revisit" if again else "response", original if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 6])
def test_archives_round_trip(spark, tmp_path, min_bytes):
    pages = spark.createDataFrame(ODD, "page_id long, url string, html string").selectExpr("*", "1 AS id", "'d' AS digest", "2 AS original", "3 AS `check`")
    got = warc.deduplicated(pages, min_bytes=min_bytes, path=f"{tmp_path}/w", date="2020-01-01T00:00:00Z")
    columns = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == brute_pages(ODD, min_bytes)
    # payloads come back byte by byte, and headers are those of the payload
    records = warc.read_archives(spark, f"{tmp_path}/w").collect()
    full = sorted((r["key"], bytes(r["payload"])) for r in records if r["type"] == "response" and r["key"])
    assert set(full) <= {(str(i), (t or "").encode()) for i, _, t in ODD}
    assert all(r["header_digest"] == r["payload_digest"] for r in records if r["type"] == "response")
    assert {None, "http://a/%205%20X:%20y", "u"} <= {r["uri"] for r in records} and {r["date"] for r in records} == {"2020-01-01T00:00:00Z"}
    revisits = [r for r in records if r["type"] == "revisit"]
    ids = {r["record_id"] for r in records if r["type"] == "response"}
    assert revisits and all(r["refers_to"] in ids and r["payload_bytes"] is None for r in revisits)


def test_archives_are_warc(spark, tmp_path):
    """Read by hand: header lines, block by length, two line ends."""
    pages = spark.createDataFrame(ODD[:8], "page_id long, url string, html string")
    warc.write_archives(warc.records(pages), f"{tmp_path}/w", date="2020-01-01T00:00:00Z")
    seen = {}
    for file in Path(tmp_path, "w").glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            block, data = data[: int(fields["Content-Length"])], data[int(fields["Content-Length"]) :]
            assert lines[0] == "WARC/1.1" and data.startswith(b"\r\n\r\n") and fields["WARC-Type"] == "response"
            data = data[4:]
            seen[int(fields["X-Record-Key"])] = block.partition(b"\r\n\r\n")[2]
            assert fields["WARC-Payload-Digest"] == "sha1:" + b32(seen[int(fields["X-Record-Key"])])
    assert seen == {i: (t or "").encode() for i, _, t in ODD[:8]}


def test_archives_of_nothing_and_cut_short(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.deduplicated(empty, path=f"{tmp_path}/e").collect() == []
    pages = spark.createDataFrame([(i, "u", "text " * i) for i in range(50)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.records(pages), f"{tmp_path}/w")
    (file,) = Path(tmp_path, "w").glob("*.gz")
    data = gzip.decompress(file.read_bytes())
    os.makedirs(f"{tmp_path}/cut")
    Path(tmp_path, "cut", "a.warc.gz").write_bytes(gzip.compress(data[: len(data) // 2]))
    Path(tmp_path, "cut", "b.warc.gz").write_bytes(gzip.compress(data[: len(data) // 3]) )
    got = warc.read_archives(spark, f"{tmp_path}/cut").groupBy("key").count().collect()
    assert 15 <= len(got) < 50 and all(r["count"] <= 2 for r in got)
    Path(tmp_path, "cut", "c.warc.gz").write_bytes(gzip.compress(data[: len(data) // 2]) + gzip.compress(data[len(data) // 2 :]))  # members
    assert {r["key"] for r in warc.read_archives(spark, f"{tmp_path}/cut", payloads=False).collect()} == {str(i) for i in range(50)}
