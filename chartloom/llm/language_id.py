"""Language identification by nearest centroid over TF-IDF byte n-gram vectors.

A text's vector counts its byte 3-grams, hashed to ``DIMS`` places, over letters only (everything else counts as one blank);
counts are damped by a logarithm, weighted by inverse document frequency and scaled to length one. Document frequencies come from
all training rows. Every language gets several centroids by spherical k-means from a balanced start; small clusters are given up. A text takes the
language of the centroid with the highest cosine; it is rejected if its distance exceeds the language's bound
for texts of its length, or if it holds no letter.

The centroids are fitted on a sample of about ``fit_rows`` training rows per language, chosen by a hash of the id: the bound is a
parameter, the sample goes to the driver as sparse vectors. Prediction reads whole texts in Arrow batches and keeps one block of
vectors at a time.

Defined cases: NULL text, and text without any letter: ``und``, score 0, rejected. Ties go to the first language by code point.
Without training rows everything is ``und``. Repeated rows are predicted alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import bytes_of, quoted, scan

DIMS = 4096
FIT_ROWS = 1000
CENTROIDS = 4
#: The least share of a language's rows in a cluster; the share of training rows that count as far ones for the bound.
SHARE, FAR = 0.05, 0.005
#: Different n-grams from which on the bound does not grow.
FULL = 400
BLOCK_BYTES = 4_000_000
BLOCK_ROWS = 256

_CLASS = np.full(256, 32, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_CLASS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_CLASS[128:] = np.arange(128, 256)


def counts(texts: list[bytes]) -> np.ndarray:
    """3-gram counts, a row per text."""
    lengths = np.array([len(t) + 2 for t in texts])
    joined = np.frombuffer(b" " + b"  ".join(texts) + b" ", np.uint8)
    code = _CLASS[joined].astype(np.uint32)
    gram = (code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA77)) + code[2:] * np.uint32(0xC2B2AE3D)
    gram ^= gram >> np.uint32(15)
    gram *= np.uint32(0x2C1B3C6D)
    gram >>= np.uint32(20)
    row = np.repeat(np.arange(len(texts), dtype=np.int64) * DIMS, lengths)[: len(gram)]
    keep = (code[:-2] != 32) | (code[1:-1] != 32)
    return np.bincount((row + gram)[keep], minlength=len(texts) * DIMS).reshape(len(texts), DIMS)


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) > BLOCK_BYTES or i - start >= BLOCK_ROWS):
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode(errors="ignore")))


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # float32, a row each, length one
    idf: np.ndarray
    bound: np.ndarray  # least cosine that is accepted, for a text of one n-gram


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def weighted(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(n).astype(np.float32) * idf)


def reach(vectors: np.ndarray) -> np.ndarray:
    """By how much texts of so many different n-grams come nearer to a centroid than a text of one: short texts are far from any."""
    return np.sqrt(np.clip((vectors != 0).sum(axis=1), 1, FULL))


def document_frequency(train: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and how many of them hold each n-gram place; sums of one row per task and place."""

    def per_task(batches):
        df, rows = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            texts = bytes_of(batch, "text")
            rows += len(texts)
            for a, b in blocks(texts):
                df += (counts(texts[a:b]) > 0).sum(axis=0)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, DIMS), pa.int32()), pa.array([rows, *df.tolist()], pa.int64())], names=["place", "n"])

    found = dict(scan(train.select("text"), per_task, "place int, n long").groupBy("place").agg(F.sum("n")).collect())
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(DIMS)], np.float64)


def sample_vectors(train: DataFrame, fit_rows: int) -> dict[str, np.ndarray]:
    """About ``fit_rows`` count vectors of each language, by a hash of the id."""
    per_lang = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.create_map(*[x for k, n in per_lang.items() for x in (F.lit(k), F.lit(min(1.0, fit_rows / n)))]) if per_lang else None
    if share is None:
        return {}
    u = F.shiftrightunsigned(F.xxhash64(F.col("id"), F.lit("fit")), 11).cast("double") / float(2**53)

    def per_task(batches):
        for batch in batches:
            texts, langs = bytes_of(batch, "text"), batch.column("lang").to_pylist()
            for a, b in blocks(texts):
                rows = counts(texts[a:b])
                at = [np.flatnonzero(r) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), pa.array(langs[a:b], pa.string()), pa.array([x.astype("<u2").tobytes() for x in at], pa.binary()),
                     pa.array([r[x].astype("<u4").tobytes() for r, x in zip(rows, at, strict=True)], pa.binary())],
                    names=["id", "lang", "at", "n"],
                )

    rows = scan(train.filter(u < share[F.col("lang")]).select("id", "text", "lang"), per_task, "id string, lang string, at binary, n binary").collect()
    out: dict[str, list[np.ndarray]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["id"] or "", bytes(r["at"]))):
        row = np.zeros(DIMS, np.float32)
        row[np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<u4")
        out.setdefault(r["lang"], []).append(row)
    return {k: np.stack(v) for k, v in out.items()}


def halves(x: np.ndarray) -> np.ndarray:
    """A balanced split: which rows lie above the median along the rows' main direction."""
    centred = x - x.mean(axis=0)
    direction = centred[int((centred * centred).sum(axis=1).argmax())]
    for _ in range(10):
        direction = centred.T @ (centred @ direction)
        direction /= max(float(np.linalg.norm(direction)), 1e-30)
    along = centred @ direction
    upper = np.zeros(len(x), bool)
    upper[np.argsort(along, kind="stable")[len(x) // 2 :]] = True
    return upper


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, least: float = SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Centroids, and the cluster of each row.

    The start is balanced: the largest cluster is split in halves until there are ``k``. Clusters that end under the share ``least``
    of the rows are given up one by one, the smallest first, and their rows go to the others: no centroid stands for a few odd texts.
    """
    label = np.zeros(len(x), np.int64)
    for new in range(1, min(k, len(x))):
        at = np.flatnonzero(label == np.bincount(label).argmax())
        label[at[halves(x[at])]] = new
    while True:
        for _ in range(rounds):
            kept = [j for j in range(label.max() + 1) if (label == j).any()]
            c = np.stack([unit(x[label == j].mean(axis=0, keepdims=True))[0] for j in kept])
            label = (x @ c.T).argmax(axis=1)
        size = np.bincount(label, minlength=len(c))
        if len(c) == 1 or size.min() >= least * len(x):
            return c, label
        rest = np.delete(c, int(size.argmin()), axis=0)
        label = (x @ rest.T).argmax(axis=1)


def fit(train: DataFrame, fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS) -> Model:
    """``train``: id (string), text, lang; rows without a language are left out."""
    train = train.filter("lang IS NOT NULL AND text IS NOT NULL")
    rows, df = document_frequency(train)
    idf = (np.log((1 + rows) / (1 + df)) + 1).astype(np.float32)
    languages, all_c, bound = [], [], []
    for lang, n in sorted(sample_vectors(train, fit_rows).items()):
        x = weighted(n[n.any(axis=1)], idf)  # texts without a letter have no direction
        if not len(x):
            continue
        c, _ = spherical_kmeans(x, centroids)
        # one bound for all centroids of a language: half of what all but its farthest training rows reach for their length
        reached = float(np.quantile((x @ c.T).max(axis=1) / reach(x), FAR))
        languages += [lang] * len(c)
        all_c += list(c)
        bound += [0.5 * reached] * len(c)
    if not languages:
        return Model([], np.zeros((0, DIMS), np.float32), idf, np.zeros(0))
    return Model(languages, np.stack(all_c).astype(np.float32), idf, np.array(bound))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``: ``__text`` is read and left out, all other columns stay; adds lang_pred, score, rejected."""
    kept = [c for c in docs.columns if c != "__text"]

    def per_task(batches):
        for batch in batches:
            texts = bytes_of(batch, "__text")
            langs, scores, rejected = [], [], []
            for a, b in blocks(texts):
                near, far = np.zeros((b - a, 1), np.float32), np.ones(b - a)
                if model.languages:
                    vectors = weighted(counts(texts[a:b]), model.idf)
                    near, far = vectors @ model.centroids.T, reach(vectors)
                best = near.argmax(axis=1)
                for i, j in enumerate(best):
                    known = bool(model.languages) and has_letter(texts[a + i])
                    score = min(1.0, max(0.0, float(near[i, j]))) if known else 0.0
                    langs.append(model.languages[j] if known else "und")
                    scores.append(score)
                    rejected.append(not known or score < model.bound[j] * far[i])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*kept, "lang_pred", "score", "rejected"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "__text")
    return scan(docs, per_task, f"{fields}, lang_pred string, score double, rejected boolean")


def training_rows(docs: DataFrame, used: Column, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.filter(used).select(
        quoted(id_col).cast("string").alias("id"), quoted(text_col).cast("string").alias("text"), quoted(lang_col).cast("string").alias("lang")
    )
