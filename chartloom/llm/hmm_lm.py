"""Language-model scoring with a hidden Markov model of the corpus.

*Vocabulary.* Words are counted over all training documents, folded per task before the shuffle. The most frequent words are
symbols of the model; all others share the symbol TAIL and are told apart by their own add-one share of it. Two bounded tables go to
the tasks, both cut at a count, so nothing depends on ties: the symbols, and the counts of the most frequent words. Counts of rarer
words are joined, one row for each rare word of a document.

*Training.* Baum-Welch: a task runs scaled forward and backward recursions over its training sequences, many at once, and adds up
expected transitions, emissions and starts; the sums over all tasks re-estimate the model. Sequences are pieces of at most
``PIECE`` tokens, every token is in one; a piece that does not begin its document starts from the stationary distribution.

*Scoring.* The scaled forward recursion over the whole document, end token included, gives its exact likelihood.

Documents are read and coded once; the coded corpus is a table in the shared folder, which every round reads again.

Defined cases: NULL counts as empty (the end token alone); without training documents the model is uniform over its symbols;
repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import bytes_of, quoted, scan, written

STATES, ROUNDS, PIECE, PRIOR = 8, 5, 256, 5.0
#: Bounds of the two tables: symbols of the model, and words whose counts tasks keep.
SYMBOLS, KNOWN = 32_000, 1_000_000
FOLD_WORDS, TASK_TOKENS, BATCH_TOKENS = 300_000, 8_000_000, 400_000


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(train: DataFrame) -> DataFrame:
    """``word, n`` over all training texts."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words = list(counts)
            for i in range(0, len(words), 50_000):
                part = words[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()).cast(pa.string()), pa.array([counts[w] for w in part], pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            for text in bytes_of(batch, "text"):
                counts.update(words_of(text))
                if len(counts) > FOLD_WORDS:
                    yield from out()
        yield from out()

    return scan(train.select("text"), per_task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Words above a count by hash, in order of their codes (most frequent first); codes below ``symbols`` are symbols."""

    hashes: np.ndarray
    counts: np.ndarray
    symbols: int
    documents: int
    tokens: int  # N, with the end tokens
    distinct: int  # V, with the end token

    @property
    def tail(self) -> int:
        return self.symbols

    @property
    def end(self) -> int:
        return self.symbols + 1

    @property
    def tail_total(self) -> int:
        """Add-one total of the words that share TAIL."""
        head = int(self.counts[: self.symbols].sum())
        return (self.tokens - self.documents - head) + (self.distinct - (self.documents > 0) - self.symbols) + 1

    def unigram(self) -> np.ndarray:
        c = np.r_[self.counts[: self.symbols], self.tokens - self.documents - self.counts[: self.symbols].sum(), self.documents].astype(np.float64) + 1
        return c / c.sum()


def cut_at(histogram: list[tuple[int, int]], bound: int) -> int:
    """The smallest count such that at most ``bound`` words are as frequent."""
    held, least = 0, (histogram[0][0] + 1) if histogram else 1
    for n, words in histogram:
        held += words
        if held > bound:
            break
        least = n
    return least


def vocabulary(counts: DataFrame, documents: int, symbols: int = SYMBOLS, known: int = KNOWN) -> tuple[Vocabulary, int]:
    """The tables for tasks, and the count below which words are joined."""
    per_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).toArrow().to_pydict()
    histogram = sorted(zip(per_count["n"], per_count["words"], strict=True), reverse=True)
    tokens, distinct = sum(n * w for n, w in histogram), sum(w for _, w in histogram)
    least, head = cut_at(histogram, known), cut_at(histogram, symbols)
    least = min(least, head)
    found = counts.filter(F.col("n") >= least).select(F.xxhash64("word").alias("h"), "n").toArrow()
    h, n = found.column("h").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.lexsort((h, -n))
    return Vocabulary(h[order], n[order], int((n >= head).sum()), documents, tokens + documents, distinct + (documents > 0)), least


class Coder(dict):
    """Code of a word, -1 if its count is not in the table."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.order = np.argsort(v.hashes)
        self.sorted = v.hashes[self.order]

    def learn(self, documents: list[list[bytes]]) -> None:
        """The codes of all words of some documents, looked up together."""
        if len(self) > 250_000:
            self.clear()
        new = [w for w in set(itertools.chain.from_iterable(documents)) if w not in self]
        h = np.fromiter((xxhash.xxh64_intdigest(w, seed=42) for w in new), np.uint64, len(new))
        code = np.full(len(new), -1)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
            code = np.where(self.sorted[at] == h, self.order[at], -1)
        self.update(zip(new, code.tolist(), strict=True))


CODED = "id long, uid long, train boolean, n_tokens long, n_known long, base double, tail double, n_rare long, rare array<string>, codes binary"


def coded(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """``id, uid, train, text`` → symbols of every document, and what of its scores does not depend on the model."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(v))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(**shared.value)
        coder = Coder(v)
        log_count = np.log10(v.counts + 1.0)
        base_total, tail_total = np.log10(float(v.tokens + v.distinct + 1)), np.log10(float(v.tail_total))
        end = np.log10(v.documents + 1.0) - base_total
        for batch in batches:
            out = [[] for _ in range(7)]
            documents = [words_of(text) for text in bytes_of(batch, "text")]
            for i, words in enumerate(documents):
                if i % 200 == 0:
                    coder.learn(documents[i : i + 200])
                code = np.fromiter(map(coder.__getitem__, words), np.int64, len(words))
                rare = code < 0
                n_rare = int(rare.sum())
                seen, symbol = code[~rare], np.where(rare | (code >= v.symbols), v.tail, code)
                in_tail = seen[seen >= v.symbols]
                values = (
                    len(words) + 1, len(seen) + (v.documents > 0), float(log_count[seen].sum()) - len(words) * base_total + end,
                    float(log_count[in_tail].sum()) - (len(in_tail) + n_rare) * tail_total, n_rare,
                    [words[i] for i in np.flatnonzero(rare)], np.r_[symbol, v.end].astype("<u2").tobytes(),
                )
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary()), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
            arrays[5] = arrays[5].cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "uid", "train")), *arrays], names=[c.split()[0] for c in CODED.split(", ")])

    return scan(docs, per_task, CODED)


@dataclass
class Hmm:
    start: np.ndarray  # K
    move: np.ndarray  # K x K
    emit: np.ndarray  # symbols x K


def first_model(p: np.ndarray, states: int, seed: int = 1) -> Hmm:
    """Sticky states, whose emissions are the unigram distribution disturbed at random."""
    emit = p[:, None] * (0.5 + np.random.default_rng(seed).random((len(p), states)))
    move = np.full((states, states), 0.1 / max(1, states - 1)) if states > 1 else np.ones((1, 1))
    if states > 1:
        np.fill_diagonal(move, 0.9)
    return Hmm(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def stationary(move: np.ndarray) -> np.ndarray:
    x = np.full(len(move), 1 / len(move))
    for _ in range(200):
        x = x @ move
    return x / x.sum()


def batches_of(sequences: list[np.ndarray], tokens: int) -> Iterator[np.ndarray]:
    """Sequences of like length as columns of a matrix, longest first; yields their places."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = lengths[order[at]]
        n = max(1, tokens // longest)
        part = order[at : at + n]
        part = part[lengths[part] * 1.3 + 8 >= longest]
        yield part
        at += len(part)


def matrix(sequences: list[np.ndarray], part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols by time and sequence, and how many sequences are as long as each time."""
    lengths = np.array([len(sequences[i]) for i in part])
    x = np.zeros((lengths[0], len(part)), np.int64)
    for j, i in enumerate(part):
        x[: lengths[j], j] = sequences[i]
    return x, np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")


def log10_likelihood(m: Hmm, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of every sequence: scaled forward recursion."""
    out = np.zeros(len(sequences))
    for part in batches_of(sequences, BATCH_TOKENS):
        x, live = matrix(sequences, part)
        total = np.zeros(len(part))
        a = m.start * m.emit[x[0]]
        for t in range(len(x)):
            if t:
                n = live[t]
                a = (a[:n] @ m.move) * m.emit[x[t, :n]]
            scale = a.sum(axis=1)
            a /= scale[:, None]
            total[: len(scale)] += np.log10(scale)
        out[part] = total
    return out


def expected_counts(m: Hmm, sequences: list[np.ndarray], begins: np.ndarray, sums: list[np.ndarray]) -> None:
    """Adds expected starts, transitions and emissions; ``begins``: the sequence is the beginning of its document."""
    k, symbols = len(m.start), len(m.emit)
    emit, move, inner = m.emit.astype(np.float32), m.move.astype(np.float32), stationary(m.move)
    for part in batches_of(sequences, BATCH_TOKENS):
        x, live = matrix(sequences, part)
        alpha, scale = np.zeros((*x.shape, k), np.float32), np.ones(x.shape, np.float32)
        a = np.where(begins[part][:, None], m.start, inner).astype(np.float32) * emit[x[0]]
        for t in range(len(x)):
            n = live[t]
            if t:
                a = (a[:n] @ move) * emit[x[t, :n]]
            scale[t, :n] = c = a.sum(axis=1)
            a /= c[:, None]
            alpha[t, :n] = a
        beta = np.ones((live[-1], k), np.float32)
        between = np.zeros((k, k))
        for t in range(len(x) - 2, -1, -1):
            n = live[t + 1]
            weighted = emit[x[t + 1, :n]] * beta[:n] / scale[t + 1, :n, None]
            between += alpha[t, :n].T @ weighted
            beta = np.ones((live[t], k), np.float32)
            beta[:n] = weighted @ move.T
            alpha[t, : live[t]] *= beta
        sums[0] += (alpha[0] * begins[part][:, None]).sum(axis=0)
        sums[1] += between * m.move
        there = np.arange(x.shape[1])[None, :] < live[:, None]
        symbol, gamma = x[there], alpha[there]
        for z in range(k):
            sums[2][:, z] += np.bincount(symbol, gamma[:, z], symbols)


def baum_welch_round(corpus: DataFrame, m: Hmm, p: np.ndarray, prior: float = PRIOR) -> Hmm:
    """One round over the training rows.

    Emissions are re-estimated as P(state | word) P(word) / P(state), with ``prior`` occurrences of every word spread over the
    states as all words are: a rare word tells little about its states.
    """
    shared = corpus.sparkSession.sparkContext.broadcast(vars(m))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Hmm(**shared.value)
        k, symbols = len(m.start), len(m.emit)
        sums = [np.zeros(k), np.zeros((k, k)), np.zeros((symbols, k))]
        pieces, begins, held, any_rows = [], [], 0, False

        def add():
            expected_counts(m, pieces, np.array(begins), sums)

        for batch in batches:
            for blob in batch.column("codes").to_pylist():
                codes, any_rows = np.frombuffer(blob, "<u2"), True
                for i in range(0, len(codes), PIECE):
                    pieces.append(codes[i : i + PIECE])
                    begins.append(i == 0)
                held += len(codes)
            if held > TASK_TOKENS:
                add()
                pieces, begins, held = [], [], 0
        if pieces:
            add()
        if any_rows:
            blobs = [zlib.compress(s.astype("<f4").tobytes(), 1) for s in sums]
            yield pa.RecordBatch.from_arrays([pa.array([0, 1, 2], pa.int32()), pa.array(blobs, pa.binary())], names=["part", "sums"])

    def total(key, rows):
        out = 0.0
        for blob in rows.column("sums"):
            out = out + np.frombuffer(zlib.decompress(blob.as_py()), "<f4").astype("<f8")
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([out.tobytes()], pa.binary())})

    partial = scan(corpus.filter("train").select("codes"), per_task, "part int, sums binary")
    # two levels, so that no group holds the sums of very many tasks
    few = partial.withColumn("some", F.pmod(F.xxhash64("sums"), F.lit(16)).cast("int")).groupBy("part", "some").applyInArrow(total, "part int, sums binary")
    found: dict[int, np.ndarray] = {}
    for r in few.collect():  # at most 16 rows for each of the three sums, of bounded size
        found[r["part"]] = found.get(r["part"], 0.0) + np.frombuffer(r["sums"], "<f8")
    if not found:
        return m
    k = len(m.start)
    start, move, emit = found[0] + 0.1, found[1].reshape(k, k) + 0.1, found[2].reshape(-1, k)
    share = emit.sum(axis=0) / emit.sum()
    emit = p[:, None] * (emit + prior * share) / (emit.sum(axis=1, keepdims=True) + prior)
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def scored(corpus: DataFrame, m: Hmm) -> DataFrame:
    shared = corpus.sparkSession.sparkContext.broadcast(vars(m))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Hmm(**shared.value)
        held: list[pa.RecordBatch] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            sequences = [np.frombuffer(b, "<u2") for b in table.column("codes").to_pylist()]
            table = table.drop_columns(["codes"]).append_column("forward", pa.array(log10_likelihood(m, sequences)))
            yield from table.to_batches()

        for batch in batches:
            held.append(batch)
            size += batch.column("codes").nbytes // 2
            if size > TASK_TOKENS // 2:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    fields = ", ".join(c for c in CODED.split(", ") if not c.startswith("codes"))
    return scan(corpus, per_task, f"{fields}, forward double")


def lm_scores(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS,
    symbols: int = SYMBOLS, known: int = KNOWN,
) -> DataFrame:
    """Every row: id, train, n_tokens, n_known, train_tokens, base_score (unigram), score (the model), both log10 probabilities."""
    if symbols > 65_534:
        raise ValueError("symbols are kept in 16 bits")
    rows = docs.select(
        quoted(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("uid"), train.alias("train"), quoted(text_col).cast("string").alias("text")
    )
    counts = written(word_counts(rows.filter("train")), "lm-counts")
    documents = docs.filter(train).count()
    v, least = vocabulary(counts, documents, symbols, known)
    corpus = written(coded(rows, v), "lm-corpus")
    p = v.unigram()
    m = first_model(p, states)
    for _ in range(rounds if documents else 0):
        m = baum_welch_round(corpus, m, p)
    parts = scored(corpus, m)
    rare = corpus.filter("n_rare > 0").select("uid", F.explode("rare").alias("word"))
    rare = rare.join(counts.filter(F.col("n") < least), "word", "left").groupBy("uid").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_log"), F.count("n").alias("rare_known")
    )
    whole = parts.join(rare, "uid", "left")
    extra = F.coalesce("rare_log", F.lit(0.0))
    return whole.select(
        "id", "train", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"), (F.col("forward") + F.col("tail") + extra).alias("score"),
    )
