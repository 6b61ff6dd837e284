"""Periodic runs of words by enumeration of maximal pairs.

A run is a stretch of consecutive words with smallest period q and at least max(``shortest``, 2q) words that no neighbouring word
extends with the same period. Two positions i < j of a document whose suffixes share l words, no more, and whose words before them
differ (or i is the first) are a maximal pair. Maximal pairs of distance q = j - i with q <= l and q + l >= ``shortest`` are exactly the
stretches [i, i + q + l) of period q that nothing extends, so nothing is extended after the enumeration; a stretch that several
distances give has the smallest of them as its period (the others are its multiples).

Documents of a batch are coded by an exact dictionary of their words and sorted by suffix together, by prefix doubling (positions that
are already alone drop out), each document apart. Common prefixes of neighbours come from the ranks of every doubling. Only neighbours
that share half of ``shortest`` words can be in a run; of these the tree of LCP intervals is built bottom-up. A node holds its positions
by the word to their left, in order; where two children meet, every position of the smaller looks for partners in the larger that have
another word to their left and are no farther away than the node is deep, by class or by position, whichever is less to read. So the
positions that only shift a run are skipped in whole classes.

Words are runs of anything but ASCII white space. A document is worked on whole, in one task; memory is bounded by the larger of a batch
of words and the longest document. Defined cases: NULL, empty and blank texts have no words and no runs; NULL and repeated ids are rows
like others; no rows give no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import bytes_of, quoted, release, scan

SHORTEST = 12
#: Words that are sorted together.
BATCH_WORDS = 100_000


class Codes(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def suffix_order(code: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """All suffixes of every document in order (documents apart), and the ranks of their first 1, 2, 4, ... words.

    Equal ranks are equal words; the end of a document is smaller than any word.
    """
    n = len(code)
    key = doc.astype(np.int64) * (int(code.max()) + 1) + code
    order = np.argsort(key, kind="stable")
    head = np.r_[True, key[order][1:] != key[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, width = [rank.astype(np.int32)], 1
    # slots of the order that belong to groups of two or more
    alone = head & np.r_[head[1:], True]
    slots = np.flatnonzero(~alone)
    while len(slots):
        at = order[slots]
        follows = at + width
        second = np.where(follows < end[at], rank[np.minimum(follows, n - 1)] + 1, 0)
        first = rank[at]
        by = np.argsort(first * (n + 1) + second, kind="stable")
        at, first, second = at[by], first[by], second[by]
        order[slots] = at
        fresh = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        levels.append(rank.astype(np.int32))
        slots = slots[~(fresh & np.r_[fresh[1:], True])]
        width *= 2
    return order, levels


def shared_words(order: np.ndarray, levels: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """How many words each suffix in the order shares with the one before it; 0 for the first."""
    shared = np.zeros(len(order), np.int64)
    # only neighbours that were together after the first word can share anything
    first = levels[0]
    which = np.flatnonzero(first[order[1:]] == first[order[:-1]]) + 1
    a, b, got = order[which - 1], order[which], np.zeros(len(which), np.int64)
    for k in reversed(range(len(levels))):
        x, y = a + got, b + got
        inside = (x < end[a]) & (y < end[b])
        same = inside.copy()
        same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
        got += same.astype(np.int64) << k
    shared[which] = got
    return shared


class Positions:
    """Positions of a node in order, all together and by the word to their left."""

    __slots__ = ("all", "by")

    def __init__(self, position: int, left: int) -> None:
        self.all, self.by = [position], {left: [position]}

    def partners(self, position: int, left: int, reach: int) -> Iterator[int]:
        a, b = bisect_left(self.all, position - reach), bisect_right(self.all, position + reach)
        if b - a <= len(self.by):
            for k in range(a, b):
                yield self.all[k]
            return
        for word, places in self.by.items():
            if word != left:
                yield from places[bisect_left(places, position - reach) : bisect_right(places, position + reach)]

    def add(self, position: int, left: int) -> None:
        insort(self.all, position)
        if left in self.by:
            insort(self.by[left], position)
        else:
            self.by[left] = [position]


def meet(a: Positions, b: Positions, depth: int, left: dict[int, int], shortest: int, found: list[tuple[int, int, int]]) -> Positions:
    """Adds the maximal pairs between two children of a node of this depth; returns the children as one."""
    small, large = (a, b) if len(a.all) < len(b.all) else (b, a)
    for word, places in small.by.items():
        for i in places:
            for j in large.partners(i, word, depth):
                if left[j] != word and abs(i - j) + depth >= shortest:
                    found.append((min(i, j), max(i, j), depth))
    for word, places in small.by.items():
        for i in places:
            large.add(i, word)
    return large


def maximal_pairs(order: list[int], shared: list[int], left: dict[int, int], shortest: int) -> list[tuple[int, int, int]]:
    """(i, j, l) of every maximal pair of a family of suffixes with j - i <= l and j - i + l >= shortest.

    ``order`` are suffixes that stand next to each other, ``shared[k]`` what the k-th shares with the one before, ``left`` by position
    the word before it (-1 for the first of a document).
    """
    found: list[tuple[int, int, int]] = []
    nodes: list[tuple[int, Positions]] = []  # children not yet met: how deep they meet what stands before, and their positions

    def close(depth: int) -> None:
        while len(nodes) > 1 and nodes[-1][0] > depth:
            at, last = nodes.pop()
            before, earlier = nodes.pop()
            nodes.append((before, meet(earlier, last, at, left, shortest, found)))

    for k, suffix in enumerate(order):
        depth = shared[k] if k else -1
        close(depth)
        nodes.append((depth, Positions(suffix, left[suffix])))
    close(-1)
    return found


def runs_of(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every text, in order."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    if total == 0:
        return found
    codes = Codes()
    code = np.fromiter((codes[w] for t in texts for w in t), np.int64, total)
    starts = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(texts)), sizes)
    end = np.repeat(starts + sizes, sizes)
    order, levels = suffix_order(code, doc, end)
    shared = shared_words(order, levels, end)
    least = (shortest + 1) // 2  # q <= l and q + l >= shortest
    close = shared >= max(1, least)
    if not close.any():
        return found
    left = np.r_[-1, code[:-1]]
    left[starts[sizes > 0]] = -1
    # families: neighbours that share enough, with the suffix before them
    rises = np.flatnonzero(close & ~np.r_[False, close[:-1]])
    falls = np.flatnonzero(close & ~np.r_[close[1:], False]) + 1
    best: dict[tuple[int, int], int] = {}
    for a, b in zip((rises - 1).tolist(), falls.tolist(), strict=True):
        family = order[a:b].tolist()
        words = dict(zip(family, left[order[a:b]].tolist(), strict=True))
        for i, j, depth in maximal_pairs(family, shared[a:b].tolist(), words, shortest):
            q = j - i
            stretch = i, q + depth
            if best.get(stretch, q) >= q:
                best[stretch] = q
    for (start, length), q in sorted(best.items()):
        d = int(doc[start])
        found[d].append((start - int(starts[d]), length, q))
    for d in found:
        d.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    kept = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return [w for w, k in zip(words, kept, strict=True) if k]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """Per row: id, n_words, runs (start, length, period; in order of start, then period), collapsed (the words kept, blank-joined)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = bytes_of(batch, "text")
            a = 0
            while a < len(texts):
                words, size, b = [], 0, a
                while b < len(texts) and (size == 0 or size < BATCH_WORDS):
                    words.append(texts[b].split())
                    size, b = size + len(words[-1]), b + 1
                runs = runs_of(words, shortest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), pa.array([len(w) for w in words], pa.int64()),
                     pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], run),
                     pa.array([b" ".join(collapsed(w, r)) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string())],
                    names=["id", "n_words", "runs", "collapsed"],
                )
                a = b
            release()

    return scan(rows, per_task, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
