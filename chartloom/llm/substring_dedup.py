"""Removing repeated passages with prefix-partitioned suffix trees.

A window is ``length`` consecutive words; every word is removed that lies in a window whose word sequence also starts earlier
(smaller id, or earlier in the same document). Windows are the suffixes of the corpus down to depth ``length``.

1. *Prefixes.* A window's prefix group is named by its anchor, the smallest hash among its runs of ``gram`` words: equal windows
   have equal anchors, and few positions are anchors of any window. Anchors are counted over all documents, folded per task.
2. *Leaves.* A window with an anchor that occurs once is a leaf of its own and needs no tree; the anchors that repeat are marked in
   a table of fixed size. Windows that may repeat are first compared within a task's chunk: all but the earliest of equal windows are
   decided there, so a passage that very many documents share reaches its group once per chunk.
3. *Subtrees.* The remaining windows go to the group of their prefix, as runs of words. The prefix has a variable length: the anchor,
   or the whole window where the anchor is so frequent that its group would not fit in memory. A group sorts its suffixes by prefix
   doubling (ranks of 1, 2, 4, ... words, exact on the words' 48-bit hashes); nodes at depth ``length`` with two or more leaves are
   the repeats, and all leaves but the earliest are removed.
4. Overlapping removed windows merge into maximal repeats when they meet their document again.

Defined cases: NULL and short texts have no window; rows that repeat an id are one document, equal windows at the same place of it
are not earlier than each other; a NULL id counts as the last document, rows with NULL ids share one verdict. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import WordHash, bytes_of, default_parallelism, grams, quoted, scan, written

LENGTH, GRAM = 20, 8
#: Suffix runs in a group, and words in a chunk that is folded by one task.
GROUP_RUNS, CHUNK_WORDS = 20_000, 1_000_000
FILTER_BITS, HOT_BITS = 25, 20
WORD_BYTES = 6
LAST = (1 << 63) - 1


def sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of every ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        x, have = best(x[:-have], x[have:]), have * 2
    return best(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def anchors(g: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor hash of every window, and which positions are an anchor of some window (all of equal value)."""
    low = sliding(g, width, np.minimum)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    return low, sliding(padded, width, np.maximum) == g


def anchor_counts(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, held, size = WordHash(), [], 0

        def fold() -> pa.RecordBatch:
            values, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(count)], names=["anchor", "n"])

        for batch in batches:
            for text in bytes_of(batch, "text"):
                words = text.split()
                if len(words) >= length:
                    g = grams(cache.of(words), gram)
                    held.append(g[anchors(g, length - gram + 1)[1]])
                    size += len(held[-1])
            if size > 500_000:
                yield fold()
                held, size = [], 0
        if held:
            yield fold()

    return scan(rows.select("text"), per_task, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")


def bit_table(values: DataFrame, bits: int) -> np.ndarray:
    """A table of 2**bits bits with those of column ``anchor`` set: one row per 64 bits comes to the driver at most."""
    at = F.col("anchor").bitwiseAND((1 << bits) - 1)
    words = values.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(anchor & {63} as int))")).alias("bits"))
    table = np.zeros(1 << (bits - 6), np.int64)
    found = words.toArrow()
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint8)


def marked(table: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    at = (values & np.uint64((1 << bits) - 1)).astype(np.int64)
    return ((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


RUNS = "part long, doc long, start int, windows int, words binary"


def _runs(length: int, gram: int, live, hot):
    """Runs of windows: with words where the group must decide, without where the chunk has found an earlier one."""
    width = length - gram + 1

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, live_table, hot_table = WordHash(), live.value, hot.value
        docs: list[tuple[int, np.ndarray]] = []
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def fold() -> Iterator[pa.RecordBatch]:
            which, start, part, window = (np.concatenate([h[k] for h in held]) for k in range(4))
            doc = np.array([d for d, _ in docs], np.int64)[which]
            order = np.lexsort((start, doc, window))
            w, d, s = window[order], doc[order], start[order]
            head = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            of = np.repeat(head, np.diff(np.r_[head, len(w)]))
            later = np.empty(len(w), bool)
            later[order] = (d != d[of]) | (s != s[of])
            # consecutive windows of a document with the same verdict and group form a run
            split = np.r_[True, (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1) | (later[1:] != later[:-1]) | ~later[1:] & (part[1:] != part[:-1])]
            first = np.flatnonzero(split)
            count = np.diff(np.r_[first, len(start)])
            words = [
                None if later[i] else docs[which[i]][1][start[i] : start[i] + n + length - 1].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()
                for i, n in zip(first.tolist(), count.tolist(), strict=True)
            ]
            for a in range(0, len(first), 50_000):
                at = first[a : a + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[at].view(np.int64)), pa.array(doc[at]), pa.array(start[at].astype(np.int32)), pa.array(count[a : a + 50_000].astype(np.int32)),
                     pa.array(words[a : a + 50_000], pa.binary())],
                    names=["part", "doc", "start", "windows", "words"],
                )

        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), bytes_of(batch, "text"), strict=True):
                found = text.split()
                if len(found) < length:
                    continue
                h = cache.of(found)
                g = grams(h, gram)
                low = sliding(g, width, np.minimum)
                start = np.flatnonzero(marked(live_table, low, FILTER_BITS))
                if len(start):
                    window = grams(h, length)[start]
                    part = np.where(marked(hot_table, low[start], HOT_BITS), window, low[start])
                    held.append((np.full(len(start), len(docs)), start, part, window))
                    docs.append((doc, h))
                    size += len(h)
                if size > CHUNK_WORDS:
                    yield from fold()
                    docs, held, size = [], [], 0
        if held:
            yield from fold()

    return per_task


def doubled_ranks(x: np.ndarray, length: int) -> np.ndarray:
    """Names of all runs of ``length`` values: equal names, equal values (np.unique at each doubling, no hashing)."""
    _, rank = np.unique(x, return_inverse=True)
    have, done, total = 1, 0, None
    rest = length
    while rest:
        if rest & 1:
            here = rank[done:] if done else rank
            if total is None:
                total = here
            else:
                n = min(len(total), len(here))
                _, total = np.unique(total[:n].astype(np.int64) * (int(here.max()) + 1) + here[:n], return_inverse=True)
            done += have
        rest >>= 1
        if rest:
            _, rank = np.unique(rank[:-have].astype(np.int64) * (int(rank.max()) + 1) + rank[have:], return_inverse=True)
            have *= 2
    return total


def repeated_leaves(doc: np.ndarray, start: np.ndarray, count: np.ndarray, words: list[bytes], length: int) -> np.ndarray:
    """For all windows of the runs in order: whether the subtree has an earlier leaf at their node."""
    raw = np.frombuffer(b"".join(words), np.uint8).reshape(-1, WORD_BYTES)
    values = np.zeros((len(raw), 8), np.uint8)
    values[:, :WORD_BYTES] = raw
    node = doubled_ranks(values.view("<u8").ravel(), length)
    sizes = count + length - 1
    run_at = np.cumsum(sizes) - sizes
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    node, d, s = node[np.repeat(run_at, count) + within], np.repeat(doc, count), np.repeat(start, count) + within
    order = np.lexsort((s, d, node))
    node, d, s = node[order], d[order], s[order]
    head = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    of = np.repeat(head, np.diff(np.r_[head, len(node)]))
    later = np.empty(len(node), bool)
    later[order] = (d != d[of]) | (s != s[of])
    return later


def repeats(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Runs of windows that start earlier elsewhere: doc, start, windows (each of ``length`` words)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(LAST)).alias("doc"), quoted(text_col).cast("string").alias("text"))
    counted = written(anchor_counts(rows, length, gram), "substring-anchors")
    total = counted.agg(F.sum("n")).first()[0] or 0
    live = spark.sparkContext.broadcast(bit_table(counted, FILTER_BITS))
    hot = spark.sparkContext.broadcast(bit_table(counted.filter(F.col("n") > GROUP_RUNS), HOT_BITS))
    groups = max(default_parallelism(spark), -(-total // GROUP_RUNS))

    def subtree(table: pa.Table) -> pa.Table:
        open_runs = table.filter(pc.is_valid(table.column("words")))
        done = table.filter(pc.is_null(table.column("words")))
        doc, start, count = (done.column(c).to_numpy() for c in ("doc", "start", "windows"))
        if open_runs.num_rows:
            d, s, n = (open_runs.column(c).to_numpy() for c in ("doc", "start", "windows"))
            later = repeated_leaves(d, s, n, open_runs.column("words").to_pylist(), length)
            run = np.repeat(np.arange(len(n)), n)
            at = np.flatnonzero(later)
            within = (np.arange(len(later)) - np.repeat(np.cumsum(n) - n, n))[at]
            r = run[at]
            first = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (within[1:] != within[:-1] + 1)]) if len(at) else np.zeros(0, np.int64)
            doc, start = np.r_[doc, d[r[first]]], np.r_[start, s[r[first]] + within[first]]
            count = np.r_[count, np.diff(np.r_[first, len(at)])]
        return pa.table({"doc": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int32()), "windows": pa.array(count, pa.int32())})

    runs = scan(rows, _runs(length, gram, live, hot), RUNS)
    group = F.when(F.col("words").isNull(), F.pmod(F.xxhash64("doc"), F.lit(groups))).otherwise(F.pmod(F.xxhash64("part"), F.lit(groups)))
    return runs.withColumn("group", group).groupBy("group").applyInArrow(subtree, "doc long, start int, windows int")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row: id, n_words, n_removed, spans (removed words as start, end pairs: maximal repeats), kept (the rest, blank-joined)."""
    found = repeats(docs, id_col, text_col, length, gram)
    per_doc = found.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "windows"))).alias("runs"))
    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    joined = rows.join(per_doc, F.coalesce("id", F.lit(LAST)) == F.col("doc"), "left").select(
        "id", "text", F.col("runs.start").alias("starts"), F.col("runs.windows").alias("counts")
    )

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, spans, kept = [], [], [], []
            columns = bytes_of(batch, "text"), batch.column("starts").to_pylist(), batch.column("counts").to_pylist()
            for text, starts, counts in zip(*columns, strict=True):
                words = text.split()
                merged: list[list[int]] = []
                for s, n in zip(starts or (), counts or (), strict=True):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s + n + length - 1)
                    else:
                        merged.append([s, s + n + length - 1])
                size.append(len(words))
                gone.append(sum(b - a for a, b in merged))
                spans.append([x for m in merged for x in m])
                for a, b in reversed(merged):
                    del words[a:b]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.int32())),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "n_removed", "spans", "kept"],
            )

    return scan(joined, per_task, "id long, n_words long, n_removed long, spans array<int>, kept string")
