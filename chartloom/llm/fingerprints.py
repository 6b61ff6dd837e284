"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up into phrases. On each level runs of one symbol become one symbol; deterministic coin tossing (the lowest
bit in which a symbol differs from the one before, and that bit's value, three or four rounds) reduces symbols to a few labels;
local maxima of the labels begin phrases; a phrase is named by a hash of its symbols in order. Whether a phrase begins at a place
depends on a few symbols around it only, so equal substrings are parsed alike but for their margins, at whatever offset they stand.

The fingerprint is the ``SKETCH`` smallest names among the phrases of level ``LEVEL`` and above (about 30 bytes and more each), the
top 32 bits of each as hex. Likeness of two fingerprints estimates the Jaccard similarity of the phrase sets: of the smallest names
of both together, the share that both have. Symbols are bytes of UTF-8. Many texts are parsed at once in flat arrays.

The next document in ascending id is found without moving a text twice: rows are range-partitioned and sorted by id, and a task
passes through its range; only its first and last text meet the neighbouring ranges' in a second, small step.

Defined cases: NULL counts as empty; the empty text has the empty fingerprint, alike 1 to itself and 0 to others; rows are in order
of id (NULL last), then text; a single document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chartloom.llm.common import bytes_of, default_parallelism, mixed, quoted, scan, written

SKETCH, LEVEL = 48, 3
CHUNK_BYTES = 1_000_000


def coins(x: np.ndarray, first: np.ndarray, rounds: int) -> np.ndarray:
    """Labels of symbols that differ from their predecessors; ``first`` are the places where a text begins."""
    for _ in range(rounds):
        before = np.empty_like(x)
        before[1:] = x[:-1]
        before[first] = ~x[first]
        differ = x ^ before
        low = np.bitwise_count((differ & (~differ + differ.dtype.type(1))) - differ.dtype.type(1))  # place of the lowest bit
        x = ((low << 1) | ((x >> low.astype(x.dtype)) & x.dtype.type(1)).astype(np.uint8)).astype(np.uint8)
    return x


def phrases(symbol: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level: names of phrases, and the text of each."""
    new_text = np.r_[True, text[1:] != text[:-1]]
    begin = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1]] | new_text)
    run = np.diff(np.r_[begin, len(symbol)]).astype(np.uint64)
    symbol, text, first = symbol[begin], text[begin], np.flatnonzero(new_text[begin])
    label = coins(symbol, first, 3 if symbol.dtype == np.uint8 else 4).astype(np.int8)
    left, right = np.empty_like(label), np.empty_like(label)
    left[1:], right[:-1] = label[:-1], label[1:]
    left[0], right[-1] = 127, -1
    left[first], right[first[1:] - 1] = 127, -1
    start = (label > left) & (label > right)
    start[first] = True
    at = np.flatnonzero(start)
    place = np.arange(len(symbol), dtype=np.uint64) - np.repeat(at, np.diff(np.r_[at, len(symbol)])).astype(np.uint64)
    parts = symbol.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + run * np.uint64(0xC2B2AE3D27D4EB4F)
    name = mixed(np.add.reduceat(mixed(parts + place * np.uint64(0x165667B19E3779F9)), at))
    return name, text[at]


def sketches(texts: list[bytes]) -> list[np.ndarray]:
    """The fingerprint of every text as sorted 32-bit names."""
    lengths = np.array([len(t) for t in texts])
    symbol, text = np.frombuffer(b"".join(texts), np.uint8), np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    names, owners = [], []
    level = 0
    while len(symbol):
        level += 1
        symbol, text = phrases(symbol, text)
        if level >= LEVEL:
            names.append(symbol)
            owners.append(text)
            # a text is done when it is one phrase
            more = np.bincount(text, minlength=len(texts))[text] > 1
            symbol, text = symbol[more], text[more]
    empty = np.empty(0, np.uint32)
    out = [empty] * len(texts)
    if names:
        name, owner = np.concatenate(names), np.concatenate(owners)
        order = np.lexsort((name, owner))
        name, owner = (name[order] >> np.uint64(32)).astype(np.uint32), owner[order]
        keep = np.r_[True, (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])]
        name, owner = name[keep], owner[keep]
        head = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for a, b in zip(head.tolist(), np.r_[head[1:], len(owner)].tolist(), strict=True):
            out[owner[a]] = name[a : min(b, a + SKETCH)]
    return out


def packed(sketch: np.ndarray) -> bytes:
    return sketch.astype(">u4").tobytes()


def fingerprint(sketch: np.ndarray) -> str:
    return packed(sketch).hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:SKETCH]
    return float((np.isin(both, a) & np.isin(both, b)).sum()) / len(both)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the next document's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_chunks(texts: list[bytes]) -> Iterator[np.ndarray]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > CHUNK_BYTES:
            yield from sketches(texts[start:i])
            start, size = i, 0
        size += len(t)
    yield from sketches(texts[start:])


def compared(ids: list, texts: list[str], following: list[str]) -> list[list]:
    """Columns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    changed = [edited(a, b).encode() for a, b in zip(texts, following, strict=True)]
    own = list(in_chunks([t.encode() for t in texts]))
    # the next text of most rows is the next row's
    other = [t for i, t in enumerate(following) if i + 1 == len(texts) or t is not texts[i + 1]]
    rest = iter(in_chunks([t.encode() for t in other]))
    after = [own[i + 1] if i + 1 < len(texts) and following[i] is texts[i + 1] else next(rest) for i in range(len(texts))]
    turned = list(in_chunks(changed))
    return [
        ids, [len(t) for t in texts], [hashlib.sha256(c).digest() for c in changed], [packed(s) for s in own], [packed(s) for s in turned],
        [likeness(a, b) for a, b in zip(own, turned, strict=True)], [likeness(a, b) for a, b in zip(own, after, strict=True)],
    ]


# digests and fingerprints stay bytes in the written table, which halves it, and become hex in the result
COLUMNS = "id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
KINDS = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All documents of a range but the last, and the first and last text for the neighbours."""
    part = TaskContext.get().partitionId()

    def out(columns: list[list], edge: str | None = None, text: str | None = None) -> pa.RecordBatch:
        n = len(columns[0])
        arrays = [pa.array(c, t) for c, t in zip(columns, KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array([part] * n, pa.int32()), pa.array([edge] * n, pa.string()), pa.array([text] * n, pa.string())],
            names=[*NAMES, "part", "edge", "text"],
        )

    blank = lambda doc: [[doc], *[[None]] * 6]
    last: tuple | None = None
    for batch in batches:
        ids, texts = batch.column("id").to_pylist(), [t.decode() for t in bytes_of(batch, "text")]
        if not ids:
            continue
        if last is None:
            yield out(blank(ids[0]), "first", texts[0])
        else:
            ids, texts = [last[0], *ids], [last[1], *texts]
        last = ids[-1], texts[-1]
        if len(ids) > 1:
            done = compared(ids[:-1], texts[:-1], texts[1:])
            yield out(done)
    if last is not None:
        yield out(blank(last[0]), "last", last[1])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [[] for _ in NAMES]
        texts = [[t.decode() for t in bytes_of(batch, c)] for c in ("text", "following")]
        for doc, text, following in zip(batch.column("id").to_pylist(), *texts, strict=True):
            for column, value in zip(columns, compared([doc], [text], [following]), strict=True):
                column += value
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS, strict=True)], names=NAMES)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness to each other and to the next document."""
    rows = docs.select(quoted(id_col).cast("long").alias("id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_last(), "text"]
    ranged = rows.repartitionByRange(default_parallelism(docs.sparkSession), F.col("id").asc_nulls_last()).sortWithinPartitions(*order)
    done = written(scan(ranged, _ranges, f"{COLUMNS}, part int, edge string, text string"), "fingerprints")
    first = done.filter("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    parts = first.select(F.col("next").alias("part"))
    every = W.orderBy("part")  # one row for each range
    around = parts.withColumns({"next": F.lead("part").over(every), "least": F.min("part").over(W.partitionBy())}).select("part", F.coalesce("next", "least").alias("next"))
    edges = done.filter("edge = 'last'").select("id", "text", "part").join(around, "part").join(first, "next").select("id", "text", "following")
    both = done.filter("edge IS NULL").select(*NAMES).unionByName(scan(edges, _pairs, COLUMNS))
    return both.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint`` of every document."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(s) for s in in_chunks(bytes_of(batch, "text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.string())], names=["id", "fingerprint"])

    kind = dict(docs.dtypes)[id_col]
    return scan(docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text")), per_task, f"id {kind}, fingerprint string")
