"""Finding and sanitising personal data: patterns, and terms that reveal what the patterns protect.

*Patterns* (e-mail, IP, card, phone) give the base spans, found left to right without overlap in linear time.

*Terms.* A protected entity is a value found by a pattern, the domain of an address, or a kind of value: values pool into the other
two. For a term t within ``CONTEXT`` words of an entity e the corpus tells how likely e is where t stands: of n(t) documents with t,
n(t, e) show it beside e, in c different contexts (copies of one text are one). With p(e) = n(e) / n and a weight ``PRIOR`` for what is
known without t,

    p(e | t) = (c * n(t, e) / n(t) + PRIOR * p(e)) / (c + PRIOR),    PMI(t; e) = log2(p(e | t) / p(e)),    IC(e) = -log2 p(e).

A term discloses e when it leaves at most ``GENERALISE`` bits of IC(e): IC(e) - PMI(t; e) <= GENERALISE. It is then generalised, wherever
it occurs; at ``REMOVE`` bits or less it is removed. The prior asks for more contexts the rarer a term is beside e; one context alone is
chance and never counts. The bound is in bits left, so it does not depend on the size of the corpus.

1. One scan finds the base spans of all documents and the terms beside them; pairs of entity and term are counted.
2. A second scan counts the documents of the terms that are left, folded per task: no occurrence leaves a task.
3. A third scan gives the places of the disclosing terms, one row for a document that has any. They are few by their definition: most
   documents with such a term have its entity. Without candidates or disclosing terms the later scans are left out.

In both scans a table of fixed size passes over other words; exact joins on the term follow.

Defined cases: NULL counts as empty; repeated rows have equal spans; a NULL id is a document like others; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import bytes_of, quoted, scan, text_of, written

KINDS = ("email", "ip", "card", "phone")
CONTEXT, PRIOR, GENERALISE, REMOVE = 10, 0.5, 0.5, 0.1
FILTER_BITS = 1 << 22

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TERM = re.compile(r"[^\W\d_](?:[\w'’-]*\w)?")


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """kind, start, end in code points; by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and m.end() - m.start() <= 38:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def hash_of(text: str) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), seed=42)).astype(np.int64))


def terms(text: str, start: int = 0, end: int | None = None) -> Iterator[tuple[str, int, int]]:
    """Terms in lower case with their place: the word-like part of a word, three letters or more."""
    for m in _TERM.finditer(text, start, len(text) if end is None else end):
        if m.end() - m.start() >= 3:
            yield m[0].lower(), m.start(), m.end()


def entities(kind: str, value: str) -> list[str]:
    """What a value stands for: itself, its kind, and the domain of an address."""
    return [f"value:{kind}:{value}", f"kind:{kind}", *([f"domain:{value.rpartition('@')[2].lower()}"] if kind == "email" else [])]


def contexts(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[list[int], int, list[str]]]:
    """Entities, context (hashed) and terms of the words near each base span; words with digits or addresses give no terms."""
    words = [m.span() for m in _WORD.finditer(text)] if spans else []
    starts, ends = [a for a, _ in words], [b for _, b in words]
    for kind, a, b in spans:
        before, after = bisect_right(ends, a), bisect_left(starts, b)
        near = [text[p:q] for p, q in (*words[max(0, before - CONTEXT) : before], *words[after : after + CONTEXT])]
        found = sorted({t for w in near if "@" not in w and not _DIGIT.search(w) for t, _, _ in terms(w)})
        yield [hash_of(e) for e in entities(kind, text[a:b])], hash_of("\n".join(found)), found


BASE = "id long, mark long, n_email long, n_ip long, n_card long, n_phone long, base string, near array<struct<entities:array<bigint>,context:bigint,terms:array<string>>>"


def found(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows (id, mark, text), and the written table of their base spans; ``mark`` tells texts of one id apart."""
    rows = docs.select(quoted(id_col).cast("long").alias("id"), text_of(f"`{text_col}`").alias("text")).withColumn("mark", F.xxhash64("text"))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entity = pa.list_(pa.struct([("entities", pa.list_(pa.int64())), ("context", pa.int64()), ("terms", pa.list_(pa.string()))]))
        for batch in batches:
            counts, base, near = [[] for _ in KINDS], [], []
            for raw in bytes_of(batch, "text"):
                text = raw.decode()
                spans = base_spans(text)
                for kind, column in zip(KINDS, counts, strict=True):
                    column.append(sum(s[0] == kind for s in spans))
                base.append(joined(spans))
                near.append([{"entities": e, "context": c, "terms": t} for e, c, t in contexts(text, spans)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(near, entity)],
                names=["id", "mark", *(f"n_{k}" for k in KINDS), "base", "near"],
            )

    return rows, written(scan(rows, per_task, BASE), "pii-base")


def filter_table(candidates: DataFrame) -> np.ndarray:
    """Bits of a table of fixed size, by hash of the terms."""
    at = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS))
    words = candidates.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(term), {FILTER_BITS}) & 63 as int))")).alias("bits"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    got = words.toArrow()  # one row per 64 bits of the fixed table at most
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return table.view(np.uint8)


class Passing(dict):
    """The terms of a word that pass the table; remembers the words of a task, up to a bound."""

    LIMIT = 300_000

    def __init__(self, bits: np.ndarray) -> None:
        super().__init__()
        self.bits = bits.tobytes()

    def __missing__(self, word: bytes) -> tuple[str, ...]:
        if len(self) >= self.LIMIT:
            self.clear()
        out = []
        for t, _, _ in terms(word.decode()):
            i = hash_of(t) % FILTER_BITS
            if self.bits[i >> 3] >> (i & 7) & 1:
                out.append(t)
        self[word] = found = tuple(out)
        return found


def document_counts(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """``term, n_t``: how many rows have each candidate term."""
    shared = rows.sparkSession.sparkContext.broadcast(filter_table(candidates))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing, counts = Passing(shared.value), Counter()

        def folded() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n_t"])

        for batch in batches:
            for raw in bytes_of(batch, "text"):
                counts.update({t for w in set(raw.split()) for t in passing[w]})
            if len(counts) > 300_000:
                yield folded()
                counts.clear()
        yield folded()

    counted = scan(rows.select("text"), per_task, "term string, n_t long").groupBy("term").agg(F.sum("n_t").alias("n_t"))
    return counted.join(candidates.select("term"), "term", "left_semi")


def places_of(rows: DataFrame, strong: DataFrame) -> DataFrame:
    """``id, mark, term, start, end, bits`` of the disclosing terms in all texts."""
    shared = rows.sparkSession.sparkContext.broadcast(filter_table(strong))
    place = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = Passing(shared.value)
        for batch in batches:
            at, found = [], []
            for k, raw in enumerate(bytes_of(batch, "text")):
                if any([passing[w] for w in set(raw.split())]):
                    text = raw.decode()
                    here = [
                        {"term": t, "start": a, "end": b}
                        for m in _WORD.finditer(text) if (hits := passing[m[0].encode()])
                        for t, a, b in terms(text, *m.span()) if t in hits
                    ]
                    at.append(k)
                    found.append(here)
            picked = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(picked), batch.column("mark").take(picked), pa.array(found, place)], names=["id", "mark", "places"])

    found = scan(rows, per_task, "id long, mark long, places array<struct<term:string,start:int,end:int>>")
    return found.select("id", "mark", F.inline("places")).join(strong, "term")


def disclosing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE, prior: float = PRIOR):
    """The base table, and the places of disclosing terms (id, mark, term, start, end, bits; distinct) or None if there are none.

    ``bits``: what the term leaves of the information of the entity it discloses most.
    """
    rows, base = found(docs, id_col, text_col)
    seen = base.select("id", "mark", F.inline("near")).select("id", "mark", "context", F.explode("entities").alias("entity"), "terms")
    document = F.struct("id", "mark")
    n = base.count()
    n_e = seen.groupBy("entity").agg(F.count_distinct(document).alias("n_e"))
    # one row per context first, so that thousands of copies of a text are folded before they are counted
    beside = seen.select("id", "mark", "context", "entity", F.explode("terms").alias("term"))
    per_context = beside.groupBy("entity", "term", "context").agg(F.count_distinct(document).alias("n"))
    pairs = per_context.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n_te")).filter("c > 1")
    pairs = written(pairs.join(n_e, "entity"), "pii-pairs")
    if pairs.isEmpty():
        return base, None
    n_t = document_counts(rows, pairs.select("term").distinct())
    p_e = F.col("n_e") / F.lit(n)
    p = (F.col("c") * F.least(F.lit(1.0), F.col("n_te") / F.col("n_t")) + F.lit(prior) * p_e) / (F.col("c") + F.lit(prior))
    # an entity that half of all documents have is nothing to disclose
    measured = pairs.join(n_t, "term").filter(p_e <= 0.5).withColumn("bits", -F.log2(p)).filter((F.col("bits") <= generalise) & (p > p_e))
    strong = written(measured.groupBy("term").agg(F.min("bits").alias("bits")), "pii-strong")
    if strong.isEmpty():
        return base, None
    return base, written(places_of(rows, strong).distinct(), "pii-places")


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE) -> DataFrame:
    """Per row: id, n_email, n_ip, n_card, n_phone, base (spans of the patterns), spans (all of them, terms last)."""
    base, places = disclosing(docs, id_col, text_col, generalise)
    columns = ["id", *(f"n_{k}" for k in KINDS), "base"]
    if places is None:
        return base.select(*columns, F.col("base").alias("spans"))
    per_doc = places.groupBy("id", "mark").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("t"))
    more = per_doc.select(
        F.col("id").alias("__id"), F.col("mark").alias("__mark"),
        F.array_join(F.transform("t", lambda s: F.concat(F.lit("term:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",").alias("more"),
    )
    both = base.join(more, F.col("id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")), "left")
    return both.select(*columns, F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "more").alias("spans"))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``id, text``: base spans replaced by their kind, disclosing terms by ``[TERM]`` or, at ``remove`` bits left, by nothing."""
    base, places = disclosing(docs, id_col, text_col, generalise)
    rows = docs.select(quoted(id_col).cast("long").alias("id"), text_of(f"`{text_col}`").alias("text")).withColumn("mark", F.xxhash64("text"))
    cuts = base.filter("base <> ''").select("id", "mark", "base").distinct()
    if places is not None:
        per_doc = places.groupBy("id", "mark").agg(F.array_join(F.collect_set(F.concat_ws(
            ":", F.when(F.col("bits") <= remove, "remove").otherwise("term"), F.col("start").cast("string"), F.col("end").cast("string")
        )), ",").alias("base"))
        cuts = cuts.unionByName(per_doc).groupBy("id", "mark").agg(F.array_join(F.collect_list("base"), ",").alias("base"))
    cuts = cuts.select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), "base")
    both = rows.join(cuts, F.col("id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")), "left").select("id", "text", "base")

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, marks in zip(bytes_of(batch, "text"), batch.column("base").to_pylist(), strict=True):
                text, done, pieces = raw.decode(), 0, []
                spans = sorted((int(a), -int(b), k) for k, a, b in (s.split(":") for s in marks.split(","))) if marks else []
                for a, b, kind in spans:
                    if a >= done:
                        pieces += [text[done:a], "" if kind == "remove" else f"[{kind.upper()}]"]
                        done = -b
                out.append("".join([*pieces, text[done:]]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], names=["id", "text"])

    return scan(both, per_task, "id long, text string")

