"""The corpus operators bound to the benchmark tables, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import (
    exact_dedup, fingerprints, hmm_lm, language_id, licenses, mixing, ngram_join, packing, periodic_runs, pii, substring_dedup, warc, whitening,
)
from chartloom.llm.common import SPACE

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, table: str = "documents"):
    def register(fn: Callable[[DataFrame], DataFrame]):
        LLM_QUERIES[name] = lambda spark, folder: fn(spark.read.parquet(f"{folder}/{table}.parquet"))
        if sql:
            LLM_SQL[name] = sql
        return fn

    return register


def remainder(modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op1_exact_dedup", f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, {NORMAL} AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER g = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm ORDER BY n DESC, doc_id)
""")
def op1(docs: DataFrame) -> DataFrame:
    return exact_dedup.exact_dedup(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


@query("op2_hmm_lm")
def op2(docs: DataFrame) -> DataFrame:
    return hmm_lm.lm_scores(docs, remainder(7) != 2).select(
        F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op3_language_id")
def op3(docs: DataFrame) -> DataFrame:
    held_out = remainder(3) == 1
    model = language_id.fit(language_id.training_rows(docs, ~held_out, "doc_id", "text", "lang"))
    rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").alias("__text"))
    return language_id.predict(rows, model)


@query("op4_mixing", f"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total,
        coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
c AS (SELECT *, (total - before) * w > cap * rest AS capped FROM o),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
        (w * (total - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0)))::DOUBLE / (sum(w) FILTER (WHERE NOT capped) OVER ())::DOUBLE END AS target FROM c),
r AS (SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size::DOUBLE END AS rate FROM t)
SELECT d.doc_id, d.size, r.source_size::BIGINT AS source_size, r.target,
       d.size * (floor(rate)::BIGINT + CASE WHEN ('0x' || substr(sha256('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0
                                             < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
""")
def op4(docs: DataFrame) -> DataFrame:
    return mixing.mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op5_substring_dedup", f"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM s) WHERE k > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
k AS (SELECT p.doc_id, count(c.i) AS n_removed, string_agg(p.word, ' ' ORDER BY p.i) FILTER (WHERE c.i IS NULL) AS kept
      FROM p LEFT JOIN c ON c.doc_id = p.doc_id AND c.i = p.i GROUP BY p.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
""")
def op5(docs: DataFrame) -> DataFrame:
    return substring_dedup.without_repeats(docs).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op6_pii")
def op6(docs: DataFrame) -> DataFrame:
    return pii.pii_spans(docs).select(
        F.col("id").alias("doc_id"), *(f"n_{k}" for k in pii.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@query("op7_licenses")
def op7(docs: DataFrame) -> DataFrame:
    return licenses.licenses(docs).withColumnRenamed("id", "doc_id")


@query("op8_fingerprints")
def op8(docs: DataFrame) -> DataFrame:
    return fingerprints.with_next(docs).withColumnRenamed("id", "doc_id")


@query("op9_ngram_join", f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
c(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, c.r FROM c JOIN e ON e.a = c.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(r) FROM c WHERE c.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
""")
def op9(docs: DataFrame) -> DataFrame:
    return ngram_join.ngram_join(docs).select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id")
    )


@query("op10_packing")
def op10(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, packing.default_tokenizer())
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op11_whitening", table="embeddings")
def op11(vectors: DataFrame) -> DataFrame:
    return whitening.whiten(vectors).withColumnRenamed("id", "vec_id")


def with_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by hash of the id, with a periodic tail in place of their last words."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.filter(F.split("text", SPACE), lambda w: w != ""))  # others are not cut at all
    cut = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), words.alias("w")).withColumn("n", F.coalesce(F.size("w"), F.lit(0)))
    start = F.col("g") % F.col("n")
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    tail = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.col("w")[F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")])
    planted = cut.withColumn("a", F.when(F.col("n") > 0, start)).withColumn("p", period)
    return planted.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(docs: DataFrame) -> DataFrame:
    found = periodic_runs.periodic_runs(with_periods(docs))
    # least by (-length, start, period): the longest run, ties by start and period
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"),
        F.col("best.q").alias("period"), F.floor(F.lit(-1000) * F.col("best.l") / F.col("best.q")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


DIGIT32 = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, {at}, 5))::BIGINT >> {shift}) & 31) + 1)::INTEGER, 1)"
BASE32 = " || ".join(DIGIT32.format(at=1 + 5 * k, shift=shift) for k in range(8) for shift in (15, 10, 5, 0))


@query("op13_warc", f"""
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, {BASE32} AS payload_digest, max(page_id) OVER (PARTITION BY h) AS original FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM b
""", table="pages")
def op13(pages: DataFrame) -> DataFrame:
    return warc.deduplicated(pages).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
