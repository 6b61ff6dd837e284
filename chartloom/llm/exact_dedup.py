"""Exact de-duplication through an extendible-hash index on shared files.

Texts are compared after white space is deleted. The index is built in three steps:

1. *Entries.* One scan hashes every text to a 64-bit key and writes narrow entries (id, key, digest, size) to shared files.
2. *Directory.* Key prefixes of ``depth`` bits are the slots. While a bucket holds more than ``capacity`` distinct keys, the
   directory doubles (one bit more) and the overfull bucket splits; a bucket keeps the first depth at which it fits, so several
   slots may point to one bucket. Copies of a text are one key, so a hot group never overfills a bucket.
3. *Owners.* Texts go to the owner of their slot, copies folded where they are read; an owner compares the bytes of texts with
   equal keys and chains those that differ. The links are range-partitioned by slot and key, numbered within their chain and
   written as index files.

Every entry then finds its link by key and digest. Only narrow rows are joined; a hot key is split by the adaptive skew join.

Defined cases: a NULL text counts as empty, empty texts are copies of each other; of rows alike in text, size and id exactly one
stays; a NULL id ranks last; an empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chartloom.llm.common import SPACE, quoted, text_of, unused, written

#: Distinct keys in a bucket.
CAPACITY = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, "")


def hash_key(norm: Column, key_bits: int) -> Column:
    """The leading ``key_bits`` bits of a 64-bit hash, the rest zero."""
    h = F.xxhash64(norm)
    return h if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(h, 64 - key_bits), 64 - key_bits)


def slot_of(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY, key_bits: int = 64) -> tuple[int, DataFrame]:
    """Global depth, and the table (slot, local_depth, bucket) of the slots in use.

    ``keys``: distinct ``key``. The first depth is the one at which equal buckets would be full; each further round doubles the
    directory. Keys that agree in all ``key_bits`` stay in one overfull bucket.
    """
    n = keys.count()
    first = max(0, min(key_bits, math.ceil(math.log2(max(1, n) / capacity)))) if n > capacity else 0
    depth = first
    while depth < key_bits:
        load = keys.groupBy(slot_of(F.col("key"), depth).alias("slot")).count()
        if load.filter(F.col("count") > capacity).isEmpty():
            break
        depth += 1
    slots = keys.groupBy(slot_of(F.col("key"), depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    local = F.lit(depth)
    for d in range(depth - 1, first - 1, -1):
        load = F.sum("n").over(W.partitionBy(F.shiftrightunsigned("slot", depth - d)))
        slots = slots.withColumn(f"load_{d}", load)
        local = F.when(F.col(f"load_{d}") <= capacity, d).otherwise(local)
    slots = slots.select("slot", local.cast("int").alias("local_depth"))
    return depth, slots.withColumn("bucket", F.expr(f"shiftrightunsigned(slot, {depth} - local_depth)"))


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, key_bits: int = 64
) -> tuple[DataFrame, DataFrame]:
    """Entries (one per row) and index links (one per distinct text), both as written tables.

    Entries: id, uid, key, digest, n_chars. Links: bucket, local_depth, slot, key, digest, link (place in the chain of its key),
    copies.
    """
    rows = docs.select(quoted(id_col).alias("id"), text_of(f"`{text_col}`").alias("text"))
    norm = normalised(F.col("text"))
    entries = written(
        rows.select("id", F.length("text").alias("n_chars"), norm.alias("norm"))
        .select("id", "n_chars", hash_key(F.col("norm"), key_bits).alias("key"), F.sha2("norm", 256).alias("digest"))
        .withColumn("uid", F.monotonically_increasing_id()),
        "dedup-entries",
    )
    keys = written(entries.select("key").distinct(), "dedup-keys")
    depth, slots = directory(keys, capacity, key_bits)
    owned = (
        rows.select(norm.alias("norm"))
        .select(hash_key(F.col("norm"), key_bits).alias("key"), "norm")
        .groupBy(slot_of(F.col("key"), depth).alias("slot"), "key", "norm")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("slot", "key", F.sha2("norm", 256).alias("digest"), "copies")
    )
    links = (
        owned.join(slots, "slot")
        .repartitionByRange("slot", "key")
        .withColumn("link", F.row_number().over(W.partitionBy("slot", "key").orderBy("digest")))
    )
    return entries, written(links.select("bucket", "local_depth", "slot", "key", "digest", "link", "copies"), "dedup-index")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, key_bits: int = 64
) -> DataFrame:
    """Every row with the row that stays of its group: id, uid, keep_id, group_size, kept, digest, key, link.

    ``uid`` tells rows apart that agree in id and text; ``link`` is the place in the chain of the key.
    """
    entries, index = build_index(docs, id_col, text_col, capacity, key_bits)
    rank = F.struct(-F.col("n_chars"), F.col("id").isNull(), F.col("id"), F.col("uid"))
    best = entries.groupBy("key", "digest").agg(F.min(rank).alias("best"))
    groups = index.join(best, ["key", "digest"]).select(
        "key", "digest", "link", F.col("copies").alias("group_size"), F.col("best.id").alias("keep_id"), F.col("best.uid").alias("keep_uid")
    )
    return entries.join(groups, ["key", "digest"]).select(
        "id", "uid", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "digest", "key", "link"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows that stay, with all their columns.

    Ids name documents; where an id is repeated, its rows are told apart by their digest, and of full repeats one stays.
    """
    decided = exact_dedup(docs, id_col, text_col, capacity)
    i, digest, own, size, n = (unused(docs, c) for c in ("__id", "__digest", "__own", "__len", "__n"))
    stays = decided.filter("kept").select(F.col("id").alias(i), F.col("digest").alias(digest))
    marked = docs.withColumns({own: F.sha2(normalised(text_of(f"`{text_col}`")), 256), size: F.length(text_of(f"`{text_col}`"))})
    found = marked.join(stays, quoted(id_col).eqNullSafe(F.col(i)) & (F.col(own) == F.col(digest)), "left_semi")
    repeated = W.partitionBy(quoted(id_col), own).orderBy(F.col(size).desc())
    return found.withColumn(n, F.row_number().over(repeated)).filter(F.col(n) == 1).select(*[quoted(c) for c in docs.columns])
