"""Jaccard join of n-gram sets by prefix trees.

Every document is the set of its n-word shingles, held as 64-bit hashes. All sets are ordered by one global order, rarest first:
estimated frequency (from the counts of their words and of themselves, kept in tables of fixed size that cover all documents),
then the hash. Two sets that link must share one of their first ``n - ceil(t n) + 1`` shingles, whatever the total order is, so
the quality of the estimate decides the cost and never the result.

1. Documents with equal sets are one class, represented by its smallest id.
2. Representatives that hold a common prefix shingle are candidates if their sizes and profiles (counts of shingles in 128 parts by
   hash, whose difference is a lower bound of the sets' difference) allow a link. Candidates form clusters, connected components of
   narrow rows; all other documents are done.
   The sets of a cluster of more than one block are clustered again: the holders of its shingles are counted exactly, sets that share
   too few of theirs with others are done, and the prefixes of the rest follow the order of those counts.
3. A cluster's sets are stored in a trie, ordered so that what most of them share comes first. A set is looked up before it is
   inserted: the walk shares the overlap along common paths, leaves a subtree when overlap plus what remains of the shorter side
   cannot reach the required overlap, and when the subtree's documents are already in the component of the set.
4. A cluster of more than ``block`` sets is cut into blocks. First each block is joined with itself and the next one: that is
   linear, and puts near copies into one component. What is not in the cluster's main component then is joined with all blocks.

Links found are a spanning forest of all links; components of them are the result. A trie holds two blocks at most.

Defined cases: NULL and blank texts have an empty set and link with nothing; fewer than n words are one shingle; repeated rows and
ids are one class, or linked by their equal sets; a NULL id takes part in no link (component NULL). An empty table gives an empty
result. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chartloom.llm.common import WordHash, bytes_of, grams, mixed, quoted, release, scan, unused, written
from chartloom.llm.graph import Forest, components

#: Share of the union that linked sets have in common, as a fraction.
THRESHOLD = (9, 10)
WORD_BITS, GRAM_BITS, TABLE_BLOCK_BITS = 22, 20, 16
#: Sets, and shingles of all its sets, in a block.
BLOCK, BLOCK_SHINGLES = 1000, 400_000
#: A set's profile counts its shingles in so many parts by hash; rows of postings in a group.
PROFILE_BITS, POSTINGS = 7, 50_000
#: Shingles whose holders are counted together.
COUNT_SHINGLES = 1_000_000


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case; bytes know no other case."""
    return text.lower().split()


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all shingles in text order; a shorter text is one shingle."""
    if 0 < len(hashes) < n:
        return mixed(grams(hashes, len(hashes)) + np.uint64(len(hashes)))
    return grams(hashes, n)


def need(size: int, t: tuple[int, int] = THRESHOLD) -> int:
    """The smallest overlap that a set of this size has with any set it links to: ceil(t * size)."""
    return -(-size * t[0] // t[1])


def need_both(a: int, b: int, t: tuple[int, int] = THRESHOLD) -> int:
    """The smallest overlap with which sets of these sizes link: i / (a + b - i) >= t."""
    return -(-(a + b) * t[0] // (t[0] + t[1]))


def frequency_tables(docs: DataFrame, n: int, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of words and of shingles of all documents by hash, in tables of fixed size (16 MB and 4 MB)."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, tables = WordHash(), [np.zeros(1 << WORD_BITS, np.int64), np.zeros(1 << GRAM_BITS, np.int64)]
        held: list[list[np.ndarray]] = [[], []]

        def add() -> None:
            for table, values, bits in zip(tables, held, (WORD_BITS, GRAM_BITS), strict=True):
                if values:
                    table += np.bincount((np.concatenate(values) >> np.uint64(64 - bits)).astype(np.int64), minlength=len(table))
                values.clear()

        size = 0
        for batch in batches:
            for text in bytes_of(batch, "text"):
                if len(h := hashes.of(words_of(text))):
                    held[0].append(h)
                    held[1].append(shingles(h, n))
                    size += len(h)
            if size > 500_000:
                add()
                size = 0
        add()
        for k, table in enumerate(tables):
            for b in range(len(table) >> TABLE_BLOCK_BITS):
                part = table[b << TABLE_BLOCK_BITS : (b + 1) << TABLE_BLOCK_BITS]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([1000 * k + b], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["part", "counts"]
                    )

    def add(key, rows):
        total = np.zeros(1 << TABLE_BLOCK_BITS, np.int64)
        for blob in rows.column("counts"):
            total += np.frombuffer(zlib.decompress(blob.as_py()), "<i8")
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    rows = scan(docs.select(quoted(text_col).cast("string").alias("text")), per_task, "part int, counts binary")
    sums = rows.groupBy("part").applyInArrow(add, "part int, counts binary").collect()
    out = [np.zeros(1 << WORD_BITS, np.float32), np.zeros(1 << GRAM_BITS, np.float32)]
    for r in sums:
        k, b = divmod(r["part"], 1000)
        out[k][b << TABLE_BLOCK_BITS : (b + 1) << TABLE_BLOCK_BITS] = np.frombuffer(zlib.decompress(r["counts"]), "<i8")
    total, grams_total = max(1.0, float(out[0].sum())), float(out[1].mean())
    # log2 of the share of a word; of a shingle's counter only what stands out of the mean load tells something
    return np.log2((out[0] + 0.5) / total).astype(np.float16), np.log2(1 + np.maximum(0, out[1] - grams_total - 4 * np.sqrt(grams_total + 1))).astype(np.float16)


def profile_of(s: np.ndarray) -> bytes:
    return np.minimum(np.bincount((s >> np.uint64(64 - PROFILE_BITS)).astype(np.int64), minlength=1 << PROFILE_BITS), 255).astype(np.uint8).tobytes()


def ordered_set(hashes: np.ndarray, n: int, word_table: np.ndarray, gram_table: np.ndarray) -> np.ndarray:
    """The set, rarest first; the key of a shingle depends on its words alone."""
    g = shingles(hashes, n)
    w = word_table[(hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)].astype(np.float32)
    key = w[: len(g)].copy() if len(hashes) >= n else w[:1].copy()
    if len(hashes) >= n:
        for k in range(1, n):
            key += w[k : k + len(g)]
    g, first = np.unique(g, return_index=True)
    seen = gram_table[(g >> np.uint64(64 - GRAM_BITS)).astype(np.int64)].astype(np.float32)
    return g[np.lexsort((g, key[first], seen))]


def sets(docs: DataFrame, n: int, tables, t: tuple[int, int], with_set: bool, marks=None) -> DataFrame:
    """``id, text`` (with ``marks``, a broadcast bit table: also ``at``, rows without their bit, and ids that the task had before, are left out) → id, size, signature (16 bytes of a digest), profile, prefix or the whole ordered set as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, (word_table, gram_table), seen = WordHash(), shared.value, set()
        for batch in batches:
            if marks is not None:
                pos = batch.column("at").to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(((marks.value[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1).astype(bool)))
                # rows that repeat an id are folded where they are read
                batch = batch.filter(pa.array([not (i in seen or seen.add(i)) for i in batch.column("id").to_pylist()], pa.bool_()))
            size, sign, profile, blob = [], [], [], []
            for text in bytes_of(batch, "text"):
                hashes = cache.of(words_of(text))
                s = ordered_set(hashes, n, word_table, gram_table) if len(hashes) else np.empty(0, np.uint64)
                size.append(len(s))
                profile.append(profile_of(s))
                sign.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                if with_set:
                    blob.append(s.astype("<u8").tobytes())
                else:
                    blob.append(s[: len(s) - need(len(s), t) + 1].view(np.int64).tolist() if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(size, pa.int64()), pa.array(sign, pa.binary()), pa.array(profile, pa.binary()), pa.array(blob, pa.binary() if with_set else pa.list_(pa.int64()))],
                names=["id", "size", "signature", "profile", "grams"],
            )

    return scan(docs, per_task, f"id long, size long, signature binary, profile binary, grams {'binary' if with_set else 'array<long>'}")


class Trie:
    """Ordered sets with shared beginnings; answers which stored sets link with a given one, save those of its own component."""

    __slots__ = ("t", "forest", "root")  # segments are arrays of 32-bit ranks

    def __init__(self, t: tuple[int, int], forest: Forest):
        # a node: [tokens, children by first token, sets that end here, smallest size, largest size, a document, mixed]
        self.t, self.forest, self.root = t, forest, [array("i"), {}, [], 1 << 60, 0, None, False]

    def insert(self, tokens: array, doc: int) -> None:
        node, at, size, find = self.root, 0, len(tokens), self.forest.find
        while True:
            node[3], node[4] = min(node[3], size), max(node[4], size)
            if node[5] is None:
                node[5] = doc
            elif not node[6] and find(node[5]) != find(doc):
                node[6] = True
            if at == size:
                node[2].append(doc)
                return
            child = node[1].get(tokens[at])
            if child is None:
                node[1][tokens[at]] = [tokens[at:], {}, [doc], size, size, doc, False]
                return
            seg, k = child[0], 1
            while k < len(seg) and at + k < size and seg[k] == tokens[at + k]:
                k += 1
            if k < len(seg):  # the paths part within the segment
                upper = [seg[:k], {seg[k]: child}, [], child[3], child[4], child[5], child[6]]
                child[0] = seg[k:]
                node[1][seg[0]] = upper
                child = upper
            node, at = child, at + k

    def links(self, tokens: array, doc: int) -> Iterator[int]:
        """Documents of other components that link; the caller unites them, which prunes what is left of the walk."""
        size, t, find, rank = len(tokens), self.t, self.forest.find, {x: i for i, x in enumerate(tokens)}
        stack = [(c, 0, 0, 0) for c in self.root[1].values()]
        while stack:
            node, depth, passed, overlap = stack.pop()
            if not node[6] and find(node[5]) == find(doc):
                continue
            if need(size, t) > node[4] or need(node[3], t) > size:
                continue
            least = need_both(max(node[3], need(size, t)), size, t)
            for x in node[0]:
                depth += 1
                i = rank.get(x)
                if i is not None:
                    overlap += 1
                    passed = i + 1  # tokens of the set before this one can't come later on the path
                elif overlap + min(node[4] - depth, size - passed) < least:
                    break
            else:
                if overlap + min(node[4] - depth, size - passed) < least:
                    continue
                for other in node[2]:
                    if overlap >= need_both(depth, size, t) and find(other) != find(doc):
                        yield other
                stack.extend((c, depth, passed, overlap) for c in node[1].values())


def trie_links(ids: list[int], members: list[np.ndarray], sides: list[int], t: tuple[int, int]) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets; side 1 sets are only stored, side 2 only looked up, side 0 both."""
    if not ids:
        return []
    flat, where = np.concatenate(members), np.cumsum([0, *map(len, members)])
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.empty(len(count), np.int64)
    order[np.argsort(-count, kind="stable")] = np.arange(len(count))
    ranks = order[inverse]
    del flat, inverse, count, order
    forest, found = Forest(), []
    trie = Trie(t, forest)
    for k in sorted(range(len(ids)), key=lambda k: (sides[k] == 2, len(members[k]), ids[k])):
        tokens = array("i", np.sort(ranks[where[k] : where[k + 1]]).astype(np.int32).tobytes())
        if sides[k] != 1:
            for other in trie.links(tokens, ids[k]):
                if forest.union(other, ids[k]):
                    found.append((other, ids[k]))
        if sides[k] != 2:
            trie.insert(tokens, ids[k])
    return found


def join_groups(rows: DataFrame, t: tuple[int, int]) -> DataFrame:
    """``task columns g1, g2, g3; id, grams, side`` → links a, b of every group. Of an id that comes more than once on a side, the
    smallest set (as bytes) takes part."""

    def per_group(rows):
        ids, sides, sets = (rows.column(c).to_pylist() for c in ("id", "side", "grams"))
        one: dict[tuple[int, int], int] = {}
        for k, key in enumerate(zip(ids, sides, strict=True)):
            if key not in one or sets[k] < sets[one[key]]:
                one[key] = k
        members = [np.frombuffer(sets[k], "<u8") for k in one.values()]
        found = trie_links([i for i, _ in one], members, [side for _, side in one], t)
        if sum(map(len, members)) > BLOCK_SHINGLES // 4:
            release()
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return rows.groupBy("g1", "g2", "g3").applyInArrow(per_group, "a long, b long")


def classes(docs: DataFrame, n: int, t: tuple[int, int], id_col: str, text_col: str):
    """A written table of every row's set class (with a row number), and the tables of the global order."""
    tables = frequency_tables(docs, n, text_col)
    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    return written(sets(rows, n, tables, t, False).withColumn("row", F.monotonically_increasing_id()), "join-sets"), tables, rows


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, threshold: tuple[int, int] = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """Per row: id, size (of its set), component (smallest id reachable by links)."""
    found, tables, rows = classes(docs, n, threshold, id_col, text_col)
    filled = found.filter("size > 0 AND id IS NOT NULL")
    named = filled.groupBy("signature", "size").agg(F.min(F.struct("id", "row")).alias("of"))
    named = written(named.select("signature", "size", F.col("of.id").alias("rep"), F.col("of.row").alias("first")), "join-classes")
    # only the numbers of the other rows move, mostly few and then broadcast: prefixes and profiles stay in place
    others = written(filled.join(named, ["signature", "size"]).filter("row <> first").select("row"), "join-copies")
    reps = filled.join(others, "row", "left_anti").select("size", F.col("id").alias("rep"), "grams", "profile")
    links = cluster_links(reps, rows, tables, n, threshold, block)
    parts = written(components(links), "join-components")
    named = named.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("signature", "size", F.coalesce("component", "rep").alias("component"))
    small = found.select("id", "size", "signature").join(named, ["signature", "size"], "left")
    return small.select("id", "size", F.coalesce("component", "id").alias("component"))


def plausible_pairs(gram: np.ndarray, rep: np.ndarray, size: np.ndarray, profile: np.ndarray, side: np.ndarray, t: tuple[int, int]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that share a shingle and may link by size and profile.

    The difference of two profiles is no more than the sets' symmetric difference, so no pair that links is left out.
    """
    order = np.lexsort((rep, size, gram))
    gram, rep, size, profile, side = gram[order], rep[order], size[order], profile[order].astype(np.int16), side[order]
    forest, found, at, step = Forest(), [], np.arange(len(gram)), 1
    while True:
        at = at[at + step < len(gram)]
        at = at[gram[at] == gram[at + step]]
        # sizes ascend within a shingle: once too large, all later ones are
        at = at[-(-size[at + step] * t[0] // t[1]) <= size[at]]
        if not len(at):
            return found
        for i in range(0, len(at), 200_000):
            a = at[i : i + 200_000]
            b = a + step
            most = size[a] + size[b] - 2 * -(-(size[a] + size[b]) * t[0] // (t[0] + t[1]))
            ok = (np.abs(profile[a] - profile[b]).sum(axis=1) <= most) & ((side[a] != side[b]) | (side[a] == 0))
            for x, y in zip(rep[a[ok]].tolist(), rep[b[ok]].tolist(), strict=True):
                if forest.union(x, y):
                    found.append((x, y))
        step += 1


def plausible(live: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Edges between representatives that may link; a shingle with very many holders is compared in pairs of blocks."""

    def per_group(rows):
        columns = [rows.column(c).to_numpy() for c in ("gram", "rep", "size")]
        profile = np.frombuffer(b"".join(rows.column("profile").to_pylist()), np.uint8).reshape(len(columns[0]), -1)
        found = plausible_pairs(*columns, profile, rows.column("side").to_numpy(), t)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    groups = -(-live.count() // POSTINGS)
    blocks = F.ceil(F.col("holders") / F.lit(POSTINGS // 10)).cast("int")
    few = live.filter(F.col("holders") <= POSTINGS // 10).select(
        "gram", "rep", "size", "profile", F.lit(0).alias("side"), F.pmod(F.xxhash64("gram"), F.lit(max(1, groups))).alias("g"), F.lit(0).alias("i"), F.lit(0).alias("j")
    )
    many = live.filter(F.col("holders") > POSTINGS // 10).withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("rep"), blocks).cast("int")})
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "gram", "rep", "size", "profile", F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        F.col("gram").alias("g"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
    )
    return few.unionByName(many).groupBy("g", "i", "j").applyInArrow(per_group, "a long, b long")


def blocks_of(members: Column, shingles: Column, block: int) -> Column:
    """Blocks of a cluster: bounded both in sets and in shingles, so whole sets of long texts do not pile up in a task."""
    return F.ceil(F.greatest(members / F.lit(block), shingles / F.lit(BLOCK_SHINGLES))).cast("int")


def candidate_clusters(posting: DataFrame, reps: DataFrame, t: tuple[int, int]) -> DataFrame:
    """``gram, rep`` and ``rep, size, profile`` → a written table ``node, component`` of the clusters of sets that may link."""
    shared = posting.groupBy("gram").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    live = posting.join(shared, "gram").join(reps.select("rep", "size", "profile"), "rep")
    live = written(live.select("gram", "rep", "size", "profile", "holders"), "join-postings")
    clusters = components(written(plausible(live, t), "join-candidates"))
    return written(clusters.unionByName(clusters.select(F.col("component").alias("node"), "component")).distinct(), "join-clusters")


def dealt(clusters: DataFrame, reps: DataFrame, block: int) -> DataFrame:
    """Every clustered id with the number of blocks of its cluster and its own block."""
    measured = clusters.join(reps.select(F.col("rep").alias("node"), "size"), "node")
    sizes = measured.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum("size").alias("shingles"))
    return clusters.join(sizes, "component").select(
        F.col("node").alias("id"), "component", blocks_of(F.col("members"), F.col("shingles"), block).alias("blocks"),
    ).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))


def shared_enough(sets: DataFrame, t: tuple[int, int], count_rows: int = COUNT_SHINGLES) -> DataFrame:
    """``component, id, grams`` → the ids that hold as many shingles as a link takes together with others of their component.

    Shingles go to buckets by hash, as 32 bits, each set's after each other. What a task meets more than once is known to be shared
    and sent once, so a frequent shingle is few entries. Equal bits of different shingles, and repeated ids, only keep more ids.
    """
    total = sets.agg(F.sum(F.octet_length("grams")) / 8).first()[0] or 0
    buckets = max(1, -(-int(total) // count_rows))
    columns = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("ids", "known", "counts", "keys", "marks"))])

    def deal(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        """Rows of a bucket: ids, for each how many shared shingles are known and how many keys follow, their keys; and keys that are
        shared whoever holds them."""
        ids = np.array([i for i, _, _ in held], np.int64)
        sizes = np.array([len(g) // 8 for _, _, g in held], np.int64)
        flat = np.frombuffer(b"".join(g for _, _, g in held), "<u8")
        own = np.repeat(np.arange(len(ids)), sizes)
        key = mixed(flat + mixed(np.array([c for _, c, _ in held], np.int64).view(np.uint64))[own])
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        many = count[inverse] > 1
        known = np.bincount(own[many], minlength=len(ids))
        rows = [(int(ids[0]) % buckets, ids.tobytes(), known.astype("<i8").tobytes(), bytes(8 * len(ids)), b"", b"")]
        marks, key, own = np.unique(key[many]), key[~many], own[~many]
        place, marked = ((k >> np.uint64(32)) % np.uint64(buckets) for k in (key, marks))
        order, by = np.lexsort((own, place)), np.argsort(marked, kind="stable")
        key, own, place, marks, marked = key[order].astype("<u4"), own[order], place[order], marks[by].astype("<u4"), marked[by]
        used = np.unique(np.concatenate([place, marked]))
        cuts = [np.searchsorted(x, used, side).tolist() for x in (place, marked) for side in ("left", "right")]
        for bucket, a, b, c, d in zip(used.tolist(), *cuts, strict=True):
            who, n = np.unique(own[a:b], return_counts=True)
            rows.append((bucket, ids[who].tobytes(), bytes(8 * len(who)), n.astype("<i8").tobytes(), key[a:b].tobytes(), marks[c:d].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), columns, strict=True)], schema=columns)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "component", "grams")), strict=True):
                held.append(row)
                size += len(row[2]) // 8
                if size > count_rows // 4:
                    yield deal(held)
                    held, size = [], 0
        if held:
            yield deal(held)

    def per_bucket(rows: pa.Table) -> pa.Table:
        ids, known, counts, keys, marks = (
            np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c, kind in zip(columns.names[1:], ("<i8", "<i8", "<i8", "<u4", "<u4"), strict=True)
        )
        _, inverse, count = np.unique(np.concatenate([keys, marks]), return_inverse=True, return_counts=True)
        who, own = np.unique(ids, return_inverse=True)
        n = np.zeros(len(who), np.int64)
        np.add.at(n, own, known)
        np.add.at(n, np.repeat(own, counts), count[inverse[: len(keys)]] > 1)
        return pa.table({"id": pa.array(who[n > 0], pa.int64()), "n": pa.array(n[n > 0], pa.int64())})

    rows = scan(sets.select("id", "component", "grams"), per_task, "bucket int, ids binary, known binary, counts binary, keys binary, marks binary")
    seen = rows.groupBy("bucket").applyInArrow(per_bucket, "id long, n long")
    least = sets.groupBy("id").agg(F.min(F.expr("octet_length(grams) div 8")).alias("size"))
    seen = seen.groupBy("id").agg(F.sum("n").alias("n")).join(least, "id")
    return seen.filter(F.col("n") * t[1] >= F.col("size") * t[0]).select("id")


def refined(large: DataFrame, t: tuple[int, int], block: int) -> tuple[DataFrame, DataFrame]:
    """Sets of large clusters (``component, id, grams``) → the clusters that they make by the exact counts of their shingles: ids with
    blocks, and their sets.

    Long sets that share a few rare shingles by chance make one cluster, which costs the square of its size. Within it the holders of
    a shingle are counted: sets that do not share enough with others are done, and the prefixes of the rest are taken anew by a total
    order of exact counts.
    """
    kept = written(shared_enough(large, t), "join-kept")
    # of an id that repeats the smallest set takes part, as in every group
    kept = written(large.join(kept, "id", "left_semi").groupBy("component", "id").agg(F.min("grams").alias("grams")), "join-kept-sets")

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(g, "<u8") for g in batch.column("grams").to_pylist()]
            profile = [profile_of(s) for s in held]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(map(len, held), pa.int64()), pa.array(profile, pa.binary())], names=["rep", "size", "profile"]
            )

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for component, i, g in zip(*(batch.column(c).to_pylist() for c in ("component", "id", "grams")), strict=True):
                gram = np.frombuffer(g, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(gram), v), pa.int64()) for v in (component, i, len(gram))] + [pa.array(gram, pa.int64())],
                    names=["component", "rep", "size", "gram"],
                )

    reps = written(scan(kept.select("id", "grams"), profiles, "rep long, size long, profile binary"), "join-kept-sizes")
    posting = scan(kept.select("component", "id", "grams"), flat, "component long, rep long, size long, gram long")
    posting = posting.select("rep", "size", F.xxhash64("component", "gram").alias("gram"))
    held = posting.groupBy("gram").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    # a set's shingles without another holder come first in the order, so they need not be listed
    mine = W.partitionBy("rep")
    ranked = posting.join(held, "gram").withColumns({
        "at": F.row_number().over(mine.orderBy("held", "gram")), "listed": F.count(F.lit(1)).over(mine),
    })
    least = F.ceil(F.col("size") * F.lit(t[0]) / F.lit(t[1]))
    prefix = ranked.filter(F.col("at") + F.col("size") - F.col("listed") <= F.col("size") - least + 1).select("gram", "rep")
    clusters = candidate_clusters(written(prefix, "join-prefixes"), reps, t)
    live = written(dealt(clusters, reps, block), "join-live")
    return live, written(live.join(kept.select("id", "grams"), "id"), "join-live-sets")


def cluster_links(reps: DataFrame, rows: DataFrame, tables, n: int, t: tuple[int, int], block: int) -> DataFrame:
    clusters = candidate_clusters(reps.select(F.explode("grams").alias("gram"), "rep"), reps, t)
    live = written(dealt(clusters, reps, block), "join-live")
    candidates = written(sets_of(rows, live, tables, n, t), "join-live-sets")
    if not live.filter("blocks > 1").isEmpty():
        again, sets_again = refined(candidates.filter("blocks > 1").select("component", "id", "grams"), t, block)
        live = live.filter("blocks = 1").unionByName(again)
        candidates = candidates.filter("blocks = 1").unionByName(sets_again)
    own = candidates.select("component", "id", "grams", F.lit(0).alias("side"), F.explode(
        F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.array("block", F.pmod(F.col("block") - 1, F.col("blocks"))))
    ).alias("at"))
    first = written(join_groups(own.select(F.col("component").alias("g1"), F.col("at").alias("g2"), F.lit(-1).alias("g3"), "id", "grams", "side"), t), "join-links")
    if live.filter("blocks > 2").isEmpty():
        return first
    # sets outside the main component of a cluster of many blocks meet all blocks
    linked = components(first).withColumnRenamed("component", "part").withColumnRenamed("node", "id")
    many = live.filter("blocks > 2").join(linked, "id", "left").withColumn("part", F.coalesce("part", "id"))
    many = written(many, "join-parts")
    mass = many.groupBy("component", "part").agg(F.count(F.lit(1)).alias("n"))
    main = mass.groupBy("component").agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    rest = written(many.join(main, "component").filter("part <> main").select("id"), "join-rest")
    with_sets = candidates.filter("blocks > 2")
    every = with_sets.select("component", "id", "grams", F.lit(1).alias("side"), "block", "blocks")
    few = with_sets.join(rest, "id", "left_semi")
    held = F.sum(F.octet_length("grams") / 8)
    # written, so that its size is known and the sets need not be shuffled to meet it
    rest_blocks = written(few.groupBy("component").agg(blocks_of(F.count(F.lit(1)), held, block).alias("probes")), "join-probes")
    stored = every.join(rest_blocks, "component").select(
        "component", "block", F.explode(F.expr("sequence(0, probes - 1)")).alias("probe"), "id", "grams", "side"
    )
    probing = few.join(rest_blocks, "component").select(
        "component", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.pmod(F.xxhash64("id"), "probes").cast("int").alias("probe"),
        "id", "grams", F.lit(2).alias("side"),
    )
    both = stored.unionByName(probing).select(F.col("component").alias("g1"), F.col("block").alias("g2"), F.col("probe").alias("g3"), "id", "grams", "side")
    return first.unionByName(join_groups(both, t))


FILTER_BITS = 1 << 23


def sets_of(rows: DataFrame, live: DataFrame, tables, n: int, t: tuple[int, int]) -> DataFrame:
    """The whole sets of the live ids. A bit table of fixed size lets the scan skip most other texts; the join is exact. An id
    that repeats may come once from every task of the scan; ``join_groups`` takes one of its sets."""
    at = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    marks = live.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    view = bits.view("<i8")
    for r in marks.toLocalIterator():  # one row for each word of the fixed table at most
        view[r["word"]] = r["bits"]
    table = rows.sparkSession.sparkContext.broadcast(bits)
    marked = rows.filter("id IS NOT NULL").select("id", "text", at.alias("at"))
    return live.join(sets(marked, n, tables, t, True, table).select("id", "grams"), "id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The document with the smallest id of every component, with all columns; a repeated id keeps its rows."""
    joined = ngram_join(docs, id_col, text_col, n, threshold)
    name = unused(docs, "__id")
    # those that go are mostly few: as a written table of known size they are broadcast where they are, and the texts stay in place
    stays = joined.filter("id IS NOT NULL").groupBy("id").agg(F.max(F.col("id") == F.col("component")).alias("stays"))
    gone = written(stays.filter("NOT stays").select(F.col("id").alias(name)), "join-gone")
    return docs.join(gone, quoted(id_col).cast("long") == F.col(name), "left_anti")
