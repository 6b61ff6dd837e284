"""Exact dedup, mixing, components and the n-gram join against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from chartloom.llm import exact_dedup, mixing, ngram_join
from chartloom.llm.graph import components

ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "a  b"), (8, "ü"), (8, "ü"), (None, "ab"), (10, "a b"),
    (11, "x" * 200_000), (12, "x " * 200_000),
]


def norm(text):
    return (text or "").translate({i: None for i in (32, 9, 10, 11, 12, 13)})


@pytest.mark.parametrize("bits, capacity", [(64, 4096), (64, 2), (2, 2)])
def test_exact_dedup_odd_cases(table, bits, capacity):
    """Nulls, blank and long texts, ties, repeats; few key bits force collisions into chains, small buckets force doubling."""
    got = exact_dedup.exact_dedup(table(ODD), capacity=capacity, key_bits=bits).collect()
    assert len(got) == len(ODD)
    groups = {}
    for doc, text in ODD:
        groups.setdefault(norm(text), []).append((-len(text or ""), doc is None, doc or 0))
    for r in got:
        key = next(k for k in groups if hashlib.sha256(k.encode()).hexdigest() == r["digest"])
        assert r["group_size"] == len(groups[key])
        best = min(groups[key])
        assert r["keep_id"] == (None if best[1] else best[2])
    assert sum(r["kept"] for r in got) == len(groups)


def test_chains_hold_all_collisions(table):
    _, index = exact_dedup.build_index(table([(i, f"t{i}") for i in range(40)]), key_bits=1)
    links = index.collect()
    assert len(links) == 40 and {r["key"] for r in links} == {0, -(1 << 63)}
    for key in {r["key"] for r in links}:
        own = sorted(r["link"] for r in links if r["key"] == key)
        assert own == list(range(1, len(own) + 1))


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key")
    depth, slots = exact_dedup.directory(keys, capacity=100)
    assert depth >= 6
    marked = keys.selectExpr(f"shiftrightunsigned(key, {64 - depth}) AS slot").join(slots, "slot")
    assert marked.count() == 5000
    assert max(r["count"] for r in marked.groupBy("bucket", "local_depth").count().collect()) <= 100


def test_drop_copies_keeps_columns_and_one_row(table):
    docs = table(ODD)
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    assert sorted(norm(r["text"]) for r in got.collect()) == sorted({norm(t) for _, t in ODD})
    assert exact_dedup.exact_dedup(table([])).count() == 0


def water(sizes, weights, rate=3):
    """Targets by repeated capping."""
    target, free, left = {}, dict(weights), float(sum(sizes.values()))
    while free:
        level = left / sum(free.values())
        over = [s for s in free if level * free[s] > rate * sizes[s]]
        if not over:
            return target | {s: level * w for s, w in free.items()}
        for s in over:
            target[s] = float(rate * sizes[s])
            left -= target[s]
            del free[s]
    return target


def test_mixing_targets_and_bounds(table):
    rng = random.Random(3)
    sources = ["a", "b", "c", "d", "é", "Z", None, "empty"]
    rows = [(i, " ".join(["w"] * rng.randint(1, 30)), "en", sources[min(6, int(rng.expovariate(0.6)))]) for i in range(3000)]
    rows += [(5000, None, "en", "empty"), (5001, " \n", "en", "empty")]
    got = mixing.mix(table(rows)).collect()
    assert len(got) == len(rows)
    size, order = {}, sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len((r[1] or "").split())
    want = water(size, {s: i % 3 + 1 for i, s in enumerate(order)})
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == size[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in order:
        assert abs(taken[s] - want[s]) <= 0.1 * want[s] + 150
    assert got == mixing.mix(table(rows)).collect()


def test_emit_repeats_rows_as_decided(table):
    docs = table([(i, "a b c", "en", "s" if i % 10 else "t") for i in range(200)] + [(0, "a b c", "en", "t")])
    decided = {}
    for r in mixing.mix(docs).collect():
        decided[r["id"]] = decided.get(r["id"], 0) + r["copies"]
    out = mixing.emit(docs)
    assert out.columns == docs.columns
    counted = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counted == {k: v for k, v in decided.items() if v}


def test_given_weights_and_no_rows(spark, table):
    docs = table([(i, "a b", "en", "s" if i % 2 else "t") for i in range(100)])
    weights = spark.createDataFrame([("s", 1)], "source string, weight long")
    assert {r["source"] for r in mixing.mix(docs, weights=weights).collect()} == {"s"}
    assert mixing.mix(table([])).count() == 0 and mixing.emit(table([])).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {n: find(n) for n in up if any(n in e and e[0] != e[1] for e in edges)}


def brute_components(rows, n, t):
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    part = {d: d for d in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both * t[1] >= t[0] * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                part[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("n, t, block", [(3, (9, 10), 1000), (5, (8, 10), 1000), (3, (9, 10), 7), (2, (6, 10), 5)])
def test_ngram_join_against_all_pairs(table, n, t, block):
    """Near copies in chains, equal sets, short and blank texts; small blocks make clusters of many blocks."""
    rng = random.Random(n)
    rows, words = [], [f"w{i}" for i in range(400)]
    for g in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 30, 120]))]
        for _ in range(rng.choice([1, 2, 20])):
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text).upper() if g % 2 else "\t".join(text)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "Ä b"), (904, "ä b"), (905, "a b"), (906, "A  B")]
    got = {r["id"]: (r["size"], r["component"]) for r in ngram_join.ngram_join(table(rows), n=n, threshold=t, block=block).collect()}
    assert got == brute_components(rows, n, t)


def test_one_per_component(table):
    docs = table([(1, "a b c d e f"), (2, "a b c d e f"), (3, "q r s t u v"), (4, None), (5, None)])
    got = ngram_join.one_per_component(docs, n=5, threshold=(8, 10))
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 3, 4, 5] and got.columns == docs.columns
    assert ngram_join.ngram_join(table([])).count() == 0


def test_columns_that_stages_use_themselves(spark, table):
    """Stages keep columns whatever their names: none is lost, overwritten or ambiguous."""
    import corpus_pipeline

    rows = [(1, "the house and the garden are old", "en", "a"), (2, "the house and the garden are old", "en", "a"), (3, "das haus und der garten sind alt", "de", "b")]
    names = ["score", "rejected", "lang_pred", "__text", "__id", "__own", "__len", "__n", "__digest", "__rate", "__source", "__copy", "component", "row"]
    docs = table(rows).withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id")) for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        kept = out.collect()
        assert kept and all(r[c] == f"{c}-{r['doc_id']}" for r in kept for c in names), name
        if name != "mixing":
            assert {r["doc_id"] for r in kept} <= {1, 2, 3} and 3 in {r["doc_id"] for r in kept}


def test_join_moves_no_sets_before_the_tries(spark, table, monkeypatch):
    """Prefixes and whole sets stay where they were computed: only narrow rows are shuffled to find classes and live ids."""
    plans, kept = {}, ngram_join.written

    def recorded(df, purpose):
        plans.setdefault(purpose, df._jdf.queryExecution().executedPlan().toString())
        return kept(df, purpose)

    monkeypatch.setattr(ngram_join, "written", recorded)
    base = [f"w{i}" for i in range(60)]
    # id 1 comes with two texts, a copy has an id of its own, and enough near copies make a cluster of many blocks
    rows = [(1, " ".join(base)), (1, "other words here"), (2, " ".join(base))] + [(10 + k, " ".join([*base[:59], f"x{k}"])) for k in range(12)]
    got = {r["id"]: r["component"] for r in ngram_join.ngram_join(table(rows + rows[:3]), block=3).collect()}
    assert got == {i: 1 for i, _ in rows}
    moved = {name: [line for line in plan.splitlines() if "Exchange hash" in line] for name, plan in plans.items()}
    assert "grams" not in plans["join-classes"] and "profile" not in plans["join-classes"]
    assert moved["join-live-sets"] == [] and "join-probes" in plans


def test_chance_clusters_are_taken_apart(table, monkeypatch):
    """Long texts that share a rare passage with the next one, but don't link, are not compared block by block."""
    rng, sent, kept = random.Random(5), [], ngram_join.join_groups

    def counted(rows, t):
        sent.append(rows.count())
        return kept(rows, t)

    monkeypatch.setattr(ngram_join, "join_groups", counted)
    texts = [[f"w{rng.randrange(500)}" for _ in range(4000)] for _ in range(24)]
    texts = [[*(f"r{k}{x}" for x in "abc"), *text, *(f"r{k + 1}{x}" for x in "abc")] for k, text in enumerate(texts)]
    rows = [(k, " ".join(text)) for k, text in enumerate(texts)] + [(100, " ".join([*texts[7][:3900], "new", *texts[7][3900:]]))]
    got = {r["id"]: r["component"] for r in ngram_join.ngram_join(table(rows), n=3, threshold=(8, 10), block=5).collect()}
    assert got == {i: 7 if i == 100 else i for i, _ in rows}
    assert sum(sent) <= 4  # 300 before


def test_shared_enough_against_counts(spark):
    """Sets are left out only if they share too little within their component; of a repeated id all rows count."""
    rng = random.Random(2)
    sets = [(c, 50 * c + k, rng.sample(range(1, 800), rng.choice([5, 20, 60]))) for c in (0, 1) for k in range(30)] + [(2, 200, [1, 2, 3]), (2, 201, [9]), (2, 201, [9, 8])]
    frame = spark.createDataFrame([(c, i, bytearray(b"".join(x.to_bytes(8, "little") for x in s))) for c, i, s in sets], "component long, id long, grams binary").repartition(3)
    for t, count_rows in (((8, 10), 1_000_000), ((9, 10), 100)):
        want = set()
        for i in {i for _, i, _ in sets}:
            own = [(c, s) for c, j, s in sets if j == i]
            held = sum(sum(x in s2 for c2, _, s2 in sets if c2 == c) > 1 for c, s in own for x in s)
            if held * t[1] >= t[0] * min(len(s) for _, s in own):
                want.add(i)
        assert {r["id"] for r in ngram_join.shared_enough(frame, t, count_rows).collect()} == want and 0 < len(want) < 61
