"""Language ID, substring dedup, personal data, licences, fingerprints, scoring and packing."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom.llm import fingerprints, hmm_lm, language_id, licenses, packing, pii, substring_dedup

ODD = [(1, None), (2, ""), (3, " \t\r\n"), (4, "a"), (5, "ü 12"), (5, "ü 12"), (None, "x y"), (7, "long " * 30_000)]


# language ID


def test_language_id_held_out_accuracy(spark, sample, table):
    docs = table(sample)
    out = remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language_id.fit(language_id.training_rows(docs, ~remainder, "doc_id", "text", "lang"), fit_rows=50)
    rows = docs.select("doc_id", "lang", out.alias("held_out"), F.col("text").alias("__text"))
    got = language_id.predict(rows, model).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(sample) and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got) and sum(r["rejected"] for r in got) <= 0.03 * len(got)


def test_language_id_odd_cases(table):
    train = [(100 + i, t, lang) for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 5)]
    model = language_id.fit(language_id.training_rows(table(train), F.lit(True), "doc_id", "text", "lang"))
    rows = table(ODD + [(9, "THE GARDEN"), (10, "12 + 3"), (11, "Ω")]).select("doc_id", "size", F.col("text").alias("__text"))
    got = {r["doc_id"]: r for r in language_id.predict(rows, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 10)] == ["und"] * 4 and got[9]["lang_pred"] == "en" and got[1]["rejected"]
    assert got[11]["lang_pred"] in ("en", "de")
    nothing = language_id.fit(language_id.training_rows(table([]), F.lit(True), "doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in language_id.predict(rows, nothing).collect()} == {"und"}


def test_language_id_clusters_and_short_texts(spark, sample, table):
    """Every centroid stands for a good share of its language, and clean texts are not rejected for being short."""
    rng = np.random.default_rng(0)
    docs = [(t, lang) for _, t, lang, *_ in sample if t and lang]
    idf = np.ones(language_id.DIMS, np.float32)
    for lang in {lang for _, lang in docs}:
        x = language_id.weighted(language_id.counts([t.encode() for t, l in docs if l == lang]), idf)
        c, label = language_id.spherical_kmeans(x, 4)
        assert 1 <= len(c) <= 4 and np.bincount(label).min() >= 0.05 * len(x)
    model = language_id.fit(language_id.training_rows(table(sample), F.lit(True), "doc_id", "text", "lang"))
    short = []
    for t, lang in docs:
        words = [w for w in t.split() if w.isalpha()]
        for n in (3, 6):
            if len(words) > n:
                a = int(rng.integers(len(words) - n))
                short.append((len(short), " ".join(words[a : a + n]), lang))
    got = language_id.predict(table(short).select("doc_id", "lang", F.col("text").alias("__text")), model).collect()
    assert not any(r["rejected"] for r in got) and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.9 * len(got)


# substring dedup


def brute_repeats(rows, length):
    words, seen = {d: (t or "").encode().split() for d, t in rows}, {}
    for d in sorted(words):
        for i in range(len(words[d]) - length + 1):
            seen.setdefault(tuple(words[d][i : i + length]), []).append((d, i))
    gone = {d: set() for d in words}
    for places in seen.values():
        for d, i in places[1:]:
            gone[d].update(range(i, i + length))
    return {d: (len(w), len(gone[d]), b" ".join(x for i, x in enumerate(w) if i not in gone[d]).decode()) for d, w in words.items()}


@pytest.mark.parametrize("length, gram, alphabet, hot", [(20, 8, 500, False), (6, 2, 3, False), (5, 5, 2, True), (20, 8, 1, False)])
def test_substring_dedup_against_brute_force(table, monkeypatch, length, gram, alphabet, hot):
    """Shared passages, repeats within a document, periodic texts; a tiny group size makes prefixes longer."""
    if hot:
        monkeypatch.setattr(substring_dedup, "GROUP_RUNS", 3)
    rng = random.Random(alphabet)
    text = lambda n: [f"w{rng.randrange(alphabet)}" for _ in range(n)]
    passages = [text(rng.randint(15, 60)) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = [p for _ in range(rng.randint(0, 4)) for p in (text(rng.randint(0, 30)), rng.choice(passages))]
        rows.append((i * 3, " ".join(itertools.chain.from_iterable(parts))))
    rows += [(500, None), (501, ""), (502, "w0 " * 5000)]
    got = {r["id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.without_repeats(table(rows).repartition(5), length=length, gram=gram).collect()}
    assert got == brute_repeats(rows, length)


def test_substring_dedup_odd_cases(table):
    got = substring_dedup.without_repeats(table(ODD)).collect()
    assert len(got) == len(ODD) and {r["kept"] for r in got if r["id"] == 7} == {"long"}
    assert substring_dedup.without_repeats(table([])).count() == 0


# personal data


def test_pii_base_spans():
    text = "mail a.b@x.org. or c@d (no) e@f.g@h.i; ips 1.2.3.4.5.6.7.8 256.1.1.1; 4111 1111-1111 1111, +1 (017) 555-7713 +12"
    found = pii.base_spans(text)
    assert [text[a:b] for k, a, b in found if k == "email"] == ["a.b@x.org", "e@f.g"]
    assert [text[a:b] for k, a, b in found if k == "ip"] == ["1.2.3.4", "5.6.7.8"]
    assert [text[a:b] for k, a, b in found if k == "card"] == ["4111 1111-1111 1111"]
    assert [text[a:b] for k, a, b in found if k == "phone"] == ["+1 (017) 555-7713"]


def test_pii_patterns_as_regular_expressions():
    import re

    rng = random.Random(5)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(rng.choice("ab1.@-+ ü") for _ in range(40))
        assert list(pii.emails(text)) == [m.span() for m in email.finditer(text)]
        want = [("ip", *m.span()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [s for s in pii.base_spans(text) if s[0] == "ip"] == want
    assert pii.base_spans("a" * 300_000 + "1" * 300_000) == []  # in linear time


def test_pii_terms_that_reveal(table):
    """A name that stands beside one address in different contexts is found, also where the address is not; others are not."""
    near = [(i, f"{chr(97 + i) * 4} words from Zork mail zork@example.com about {chr(97 + i) * 3}") for i in range(6)]
    rows = near + [(50, "then Zork went home"), (51, "mail about home"), (52, None), (53, "")] + [(100 + i, f"the mail from words about x{i}") for i in range(60)]
    got = {r["id"]: r for r in pii.pii_spans(table(rows)).collect()}
    assert got[50]["spans"] == "term:5:9" and got[50]["base"] == ""
    assert got[51]["spans"] == "" and got[0]["spans"].startswith(got[0]["base"] + ",term:") and got[0]["n_email"] == 1
    clean = {r["id"]: r["text"] for r in pii.sanitised(table(rows)).collect()}
    assert "[EMAIL]" in clean[0] and "Zork" not in clean[0] and clean[51] == rows[7][1] and clean[52] == ""
    copies = [(i, "from Zork mail zork@example.com today") for i in range(20)]
    assert {r["spans"] for r in pii.pii_spans(table(copies)).collect()} == {"email:15:31"}
    assert len(pii.pii_spans(table(ODD)).collect()) == len(ODD) and pii.pii_spans(table([])).count() == 0


def test_pii_terms_against_brute_force(spark, table):
    """Contexts, counts and bits recomputed row by row, on random texts with names beside addresses, numbers and pooled domains."""
    rng = random.Random(9)
    names, filler = ["Zork", "Quill", "Brann", "Oda"], ["mail", "the", "from", "about", "house", "tree", "river", "stone"]
    rows = []
    for i in range(300):
        words = [rng.choice(filler) for _ in range(rng.randint(5, 40))]
        if rng.random() < 0.3:
            k = rng.randrange(4)
            near = [names[k], f"{names[k].lower()}{'' if rng.random() < 0.5 else i}@{'acme' if k < 2 else 'site'}{k % 2}.org"]
            at = rng.randrange(len(words))
            words[at:at] = near if rng.random() < 0.7 else near[::-1]
        if rng.random() < 0.1:
            words.insert(0, rng.choice(names))
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[0][1]) for i in range(5)] + [(2000, None)]

    near, n_docs, n_e, n_t = {}, len(rows), {}, {}
    for i, text in rows:
        words = [(m.start(), m.end()) for m in pii._WORD.finditer(text or "")]
        for w in {t for a, b in words for t, _, _ in pii.terms(text[a:b])}:
            n_t.setdefault(w, set()).add(i)
        for kind, a, b in pii.base_spans(text or ""):
            left, right = [w for w in words if w[1] <= a][-10:], [w for w in words if w[0] >= b][:10]
            here = sorted({t for p, q in left + right if "@" not in text[p:q] and not any(c.isdigit() for c in text[p:q]) for t, _, _ in pii.terms(text[p:q])})
            for e in pii.entities(kind, text[a:b]):
                n_e.setdefault(e, set()).add(i)
                for t in here:
                    near.setdefault((e, t), {}).setdefault(tuple(here), set()).add(i)
    strong = set()
    for (e, t), places in near.items():
        c, n_te, p_e = len(places), sum(map(len, places.values())), len(n_e[e]) / n_docs
        p = (c * min(1, n_te / len(n_t[t])) + pii.PRIOR * p_e) / (c + pii.PRIOR)
        if c > 1 and p_e <= 0.5 and p > p_e and -math.log2(p) <= pii.GENERALISE:
            strong.add(t)
    assert strong and strong <= {n.lower() for n in names}
    for r in pii.pii_spans(table(rows)).collect():
        text = dict(rows)[r["id"]] or ""
        want = [("term", a, b) for m in pii._WORD.finditer(text) for t, a, b in pii.terms(text, *m.span()) if t in strong]
        assert r["spans"] == ",".join(filter(None, [r["base"], pii.joined(want)]))


def test_pii_card_and_phone_patterns_as_regular_expressions():
    import re

    rng = random.Random(6)
    card, phone = re.compile(r"[0-9](?:[\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def luhn(digits):
        doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    hits = 0
    for _ in range(4000):
        text = "".join(rng.choice("0123456789012345678901234567 -+(.)a") for _ in range(60))
        want = [("card", *m.span()) for m in card.finditer(text) if 13 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
        want += [("phone", *m.span()) for m in phone.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert [s for s in pii.base_spans(text) if s[0] in ("card", "phone")] == want
        hits += len(want)
    assert hits > 200


# licences


def test_licenses(table):
    rows = ODD + [(20, "x\nThis work is licensed under the GNU General Public License, version 3.\ny"), (21, "Some text. Released under the MIT License. More."),
                  (22, "The driver lost the license under the general public library"), (23, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.")]
    got = {r["id"]: (r["families"], r["n_notices"]) for r in licenses.licenses(table(rows)).collect()}
    assert got[20] == ("GPL", 1) and got[21] == ("MIT", 1) and got[22] == ("", 0) and got[23] == ("Apache-2.0,CC-BY-NC", 2)
    assert licenses.licenses(table(rows)).count() == len(rows) and licenses.licenses(table([])).count() == 0


def test_every_template_is_found_and_no_ordinary_sentence(table):
    rows = [(i, t) for i, (_, t) in enumerate(licenses.TEMPLATES)] + [(100 + i, t) for i, t in enumerate(licenses.OTHERS)]
    got = {r["id"]: r["families"] for r in licenses.licenses(table(rows)).collect()}
    assert [got[i] for i in range(len(licenses.TEMPLATES))] == [f for f, _ in licenses.TEMPLATES]
    assert {got[100 + i] for i in range(len(licenses.OTHERS))} == {""}


def test_licence_notices_in_long_lines_and_several_in_one_line(table, sample):
    """Ordinary words around a notice have no say, and a second notice of the line is not lost."""
    english = " ".join(t for _, t, lang, *_ in sample if lang == "en" and t and "icense" not in t).replace("\n", " ")
    lengths = (600, 1300, 3000, 8000)
    rows = [(1000 * k + i, f"{english[i * 97 :][:n]} {t} {english[:n]}") for k, n in enumerate(lengths) for i, (_, t) in enumerate(licenses.TEMPLATES)]
    rows += [(9000, "Released under the MIT License. Licensed under the Apache License, Version 2.0."),
             (9001, "Licensed under CC BY-SA 4.0. Released under the MIT License. Licensed under CC BY-SA 4.0."), (9002, english[:100_000])]
    got = {r["id"]: r for r in licenses.licenses(table(rows)).collect()}
    for k in range(len(lengths)):
        assert [got[1000 * k + i]["families"] for i in range(len(licenses.TEMPLATES))] == [f for f, _ in licenses.TEMPLATES]
    assert got[9000]["families"] == "Apache-2.0,MIT" and got[9000]["n_notices"] == 2
    assert got[9001]["families"] == "CC-BY-SA,MIT" and got[9001]["n_notices"] == 3 and got[9002]["families"] == ""


def test_wrapped_licence_headers(table):
    """Headers as they stand in files: wrapped at any width, in comments, with a blank line after them."""
    again = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    headers = [
        ("GPL", again.format("program", ":", "", 3)), ("LGPL", again.format("library", ";", "Lesser ", 2.1)), ("AGPL", again.format("program", ":", "Affero ", 3)),
        ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ]
    rows, want = [], {}
    for (family, text), width, mark, end in itertools.product(headers, (30, 50, 72), ("", "# ", " * ", "// "), ("\n", "\r\n")):
        lines = ["demo.c", "", *textwrap.wrap(text, width), "", "int main"]
        want[len(rows)] = (family, 1)
        rows.append((len(rows), end.join(mark + x for x in lines)))
    rows.append((len(rows), "Redistribution and use in source and binary forms\n\nwith or without\n\npermission of the owner"))
    want[len(rows) - 1] = ("", 0)
    assert {r["id"]: (r["families"], r["n_notices"]) for r in licenses.licenses(table(rows)).collect()} == want


# fingerprints


def test_equal_substrings_have_equal_interior_names():
    rng = np.random.default_rng(2)
    middle = bytes(rng.integers(97, 123, 4000, dtype=np.uint8))
    a, b = (bytes(rng.integers(97, 123, n, dtype=np.uint8)) + middle for n in (501, 1007))
    symbols = [np.frombuffer(t, np.uint8) for t in (a, b)]
    for _ in range(3):
        symbols = [fingerprints.phrases(s, np.zeros(len(s), np.int32))[0] for s in symbols]
        n = int(0.8 * min(len(s) * 4000 / len(t) for s, t in zip(symbols, (a, b), strict=True)))
        assert (symbols[0][-n:] == symbols[1][-n:]).all()


def test_fingerprints_with_next(table):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gäm", "d"]) + str(rng.randrange(50)) for _ in range(rng.randint(0, 300)))) for i in range(0, 200, 2)]
    rows[5] = (10, rows[4][1])
    rows += [(900, None), (901, ""), (None, "last"), (950, "aaaa" * 5000)]
    got = {r["id"]: r for r in fingerprints.with_next(table(rows).repartition(6)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following, r = text or "", following or "", got[doc]
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        own, turned, after = fingerprints.sketches([text.encode(), edited.encode(), following.encode()])
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == fingerprints.fingerprint(own) and r["edited_fingerprint"] == fingerprints.fingerprint(turned)
        assert r["near_edited"] == fingerprints.likeness(own, turned) and r["near_next"] == fingerprints.likeness(own, after)
    assert got[8]["near_next"] == 1.0 and got[900]["near_next"] == 1.0
    assert fingerprints.with_next(table([])).count() == 0
    assert fingerprints.with_next(table([(1, "abc")])).collect()[0]["near_next"] == 1.0


def test_likeness_estimates_shared_text():
    rng = np.random.default_rng(1)
    text = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8))
    half, a, b = text(30_000), text(30_000), text(30_000)
    x, y, z = fingerprints.sketches([half + a, half + b, text(60_000)])
    assert abs(fingerprints.likeness(x, y) - 1 / 3) < 0.2 and fingerprints.likeness(x, z) < 0.05


# language-model scoring


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(7)
    move, emit, start = (x / x.sum(axis=-1, keepdims=True) for x in (rng.random((3, 3)), rng.random((3, 5)), rng.random(3)))
    m = hmm_lm.Hmm(start, move, emit.T)
    sequences = [rng.integers(0, 5, n) for n in (1, 2, 5, 3, 5)]
    for s, got in zip(sequences, hmm_lm.log10_likelihood(m, sequences), strict=True):
        total = sum(
            start[z[0]] * emit[z[0], s[0]] * math.prod(move[z[i - 1], z[i]] * emit[z[i], s[i]] for i in range(1, len(s)))
            for z in itertools.product(range(3), repeat=len(s))
        )
        assert got == pytest.approx(math.log10(total))


def test_expected_counts_against_enumeration():
    rng = np.random.default_rng(8)
    move, emit, start = (x / x.sum(axis=-1, keepdims=True) for x in (rng.random((2, 2)), rng.random((2, 3)), rng.random(2)))
    s = rng.integers(0, 3, 5)
    first, between, out, total = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2)), 0.0
    for z in itertools.product(range(2), repeat=5):
        p = start[z[0]] * emit[z[0], s[0]] * math.prod(move[z[i - 1], z[i]] * emit[z[i], s[i]] for i in range(1, 5))
        total += p
        first[z[0]] += p
        for i in range(5):
            out[s[i], z[i]] += p
            if i:
                between[z[i - 1], z[i]] += p
    sums = [np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))]
    hmm_lm.expected_counts(hmm_lm.Hmm(start, move, emit.T), [s], np.array([True]), sums)
    for got, want in zip(sums, (first, between, out), strict=True):
        assert np.allclose(got, want / total, atol=1e-4)


@pytest.mark.parametrize("symbols, known", [(32_000, 1_000_000), (300, 2000)])
def test_lm_scores(table, sample, symbols, known):
    """Counts and base score by hand, whatever the tables hold; the model beats it on held-out texts."""
    rows = [r[:2] for r in sample] + [(9000, None), (9001, ""), (9002, "neverseen " * 3)]
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    got = {r["id"]: r for r in hmm_lm.lm_scores(table(rows), train, symbols=symbols, known=known).collect()}
    used = [(d, t) for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    counts = {}
    for _, t in used:
        for w in [*(t or "").encode().lower().split(), None]:
            counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())
    for d, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(w in counts for w in tokens), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts.get(w, 0) + 1) / (total + len(counts) + 1)) for w in tokens))
        assert r["score"] < 0
    held = [r for r in got.values() if not r["train"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_without_rows(table):
    assert hmm_lm.lm_scores(table([]), F.lit(True)).count() == 0
    assert len(hmm_lm.lm_scores(table(ODD[:4]), F.lit(False)).collect()) == 4


# packing


def check_pieces(rows, pieces, window):
    """Every id of every document lies in one piece, sequences are gapless and full; returns tokens by (sequence, source)."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = sorted((d, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])) for d, t, *_ in rows)
    by_doc, by_sequence, mixed = {}, {}, {}
    for p in pieces:
        by_doc.setdefault(p["id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
        key = p["sequence_id"], p["source"]
        mixed[key] = mixed.get(key, 0) + p["length"]
    assert sum(p["length"] for p in pieces) == sum(len(ids) for _, ids in want)
    texts = {}
    for d, ids in want:
        texts.setdefault(d, []).append(ids)
    for d, own in by_doc.items():
        left = sorted(own, key=lambda p: (p["start"], p["length"]))
        if len(texts[d]) == 1:
            ids, at = np.array(texts[d][0], "<u4"), 0
            for p in left:
                assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
                assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
                at += p["length"]
            assert at == len(ids)
    for k, own in by_sequence.items():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or at < window and at & (at - 1) == 0, (k, at)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return mixed


@pytest.mark.parametrize("window", [16, 256])
def test_packing(table, window):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["Hello", "wörld", "it's", "42", "a.b"]) for _ in range(rng.randint(0, 60))), "en", rng.choice("aaaabc") if i % 9 else None) for i in range(300)]
    rows += [(400, None, "en", "d"), (401, "", "en", "a"), (402, "x<|endoftext|>y", "en", "a"), (7, "again", "en", "a"), (403, "word " * 3000, "en", "b")]
    pieces = packing.pack(table(rows).repartition(4), packing.default_tokenizer(), window=window).collect()
    mixed = check_pieces(rows, pieces, window)
    total, held = sum(p["length"] for p in pieces), {}
    for (_, s), n in mixed.items():
        held[s] = held.get(s, 0) + n
    full = total // window
    for k in range(full):
        for s, n in held.items():
            assert abs(mixed.get((k, s), 0) - window * n / total) <= 2


def test_packing_to_weights(table):
    rows = [(i, "one two three", "en", "ab"[i % 2]) for i in range(200)]
    pieces = packing.pack(table(rows), packing.default_tokenizer(), weights={"a": 3, "b": 1}, window=16).collect()
    mixed = check_pieces(rows, pieces, 16)
    assert all(abs(mixed.get((k, "a"), 0) - 12) <= 1 for k in range(20))
    assert packing.pack(table([]), packing.default_tokenizer()).count() == 0


def test_pieces_of_queues_are_nested():
    schedule = packing.Schedule([[1000, 10, 333, 1]], 64)
    states = [schedule.taken(schedule.bound(k)) for k in range(schedule.sequences + 1)]
    assert states[-1] == [1000, 10, 333, 1]
    assert all(sum(s) == schedule.bound(k) for k, s in enumerate(states))
    assert all(b >= a for x, y in itertools.pairwise(states) for a, b in zip(x, y, strict=True))


def test_words_are_encoded_once_a_worker(monkeypatch):
    """The next task of a worker finds the words of the one before, with the same ids."""
    import pyarrow as pa

    monkeypatch.setattr(packing, "_CODERS", {})
    texts, path = pa.array(["The house, the garden.", "", "42 Häuser"]), packing.default_tokenizer()
    first = list(packing.coder_of(path).ids(texts, 1))
    monkeypatch.setattr(packing.Tokens, "learn", lambda *a: pytest.fail("encoded again"))
    assert list(packing.coder_of(path).ids(texts, 1)) == first


def test_known_words_are_small(monkeypatch):
    """What a worker keeps of the words it has met takes a few dozen bytes a word (several hundred as Python objects)."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(40_000)]
    monkeypatch.setattr(packing, "_CODERS", {})
    coder = packing.coder_of(packing.default_tokenizer())
    texts = pa.array([" ".join(words[i : i + 100]) for i in range(0, len(words), 100)])
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    assert sum(1 for _ in coder.ids(texts, 1)) == 400
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert kept < 100 * len(words)


@pytest.mark.parametrize("case", ["as it is", "one hash for all", "forgetful"])
def test_ids_of_odd_words(monkeypatch, case):
    """Ids are the tokenizer's for words of letters, digits, marks, contractions, special tokens and other characters, also when
    all hashes are equal and when words are forgotten."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    if case == "one hash for all":
        monkeypatch.setattr(packing, "_RANDOM", np.zeros_like(packing._RANDOM))
    if case == "forgetful":
        monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    rng, path = random.Random(8), packing.default_tokenizer()
    parts = ["a", "Word", "ÉCOLE", "straße", "ÿ", "×", "÷", "µ", "é", "İ", "Σ", "日本", " ", "\u0085", "​", "'", "'s", "'LL", "<", "<|", "|>", "<|endoftext|>", "<|EndOfText|>", "42", "٣", "½", "\0", "😀", " ", "\t\n", "  "]
    parts += list("!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~")
    texts = [None, "", " ", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(1500))]
    tokenizer, coder = Tokenizer.from_file(path), packing.Tokens(path)
    for _ in range(2):  # the second time with known words
        got = [np.frombuffer(x, coder.kind).tolist() for i in range(0, len(texts), 100) for x in coder.ids(pa.array([t or "" for t in texts[i : i + 100]]), 1)]
        for t, ids in zip(texts, got, strict=True):
            assert ids == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], t
