"""Packing documents into windows of tokens by deficit round-robin over source queues.

Every source is a queue of tokens; a window visits the queues in turn and takes from each what its quota and the deficit carried
from the windows before allow, so that each window holds the target proportions to within a token. Cuts are free, so the service
is a schedule in closed form: token j of a queue with weight w is due at (j + 1/2) / w, and a window takes the next ``window``
tokens in order of their due times. Hence the state after any number of windows (tokens taken of each queue, i.e. the deficits) is
computed directly, in exact integers, and tasks pack their part of the queues without waiting for each other.

Queues do not run dry at the same time unless targets equal what the sources hold (the default). With other targets the packing
goes on in blocks: when a queue is empty, the others share on by weight.

1. One scan tokenises; a task writes its documents' ids (compressed) with their place among the task's tokens of the source.
2. Tokens per (task, source) are summed and turned into queue offsets: few rows, one per task and source.
3. A second scan over the written ids cuts every document at the windows' bounds.

The remainder of less than a window is cut into windows of powers of two, which need no padding.

Defined cases: a NULL or empty text is the end id alone; NULL is a source of its own; repeated rows are packed one by one; an
empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chartloom.llm.common import quoted, scan, written

WINDOW = 2048
END_ID = 1
#: Words whose ids a worker remembers, and their bytes; bytes of text that are coded together; words that are encoded together.
KNOWN_WORDS, KNOWN_BYTES, SLICE_BYTES, GROUP = 1_000_000, 64 << 20, 4 << 20, 100
#: Random numbers by place in a word (modulo 64) and byte; a word's hash is their sum.
_RANDOM = np.random.default_rng(10).integers(0, 1 << 64, (64, 256), np.uint64)
#: What the plain path knows how to split, as this expression of a tokenizer does: runs of letters, single digits, runs of marks.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters whose lower case and normal form are letters of the same range, and ASCII but ' and <, which begin contractions and
#: special tokens; words with any other character are given to the tokenizer as they are.
_MARKS = r"!-&(-/:;=-@\[-`{-~"
_PLAIN = rf"^[A-Za-zÀ-ÖØ-öø-ÿ0-9{_MARKS}]+$"
_PIECE = rf"([a-zß-öø-ÿ]+|[0-9]|[{_MARKS}]+)"
_ENDED = r"([a-zß-öø-ÿ])([.,;:!?|)])([\x20\x09-\x0D]|$)"


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words; that of the empty word is 0."""
    _, offsets, values = words.buffers()
    at = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw = np.frombuffer(values or b"", np.uint8)[at[0] : at[-1]]
    at -= at[0]
    place = (np.arange(len(raw)) - np.repeat(at[:-1], np.diff(at))) & 63
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_RANDOM[place, raw])]
    return sums[at[1:]] - sums[at[:-1]]


class Tokens:
    """Ids of whole texts, word by word: valid for tokenizers that drop white space, never join across it and split off
    punctuation.

    Texts are split and their words numbered in Arrow; only different words are looked up or encoded, and the texts' ids are
    gathered from them by number. Known words are one Arrow column, their ids one array: a few dozen bytes a word, and no Python
    object for any of them. They are found by a sorted hash, and compared: a word whose hash another one has is encoded anew.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "<u2" if len(vocabulary) < 65536 else "<u4"
        self.plain, suffix = self._plain(path)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a piece
        if self.plain:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.words, self.every, self.at = pa.array([""]), np.empty(0, self.kind), np.zeros(2, np.int64)
        self.hashes, self.order = np.zeros(1, np.uint64), np.zeros(1, np.int64)

    def _plain(self, path: str):
        """The same model behind a plain split at white space, and how its last token of a piece ends, if the tokenizer lower-cases
        and splits by the expression above: pieces in lower case then need neither normalising nor expressions."""
        from tokenizers import Tokenizer

        with open(path) as f:
            spec = json.load(f)
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        suffix = spec["model"].get("end_of_word_suffix")
        if steps[-1:] != ["Lowercase"] or [p.get("type") for p in splits] != ["Split", "ByteLevel"] or not suffix:
            return None, None
        if splits[0].get("pattern") != {"Regex": _SPLIT} or splits[0].get("behavior") != "Removed" or not splits[0].get("invert"):
            return None, None
        spec["normalizer"], splits[0] = None, {"type": "WhitespaceSplit"}
        return Tokenizer.from_str(json.dumps(spec)), suffix

    def packed(self, ids) -> bytes:
        return np.asarray(ids, self.kind).tobytes()

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, and how many each has: many are encoded as one text, and cut where a piece's last token is."""
        pieces = pc.replace_substring_regex(pc.utf8_lower(words), _PIECE, r"\1 ")
        count = pc.count_substring(pieces, " ").to_numpy(zero_copy_only=False)
        bounds = np.r_[0, np.cumsum(pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64))]
        cuts, raw = [*bounds[:-1:GROUP].tolist(), int(bounds[-1])], pc.binary_join(pa.ListArray.from_arrays([0, len(pieces)], pieces), "")[0].as_buffer().to_pybytes()
        found = [
            np.array(self.plain.encode_batch_fast([raw[a:b].decode()], add_special_tokens=False)[0].ids, self.kind)
            for a, b in itertools.pairwise(cuts)
        ]
        ids = np.concatenate([np.empty(0, self.kind), *found])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != count.sum():  # a piece without a token that ends it
            return self.encode_whole(words)
        return ids, np.diff(np.r_[0, np.r_[0, ends][np.cumsum(count)]])

    def encode_whole(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any words, and how many each has, by the tokenizer as it is."""
        found = []
        for i in range(0, len(words), 1000):
            found += [e.ids for e in self.tokenizer.encode_batch_fast(words.slice(i, 1000).to_pylist(), add_special_tokens=False)]
        return np.array(list(itertools.chain.from_iterable(found)), self.kind), np.array(list(map(len, found)), np.int64)

    def learn(self, words: pa.Array) -> np.ndarray:
        """Encodes words and adds them to the known ones; returns the words' numbers there."""
        if self.plain:
            plain = pc.match_substring_regex(words, _PLAIN)
            parts = [(self.encode, plain), (self.encode_whole, pc.invert(plain))]
        else:
            parts = [(self.encode_whole, pa.array(np.ones(len(words), bool)))]
        numbers = np.empty(len(words), np.int64)
        for encode, mask in parts:
            if not len(own := words.filter(mask)):
                continue
            ids, count = encode(own)
            numbers[mask.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(own))
            self.words, self.every = pa.concat_arrays([self.words, own]), np.concatenate([self.every, ids])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(count)])
        return numbers

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers of different words among the known ones."""
        if len(self.words) + len(words) > KNOWN_WORDS or self.words.nbytes > KNOWN_BYTES:
            self.forget()
        own = hashes(words)
        numbers = self.order[np.minimum(np.searchsorted(self.hashes, own), len(self.order) - 1)]
        new = pc.not_equal(words, self.words.take(pa.array(numbers)))
        if len(at := np.flatnonzero(new.to_numpy(zero_copy_only=False))):
            numbers[at] = self.learn(words.filter(new))
            fresh, first = np.unique(own[at], return_index=True)
            place = np.searchsorted(self.hashes, fresh)
            free = self.hashes[np.minimum(place, len(self.hashes) - 1)] != fresh
            self.hashes = np.insert(self.hashes, place[free], fresh[free])
            self.order = np.insert(self.order, place[free], numbers[at[first[free]]])
        return numbers

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts after each other, and where each text's begin (and the last one's end)."""
        if self.plain:  # A-Z in lower case first: the tokenizer does so too, but for its special tokens
            texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
            # a single mark after a letter is a word of its own, so fewer different words are met
            texts = pc.replace_substring_regex(texts, _ENDED, r"\1 \2\3")
        split = pc.ascii_split_whitespace(texts)
        numbered = split.flatten().dictionary_encode()
        lists = split.offsets.to_numpy(zero_copy_only=False)
        own = self.numbers(numbered.dictionary)[numbered.indices.to_numpy(zero_copy_only=False)]
        first, count = self.at[own], np.diff(self.at)[own]
        upto = np.cumsum(count)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.every[np.repeat(first - (upto - count), count) + np.arange(total)]
        return ids, np.r_[0, upto][lists - lists[0]]

    def ids(self, texts: pa.Array, end_id: int) -> Iterator[bytes]:
        """Packed ids of some texts, each with the end id; texts are coded in slices of bounded size."""
        end = self.packed([end_id])
        sizes = np.r_[0, np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))]
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + SLICE_BYTES, "right")) - 1)
            ids, at = self.coded(texts.slice(a, b - a))
            for start, stop in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                yield ids[start:stop].tobytes() + end
            a = b


_CODERS: dict[str, Tokens] = {}


def coder_of(path: str) -> Tokens:
    """The coder of this Python worker, with the words that its tasks have met: a word is encoded once a worker, not once a task."""
    if path not in _CODERS:
        _CODERS.clear()
        _CODERS[path] = Tokens(path)
    return _CODERS[path]


TOKENISED = "id long, source string, task int, start long, n long, ids binary"


def tokenised(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, source_col: str, end_id: int) -> DataFrame:
    """A written table: each document's compressed ids and its start among its task's tokens of the source."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack, coder, place, task = zstandard.ZstdCompressor(level=1), coder_of(tokenizer_path), {}, TaskContext.get().partitionId()
        width = int(coder.kind[2])
        for batch in batches:
            starts, sizes, blobs = [], [], []
            sources = batch.column("source").to_pylist()
            texts = pc.fill_null(batch.column("text").cast(pa.string()), "")
            for source, ids in zip(sources, coder.ids(texts, end_id), strict=True):
                n = len(ids) // width
                starts.append(at := place.get(source, 0))
                place[source] = at + n
                sizes.append(n)
                blobs.append(bytes([width]) + pack.compress(ids))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sources, pa.string()), pa.array([task] * n, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
                names=["id", "source", "task", "start", "n", "ids"],
            )

    rows = docs.select(
        quoted(id_col).cast("long").alias("id"), quoted(source_col).cast("string").alias("source"), quoted(text_col).cast("string").alias("text")
    )
    return written(scan(rows, per_task, TOKENISED), "packing-ids")


def blocks(held: list[int], weights: list[int]) -> list[list[int]]:
    """Tokens of each queue in consecutive blocks within which the proportions stay: a block ends when a queue runs dry."""
    left, out = list(held), []
    while any(left):
        live = [i for i, n in enumerate(left) if n and weights[i] > 0] or [i for i, n in enumerate(left) if n]
        w = [weights[i] if weights[i] > 0 else 1 for i in live]
        first = min(range(len(live)), key=lambda k: (left[live[k]] * 1.0 / w[k], k))
        full = left[live[first]]
        take = [0] * len(left)
        for k, i in enumerate(live):
            take[i] = min(left[i], full * w[k] // w[first]) if k != first else full
        out.append(take)
        left = [a - b for a, b in zip(left, take, strict=True)]
    return out


class Schedule:
    """Tokens taken of every queue once the first q tokens are packed."""

    def __init__(self, parts: list[list[int]], window: int):
        self.parts = parts
        self.total = sum(map(sum, parts))
        self.window = window
        rest, size, tail = self.total % window, window, []
        while rest:
            size //= 2
            if rest >= size > 0:
                tail.append(size)
                rest -= size
        self.full, self.tail = self.total // window, list(itertools.accumulate(tail))

    def bound(self, k: int) -> int:
        """Tokens before sequence k."""
        return k * self.window if k <= self.full else self.full * self.window + self.tail[k - self.full - 1]

    @property
    def sequences(self) -> int:
        return self.full + len(self.tail)

    def taken(self, q: int) -> list[int]:
        done = [0] * len(self.parts[0]) if self.parts else []
        for part in self.parts:
            n = sum(part)
            if q >= n:
                done, q = [a + b for a, b in zip(done, part, strict=True)], q - n
                continue
            if q:
                now = [(2 * p * q + n) // (2 * n) for p in part]
                over = sum(now) - q
                for _ in range(abs(over)):
                    if over > 0:  # give back the token that was due last
                        i = max((i for i, c in enumerate(now) if c), key=lambda i: ((2 * now[i] - 1) / part[i], i))
                        now[i] -= 1
                    else:  # take the token that is due next
                        i = min((i for i, p in enumerate(part) if now[i] < p), key=lambda i: ((2 * now[i] + 1) / part[i], i))
                        now[i] += 1
                done = [a + b for a, b in zip(done, now, strict=True)]
            break
        return done


PIECES = "id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: dict[str | None, int] | None = None, window: int = WINDOW, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents in sequences: id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``weights``: target share of every source (positive integers), by default the tokens it holds. A task keeps one number per
    source.
    """
    coded = tokenised(docs, tokenizer_path, id_col, text_col, source_col, end_id)
    sums = coded.groupBy("source", "task").agg(F.sum("n").alias("n"))
    order = W.partitionBy("source").orderBy("task")
    offsets = sums.withColumn("base", F.sum("n").over(order) - F.col("n")).select(
        F.col("source").alias("__source"), F.col("task").alias("__task"), "base"
    )
    held = sorted(((r["source"], r["n"]) for r in coded.groupBy("source").agg(F.sum("n").alias("n")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    names, sizes = [s for s, _ in held], [n for _, n in held]
    parts = blocks(sizes, sizes if weights is None else [int(weights.get(s, 0)) for s in names]) if held else []
    schedule = Schedule(parts, window)
    rows = coded.join(offsets, (F.col("task") == F.col("__task")) & F.col("source").eqNullSafe(F.col("__source"))).select(
        "id", "source", (F.col("base") + F.col("start")).alias("at"), "n", "ids"
    )
    return rows.mapInArrow(_cutter(schedule, names), PIECES)


def _cutter(schedule: Schedule, names: list[str | None]):
    queue = {s: i for i, s in enumerate(names)}

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, known = zstandard.ZstdDecompressor(), {}

        def state(k: int) -> tuple[list[int], list[int]]:
            """Tokens of each queue before sequence k, and the place of each queue's first token within it."""
            if k not in known:
                if len(known) > 50_000:
                    known.clear()
                before = schedule.taken(schedule.bound(k))
                after = schedule.taken(schedule.bound(k + 1)) if k < schedule.sequences else before
                known[k] = before, list(itertools.accumulate((b - a for a, b in zip(before, after, strict=True)), initial=0))
            return known[k]

        def sequence_of(i: int, at: int) -> int:
            """The sequence that takes token ``at`` of queue i: the last one with no more than that many before it."""
            low, high = 0, schedule.sequences - 1
            guess = int(at / max(1, sum(p[i] for p in schedule.parts)) * schedule.sequences)
            step, low_try = 2, max(0, guess - 2)
            while low_try > 0 and state(low_try)[0][i] > at:
                step *= 2
                low_try = max(0, low_try - step)
            low, step, high_try = low_try, 2, min(high, guess + 2)
            while high_try < high and state(high_try)[0][i] <= at:
                step *= 2
                high_try = min(high, high_try + step)
            high = high_try
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if state(mid)[0][i] <= at else (low, mid - 1)
            return low

        last: dict[str | None, int] = {}
        for batch in batches:
            out = [[] for _ in range(8)]
            for doc, source, at, n, blob in zip(*(batch.column(c).to_pylist() for c in ("id", "source", "at", "n", "ids")), strict=True):
                raw = unpack.decompress(blob[1:])
                ids = np.frombuffer(raw, "<u2").astype("<u4").tobytes() if blob[:1] == b"\2" else raw
                i, done, k = queue[source], 0, last.get(source, -1)
                # files are in queue order, so the next document mostly begins in the sequence where the last one ended
                if k < 0 or not state(k)[0][i] <= at or k + 1 < schedule.sequences and state(k + 1)[0][i] <= at:
                    k = sequence_of(i, at)
                while done < n:
                    before, place = state(k)
                    end = state(k + 1)[0][i] if k + 1 < schedule.sequences else at + n
                    size = min(end - at - done, n - done)
                    if size > 0:
                        crc = zlib.crc32(ids[4 * done : 4 * (done + size)])
                        for column, value in zip(out, (doc, source, done, size, crc, n, k, place[i] + at + done - before[i]), strict=True):
                            column.append(value)
                        done += size
                    if done < n:
                        k += 1
                last[source] = k
            kinds = (pa.int64(), pa.string(), *[pa.int64()] * 6)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                names=["id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return per_task


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")

