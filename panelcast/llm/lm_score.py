"""Language-model scores by deleted interpolation.

P(w | h) = l2(b) c(h w)/c(h) + l1(b) c(w)/N + l0(b)/(V+1), where the bucket b is the binary
logarithm of the context's count; the weights of each bucket are learned by expectation
maximisation on held-out counts (training documents with remainder ``DELETED``; the
estimates and buckets under the weights then come from the others, and a context without a
count among them has the word's estimate for the pair's, as in scoring).  Final estimates use
all training documents.  Every word is a context of its own (``contexts`` of ``score_report`` asks for a
smaller model, where the words that are not among the most frequent ones share one context).

How it runs at scale:

1. Word counts by one sum per word; the most frequent words get numbers and are broadcast
   (at most ``CONTEXTS`` entries).  The others go by 64-bit hashes; a part is sent the counts
   of its own hashes.
2. Pair counts: every chunk of texts packs its distinct (context, word) pairs by part; a part
   holds all of a pair's counts (pairs with a hashed context are dealt by the context, pairs of
   numbered words by the pair, others by the word; a hashed word has at most N/CONTEXTS tokens).
   Parts give the held-out counts by (bucket, estimates) and the pairs with at least
   N/``PAIRS`` tokens, so at most ``PAIRS`` of them.  Where both words are hashed, the part has
   the context's count only; the word's comes by a join.
3. Scores: frequent pairs are scored where the text is.  The rest of a chunk's pairs travel
   packed (per text once) to the parts, which know their counts by then, and come back as one
   sum per text and part; pairs of two hashed words go on, with the context's and the pair's
   count, to the part of the word.  Texts themselves are never shuffled.

Expectation maximisation runs on counts binned by the logarithms of the two estimates (0.05
steps), a table bounded by buckets and bins.

Defined results: null texts are empty and have the end token only; a null doc_id is neither
learned from nor held out; without training tokens every token has the same probability;
repeated rows count and are scored like others; an empty table gives an empty one; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import ASCII_LOWER, arrow_map, column_of, docs_table, materialize, mix64, slices, texts

FOLDS, HELD_OUT, DELETED = 5, 1, 4
CONTEXTS = 65_000
PAIRS = 1_000_000
CHUNK_BYTES, CHUNK_DOCS = 4 << 20, 20_000
#: Training tokens whose pairs one part may hold on average; more tokens make more parts.
PART_TOKENS = 2_500_000
END = b"\n"  # no word has white space
RARE, START = 0, 1  # contexts; numbered words follow
HASHED = np.uint64(1 << 63)  # top bit of the hash of a word without a number
PAIR, FAR, COUNT, ON = b"P", b"Q", b"W", b"F"  # entries: numbered context, hashed context, counts of hashes, pairs that go on
FIELDS = {PAIR: [np.uint64, np.uint16], FAR: [np.uint64, np.uint64], COUNT: [np.uint64, np.int64, np.int64]}
POOLED, FIRST, BUCKETS = 41, 42, 43
STEP = 20  # bins per power of ten
NEVER = -10_000  # bin of an estimate of zero
AS_WORD = -10_001  # bin of a pair's estimate that is the word's: the context has no count
EM_ROUNDS = 60


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()


def fold_of(doc_id: int | None) -> int:
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % FOLDS


@dataclass
class Vocabulary:
    """Numbered words and totals; index i of the arrays is the word with number i."""
    number: dict[bytes, int]
    count: np.ndarray     # all training documents
    kept: np.ndarray      # without the deleted part
    contexts: np.ndarray  # how often each context precedes a token
    contexts_kept: np.ndarray
    tokens: int
    tokens_kept: int
    distinct: int
    pooled: bool = False  # words without a number share the context RARE

    @property
    def bucket(self) -> np.ndarray:
        return self._buckets(self.contexts)

    @property
    def bucket_kept(self) -> np.ndarray:
        return self._buckets(self.contexts_kept)

    def _buckets(self, counts: np.ndarray) -> np.ndarray:
        b = bucket_of(counts)
        b[RARE], b[START] = POOLED, FIRST
        return b

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def log10(self, weights: np.ndarray, context: np.ndarray, c12: np.ndarray, c2: np.ndarray) -> np.ndarray:
        """log10 P(word | context) from the pair's and the word's counts."""
        if not self.tokens:
            return np.full(len(c12), -np.log10(self.distinct + 1))
        return self.mix(weights, self.bucket[context], self.contexts[context], c12, c2)

    def mix(self, weights: np.ndarray, bucket: np.ndarray, total: np.ndarray, c12: np.ndarray, c2: np.ndarray) -> np.ndarray:
        """The same from the context's bucket and count."""
        if not self.tokens:
            return np.full(len(c12), -np.log10(self.distinct + 1))
        one = c2 / self.tokens
        two = np.where(total > 0, c12 / np.maximum(total, 1), one)
        w = weights[bucket]
        return np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] / (self.distinct + 1))


def count_words(docs: DataFrame) -> DataFrame:
    """(w, n, k): training words and ends with counts over all and over the kept part."""
    def run(batches):
        every, kept = Counter(), Counter()

        def flush():
            words = list(every)
            batch = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(list(every.values()), pa.int64()),
                                                pa.array([kept[w] for w in words], pa.int64())], ["w", "n", "k"])
            every.clear()
            kept.clear()
            return batch
        for batch in slices(batches):
            for i, t in zip(column_of(batch, "doc_id").to_pylist(), texts(batch)):
                fold = fold_of(i)
                if fold not in (-1, HELD_OUT):
                    words = Counter(words_of(t))
                    words[END] = 1
                    every.update(words)
                    if fold != DELETED:
                        kept.update(words)
            if len(every) > 400_000:
                yield flush()
        if every:
            yield flush()
    return arrow_map(docs, run, "w binary, n long, k long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))


def hash_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) | 1 << 63


def vocabulary(docs: DataFrame, numbered: int = CONTEXTS, pooled: bool = False) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and (w, n, k) of all training words."""
    counted = materialize(count_words(docs), "words")
    total = counted.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("v")).first()
    n, k, v = total["n"] or 0, total["k"] or 0, total["v"] or 0
    top = counted.filter(F.col("w") != F.lit(bytearray(END))).orderBy(F.desc("n"), "w").limit(numbered).collect()
    ends = counted.filter(F.col("w") == F.lit(bytearray(END))).first()
    number = {END: 2} | {bytes(r["w"]): i for i, r in enumerate(top, 3)}
    count, kept = np.zeros(len(number) + 2, dtype=np.int64), np.zeros(len(number) + 2, dtype=np.int64)
    if ends:
        count[2], kept[2] = ends["n"], ends["k"]
    for i, r in enumerate(top, 3):
        count[i], kept[i] = r["n"], r["k"]
    before = []
    for c, t in ((count, n), (kept, k)):
        x = c.copy()
        x[RARE], x[START], x[2] = t - c.sum(), c[2], 0  # a text's first word or end follows START, nothing follows an end
        before.append(x)
    return Vocabulary(number, count, kept, *before, n, k, v, pooled), counted


def hashed_counts(vocab, counted: DataFrame) -> DataFrame:
    """(h, n, k) of the training words without a number."""
    def run(batches):
        number = vocab.value.number
        for batch in batches:
            words = column_of(batch, "w").to_pylist()
            rest = [i for i, w in enumerate(words) if w not in number]
            h = np.array([hash_of(words[i]) for i in rest], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), *(column_of(batch, c).take(pa.array(rest, pa.int64())) for c in "nk")], ["h", "n", "k"])
    return arrow_map(counted, run, "h long, n long, k long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))


def _pack_counts(parts: int):
    def run(batches):
        def rows(held):
            h, n, k = (np.concatenate(c) for c in zip(*held))
            h = h.view(np.uint64)
            part = (mix64(h) % np.uint64(parts)).astype(np.int64)
            o = np.argsort(part, kind="stable")
            return _rows(_packed(-1, part[o], [h[o], n[o], k[o]], COUNT))
        held = []
        for batch in batches:
            if batch.num_rows:
                held.append([np.asarray(column_of(batch, c), dtype=np.int64) for c in "hnk"])
            if len(held) >= 500:
                yield from rows(held)
                held = []
        if held:
            yield from rows(held)
    return run


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """(doc_ids, words of each text) of some neighbouring rows of a task."""
    ids, words, size = [], [], 0
    for batch in slices(batches):
        for some in (batch.slice(i, CHUNK_DOCS) for i in range(0, batch.num_rows, CHUNK_DOCS)):  # texts have 16-bit numbers
            text = texts(some)
            ids += column_of(some, "doc_id").to_pylist()
            words += [words_of(t) for t in text]
            size += sum(len(t) for t in text if t)
            if size > CHUNK_BYTES or len(ids) > CHUNK_DOCS:
                yield ids, words
                ids, words, size = [], [], 0
    if ids:
        yield ids, words


def encode(words: list[list[bytes]], number: dict[bytes, int], pooled: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: the word (its number, or a hash with the top bit set), context and text.
    Contexts are such words too, or RARE for all without a number if pooled."""
    flat = [w for ws in words for w in (*ws, END)]
    size = np.array([len(ws) + 1 for ws in words])
    n = len(flat)
    code = np.fromiter(map(number.get, flat, repeat(-1)), dtype=np.int64, count=n)
    word = code.astype(np.uint64)
    rare = np.flatnonzero(code < 0)
    digest = xxhash.xxh64_intdigest
    word[rare] = np.fromiter((digest(flat[i]) for i in rare.tolist()), dtype=np.uint64, count=len(rare)) | HASHED
    context = np.empty(n, dtype=np.uint64)
    context[1:] = np.maximum(code[:-1], RARE) if pooled else word[:-1]
    context[np.cumsum(size) - size] = START
    return word, context, np.repeat(np.arange(len(words)), size)


def part_of(word: np.ndarray, context: np.ndarray, parts: int) -> np.ndarray:
    """Hashed contexts by the context, numbered words by the pair, others by the word."""
    numbered = word < np.uint64(1 << 16)
    key = np.where(context >= HASHED, context, np.where(numbered, (word << np.uint64(16)) | context, word))
    return (mix64(key) % np.uint64(parts)).astype(np.int64)


def groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (the last one first) and the starts of equal runs."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def _packed(chunk: int, part: np.ndarray, columns: list[np.ndarray], kind: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Rows (part, chunk, kind and packed columns) of entries that are sorted by part."""
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else []
    ends = [*cut[1:], len(part)]
    for a, b in zip(cut, ends):
        yield int(part[a]), chunk, kind + b"".join(c[a:b].tobytes() for c in columns)


def _unpack(raw: list[bytes], kinds: list) -> list[np.ndarray]:
    """Columns of several packed entries (a kind byte, then columns), one after another; last
    the entry's position."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    out, which = [[] for _ in kinds], []
    for i, r in enumerate(raw):
        n, at = (len(r) - 1) // width, 1
        for c, k in zip(out, kinds):
            c.append(np.frombuffer(r, dtype=k, count=n, offset=at))
            at += n * np.dtype(k).itemsize
        which.append(np.full(n, i, dtype=np.int32))
    return [np.concatenate(c) for c in (*out, which)]


def _pairs(chunk: int, part, word, context, *columns) -> Iterator[tuple[int, int, bytes]]:
    """Packed rows of pairs that are sorted by part, hashed contexts apart."""
    far = context >= HASHED
    for kind, mine, size in ((PAIR, ~far, np.uint16), (FAR, far, np.uint64)):
        if mine.any():
            yield from _packed(chunk, part[mine], [word[mine], context[mine].astype(size), *(c[mine] for c in columns)], kind)


def _of_kind(kind: bytes, data: list[bytes], kinds: list = ()) -> list[np.ndarray] | None:
    """Unpacked entries of a kind, or None if there are none; last the row's position in data.
    Their rows in data are let go."""
    at = [i for i, d in enumerate(data) if d[:1] == kind]
    if not at:
        return None
    out = _unpack([data[i] for i in at], [*FIELDS[kind], *kinds])
    for i in at:
        data[i] = b""
    out[-1] = np.array(at, dtype=np.int32)[out[-1]]
    return out


def _look_up(table: list[np.ndarray] | None, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (all, kept) of hashes from a part's COUNT entries; 0 for words never learned from."""
    if table is None:
        return np.zeros(len(sought), dtype=np.int64), np.zeros(len(sought), dtype=np.int64)
    keys, n, k = table
    at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
    hit = keys[at] == sought
    return np.where(hit, n[at], 0), np.where(hit, k[at], 0)


def _table(data: list[bytes]) -> list[np.ndarray] | None:
    found = _of_kind(COUNT, data)
    if found is None:
        return None
    order = np.argsort(found[0])
    return [c[order] for c in found[:3]]


def bucket_of(count: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(count + 1)).astype(np.int64)


def _rows(rows, kinds="part int, chunk long, data binary"):
    rows = list(rows)
    if rows:
        p, c, d = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(c, pa.int64()), pa.array(d, pa.binary())], ["part", "chunk", "data"])


def _by_part(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """Rows of sorted batches by their key: (key, the other number, data)."""
    other = "chunk" if key == "part" else "part"
    held, who, data = None, [], []
    for batch in batches:
        for k, o, d in zip(column_of(batch, key).to_pylist(), column_of(batch, other).to_pylist(), column_of(batch, "data").to_pylist()):
            if k != held and who:
                yield held, who, data
                who, data = [], []
            held = k
            who.append(o)
            data.append(d)
    if who:
        yield held, who, data


def _task_chunk() -> int:
    return TaskContext.get().partitionId() << 32


def _pair_counts(vocab, parts: int):
    def run(batches):
        v = vocab.value
        for ids, words in chunks(batches):
            fold = np.array([fold_of(i) for i in ids])
            learn = [w for w, f in zip(words, fold) if f not in (-1, HELD_OUT)]
            deleted = fold[(fold != -1) & (fold != HELD_OUT)] == DELETED
            if not learn:
                continue
            word, context, doc = encode(learn, v.number, v.pooled)
            part = part_of(word, context, parts)
            order, start = groups(context, word, part)
            b = np.add.reduceat(deleted[doc][order].astype(np.uint32), start, dtype=np.uint32)
            every = np.diff(np.append(start, len(order))).astype(np.uint32)
            first = order[start]
            yield from _rows(_pairs(0, part[first], word[first], context[first], every - b, b))
    return run


def _bin(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(STEP * np.log10(np.maximum(p, 1e-300))), NEVER).astype(np.int64)


def _read_pairs(vocab, pairs: int):
    """Held-out counts by (bucket, bin of the pair's estimate, bin of the word's), the frequent
    pairs (kind 1), and held-out counts by (hashed word, bucket, bin of the pair's estimate)
    where the context is hashed too (kind 2)."""
    def run(batches):
        v = vocab.value
        least = max(2.0, v.tokens / pairs)

        def out(kind, keys, n):
            if not len(n):
                return
            order, start = groups(*keys[::-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(start), kind, dtype=np.int32)), *(pa.array(k[order[start]]) for k in keys), pa.array(np.add.reduceat(n[order], start))],
                ["kind", "x", "y", "z", "n"])
        for _, _, data in _by_part(batches, "part"):
            table = _table(data)
            for kind in (PAIR, FAR):
                found = _of_kind(kind, data, [np.uint32, np.uint32])
                if found is None:
                    continue
                word, context, a, b, _ = found
                del found
                order, start = groups(context, word)
                first = order[start]
                word, context = word[first], context[first]
                a, b = (np.add.reduceat(x[order].astype(np.int64), start) for x in (a, b))
                numbered = word < np.uint64(1 << 16)
                number = np.where(numbered, word, 0).astype(np.int64)
                if kind == PAIR:
                    context = context.astype(np.int64)
                    bucket, total = v.bucket_kept[context], v.contexts_kept[context]
                    c2 = np.where(numbered, v.kept[number], _look_up(table, word)[1])
                    ready = b > 0
                    hot = numbered & (a + b >= least)
                    code = (number[hot] << 16) | context[hot]
                    yield from out(1, [code, (a + b)[hot], np.zeros(len(code), dtype=np.int64)], np.zeros(len(code), dtype=np.int64))
                else:
                    total = _look_up(table, context)[1]
                    bucket, c2, ready = bucket_of(total), v.kept[number], numbered & (b > 0)
                two = np.where(total > 0, _bin(a / np.maximum(total, 1)), AS_WORD)
                one = _bin(c2 / max(v.tokens_kept, 1))
                yield from out(0, [bucket[ready], np.where(two == AS_WORD, one, two)[ready], one[ready]], b[ready])
                if kind == FAR:
                    far = ~numbered & (b > 0)
                    yield from out(2, [word[far].view(np.int64), bucket[far], two[far]], b[far])
    return run


def _far_bins(tokens_kept: int):
    """(y, z, k, n) with the word's kept count -> held-out counts by (bucket, bin, bin)."""
    def run(batches):
        for batch in batches:
            one, two = _bin(np.asarray(column_of(batch, "k")) / max(tokens_kept, 1)), np.asarray(column_of(batch, "z"))
            yield pa.RecordBatch.from_arrays([column_of(batch, "y"), pa.array(np.where(two == AS_WORD, one, two)), pa.array(one), column_of(batch, "n")],
                                             ["x", "y", "z", "n"])
    return run


def maximise(x: np.ndarray, y: np.ndarray, z: np.ndarray, n: np.ndarray, distinct: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (bucket, 3) from held-out counts n by bucket x and bins y (pair), z (word)."""
    p = np.stack([np.where(b == NEVER, 0.0, 10.0 ** (b / STEP)) for b in (y, z)] + [np.full(len(x), 1.0 / (distinct + 1))], axis=1)

    def fit(p, n):
        w = np.full(3, 1 / 3)
        for _ in range(rounds):
            r = p * w
            r *= (n / r.sum(axis=1))[:, None]
            w = (r.sum(axis=0) + [0, 0, 1e-3]) / (n.sum() + 1e-3)  # unseen words keep a share
        return w
    whole = fit(p, n) if len(n) else np.array([0.4, 0.4, 0.2])
    out = np.tile(whole, (BUCKETS, 1))
    for b in np.unique(x):
        out[b] = fit(p[x == b], n[x == b])
    return out


def _score_texts(vocab, weights, codes, counts, parts: int):
    """Scores frequent pairs in place; packs the others for the parts."""
    def run(batches):
        v, hot, hot_n = vocab.value, codes.value, counts.value
        for seq, (ids, words) in enumerate(chunks(batches)):
            chunk = _task_chunk() + seq
            fold = np.array([fold_of(i) for i in ids])
            word, context, doc = encode(words, v.number, v.pooled)
            n = len(ids)
            numbered = word < np.uint64(1 << 16)
            number = np.where(numbered, word, 0).astype(np.int64)
            c2 = v.count[number]
            known = np.bincount(doc, (numbered & (c2 > 0)), minlength=n)
            base = np.bincount(doc, np.where(numbered, v.base(c2), 0.0), minlength=n)
            code = (number << 16) | np.where(context < HASHED, context, 0).astype(np.int64)
            at = np.minimum(np.searchsorted(hot, code), max(len(hot) - 1, 0))
            here = numbered & (context < HASHED) & (hot[at] == code) if len(hot) else np.zeros(len(code), dtype=bool)
            own = v.log10(weights, context[here].astype(np.int64), hot_n[at[here]], c2[here]) if here.any() else np.zeros(0)
            score = np.bincount(doc[here], own, minlength=n) if here.any() else np.zeros(n)
            yield from _rows([(chunk % parts, chunk, b"T" + _sums(score, base, known) + _header(ids, fold, [len(w) + 1 for w in words]))])
            away = ~here
            word, context, doc = word[away], context[away], doc[away].astype(np.uint16)
            part = part_of(word, context, parts)
            order, start = groups(doc, context, word, part)
            if len(order):
                first = order[start]
                times = np.diff(np.append(start, len(order))).astype(np.uint32)
                learn = (fold[doc[first]] != -1) & (fold[doc[first]] != HELD_OUT)
                times |= learn.astype(np.uint32) << np.uint32(31)
                yield from _rows(_pairs(chunk, part[first], word[first], context[first], doc[first], times))
    return run


def _sums(score, base, known) -> bytes:
    return np.int64(len(score)).tobytes() + np.asarray(score, dtype=np.float64).tobytes() + np.asarray(base, dtype=np.float64).tobytes() + np.asarray(known, dtype=np.int32).tobytes()


def _header(ids, fold, tokens) -> bytes:
    return (np.array([0 if i is None else i for i in ids], dtype=np.int64).tobytes() + np.array([i is None for i in ids], dtype=np.int8).tobytes()
            + fold.astype(np.int8).tobytes() + np.array(tokens, dtype=np.int64).tobytes())


def _score_parts(vocab, weights, parts: int):
    """Packed pairs of a part -> sums per text; what is no pair passes through, pairs of two
    hashed words go on to the part of the word."""
    def run(batches):
        v = vocab.value
        for part, chunk, data in _by_part(batches, "part"):
            yield from _rows((part, c, d) for c, d in zip(chunk, data) if d[:1] == b"T")
            table, chunk = _table(data), np.array(chunk, dtype=np.int64)
            for kind in (PAIR, FAR):
                found = _of_kind(kind, data, [np.uint16, np.uint32])
                if found is None:
                    continue
                word, context, doc, times, which = found
                del found
                learn = times >> np.uint32(31) == 1
                times &= np.uint32(0x7FFFFFFF)
                order, start = groups(context, word)
                size = np.diff(np.append(start, len(order)))
                first = order[start]
                c12 = np.add.reduceat(np.where(learn, times, 0)[order], start, dtype=np.int64)
                del learn
                w, ctx = word[first], context[first]
                numbered = w < np.uint64(1 << 16)
                number = np.where(numbered, w, 0).astype(np.int64)
                spread = np.empty(len(order), dtype=np.int32)
                spread[order] = np.repeat(np.arange(len(start), dtype=np.int32), size)
                del order, context
                if kind == PAIR:
                    c2 = np.where(numbered, v.count[number], _look_up(table, w)[0])
                    logp = v.log10(weights, ctx.astype(np.int64), c12, c2)
                    base = np.where(numbered, 0.0, v.base(c2))
                    known = ~numbered & (c2 > 0)
                else:
                    total = _look_up(table, ctx)[0]
                    logp = v.mix(weights, bucket_of(total), total, c12, v.count[number])
                    base, known = np.zeros(len(w)), np.zeros(len(w), dtype=bool)
                    on = np.flatnonzero(~numbered[spread])
                    to = (mix64(word[on]) % np.uint64(parts)).astype(np.int64)
                    o = np.argsort(to, kind="stable")
                    on, to = on[o], to[o]
                    pair = spread[on]
                    yield from _rows(_packed(part, to, [word[on], c12[pair], total[pair], chunk[which[on]], doc[on], times[on]], ON))
                    near = numbered[spread]
                    spread, which, doc, times = spread[near], which[near], doc[near], times[near]
                del word
                yield from _text_sums(part, chunk, which, doc, (x[spread] * times for x in (logp, base, known)))
    return run


def _score_far(vocab, weights):
    """Pairs of two hashed words, at the part of the word -> sums per text."""
    def run(batches):
        v = vocab.value
        for part, _, data in _by_part(batches, "part"):
            pairs = [d for d in data if d[:1] == ON]
            if not pairs:
                continue
            word, c12, total, chunk, doc, times, _ = _unpack(pairs, [np.uint64, np.int64, np.int64, np.int64, np.uint16, np.uint32])
            c2 = _look_up(_table(data), word)[0]
            logp = v.mix(weights, bucket_of(total), total, c12, c2)
            chunks_of, which = np.unique(chunk, return_inverse=True)
            yield from _text_sums(part, chunks_of, which, doc, (x * times for x in (logp, v.base(c2), c2 > 0)))
    return run


def _text_sums(part: int, chunk: np.ndarray, which: np.ndarray, doc: np.ndarray, values: Iterator[np.ndarray]):
    """One row per entry of chunk: texts and their sums of the values (score, base, known)."""
    slots, back = np.unique(which * np.int64(65536) + doc, return_inverse=True)
    score, base, known = (np.bincount(back, x, minlength=len(slots)) for x in values)
    if not len(slots):
        return
    whose, texts_of = slots >> 16, (slots & 65535).astype(np.uint16)
    cut = np.flatnonzero(np.concatenate(([True], whose[1:] != whose[:-1])))
    yield from _rows([(part, int(chunk[whose[a]]), b"S" + _sums(score[a:b], base[a:b], known[a:b]) + texts_of[a:b].tobytes()) for a, b in zip(cut, [*cut[1:], len(whose)])])


def _gather(tokens: int):
    """Sums of a chunk's parts -> one row per text."""
    def run(batches):
        for _, _, data in _by_part(batches, "chunk"):
            head = next(d for d in data if d[:1] == b"T")
            n = int(np.frombuffer(head, np.int64, 1, 1)[0])
            total = [np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64)]
            for d in data:
                m = int(np.frombuffer(d, np.int64, 1, 1)[0])
                at = slice(None) if d[:1] == b"T" else np.frombuffer(d, np.uint16, m, 9 + 20 * m)
                total[0][at] += np.frombuffer(d, np.float64, m, 9)
                total[1][at] += np.frombuffer(d, np.float64, m, 9 + 8 * m)
                total[2][at] += np.frombuffer(d, np.int32, m, 9 + 16 * m)
            at = 9 + 20 * n
            ids, null = np.frombuffer(head, np.int64, n, at), np.frombuffer(head, np.int8, n, at + 8 * n).astype(bool)
            fold, size = np.frombuffer(head, np.int8, n, at + 9 * n), np.frombuffer(head, np.int64, n, at + 10 * n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=null), pa.array(fold == HELD_OUT), pa.array(size), pa.array(total[2]), pa.array(np.full(n, tokens, dtype=np.int64)),
                 pa.array(total[1]), pa.array(total[0])], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score_report(docs: DataFrame, contexts: int | None = None, pairs: int = PAIRS, part_tokens: int = PART_TOKENS, numbered: int = CONTEXTS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.
    ``numbered`` words have numbers, which changes no score; ``contexts`` asks for the smaller
    model where only so many words have a context of their own."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vocab, counted = vocabulary(docs, numbered if contexts is None else contexts, contexts is not None)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-vocab.tokens // part_tokens))
    shared = spark.sparkContext.broadcast(vocab)
    row = "part int, chunk long, data binary"

    hashed = materialize(hashed_counts(shared, counted), "hashed")
    counts_of = arrow_map(hashed, _pack_counts(parts), row)

    def dealt(df, *key):
        return df.repartition(parts, key[0]).sortWithinPartitions(*key)

    read = materialize(arrow_map(dealt(arrow_map(docs, _pair_counts(shared, parts), row).union(counts_of), "part"), _read_pairs(shared, pairs),
                                 "kind int, x long, y long, z long, n long"), "pairs")
    far = read.filter("kind = 2").join(hashed.select(F.col("h").alias("x"), "k"), "x").groupBy("y", "z", "k").agg(F.sum("n").alias("n"))
    near = read.filter("kind = 0").select("x", "y", "z", "n")
    every = near.union(arrow_map(far, _far_bins(vocab.tokens_kept), "x long, y long, z long, n long"))
    held = np.array([tuple(r) for r in every.groupBy("x", "y", "z").agg(F.sum("n").alias("n")).orderBy("x", "y", "z").collect()], dtype=np.int64).reshape(-1, 4)
    weights = maximise(*held.T, vocab.distinct)
    found = read.filter("kind = 1").select("x", "y").toArrow()  # at most ``pairs`` rows
    hot = np.stack([np.asarray(found[c], dtype=np.int64) for c in ("x", "y")], axis=1)
    hot = hot[np.argsort(hot[:, 0])]
    codes, counts = (spark.sparkContext.broadcast(np.ascontiguousarray(hot[:, i])) for i in (0, 1))
    packed = arrow_map(docs, _score_texts(shared, weights, codes, counts, parts), row).union(counts_of)
    sums = materialize(arrow_map(dealt(packed, "part", "chunk"), _score_parts(shared, weights, parts), row).withColumn("far", F.substring("data", 1, 1) == F.lit(bytearray(ON))), "sums")
    onward = arrow_map(dealt(sums.filter("far").drop("far").union(counts_of), "part"), _score_far(shared, weights), row)
    return arrow_map(dealt(sums.filter("not far").drop("far").union(onward), "chunk", "part"), _gather(vocab.tokens),
                     "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_report(docs_table(spark, sf_dir))


SQL: dict[str, str] = {}
QUERIES = {"op8_lm_scoring": op8_lm_scoring}
