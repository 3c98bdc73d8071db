"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items build one automaton (all items share its states).
Each text's words are streamed through it while the longest match that ends at the word is
tracked.  A match of ``window`` words, or of a whole shorter item, marks its words as hit and
names the items that hold it.  Only runs whose neighbouring words are neighbours in some
item are streamed (any match lies inside such a run), most words never reach the automaton.

An automaton takes items up to ``SHARD_WORDS`` words, which bounds what is broadcast; more
items make more automata, applied one after the other over the texts, each pass written to
the shared folder.

Defined results: A-Z are lower-cased; null or wordless texts have no words and no hits; items
without words never match; rows that repeat give repeated results, items that repeat (or
share an id) name that id once, a null item_id counts as the string ``null``; empty tables of
either kind give no hits; extra columns are ignored by the query and kept by ``remove_leaks``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, column_of, docs_table, materialize, slices, texts

WINDOW = 10
#: Words of the items in one automaton (two states and a few transitions a word).
SHARD_WORDS = 200_000
#: Share of a text's words from which ``remove_leaks`` drops the text instead of the spans.
MAX_COVERAGE = 0.8

# bytes that separate words; A-Z become a-z, bytes from 0x80 on belong to words
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences (as ids)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.ids = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws in items for w in ws))}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.shortest = min((min(len(ws), window) for _, ws in items if ws), default=0)
        coded = [(name, [self.ids[w] for w in ws]) for name, ws in items if ws]
        pairs = set()
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._add(last, w)
            pairs.update(zip(ws, ws[1:]))
        size = max(len(self.ids), 1)
        self.pairs = np.sort(np.array([a * size + b for a, b in pairs], dtype=np.int64))
        # items by the state of each of their windows (or of the whole shorter item)
        self.windows: dict[int, set[str]] = {}
        self.whole: dict[int, tuple[int, set[str]]] = {}
        for name, ws in coded:
            if len(ws) < window:
                state = 0
                for w in ws:
                    state = self.next[state][w]
                self.whole.setdefault((state, len(ws)), set()).add(name)
            else:
                for end, (state, length) in enumerate(self.walk(ws)):
                    if length == window:
                        self.windows.setdefault(state, set()).add(name)
        self.whole_states = {s for s, _ in self.whole}
        # nearest state up the suffix links (itself included) that ends a whole short item
        self.up = [-1] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.len.__getitem__):
            self.up[s] = s if s in self.whole_states else self.up[self.link[s]]
        self.whole_by_state: dict[int, list] = {}
        for (s, n), names in self.whole.items():
            self.whole_by_state.setdefault(s, []).append((n, names))

    def _add(self, last: int, w: int) -> int:
        """Extend by one word after state ``last``; returns the state of the longer prefix."""
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def walk(self, ws: list[int]) -> Iterator[tuple[int, int]]:
        """After each word: the state of the longest match that ends there and its length,
        at most ``window``."""
        nxt, link, length = self.next, self.link, self.len
        state = n = 0
        for w in ws:
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                n += 1
                if n > self.window:
                    n = self.window
                while length[link[state]] >= n and link[state] > 0:
                    state = link[state]
            else:
                state = n = 0
            yield state, n

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words (first, end) and the items with occurring windows."""
        n = len(words)
        if not self.shortest or n < self.shortest:
            return [], set()
        codes = np.fromiter(map(self.ids.get, words, [-1] * n), dtype=np.int64, count=n)
        known = codes >= 0
        if not known.any():
            return [], set()
        pair = codes[:-1] * max(len(self.ids), 1) + codes[1:]
        at = np.searchsorted(self.pairs, pair)
        joined = known[:-1] & known[1:]
        if len(self.pairs):
            joined &= self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair
        else:
            joined[:] = False
        # maximal runs of joined words
        edge = np.flatnonzero(np.diff(np.concatenate(([0], joined.astype(np.int8), [0]))))
        starts, ends = edge[::2], edge[1::2] + 1
        if self.shortest == 1:
            alone = np.flatnonzero(known & ~np.append(joined, False) & ~np.insert(joined, 0, False))
            starts, ends = np.append(starts, alone), np.append(ends, alone + 1)
        long = ends - starts >= self.shortest
        spans, names = [], set()
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            for i, (state, length) in enumerate(self.walk(codes[a:b].tolist()), a + 1):
                if length == self.window and state in self.windows:
                    spans.append((i - length, i))
                    names |= self.windows[state]
                s = self.up[state] if state else -1
                while s > 0:
                    for size, held in self.whole_by_state[s]:
                        if size <= length:
                            spans.append((i - size, i))
                            names |= held
                    s = self.up[self.link[s]] if self.link[s] > 0 else -1
        return spans, names


def shards(benchmark: DataFrame, window: int, shard_words: int = SHARD_WORDS) -> Iterator[Automaton]:
    """Automata of the items, each of items with about ``shard_words`` words."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"),
                            F.col("text").cast("string").alias("t")).filter("t is not null")
    held, size = [], 0
    for r in materialize(rows, "items").toLocalIterator():
        ws = words_of(r["t"])
        held.append((r["i"], ws))
        size += len(ws)
        if size >= shard_words:
            yield Automaton(held, window)
            held, size = [], 0
    if held:
        yield Automaton(held, window)


_MARKS = "_pc_spans array<struct<s:int,e:int>>, _pc_items array<string>"


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """docs with _pc_spans (hit words, as spans) and _pc_items (sorted ids)."""
    spark = docs.sparkSession
    docs = docs.withColumn("text", F.col("text").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", " + _MARKS
    out = docs.withColumns({"_pc_spans": F.array().cast("array<struct<s:int,e:int>>"), "_pc_items": F.array().cast("array<string>")})
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    for k, automaton in enumerate(shards(benchmark, window, shard_words)):
        shared = spark.sparkContext.broadcast(automaton)

        def run(batches, shared=shared):
            a = shared.value
            for batch in slices(batches):
                spans, items = [], []
                for t, old, had in zip(texts(batch), texts(batch, "_pc_spans"), texts(batch, "_pc_items")):
                    s, names = a.match(words_of(t))
                    spans.append(old + [{"s": x, "e": y} for x, y in s])
                    items.append(sorted(names.union(had)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(spans, span) if n == "_pc_spans" else pa.array(items, pa.list_(pa.string())) if n == "_pc_items"
                     else column_of(batch, n) for n in batch.schema.names], batch.schema.names)
        if k:
            out = materialize(out, "leaks")
        out = arrow_map(out, run, schema)
    return out


def _hit(n: int, spans) -> np.ndarray:
    gone = np.zeros(n + 1, dtype=np.int32)
    for x in spans:
        gone[x["s"]] += 1
        gone[x["e"]] -= 1
    return np.cumsum(gone[:n]) > 0


_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def cut(text: str, spans) -> tuple[str, float]:
    """The text without its hit words, and the share of words that were hit."""
    places = [m.span() for m in _WORD.finditer(text)]
    hit = _hit(len(places), spans)
    out, at = [], 0
    for i in np.flatnonzero(hit).tolist():
        a, b = places[i]
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return "".join(out), float(hit.mean())


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """docs without hit words; texts with more than ``max_coverage`` of their words hit go.
    n_chars follows if present."""
    def run(batches):
        for batch in batches:
            new, stay = [], []
            for t, s in zip(texts(batch), texts(batch, "_pc_spans")):
                left, share = cut(t, s) if s else (t, 0.0)
                new.append(left)
                stay.append(share <= max_coverage)
            names = [n for n in batch.schema.names if not n.startswith("_pc_")]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == "text" else column_of(batch, n) for n in names],
                                             names).filter(pa.array(stay))

    marked = mark(docs, benchmark, window)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields if not f.name.startswith("_pc_"))
    out = arrow_map(marked, run, schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def leak_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    pairs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            n, hit, items, sha = [], [], [], []
            for t, s, names in zip(texts(batch), texts(batch, "_pc_spans"), texts(batch, "_pc_items")):
                n.append(len(words_of(t)))
                hit.append(int(_hit(n[-1], s).sum()))
                items.append(len(names))
                sha.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(items, pa.int64()),
                 pa.array(sha, pa.string()), pa.array([h > 0 for h in hit], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    return arrow_map(mark(pairs, benchmark, window, shard_words), run,
                     "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(docs_table(spark, sf_dir), docs_table(spark, sf_dir, "benchmark"))


SQL = {
    "op5_benchmark_decontamination": """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS q
  FROM (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS q
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)
), hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.q = bw.q
), pos AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM hit GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
}
QUERIES = {"op5_benchmark_decontamination": op5_benchmark_decontamination}
