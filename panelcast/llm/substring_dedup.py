"""Substring dedup by super-k-mer partitioning.

A window is ``k`` consecutive words of one text.  Every window gets a minimiser: the
leftmost smallest hashed ``m``-word piece inside it.  Consecutive windows that share one
minimiser occurrence travel as one packed string (a super-k-mer) to the bucket of that
minimiser, so a window costs a fraction of its words in the shuffle.  Equal windows always
meet in one bucket; there the packed strings are sorted and the windows compared by their
words, never by hash.

* Of equal packed strings only the earliest place can be a first occurrence.  A map slice
  sends that one; the others are spans to remove at once, which skip the buckets.
* Pieces that are frequent in a small sample rank last among minimisers (the sample only
  sets an order; every order gives the same result), so a common line spreads over its
  contexts instead of filling one bucket.  Windows that hold frequent pieces only (a passage
  that a third of all rows may share) go to ``SALTS`` buckets per minimiser first.
* A bucket is held in parts of at most ``PART_BYTES``.  The parts of larger buckets and the
  salted buckets settle what repeats inside them and hand on each window's earliest place;
  in a last round these meet by the window's own words, so no minimiser fills a task there
  and a window has at most one place a part.
* The strings go in PASSES rounds by minimiser, which halves the disk they need at once.
* What is removed is written to the shared folder as spans per text, and meets the texts
  in one join on (doc_id, text key).

Defined results: null or blank texts have no words; a null doc_id orders before all others;
rows that repeat (same doc_id and text) get equal results, as a window is repeated only if
its words start at a strictly smaller (doc_id, start); rows with the same doc_id and other
texts are judged separately; an empty table gives an empty table; extra columns are ignored
by the query and kept by ``remove_repeats``.  A very long text is a slice of its own, held
whole by one task at a time; its strings are dealt like all others.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import LOWEST, arrow_map, docs_table, mix64, materialize, slices, texts, column_of, text_key

WINDOW = 20
PIECE = 4
#: Rounds over the texts; each shuffles 1/PASSES of the packed strings (about 4.2 bytes per input byte in all).
PASSES = 2
#: Share of the sampled pieces from which one counts as frequent; its inverse bounds their number.
FREQUENT_SHARE = 1 / 20_000
SAMPLE = 0.02
#: Buckets that the strings of a frequent minimiser go to before they meet.
SALTS = 64
#: Bytes of packed strings and places that a bucket's part holds in memory.
PART_BYTES = 8 << 20

_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                                0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_PLACE = "<qIi"  # doc_id, text key, first word
_SPAN = np.dtype([("d", "<i8"), ("h", "<u4"), ("s", "<i4"), ("e", "<i4")])  # words s to e of a text are repeated
_PACKED = "mini long, salt int, packed binary, places binary"
_FOUND = "d long, h long, s int, e int, packed binary"  # spans; with packed, a window's earliest place in its part


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ as UTF-8 bytes (bytes.split() cuts at exactly these six)."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return mix64(np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words)))


def ranks(word: np.ndarray, m: int) -> np.ndarray:
    """63-bit hash of each piece of m consecutive (hashed) words."""
    n = len(word) - m + 1
    piece = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(m if n > 0 else 0):
        piece += word[j:n + j] * _MULT[j % 8]
    return mix64(piece) >> np.uint64(1)


def super_kmers(docs: list[list[bytes]], k: int, m: int, frequent: np.ndarray):
    """Super-k-mers of some texts: (words joined, byte offsets, first word, last window,
    minimiser hash, text index), all arrays over super-k-mers but the first two."""
    flat = [w for d in docs for w in d]
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    n = len(flat)
    if n < k:
        return None
    ends = np.cumsum(sizes)
    starts = ends - sizes
    joined = b" ".join(flat)
    offsets = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, flat), dtype=np.int64, count=n) + 1, out=offsets[1:])
    word = word_hashes(flat)
    rank = ranks(word, m)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, rank), len(frequent) - 1)
        rank |= (frequent[at] == rank).astype(np.uint64) << np.uint64(63)
    # leftmost minimum over w pieces, by doubling
    w = k - m + 1
    value, place, width = rank, np.arange(len(rank), dtype=np.int64), 1
    while width < w:
        step = min(width, w - width)
        a, b = value[:-step], value[step:]
        later = b < a
        value, place = np.where(later, b, a), np.where(later, place[step:], place[:-step])
        width += step
    inside = np.zeros(n + 1, dtype=np.int64)
    long = sizes >= k
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - k + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:len(value)]) > 0)
    if not len(at):
        return None
    place = place[at]
    cut = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    first = at[cut]
    last = at[np.concatenate((cut[1:], [len(at)])) - 1]
    return joined, offsets, first, last, rank[place[cut]], np.searchsorted(ends, first, side="right"), starts


def _earliest(places: list[tuple[int, int, int]], n_words: int, out: list) -> bytes:
    """The earliest of equal strings' places (doc_id, text key, first word), packed, with its
    ties under other keys; ``out`` gets the others as spans."""
    if len(places) > 1:
        head = min((d, s) for d, _, s in places)
        out.extend((d, h, s, s + n_words) for d, h, s in places if (d, s) != head)
        places = {p for p in places if (p[0], p[2]) == head}
    return b"".join(struct.pack(_PLACE, *p) for p in sorted(places))


def _pack_spans(spans: list[tuple[int, int, int, int]]) -> bytes:
    """Spans of texts, those that touch put together."""
    spans.sort()
    whole = []
    for d, h, s, e in spans:
        if whole and whole[-1][:2] == [d, h] and s <= whole[-1][3]:
            whole[-1][3] = max(whole[-1][3], e)
        else:
            whole.append([d, h, s, e])
    return np.array([tuple(x) for x in whole], dtype=_SPAN).tobytes()


def _emit_super_kmers(k: int, m: int, frequent: np.ndarray, part: int, passes: int, salts: int):
    """Packed strings of the minimisers that belong to one pass, and per slice one row
    (packed is null) with the spans that are repeated within it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = column_of(batch, "doc_id").to_pylist()
            text = texts(batch)
            found = super_kmers([words_of(t) for t in text], k, m, frequent)
            if found is None:
                continue
            joined, offsets, first, last, mini, doc, starts = found
            mine = np.flatnonzero(mini % np.uint64(passes) == np.uint64(part))
            first, last, mini, doc = first[mine], last[mine], mini[mine], doc[mine]
            keys = [(LOWEST if i is None else i, text_key(t)) for i, t in zip(ids, text)]
            lo, hi = offsets[first].tolist(), (offsets[last + k] - 1).tolist()
            start, n_words = (first - starts[doc]).tolist(), (last - first + k).tolist()
            merged: dict[bytes, list] = {}
            order, sizes = [], []
            for a, b, d, s, h, n in zip(lo, hi, doc.tolist(), start, mini.view(np.int64).tolist(), n_words):
                packed = joined[a:b]
                place = (*keys[d], s)
                if packed in merged:
                    merged[packed].append(place)
                else:
                    merged[packed] = [place]
                    order.append(h)
                    sizes.append(n)
            spans: list = []
            places = [_earliest(v, n, spans) for v, n in zip(merged.values(), sizes)]
            own = zlib.crc32(repr(keys[0]).encode())  # spreads slices
            salt = np.where(np.array(order, dtype=np.int64) < 0, own % salts, 0)
            strings: list[bytes | None] = list(merged)
            if spans:
                order.append(own)
                salt = np.append(salt, -1)
                strings.append(None)
                places.append(_pack_spans(spans))
            yield pa.RecordBatch.from_arrays(
                [pa.array(order, pa.int64()), pa.array(salt.astype(np.int32)), pa.array(strings, pa.binary()), pa.array(places, pa.binary())],
                ["mini", "salt", "packed", "places"])
    return run


def _spans_of_bucket(rows: list[tuple[bytes, bytes]], k: int, out: list, firsts: list | None = None) -> None:
    """Compare the windows of one minimiser's packed strings; ``out`` gets the spans of
    repeated ones as (doc_id, key, first word, end word), ``firsts`` (if the bucket is only a
    part) every distinct window with its earliest place as (doc_id, key, first word, end
    word, window)."""
    first_places = []
    for packed, raw in rows:
        places = sorted(struct.iter_unpack(_PLACE, raw), key=lambda p: (p[0], p[2]))
        head = (places[0][0], places[0][2])
        n_words = packed.count(b" ") + 1
        same = [p for p in places if (p[0], p[2]) == head]
        out.extend((d, h, s, s + n_words) for d, h, s in places[len(same):])
        first_places.append((head, packed, same))
    if len(first_places) < 2 and firsts is None:
        return
    first_places.sort(key=lambda x: x[0])
    seen: dict[bytes, tuple[int, int]] = {}
    for (doc, start), packed, same in first_places:
        cut = [0, *(np.flatnonzero(np.frombuffer(packed, dtype=np.uint8) == 32) + 1).tolist(), len(packed) + 1]
        run = -1
        n = len(cut) - k
        for j in range(n):
            at = (doc, start + j)
            window = packed[cut[j]:cut[j + k] - 1]
            if seen.setdefault(window, at) != at:
                run = j if run < 0 else run
                continue
            if firsts is not None:
                firsts.extend((d, h, s + j, s + j + k, window) for d, h, s in same)
            if run >= 0:
                out.extend((d, h, s + run, s + j - 1 + k) for d, h, s in same)
                run = -1
        if run >= 0:
            out.extend((d, h, s + run, s + n - 1 + k) for d, h, s in same)


def _find_spans(k: int, part_bytes: int):
    """Sorted rows of buckets -> spans.  Buckets of frequent minimisers (the top bit) and
    those above ``part_bytes`` are judged part by part and give their first windows too."""
    one = struct.calcsize(_PLACE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes]] = []
        held_key, held_bytes, split = None, 0, False
        out: list = []
        firsts: list[tuple[int, int, int, int, bytes]] = []

        def close():
            if not held:
                return
            if split or held_key[0] < 0:
                _spans_of_bucket(held, k, out, firsts)
            elif len(held) > 1 or len(held[0][1]) > one:
                _spans_of_bucket(held, k, out)

        def flush(ready=()):
            """Spans (without a window) and first windows."""
            spans = np.concatenate([np.array(out, dtype=_SPAN), np.array([f[:4] for f in firsts], dtype=_SPAN)])
            windows = pa.array([None] * len(out) + [f[4] for f in firsts], pa.binary())
            if len(ready):
                spans = np.concatenate([spans, *ready])
                windows = pa.concat_arrays([windows, pa.nulls(len(spans) - len(windows), pa.binary())])
            batch = pa.RecordBatch.from_arrays(
                [pa.array(spans[c].astype(t)) for c, t in (("d", np.int64), ("h", np.int64), ("s", np.int32), ("e", np.int32))] + [windows],
                ["d", "h", "s", "e", "packed"])
            out.clear()
            firsts.clear()
            return batch

        for batch in batches:
            done = column_of(batch, "packed").is_null()
            if done.true_count:
                yield flush([np.frombuffer(x, dtype=_SPAN) for x in column_of(batch, "places").filter(done).to_pylist()])
                batch = batch.filter(pc.invert(done))
            n = batch.num_rows
            if not n:
                continue
            mini, salt = np.asarray(column_of(batch, "mini")), np.asarray(column_of(batch, "salt"))
            packed, places = column_of(batch, "packed"), column_of(batch, "places")
            cut = np.flatnonzero(np.concatenate(([True], (mini[1:] != mini[:-1]) | (salt[1:] != salt[:-1]))))
            size = np.diff(np.concatenate((cut, [n])))
            many = np.asarray(pc.binary_length(places)) > one
            work = (size > 1) | np.add.reduceat(many, cut).astype(bool) | (mini[cut] < 0)
            work[0] = work[-1] = True  # may go on in the next batch
            for a, c in zip(cut[work].tolist(), size[work].tolist()):
                key = (int(mini[a]), int(salt[a]))
                if key != held_key:
                    close()
                    held, held_key, held_bytes, split = [], key, 0, False
                for row in zip(packed.slice(a, c).to_pylist(), places.slice(a, c).to_pylist()):
                    held.append(row)
                    held_bytes += len(row[0]) + len(row[1])
                    if held_bytes > part_bytes:
                        split = True
                        close()
                        held, held_bytes = [], 0
                        yield flush()
                if len(out) + len(firsts) > 50_000:
                    yield flush()
        close()
        if out or firsts:
            yield flush()
    return run


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the pieces of sampled texts; the piece -1 counts all."""
    for batch in slices(batches):
        rank = [ranks(word_hashes(words_of(t)), PIECE) for t in texts(batch)]
        piece, count = np.unique(np.concatenate(rank), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(piece.view(np.int64), -1)), pa.array(np.append(count, count.sum()).astype(np.int64))], ["piece", "n"])


def frequent_pieces(docs: DataFrame, sample: float = SAMPLE, share: float = FREQUENT_SHARE) -> np.ndarray:
    """Pieces that are ``share`` of a sample's pieces: at most 1/share of them."""
    counts = (arrow_map(docs.sample(False, sample, seed=7), _count_pieces, "piece long, n long")
              .groupBy("piece").agg(F.sum("n").alias("n")).filter("n >= 4 or piece = -1"))
    counts = materialize(counts, "pieces")
    every = counts.filter("piece = -1").first()
    rows = counts.filter((F.col("piece") >= 0) & (F.col("n") >= share * (every["n"] if every else 0))).select("piece").collect()
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64))


def repeated_spans(docs: DataFrame, k: int = WINDOW, m: int = PIECE, passes: int = PASSES, salts: int = SALTS,
                   part_bytes: int = PART_BYTES) -> DataFrame:
    """Spans of words covered by windows that also start earlier: (d, h, spans), one row
    per text with any; d is the doc_id, h the text key.  ``docs``: doc_id, text.  Each pass
    takes its share of the minimisers, so that only that share of the packed strings is on
    disk at once."""
    frequent = frequent_pieces(docs)
    found = []
    for part in range(passes):
        packed = arrow_map(docs, _emit_super_kmers(k, m, frequent, part, passes, salts), _PACKED)
        found.append(materialize(arrow_map(packed.repartition("mini", "salt").sortWithinPartitions("mini", "salt"),
                                           _find_spans(k, part_bytes), _FOUND), "spans"))
    every = reduce(DataFrame.unionByName, found)
    # a place earlier than all others of the same window has rank 1, and so have its ties
    earlier = F.rank().over(Window.partitionBy("packed").orderBy("d", "s"))
    late = every.filter("packed is not null").withColumn("r", earlier).filter("r > 1")
    spans = every.filter("packed is null").select("d", "h", "s", "e").unionByName(late.select("d", "h", "s", "e"))
    return spans.groupBy("d", "h").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def _kept(words: list[bytes], spans) -> list[bytes]:
    if not spans:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int32)
    for x in spans:
        gone[x["s"]] += 1
        gone[x["e"]] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def _with_spans(docs: DataFrame, k: int) -> DataFrame:
    """docs with _pc_spans; joined on the doc_id and the text's key."""
    pairs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = repeated_spans(pairs, k).select(F.col("d").alias("_pc_d"), F.col("h").alias("_pc_h"),
                                            F.col("spans").alias("_pc_spans"))
    keyed = docs.withColumns({"_pc_d": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)),
                              "_pc_h": F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0))})
    return keyed.join(spans, ["_pc_d", "_pc_h"], "left").drop("_pc_d", "_pc_h")


def remove_repeats(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """docs with each text's kept words joined by one space (n_chars follows if present);
    a text that lost all its words goes, texts that lost none stay as they are."""
    joined = _with_spans(docs, k)

    def run(batches):
        for batch in batches:
            new, stay = [], []
            for t, s in zip(texts(batch), texts(batch, "_pc_spans")):
                left = _kept(words_of(t), s) if s else None
                new.append(t if left is None else b" ".join(left).decode("utf-8", "surrogatepass"))
                stay.append(left is None or bool(left))
            names = [n for n in batch.schema.names if n != "_pc_spans"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, pa.string()) if n == "text" else column_of(batch, n) for n in names], names).filter(pa.array(stay))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = arrow_map(joined.select(*[F.col(f"`{c}`") for c in docs.columns], "_pc_spans")
                    .withColumn("text", F.col("text").cast("string")), run,
                    schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def dedup_report(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    joined = _with_spans(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                     F.col("text").cast("string").alias("text")), k)

    def run(batches):
        for batch in batches:
            n, gone, sha = [], [], []
            for t, s in zip(texts(batch), texts(batch, "_pc_spans")):
                words = words_of(t)
                kept = _kept(words, s)
                n.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(n, pa.int64()),
                                              pa.array(gone, pa.int64()), pa.array(sha)],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return arrow_map(joined, run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(docs_table(spark, sf_dir))


SQL = {
    "op1_substring_dedup": """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i AS start, array_to_string(list_slice(ws, i, i + 19), ' ') AS q
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)
), dup AS (
  SELECT doc_id, start FROM (
    SELECT doc_id, start, row_number() OVER (PARTITION BY q ORDER BY doc_id, start) AS r FROM win) WHERE r > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT doc_id, unnest(range(start, start + 20)) AS p FROM dup) GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
         CASE WHEN ps IS NULL THEN ws
              ELSE list_transform(list_filter(list_transform(ws, lambda x, i: {'x': x, 'k': NOT list_contains(ps, i)}), lambda s: s.k), lambda s: s.x)
         END AS ks
  FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(ks, ' ')) AS kept_sha256
FROM kept""",
}
QUERIES = {"op1_substring_dedup": op1_substring_dedup}
