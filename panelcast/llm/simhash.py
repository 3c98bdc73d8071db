"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: the texts' word shingles (repeats included) are hashed by XXH64 (seed 42); a
bit is 1 if it is set in over half of the hashes.  Search for fingerprints at ``radius`` or
fewer differing bits:

1. The 64 bits are grouped into ``parts`` partitions so that correlated bits share one (bit
   co-occurrence counted over all distinct fingerprints).
2. If thresholds t_i >= -1 with sum(t_i + 1) = radius + 1 are allotted to the partitions,
   every fingerprint within the radius differs in at most t_i bits of some partition i.  The
   allotment is made for each fingerprint by dynamic programming on estimated candidate
   counts (histograms of all partition values), so crowded partitions get -1 (not probed)
   and sparse ones a larger threshold.
3. Each fingerprint is filed under its exact partition values and probes all values within
   t_i; candidates are verified by their full distance in the cell where they meet.

A cell emits a spanning forest of its links, never its pairs: components need no more.  Cells
above ``BLOCK`` rows are cut into blocks and compared block by block in many tasks, so a
group of near copies that holds a third of all rows neither fills one task nor loses a link.
Exact copies collapse before (one row per distinct fingerprint).

Defined results: null, empty and blank texts have fingerprint zero, linked like any other;
fewer words than a shingle give one shingle; a component's id is its smallest non-null
doc_id (null if it has none); repeated rows give repeated results; an empty table gives an
empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import ASCII_LOWER, arrow_map, column_of, docs_table, ids_and_text, materialize, slices, text_key, texts
from panelcast.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCK = 4096
#: Histograms of partition values look at so many of a partition's bits at most.
HIST_BITS = 16
#: Relative costs of a probed value (a shuffled row) and of a candidate (one comparison).
PROBE_COST, CANDIDATE_COST = 2e-6, 4e-9

# each byte's eight bits in eight byte-wide lanes
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64).ravel()


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    lanes = _LANES[h.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, len(h), 255), axis=0)
    return sums.view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = [] if text is None else text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    start = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1, out=start[1:])
    lo, hi = start[:n - shingle + 1].tolist(), (start[shingle:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(lo, hi)), dtype=np.uint64, count=len(lo))
    bits = (2 * bit_counts(h) > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp) for every row of docs (doc_id, text); h is the text's key."""
    def run(batches):
        for batch in slices(batches):
            text = texts(batch)
            fp = np.array([fingerprint(t, shingle) for t in text], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array([text_key(t) for t in text], pa.int64()),
                                              pa.array(fp.view(np.int64))], ["doc_id", "h", "fp"])
    return arrow_map(docs, run, "doc_id long, h long, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Partition the 64 bits into ``parts`` groups of (nearly) equal size, correlated bits
    together; both[i, j]: fingerprints with bits i and j set."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, groups = set(range(64)), []
    for g in range(parts):
        size = 64 // parts + (g < 64 % parts)
        free = sorted(left)
        group = [max(free, key=lambda i: (round(float(related[i, free].max()), 9), -i))]
        while len(group) < size:
            free = sorted(left - set(group))
            group.append(max(free, key=lambda i: (round(float(related[i, group].sum()), 9), -i)))
        groups.append(sorted(group))
        left -= set(group)
    return groups


def values_of(fp: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), dtype=np.uint64)
    for k, b in enumerate(group):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def choose_parts(n: int, radius: int) -> int:
    """Number of partitions with the least estimated cost for n fingerprints."""
    def cost(parts: int) -> float:
        spare, width = radius + 1 - parts, 64 / parts
        t = [spare // parts + (i < spare % parts) for i in range(parts)]
        probes = sum(sum(comb(round(width), e) for e in range(x + 1)) for x in t)
        return probes * (PROBE_COST + CANDIDATE_COST * n / 2 ** width)
    return min(range(min(2, radius + 1), radius + 2), key=cost)


def allot(counts: np.ndarray, radius: int) -> np.ndarray:
    """counts[q, i, t + 1]: estimated candidates of fingerprint q in partition i at threshold
    t (t = -1: none).  Returns thresholds (q, parts) with sum(t + 1) = radius + 1 and the
    least sum of counts, by dynamic programming over partitions."""
    n, parts, levels = counts.shape
    best = np.full((n, radius + 2), np.inf)
    best[:, 0] = 0
    taken = []
    for i in range(parts):
        new, pick = np.full_like(best, np.inf), np.zeros(best.shape, dtype=np.int8)
        for used in range(min(levels, radius + 2)):
            through = best[:, :radius + 2 - used] + counts[:, i, used, None]
            better = through < new[:, used:]
            new[:, used:][better] = through[better]
            pick[:, used:][better] = used
        best = new
        taken.append(pick)
    left, out = np.full(n, radius + 1), np.zeros((n, parts), dtype=np.int64)
    for i in reversed(range(parts)):
        used = taken[i][np.arange(n), left]
        out[:, i] = used - 1
        left = left - used
    return out


def _estimates(hist: list[np.ndarray], groups: list[list[int]], radius: int) -> list[np.ndarray]:
    """For each partition a table (histogram key, t + 1) of expected candidates plus the
    cost of the probed values."""
    out = []
    for h, group in zip(hist, groups):
        w = len(group)
        b = min(w, HIST_BITS)
        ball, at = h.astype(np.float64), np.arange(len(h))
        table = np.zeros((len(h), radius + 2))
        shells = [ball]
        for e in range(1, radius + 1):  # h summed over keys that differ in exactly e bits
            prev = sum(shells[e - 1][at ^ (1 << k)] for k in range(b))
            older = shells[e - 2] * (b - e + 2) if e > 1 else 0
            shells.append((prev - older) / e)
        seen = np.zeros(len(h))
        values = 0
        for e in range(radius + 1):
            values += comb(w, e)
            # keys cover b of w bits: e flips fall inside the key with hypergeometric odds
            near = sum(shells[x] * comb(w - b, e - x) for x in range(e + 1)) / 2.0 ** (w - b)
            seen = seen + near
            table[:, e + 1] = seen * CANDIDATE_COST + values * PROBE_COST
        out.append(table)
    return out


def _flips(width: int, t: int) -> np.ndarray:
    """XOR masks with 1..t bits of a partition."""
    masks = [sum(1 << k for k in c) for e in range(1, t + 1) for c in combinations(range(width), e)]
    return np.array(masks, dtype=np.uint64)


def _file_and_probe(groups, tables, radius):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                fp = np.asarray(column_of(batch.slice(a, 1024), "fp")).view(np.uint64)
                values = [values_of(fp, g) for g in groups]
                keys = [(v & np.uint64((1 << min(len(g), HIST_BITS)) - 1)).astype(np.int64) for v, g in zip(values, groups)]
                t = allot(np.stack([tab[k] for tab, k in zip(tables, keys)], axis=1), radius)
                part, value, who, data, ask = [], [], [], [], []

                def add(i, v, f, d, q):
                    part.append(np.full(len(v), i, dtype=np.int32))
                    value.append(v)
                    who.append(f)
                    data.append(np.full(len(v), d))
                    ask.append(q)

                for i, g in enumerate(groups):
                    add(i, values[i], fp, True, t[:, i] >= 0)
                    for level in range(1, radius + 1):
                        pick = np.flatnonzero(t[:, i] == level)
                        if len(pick):
                            m = masks.setdefault((len(g), level), _flips(len(g), level))
                            add(i, (values[i][pick][:, None] ^ m).ravel(), np.repeat(fp[pick], len(m)), False,
                                np.ones(len(pick) * len(m), dtype=bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(part)), pa.array(np.concatenate(value).view(np.int64)),
                     pa.array(np.concatenate(who).view(np.int64)), pa.array(np.concatenate(data)),
                     pa.array(np.concatenate(ask))], ["part", "value", "fp", "data", "ask"])
    return run


def forest(fp: np.ndarray, data: np.ndarray, ask: np.ndarray, side: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links of one cell as a spanning forest: asking rows against filed rows, only across
    sides if there are two."""
    label = np.arange(len(fp))
    edges = []
    d = np.flatnonzero(data)
    for a in range(0, len(fp), 256):
        rows = a + np.flatnonzero(ask[a:a + 256])
        if not len(rows) or not len(d):
            continue
        near = np.bitwise_count(fp[rows][:, None] ^ fp[d]) <= radius
        if side is not None:
            near &= side[rows][:, None] != side[d]
        for k in np.flatnonzero(near.any(axis=1)).tolist():
            r = rows[k]
            sets = np.unique(np.append(label[d[near[k]]], label[r]))
            if len(sets) > 1:
                label[np.isin(label, sets)] = sets[0]
                edges += [(int(sets[0]), int(x)) for x in sets[1:]]
    return edges


def _links_of_cells(radius: int):
    names = ("part", "value", "x", "y", "fp", "data", "ask", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        out_a, out_b = [], []

        def work(fp, data, ask, side):
            # a fingerprint has one row in a cell: its exact value, or one flipped value
            for i, j in forest(fp, data, ask, side if side.any() else None, radius):
                out_a.append(fp[i])
                out_b.append(fp[j])

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(np.array(out_a, dtype=np.uint64).view(np.int64)),
                                                pa.array(np.array(out_b, dtype=np.uint64).view(np.int64))], ["a", "b"])
            out_a.clear()
            out_b.clear()
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: column_of(batch, n).to_numpy(zero_copy_only=False) for n in names}
            col["fp"] = col["fp"].view(np.uint64)
            if held is not None:
                col = {n: np.concatenate((held[n], col[n])) for n in names}
            key = [col[n] for n in names[:4]]
            cut = np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in key], axis=0))))
            size = np.diff(np.append(cut, len(key[0])))
            for a, n in zip(cut[:-1][size[:-1] > 1].tolist(), size[:-1][size[:-1] > 1].tolist()):
                work(*(col[c][a:a + n] for c in names[4:]))
            held = {n: col[n][cut[-1]:] for n in names}
            if len(out_a) > 20_000:
                yield flush()
        if held is not None:
            work(*(held[c] for c in names[4:]))
        if out_a:
            yield flush()
    return run


def _bit_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    both = np.zeros((64, 64))
    for batch in batches:
        if batch.num_rows:
            x = _bits(np.asarray(column_of(batch, "fp"))).astype(np.float32)
            both += x.T @ x
    i, j = np.indices(both.shape)
    yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)),
                                      pa.array(both.ravel().astype(np.int64))], ["i", "j", "n"])


def _histograms(groups):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = [np.zeros(1 << min(len(g), HIST_BITS), dtype=np.int64) for g in groups]
        for batch in batches:
            fp = np.asarray(column_of(batch, "fp")).view(np.uint64)
            for h, g in zip(hist, groups):
                h += np.bincount(values_of(fp, g[:HIST_BITS]).astype(np.int64), minlength=len(h))
        for i, h in enumerate(hist):
            k = np.flatnonzero(h)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), i, dtype=np.int32)), pa.array(k),
                                              pa.array(h[k])], ["part", "key", "n"])
    return run


def links(distinct: DataFrame, radius: int = RADIUS, parts: int | None = None, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that connect what the radius connects."""
    spark = distinct.sparkSession
    n = distinct.count()
    parts = parts or choose_parts(n, radius)
    both = np.zeros((64, 64))
    for r in arrow_map(distinct.select("fp"), _bit_pairs, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        both[r["i"], r["j"]] = r["n"]
    groups = bit_groups(both, n, parts)
    hist = [np.zeros(1 << min(len(g), HIST_BITS), dtype=np.int64) for g in groups]
    counted = arrow_map(distinct.select("fp"), _histograms(groups), "part int, key long, n long").groupBy("part", "key").agg(F.sum("n").alias("n"))
    counted = counted.toArrow()  # at most parts * 2^HIST_BITS rows
    for i, h in enumerate(hist):
        mine = counted.filter(pc.equal(counted["part"], i))
        h[np.asarray(mine["key"])] = np.asarray(mine["n"])
    tables = spark.sparkContext.broadcast([x.astype(np.float32) for x in _estimates(hist, groups, radius)])

    def probe(batches):
        return _file_and_probe(groups, tables.value, radius)(batches)

    rows = arrow_map(distinct.select("fp"), probe, "part int, value long, fp long, data boolean, ask boolean")
    rows = materialize(rows, "probes")
    big = (rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > block)
           .select("part", "value", F.ceil(F.col("k") / block).cast("int").alias("nb")))
    rows = rows.join(big, ["part", "value"], "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    rows = (rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int"))
            .withColumn("other", F.explode(F.expr("sequence(0, nb - 1)")))
            .select("part", "value", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                    "fp", "data", "ask", ((F.col("own") != F.col("other")) & (F.col("own") > F.col("other"))).alias("side")))
    cell = ["part", "value", "x", "y"]
    return arrow_map(rows.repartition(*cell).sortWithinPartitions(*cell), _links_of_cells(radius), "a long, b long")


def _placed(docs: DataFrame, shingle: int, radius: int, parts: int | None, block: int) -> DataFrame:
    """(doc_id, h, fp, root, component_id); root tells components apart, also those without ids."""
    each = materialize(fingerprints(ids_and_text(docs), shingle), "fingerprints")
    distinct = materialize(each.groupBy("fp").agg(F.min("doc_id").alias("d")), "distinct")
    roots = components(links(distinct, radius, parts, block)).select(F.col("a").alias("fp"), "root")
    placed = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = placed.groupBy("root").agg(F.min("d").alias("component_id"))
    return each.join(placed.select("fp", "root").join(lowest, "root"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, parts: int | None = None,
                    block: int = BLOCK) -> DataFrame:
    """(doc_id, h, fp, component_id) for every row of docs (doc_id, text)."""
    return _placed(docs, shingle, radius, parts, block).select("doc_id", "h", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Of each component the rows of its smallest doc_id stay, of a component without any doc_id
    the rows of one text (the least text key); texts that share a doc_id, and rows without one, are
    judged one by one; equal rows stay or go together; columns as given."""
    each = materialize(_placed(docs, shingle, radius, None, BLOCK).select("doc_id", "h", "root", "component_id"), "components")
    alone = each.filter("component_id is null").groupBy("root").agg(F.min("h").alias("least"))
    found = (each.filter("component_id is not null and not (doc_id <=> component_id)").select("doc_id", "h")
             .unionByName(each.filter("component_id is null").join(alone, "root").filter("h <> least").select("doc_id", "h"))
             .select(F.col("doc_id").alias("_pc_id"), F.col("h").alias("_pc_h")).distinct())
    key = F.coalesce(F.crc32(F.col("text").cast("string").cast("binary")), F.lit(0))
    return docs.join(found, F.col("doc_id").cast("bigint").eqNullSafe(F.col("_pc_id")) & (key == F.col("_pc_h")), "left_anti")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(docs_table(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


SQL: dict[str, str] = {}
QUERIES = {"op3_simhash_near_dedup": op3_simhash_near_dedup}
