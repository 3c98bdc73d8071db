"""Hard negatives by anchor-clustered shared lists with certified termination.

Anchors (one for each distinct label and vector) are clustered by angle.  For a cluster with
centre c and largest member angle t, a candidate x at angle f to c has an inner product of at
most ``|u| |x| cos(max(0, f - t))`` with every member u.  Candidates are sorted by that bound
once a cluster; every member walks the shared list in steps, and leaves it when the bound of
the next step is below what it still needs: the score of its last kept positive, or, for
negatives, the least of its bands' third best scores (a band's lower edge where it has fewer).
What is left out is certified by the bound, so results are exact; clusters change only the work.

Two walks: positives of each anchor first, then, for each positive, the best rows of other
labels inside the band its score gives.  The list of a cluster lies over the tasks that hold the
candidates: a task sorts and walks slabs of ``SLAB`` rows, its members' needs get
stricter from slab to slab, and the few rows that tasks keep are merged by anchor.  Anchors are
the stated query set; they go to the tasks in broadcast blocks of ``BLOCK_ROWS`` vectors and
``BLOCK_BYTES`` at most, one block after another.  Centres are fitted on ``CENTRE_SAMPLE`` anchors.

Equal vectors with equal labels share their scores: only as many of them are candidates, smallest
ids first, as one list can return, and anchors among them are walked for once.

Defined results: rows with a null id, label or vector or with a null or non-finite component
take no part; components are whole numbers floor(256 x), beyond 2^31 as 2^31; a missing
trailing component counts as zero, an empty vector scores zero everywhere; scores are exact while
products of lengths stay below 2^63; rows with equal id, label and vector are one row, and a row
is no positive of an anchor with its id; ties go by smaller id; an anchor without
positives, or a positive without rows in its band, gives no row; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, column_of, docs_table, materialize

POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score that a negative has, at least and at most.
LOW, HIGH = 50, 95
SCALE = 256.0
CENTRE_SAMPLE = 4096
CLUSTERS = 64
BLOCK_ROWS, BLOCK_BYTES = 1 << 15, 1 << 25
SLAB, STEP = 1 << 15, 2048
#: Added to angles' differences: more than the error of an arc cosine.
SLACK = 1e-6
NONE = np.int64(-2 ** 62)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors -> int32 components as bytes; rows with null or non-finite components go."""
    for batch in batches:
        lists = column_of(batch, "v")
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        flat = np.asarray(lists.flatten().cast(pa.float64()).fill_null(np.nan), dtype=np.float64)
        size = np.asarray(pc.list_value_length(lists), dtype=np.int64)
        ends = np.cumsum(size)
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
        keep = np.flatnonzero(bad[ends] == bad[ends - size])
        with np.errstate(invalid="ignore", over="ignore"):
            whole = np.clip(np.nan_to_num(np.floor(SCALE * flat)), -2.0 ** 31, 2.0 ** 31 - 1).astype("<i4").tobytes()
        q = [whole[4 * (ends[i] - size[i]):4 * ends[i]] for i in keep]
        yield pa.RecordBatch.from_arrays([column_of(batch, "id").take(pa.array(keep)), column_of(batch, "label").take(pa.array(keep)),
                                          pa.array(q, pa.binary())], ["id", "label", "q"])


def _matrix(packed: list[bytes], dim: int) -> np.ndarray:
    """Rows of int64 components, padded with zeros."""
    if all(len(p) == 4 * dim for p in packed):
        return np.frombuffer(b"".join(packed), dtype="<i4").reshape(len(packed), dim).astype(np.int64)
    out = np.zeros((len(packed), dim), dtype=np.int64)
    for row, p in zip(out, packed):
        row[:len(p) // 4] = np.frombuffer(p, dtype="<i4")
    return out


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(x.astype(np.float64)).sum(axis=1))


def _angles(x: np.ndarray, lengths: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Rows x centres; a zero vector is at a right angle to all."""
    return np.arccos(np.clip(x.astype(np.float64) @ centres.T / np.maximum(lengths, 1e-300)[:, None], -1.0, 1.0))


def fit_centres(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of a spherical k-means, started on evenly spaced rows."""
    lengths = _lengths(x)
    unit = x[lengths > 0] / lengths[lengths > 0][:, None]
    if not len(unit):
        return np.eye(1, x.shape[1] or 1)[:, :x.shape[1]]
    centres = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
    for _ in range(rounds):
        near = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


class Best:
    """The best k (score, id) of each row: higher scores first, then smaller ids."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.score = np.full((rows, k), NONE)
        self.ids = np.zeros((rows, k), dtype=np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, least: np.ndarray) -> None:
        """scores: rows x candidates, NONE where a candidate doesn't count."""
        least = np.maximum(least, self.score[rows, -1])
        if scores.shape[1] > self.k:
            least = np.maximum(least, -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1])
        r, c = np.nonzero((scores >= least[:, None]) & (scores > NONE))
        if not len(r):
            return
        touched, at = np.unique(r, return_inverse=True)
        old = rows[touched]
        row = np.concatenate((at, np.repeat(np.arange(len(old)), self.k)))
        score = np.concatenate((scores[r, c], self.score[old].ravel()))
        idn = np.concatenate((ids[c], self.ids[old].ravel()))
        order = np.lexsort((idn, -score, row))
        row = row[order]
        first = np.searchsorted(row, np.arange(len(old)))
        rank = np.arange(len(row)) - first[row]
        kept = rank < self.k
        where = (old[row[kept]], rank[kept])
        self.score[where], self.ids[where] = score[order][kept], idn[order][kept]


class Block:
    """Anchors of one block with their clusters; ``edges``: bands (low, high) of each."""

    def __init__(self, gid, label, x, centres, low=None, high=None):
        self.gid, self.label, self.x, self.centres = gid, label, x, centres
        self.length = _lengths(x)
        angles = _angles(x, self.length, centres)
        near = np.argmin(angles, axis=1)
        self.members = [np.flatnonzero(near == c) for c in range(len(centres))]
        self.widest = [float(angles[m, c].max()) if len(m) else 0.0 for c, m in enumerate(self.members)]
        self.low, self.high = low, high

    def lists(self, batches: Iterator[pa.RecordBatch]):
        """Slabs of candidates, and for each cluster the slab's list in steps, best bounds first."""
        dim = self.x.shape[1]
        for ids, labels, packed in _slabs(batches):
            x = _matrix(packed, dim)
            lengths = _lengths(x)
            angles = _angles(x, lengths, self.centres)
            most = float(lengths.max(initial=0.0)) * float(self.length.max(initial=0.0))
            kind = np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64
            x, mine = x.astype(kind), self.x.astype(kind)
            for c, members in enumerate(self.members):
                if not len(members):
                    continue
                bound = lengths * np.cos(np.maximum(0.0, angles[:, c] - self.widest[c] - SLACK))
                order = np.argsort(-bound, kind="stable")
                yield members, bound[order], ids[order], labels[order], x[order], mine

    def walk(self, batches: Iterator[pa.RecordBatch], needs, take) -> None:
        """needs(members): the least score each still needs; take(members, scores, ids, labels)."""
        for members, bound, ids, labels, x, mine in self.lists(batches):
            for at in range(0, len(ids), STEP):
                reach = self.length[members] * bound[at]
                members = members[reach + 1e-9 * np.abs(reach) + 1e-6 >= needs(members)]
                if not len(members):
                    break  # certified: nothing further down the list reaches a member's need
                step = slice(at, at + STEP)
                take(members, (mine[members] @ x[step].T).astype(np.int64), ids[step], labels[step])

    def positives(self, batches, k: int) -> Best:
        best = Best(len(self.gid), k)

        def take(members, scores, ids, labels):
            scores[self.label[members][:, None] != labels[None, :]] = NONE
            best.add(members, scores, ids, np.full(len(members), NONE))
        self.walk(batches, lambda m: best.score[m, -1], take)
        return best

    def negatives(self, batches, k: int) -> list[Best]:
        """One Best for each band; a band without whole numbers is closed from the start."""
        bands = range(self.low.shape[1])
        best = [Best(len(self.gid), k) for _ in bands]
        closed = self.low > self.high
        never = np.iinfo(np.int64).max

        def needs(m):
            each = [np.where(closed[m, j], never, np.maximum(self.low[m, j], best[j].score[m, -1])) for j in bands]
            return np.min(each, axis=0)

        def take(members, scores, ids, labels):
            scores[self.label[members][:, None] == labels[None, :]] = NONE
            for j in bands:
                some = np.flatnonzero(~closed[members, j])
                if len(some):
                    s, m = scores[some], members[some]
                    best[j].add(m, np.where(s <= self.high[m, j][:, None], s, NONE), ids, self.low[m, j])
        self.walk(batches, needs, take)
        return best


def _slabs(batches: Iterator[pa.RecordBatch]):
    """ids, labels and packed vectors of SLAB rows or one batch more."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= SLAB:
            yield _columns(held)
            held, rows = [], 0
    if rows:
        yield _columns(held)


def _columns(held: list[pa.RecordBatch]):
    table = pa.Table.from_batches(held)
    return table["id"].to_numpy().astype(np.int64), table["label"].to_numpy().astype(np.int64), table["q"].to_pylist()


def _mine_blocks(blocks, cands: DataFrame, negative: bool, k: int, centres: np.ndarray) -> DataFrame:
    """gid, band, score, id that the tasks keep for the anchors of every block."""
    out = None
    for rows in blocks:
        low = high = None
        if negative:
            # floor and ceiling of the score's percents, in whole numbers
            edges = [[(-(-LOW * p // 100), HIGH * p // 100) for p in ps] for ps in rows["scores"]]
            wide = max(map(len, edges), default=0)
            edges = np.array([e + [(1, 0)] * (wide - len(e)) for e in edges], dtype=np.int64).reshape(len(edges), wide, 2)
            low, high = edges[:, :, 0], edges[:, :, 1]
        block = cands.sparkSession.sparkContext.broadcast(
            Block(rows["gid"], rows["label"], _matrix(rows["q"], centres.shape[1]), centres, low, high))

        def run(batches, block=block):
            b = block.value
            bests = b.negatives(batches, k) if negative else [b.positives(batches, k)]
            for band, best in enumerate(bests):
                r, c = np.nonzero(best.score > NONE)
                for s in range(0, len(r), 1 << 16):
                    i, j = r[s:s + (1 << 16)], c[s:s + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(b.gid[i]), pa.array(np.full(len(i), band + 1, dtype=np.int32)),
                                                      pa.array(best.score[i, j]), pa.array(best.ids[i, j])], ["gid", "band", "score", "id"])
        kept = materialize(arrow_map(cands, run, "gid long, band int, score long, id long"), "mined")
        out = kept if out is None else out.unionByName(kept)
    return out


def _first(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rn") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """rows (vec_id, embedding, label), is_anchor a condition on vec_id -> anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score."""
    spark = rows.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    usable = rows.filter("vec_id is not null and label is not null and embedding is not null")
    packed = arrow_map(usable.select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"),
                                     F.col("embedding").cast("array<double>").alias("v")), _pack, "id long, label long, q binary")
    packed = materialize(packed.distinct(), "vectors")
    dim = (packed.agg(F.max(F.length("q"))).first()[0] or 0) // 4
    at_once = max(spark.sparkContext.defaultParallelism, 1)
    # row_number below a limit is cut in every task before the shuffle, so hot vectors stay small
    cands = materialize(_first(packed, ["label", "q"], [F.col("id")], positives + 1).drop("rn").repartition(at_once), "candidates")
    anchors = packed.withColumnRenamed("id", "vec_id").filter(is_anchor)
    groups = materialize(anchors.groupBy("label", "q").agg(F.count(F.lit(1)).alias("n")).drop("n")
                         .withColumn("gid", F.monotonically_increasing_id()), "anchors")
    n = groups.count()
    if not n:
        return spark.createDataFrame([], result)
    sample = groups.orderBy(F.xxhash64("q"), "gid").limit(CENTRE_SAMPLE).select("q").toArrow()["q"].to_pylist()
    clusters = max(1, min(CLUSTERS, round(np.sqrt(n) / 2)))
    centres = fit_centres(_matrix([bytes(q) for q in sample], dim).astype(np.float64), clusters)
    size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(4 * dim, 1)))
    n_blocks = -(-n // size)
    groups = groups.withColumn("block", F.pmod(F.xxhash64("gid"), F.lit(n_blocks)))

    def blocks(table: DataFrame):
        for b in range(n_blocks):
            t = table.filter(F.col("block") == b).toArrow()
            if t.num_rows:
                yield {"gid": t["gid"].to_numpy(), "label": t["label"].to_numpy(), "q": t["q"].to_pylist()} | (
                    {"scores": t["scores"].to_pylist()} if "scores" in t.column_names else {})

    best = [F.desc("score"), F.asc("id")]
    pos = _first(_mine_blocks(blocks(groups), cands, False, positives + 1, centres), ["gid"], best, positives + 1)
    pos = materialize(pos.groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("rn", "id", "score"))).alias("pos")), "positives")
    asked = groups.join(pos.select("gid", F.col("pos.score").alias("scores")), "gid")
    found = _mine_blocks(blocks(asked), cands, True, negatives, centres)
    if found is None:
        return spark.createDataFrame([], result)
    neg = _first(found, ["gid", "band"], best, negatives).groupBy("gid").agg(
        F.collect_list(F.struct("band", "rn", "id", "score")).alias("neg"))
    each = (anchors.join(groups.select("gid", "label", "q"), ["label", "q"]).select("vec_id", "gid").join(pos, "gid").join(neg, "gid")
            .select(F.col("vec_id").alias("anchor_id"), "neg",
                    F.explode(F.slice(F.filter("pos", lambda p: p["id"] != F.col("vec_id")), 1, positives)).alias("p"))
            .select("anchor_id", "p", F.explode(F.filter("neg", lambda x: x["band"] == F.col("p.rn"))).alias("n")))
    return each.select("anchor_id", F.col("p.id").alias("positive_id"), F.col("n.rn").alias("rank"), F.col("n.id").alias("negative_id"),
                       F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


SQL = {
    "op13_hard_negatives": """
WITH e AS (
  SELECT CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS a, x.id AS x, a.label = x.label AS same, CAST(list_inner_product(a.q, x.q) AS BIGINT) AS score
  FROM e a JOIN e x ON a.id <> x.id WHERE a.id % 50 = 0
), p AS (
  SELECT a, x AS p, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, x) <= 5
)
SELECT p.a AS anchor_id, p.p AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.x) AS INTEGER) AS rank,
       s.x AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.x) <= 3""",
}
QUERIES = {"op13_hard_negatives": op13_hard_negatives}
