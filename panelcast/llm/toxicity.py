"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade > j | x) = sigmoid(w.x - theta_j): the weights are shared by all ordered thresholds
theta_0 < theta_1 < ..., and the output is the expected severity sum_j P(grade > j).

* Features: every word and every word beginning of 4 to 8 bytes that at least ``MIN_TEXTS``
  training texts hold, sparse, each valued log2(1 + its occurrences per ``PER`` words):
  a beginning that clean texts hold now and then and toxic ones often tells them apart by rate.  Features that occur
  alike in all training texts are one feature, named after their longest beginning.  Near copies among
  the training texts (min-hash) count once.
* Weights: at least 0 (a feature can only raise severity, so clean words never outvote toxic
  ones in a long text), under an absolute penalty of ``STRENGTH`` times the noise that the
  feature's slope has by chance, times sqrt(2 ln features), plus a small squared one.  The solution is exact: features
  enter while their slope exceeds their penalty, until none does.  Those with a weight are
  fitted once more under the squared penalty alone, which undoes the shrinking.
* Grades come from the labels alone: 0 not toxic, 1 toxic, 2 toxic and of quality 0.  Grades
  that do not occur get no threshold.
* Training rows: at most ``TRAIN_ROWS`` labelled documents, those with the smallest hashed
  doc_id, one text each if a doc_id repeats (a documented bound; the model is fitted in numpy
  on the driver).  Scoring covers whole texts of all rows; very long texts cost in proportion
  to their words.

Defined results: null or wordless texts have no feature and the severity that the thresholds
give; labels that repeat or disagree count as the highest grade among them, null labels are
ignored, a null or absent quality is not 0; without toxic or without clean training rows the severity is 0 and nothing is
rejected; repeated rows give repeated results; extra columns are ignored by the query and
kept by ``reject_toxic``.
"""

from __future__ import annotations

from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, column_of, docs_table, slices, texts

TRAIN_ROWS = 8000
MIN_TEXTS = 2
STRENGTH = 0.5
#: A feature's value counts its occurrences per so many words ...
PER = 100
#: ... of a text taken to have so many words more than it has, so that short texts are no outliers.
SHORT = 20
BEGINNINGS = (4, 5, 6, 7, 8)
#: Distinct words a task remembers before it starts anew (memory only).
TABLE_WORDS = 200_000
L2 = 1e-4
#: Features that enter at once while the penalised fit is solved.
ENTER = 40
#: A text goes if a grade above 0 is at least this likely.
REJECT_AT = 0.5

# ASCII but letters separates words; A-Z become a-z
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def _candidates(word: bytes) -> list[bytes]:
    return [b"=" + word, *(word[:n] for n in BEGINNINGS if n <= len(word))]


def value(count, words):
    """A feature's value: its occurrences per ``PER`` words, damped."""
    return np.log2(1 + PER * count / (words + SHORT))


@dataclass
class Ordinal:
    """Feature weights (a word with b"=" in front, or a beginning) and ordered thresholds."""
    weights: dict[bytes, float]
    thresholds: list[float]

    def features(self, words: list[bytes], table: dict[bytes, tuple[bytes, ...]]) -> Counter:
        """Occurrences of weighted features; ``table`` remembers each distinct word's."""
        try:
            found = [f for w in words if (f := table[w])]
        except KeyError:
            if len(table) > TABLE_WORDS:
                table.clear()
            table.update((w, tuple(c for c in _candidates(w) if c in self.weights)) for w in set(words) if w not in table)
            found = [f for w in words if (f := table[w])]
        return Counter(c for f in found for c in f)

    def above(self, counts: Counter, words: int) -> list[float]:
        """P(grade > j) for each threshold, of a text of so many words."""
        x = sum(self.weights[w] * value(n, words) for w, n in sorted(counts.items()))
        return [float(1 / (1 + np.exp(-np.clip(x - t, -50, 50)))) for t in self.thresholds]


def fit_ordinal(x: np.ndarray, grade: np.ndarray, penalty: np.ndarray, l2: float = L2, start=None, steps: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Weights of at least 0 and ordered thresholds that maximise the cumulative-link
    likelihood (grouped logistic losses of all thresholds, weights shared) less the
    penalties: Newton steps whose quadratic models are solved coordinate by coordinate."""
    levels = np.arange(int(grade.max()))
    n, d, k = len(x), x.shape[1], len(levels)
    target = (grade[:, None] > levels).astype(float)
    if start is None:
        p0 = np.clip(target.mean(axis=0), 1e-6, 1 - 1e-6)
        start = np.zeros(d), -np.log(p0 / (1 - p0))
    w, theta = start

    def loss(w, theta):
        z = (x @ w)[:, None] - theta
        return float((np.logaddexp(0, z) - target * z).sum() / n + l2 * (w @ w) / 2 + penalty @ w)

    best = loss(w, theta)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - theta, -50, 50)))
        e, v = (p - target) / n, p * (1 - p) / n
        g = np.concatenate((x.T @ e.sum(axis=1) + l2 * w + penalty, -e.sum(axis=0)))
        h = np.zeros((d + k, d + k))
        h[:d, :d] = x.T @ (x * v.sum(axis=1)[:, None]) + l2 * np.eye(d)
        h[:d, d:] = -x.T @ v
        h[d:, :d] = h[:d, d:].T
        h[d:, d:] = np.diag(v.sum(axis=0))
        h += 1e-9 * np.eye(d + k)
        step = _bounded_step(h, g, np.concatenate((-w, np.full(k, -np.inf))))
        size = 1.0
        while size > 1e-8:
            w2, t2 = np.maximum(w + size * step[:d], 0), theta + size * step[d:]
            if (np.diff(t2) >= 0).all() and (now := loss(w2, t2)) <= best:
                break
            size /= 2
        else:
            break
        done = best - now < 1e-11
        w, theta, best = w2, t2, now
        if done:
            break
    return w, theta


def _bounded_step(h: np.ndarray, g: np.ndarray, low: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The step that minimises g.s + s.h.s/2 with s >= low."""
    step, slope = np.zeros(len(g)), g.copy()
    for _ in range(rounds):
        moved = 0.0
        for i in range(len(g)):
            now = max(step[i] - slope[i] / h[i, i], low[i])
            if (by := now - step[i]) != 0:
                slope += by * h[i]
                step[i] = now
                moved = max(moved, abs(by))
        if moved < 1e-7:
            break
    return step


@dataclass
class Bags:
    """Training texts as (word number, occurrences) arrays; words[i] has number i."""
    words: list[bytes]
    texts: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, counted) -> Bags:
        """From (words, occurrences) per text."""
        number: dict[bytes, int] = {}
        texts = []
        for w, n in counted:
            ids = np.array([number.setdefault(bytes(x), len(number)) for x in w], dtype=np.int32)
            order = np.argsort(ids)
            texts.append((ids[order], np.array(n, dtype=np.int32)[order]))
        return cls(list(number), texts)


def _distinct_texts(bags: Bags) -> np.ndarray:
    """Marks all but the first of near copies: 13 or more of 16 min-hashes agree."""
    from zlib import crc32
    rng = np.random.default_rng(11)
    a, b = rng.integers(1, 2 ** 31, 16, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2 ** 31, 16, dtype=np.uint64)
    h = np.array([crc32(w) for w in bags.words], dtype=np.uint64)
    sig = np.zeros((len(bags.texts), 16), dtype=np.uint32)
    for i, (ids, _) in enumerate(bags.texts):
        if len(ids):
            sig[i] = ((h[ids][:, None] * a + b) >> np.uint64(8)).astype(np.uint32).min(axis=0)
    keep = np.ones(len(sig), dtype=bool)
    for i in range(len(sig)):
        if keep[i]:
            keep[i + 1:] &= (sig[i + 1:] == sig[i]).sum(axis=1) < 13
    return keep


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Ordinal:
    """Fit on a bounded sample of labelled documents."""
    low = F.coalesce(F.col("quality") == 0, F.lit(False)) if "quality" in labels.columns else F.lit(False)
    grade = F.when(F.col("toxic") == 0, 0).when(low, 2).otherwise(1)
    chosen = (labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("_pc_id"))
              .agg(F.max(grade).alias("_pc_label"))
              .orderBy(F.xxhash64("_pc_id"), "_pc_id").limit(rows))
    found = docs.select(F.col("doc_id").cast("bigint").alias("_pc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "_pc_id")

    def count(batches):
        for batch in slices(batches):
            bags = [sorted(Counter(words_of(t)).items()) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "_pc_id"), column_of(batch, "_pc_h"), column_of(batch, "_pc_label"), pa.array([[w for w, _ in b] for b in bags], pa.list_(pa.binary())),
                 pa.array([[n for _, n in b] for b in bags], pa.list_(pa.int32()))], ["id", "h", "grade", "w", "n"])
    found = (found.withColumn("_pc_h", F.xxhash64("text")).groupBy("_pc_id", "_pc_label")
             .agg(F.min("_pc_h").alias("_pc_h"), F.min_by("text", "_pc_h").alias("text")))
    counted = arrow_map(found, count, "id long, h long, grade int, w array<binary>, n array<int>").toArrow()
    # sorted, so that a retried or reordered task changes nothing
    counted = counted.sort_by([("id", "ascending"), ("h", "ascending")])
    grade = np.array(counted["grade"].to_pylist(), dtype=np.int64)
    bags = [Bags.of((r["w"].as_py(), r["n"].as_py()) for b in counted.select(["w", "n"]).to_batches() for r in _rows(b))]
    del counted
    return fit_bags(bags.pop(), grade)


def _rows(batch: pa.RecordBatch):
    return ({n: batch.column(i)[k] for i, n in enumerate(batch.schema.names)} for k in range(batch.num_rows))


@dataclass
class Sparse:
    """Feature values by text: entry i is ``value[i]`` of feature ``at[i]`` in text ``row[i]``."""
    names: list[bytes]
    row: np.ndarray
    at: np.ndarray
    value: np.ndarray
    texts: int

    def slopes(self, e: np.ndarray) -> np.ndarray:
        """X'e for all features."""
        return sum((np.bincount(self.at[b], self.value[b] * e[self.row[b]], len(self.names)) for b in self._blocks()), np.zeros(len(self.names)))

    def squares(self) -> np.ndarray:
        return sum((np.bincount(self.at[b], self.value[b].astype(float) ** 2, len(self.names)) for b in self._blocks()), np.zeros(len(self.names)))

    def _blocks(self, size: int = 1 << 18):
        """Slices of the entries, so that what is computed from them stays small."""
        return [slice(i, i + size) for i in range(0, len(self.at), size)]

    def dense(self, chosen: np.ndarray) -> np.ndarray:
        place = np.full(len(self.names), -1, dtype=np.int32)
        place[chosen] = np.arange(len(chosen))
        x = np.zeros((self.texts, len(chosen)))
        for b in self._blocks():
            of = place[self.at[b]]
            mine = of >= 0
            x[self.row[b][mine], of[mine]] = self.value[b][mine]
        return x


def sparse_features(bags: Bags) -> Sparse:
    """All features that at least ``MIN_TEXTS`` texts hold, equal ones once."""
    number: dict[bytes, int] = {}
    flat, cut = array("i"), array("i", [0])
    for w in bags.words:
        flat.extend([number.setdefault(c, len(number)) for c in _candidates(w)])
        cut.append(len(flat))
    flat, cut = np.array(flat, dtype=np.int32), np.array(cut, dtype=np.int64)
    # columns that are alike have the same sum of random text numbers times occurrences
    salt = np.random.default_rng(5).integers(1, 2 ** 63, max(len(bags.texts), 1), dtype=np.uint64)
    mark, held = np.zeros(len(number), dtype=np.uint64), np.zeros(len(number), dtype=np.int64)
    found = []
    for (ids, n), s in zip(bags.texts, salt):
        many = cut[ids + 1] - cut[ids]
        place = np.repeat(cut[ids] - np.cumsum(many) + many, many) + np.arange(many.sum())
        of, inverse = np.unique(flat[place], return_inverse=True)
        count = np.bincount(inverse, np.repeat(n, many), len(of)).astype(np.int32)
        mark[of] += s * count.astype(np.uint64)
        held[of] += 1
        found.append((of, count))
    names = list(number)
    stays: dict[int, int] = {}
    for i in np.flatnonzero(held >= MIN_TEXTS).tolist():
        old = stays.get(int(mark[i]))
        if old is None or (names[i][:1] != b"=", len(names[i])) > (names[old][:1] != b"=", len(names[old])):
            stays[int(mark[i])] = i
    chosen = sorted(stays.values(), key=names.__getitem__)
    place = np.full(len(number), -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))
    for i, (of, count) in enumerate(found):
        at = place[of]
        found[i] = at[at >= 0], value(count[at >= 0], bags.texts[i][1].sum()).astype(np.float32)
    return Sparse([names[i] for i in chosen], np.repeat(np.arange(len(found), dtype=np.int32), [len(of) for of, _ in found]),
                  np.concatenate([np.zeros(0, dtype=np.int32), *(of for of, _ in found)]),
                  np.concatenate([np.zeros(0, dtype=np.float32), *(v for _, v in found)]), len(found))


def fit_bags(bags: Bags, grade: np.ndarray, strength: float = STRENGTH) -> Ordinal:
    """The penalised fit over all features of the training texts with these grades."""
    keep = _distinct_texts(bags)
    bags, grade = Bags(bags.words, [t for t, k in zip(bags.texts, keep) if k]), grade[keep]
    if not grade.any() or grade.all():
        return Ordinal({}, [])
    grade = np.searchsorted(np.unique(grade), grade)
    x = sparse_features(bags)
    del bags
    levels = np.arange(int(grade.max()))
    target = (grade[:, None] > levels).astype(float)
    n, p0 = len(grade), target.mean(axis=0)
    square = x.squares() / n
    # deviation of a feature's slope if the grades were independent of it
    penalty = strength * np.sqrt(2 * np.log(max(len(x.names), 2)) * square / n * ((target - p0).sum(axis=1) ** 2).mean())
    chosen = np.zeros(0, dtype=np.int64)
    w, theta = np.zeros(0), -np.log(p0 / (1 - p0))
    while len(x.names):
        z = (x.dense(chosen) @ w)[:, None] - theta
        slope = -x.slopes((1 / (1 + np.exp(-np.clip(z, -50, 50))) - target).sum(axis=1) / n)
        slope[chosen] = 0
        excess = slope / penalty
        more = [i for i in np.argsort(-excess, kind="stable")[:ENTER].tolist() if excess[i] > 1 + 1e-6]
        if not more:
            break
        chosen = np.concatenate((chosen[w > 0], more)).astype(np.int64)
        w, theta = fit_ordinal(x.dense(chosen), grade, penalty[chosen], start=(np.concatenate((w[w > 0], np.zeros(len(more)))), theta))
    chosen = np.sort(chosen[w > 0])
    w, theta = fit_ordinal(x.dense(chosen), grade, np.zeros(len(chosen)))
    return Ordinal({x.names[i]: float(v) for i, v in zip(chosen.tolist(), w) if v > 0}, theta.tolist())


_COLUMNS = "_pc_severity double, _pc_toxic double, _pc_grade int"


def score(docs: DataFrame, model: Ordinal) -> DataFrame:
    """docs with the expected severity, P(grade > 0) and the likeliest grade."""
    docs = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches):
        table: dict[bytes, tuple[bytes, ...]] = {}
        for batch in slices(batches):
            out = []
            for t in texts(batch):
                above = model.above(model.features(words := words_of(t), table), len(words))
                level = np.diff([-1.0, *(-a for a in above), 0.0])
                out.append((sum(above), above[0] if above else 0.0, int(np.argmax(level))))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.float64()),
                                              pa.array(cols[2], pa.int32())], [*batch.schema.names, "_pc_severity", "_pc_toxic", "_pc_grade"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return arrow_map(docs, run, f"{schema}, {_COLUMNS}")


def reject_toxic(docs: DataFrame, labels: DataFrame, reject_at: float = REJECT_AT) -> DataFrame:
    """docs without the rows that are likely toxic; columns as given."""
    return score(docs, train(docs, labels)).filter(F.col("_pc_toxic") < reject_at).select(*[F.col(f"`{c}`") for c in docs.columns])


def severity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, severity, p_toxic, grade, rejected for every row."""
    pairs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return score(pairs, train(docs, labels)).select("doc_id", F.col("_pc_severity").alias("severity"), F.col("_pc_toxic").alias("p_toxic"),
                                                    F.col("_pc_grade").alias("grade"), (F.col("_pc_toxic") >= REJECT_AT).alias("rejected"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity_report(docs_table(spark, sf_dir), docs_table(spark, sf_dir, "labels"))


SQL: dict[str, str] = {}
QUERIES = {"op6_toxicity": op6_toxicity}
