"""Hard negatives against a plain-Python version over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, q string, id int"


def brute(rows, anchor=lambda i: i % 5 == 0):
    ok = {(i, lab, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, lab in rows
          if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, la, qa in ok:
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(qa, q)), i, lab) for i, lab, q in ok)
        pos = [(-s, i) for s, i, lab in scored if lab == la and i != a][:5]
        for p, pi in pos:
            neg = [(-s, i) for s, i, lab in scored if lab != la and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(a, pi, k + 1, i, p, s) for k, (s, i) in enumerate(neg)]
    return sorted(out)


def got(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % 5 == 0, **how).collect())


def vectors(n, dim, labels, seed, spread=0.6):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(max(labels, 1) + 2)]
    rows = []
    for i in range(n):
        c = centres[r.randrange(len(centres))]
        rows.append((i, [x + r.gauss(0, spread) for x in c], r.randrange(labels)))
    return rows


@pytest.mark.parametrize("seed, dim, spread", [(1, 3, 0.3), (2, 8, 0.6), (3, 16, 2.0)])
def test_as_brute_force(spark, seed, dim, spread):
    rows = vectors(300, dim, 4, seed, spread)
    assert got(spark, rows) == brute(rows) != []


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rows = vectors(120, 4, 3, 9)
    hot = [0.5, -0.25, 0.125, 1.0]
    rows += [(1000 + i, hot, i % 2) for i in range(90)]           # one vector many times, anchors among it
    rows += [(2000, None, 1), (2001, hot, None), (None, hot, 1), (2005, [None, 1.0, 0.0, 0.0], 1), (2010, [float("nan")] * 4, 2),
             (2015, [float("inf"), 0.0, 0.0, 0.0], 2), (2020, [0.0] * 4, 1), (2025, [], 1), (2030, [1.0, 0.5], 0), rows[5], rows[10]]
    assert got(spark, rows) == brute(rows) != []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [x * 4000 for x in v], lab) for i, v, lab in vectors(80, 5, 3, 4)]
    assert got(spark, rows) == brute(rows) != []


def test_blocks_and_slabs_change_nothing(spark, monkeypatch):
    rows = vectors(260, 6, 3, 5, 0.2)
    want = brute(rows)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 17)
    monkeypatch.setattr(hn, "SLAB", 50)
    monkeypatch.setattr(hn, "STEP", 16)
    assert got(spark, rows) == want


def test_lists_end_early():
    """On clustered vectors a member leaves its list before the end, and loses nothing."""
    rows = vectors(4000, 6, 2, 6, 0.05)
    x = np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int64)
    ids, labels = np.arange(len(rows)), np.array([lab for *_, lab in rows])
    block = hn.Block(ids[:40], labels[:40], x[:40], hn.fit_centres(x[:40].astype(float), 4))
    seen = []
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(labels), pa.array([r.astype("<i4").tobytes() for r in x], pa.binary())], ["id", "label", "q"])
    step, hn.STEP = hn.STEP, 100
    try:
        best = hn.Best(40, 6)

        def take(members, scores, i, lab):
            seen.append(scores.size)
            scores[block.label[members][:, None] != lab[None, :]] = hn.NONE
            best.add(members, scores, i, np.full(len(members), hn.NONE))
        block.walk([batch], lambda m: best.score[m, -1], take)
    finally:
        hn.STEP = step
    assert sum(seen) < 0.8 * 40 * len(rows)
    every = x[:40] @ x.T
    every[labels[:40][:, None] != labels[None, :]] = hn.NONE
    assert (np.sort(every, axis=1)[:, ::-1][:, :6] == best.score).all()


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)], [(0, [], 1), (1, [], 1), (2, [], 0)],
                                  [(0, [1.0, 2.0], 1), (1, [1.0, 1.5], 1), (2, [0.8, 1.5], 0)]])
def test_small_tables(spark, rows):
    assert got(spark, rows) == brute(rows)
