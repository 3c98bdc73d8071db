"""Mixing against a plain-Python version: targets by repeated resharing, budgets by hand."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from panelcast.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, digest string"


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what is above a limit is reshared until nothing is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while free:
        per = left / sum(w[s] for s in free)
        above = {s for s in free if w[s] * per >= most * sizes[s]}
        if not above:
            target |= {s: w[s] * per for s in free}
            break
        target |= {s: float(most * sizes[s]) for s in above}
        left -= sum(most * sizes[s] for s in above)
        free -= above
    return target


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = {}
    for (_, _, s), n in zip(rows, size):
        sizes[s] = sizes.get(s, 0) + n
    target = brute_targets(sizes)
    keys = []
    for d, t, _ in rows:
        dig = hashlib.md5(f"{'' if d is None else d}:{t or ''}".encode()).hexdigest()
        odd = sum(c in mixing.ODD_CHARS for c in t or "")
        q = max(mixing.QUALITY_LEAST, 1 - 4 * (1 - (len(t) - odd) / len(t))) if t else mixing.QUALITY_LEAST
        keys.append((-math.log((int(dig[:13], 16) + 0.5) / 16 ** 13) / q, dig))
    out = []
    for s in sizes:
        budget = math.floor(target[s] + 0.5)
        whole, rest = divmod(budget, sizes[s]) if sizes[s] else (0, 0)
        for i in sorted((i for i in range(len(rows)) if rows[i][2] == s), key=lambda i: keys[i]):
            more = min(size[i], rest)
            rest -= more
            out.append((rows[i][0], size[i], sizes[s], round(target[s], 6), whole * size[i] + more))
    return out


def some_rows():
    rows = [(i, " ".join(f"w{j}" if i % 3 else "word" for j in range(i * 7 % 40 + 1)), "big" if i % 3 else f"s{i % 5}") for i in range(300)]
    rows += [(1000, None, "big"), (1001, "", "empty"), (None, "no id here", "s1"), (None, None, None), (1002, "a b c", None),
             (1003, " \t\n ", "big"), (1004, "twice the same", "s2"), (1004, "twice the same", "s2"), (1004, "same id only", "s2"),
             (1005, "é x y z\x0bq", "Zed"), (1006, "long " * 30_000, "long")]
    return rows


def made(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_selection_as_brute_force(spark):
    rows = some_rows()
    got = mixing.selection(made(spark, rows))
    found = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got.collect()]
    assert sorted(found, key=key) == sorted(brute(rows), key=key)
    again = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.selection(made(spark, rows[::-1], 7)).collect()]
    assert sorted(again, key=key) == sorted(found, key=key)


def test_budgets_and_limits(spark):
    got = mixing.selection(made(spark, some_rows())).toPandas()
    source = {d: s for d, _, s in some_rows() if d is not None and d != 1004}
    budgets = brute_targets({s: sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, x in some_rows() if x == s) for s in {r[2] for r in some_rows()}})
    for s, g in got.dropna(subset="doc_id").groupby(lambda i: source.get(got.doc_id[i], "")):
        if s in ("big", "Zed", "empty", "long", "s3", "s0"):
            assert abs(g.taken.sum() - budgets[s]) <= 0.5
    assert (got.taken <= 3 * got["size"]).all()
    whole = mixing.selection(made(spark, some_rows()), cut=False).toPandas()
    assert (whole.part_words == 0).all() and (whole.taken == whole.epochs * whole["size"]).all()


def test_low_quality_is_drawn_less(spark):
    rows = [(i, "plain words here" if i % 2 else "## $$ 12 == ##", "a") for i in range(1000)] + [(5000 + i, "x " * 40, "b") for i in range(300)]
    got = mixing.selection(made(spark, rows), weights=(1, 9)).filter("size < 40 and taken > 0").groupBy(F.col("doc_id") % 2).count().collect()
    n = {r[0]: r[1] for r in got}
    assert n[1] > 2 * n.get(0, 0) > 0


def test_mixed_texts(spark):
    rows = some_rows()
    chosen = mixing.selection(made(spark, rows)).agg(F.sum("taken")).first()[0]
    out = mixing.mixed(made(spark, rows)).select(F.regexp_count("text", F.lit(mixing.WORD)).alias("n"), "source", "epoch").toPandas()
    assert out.n.sum() == chosen and out.n.min() > 0
    assert out.epoch.max() == 6  # the text that has two equal rows


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "one", "a")], [(None, "", "a"), (None, "", "b")]])
def test_small_tables(spark, rows):
    got = [(r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in mixing.selection(made(spark, rows, 1)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
