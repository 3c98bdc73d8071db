"""Exact global quantiles that stay distributed.

``F.median`` buffers every distinct value of a group in one task, and a window over a column's
values is one task too; neither survives a global quantile over billions of rows.
``exact_quantiles`` finds the values at given ranks of many columns at once: rows are counted per
distinct value (hot values collapse before the shuffle), and while there are more distinct values than
``COLLECT`` each wanted rank is bracketed by ``percentile_approx`` and only values inside the bracket
are kept; a round keeps about ``6 / accuracy`` of them.  What is collected at the end is at most
``COLLECT`` values with their counts; no column is ever held by one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct (column, value) pairs that are collected at most.
COLLECT = 200_000


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("double").alias("v"))
                      for i, c in enumerate(cols)])
    return (df.select(F.explode(pairs).alias("kv")).select("kv.k", "kv.v")
            .where(F.col("v").isNotNull() & ~F.isnan("v")))


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    """The two ranks around quantile q of n sorted values and the share of the second."""
    place = q * (n - 1)
    low = math.floor(place + 1e-12)
    return low, min(low + 1, n - 1), max(0.0, place - low)


def _in_brackets(long: DataFrame, brackets: list[tuple]) -> DataFrame:
    """Rows (b, v) whose value lies in bracket b; brackets are (b, k, lo, hi), a fixed few."""
    table = long.sparkSession.createDataFrame(brackets, "b int, bk int, lo double, hi double")
    return long.join(F.broadcast(table), (F.col("k") == F.col("bk")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))).select("b", "v")


def _values_at(long: DataFrame, wanted: dict[int, set[int]], accuracy: int, collect: int) -> dict[tuple[int, int], float]:
    """(column, rank) -> value."""
    at = {}
    # one bracket a column and rank: [lo, hi] with the number of values below lo
    inf = float("inf")
    open_ = {i: [k, r, -inf, inf, 0] for i, (k, r) in enumerate((k, r) for k, rs in wanted.items() for r in sorted(rs))}
    first = True
    while open_:
        if first:  # all brackets of a column are the whole column: count its values once
            hist = long.groupBy(F.col("k").alias("b"), "v").agg(F.count(F.lit(1)).alias("n"))
        else:
            hist = _in_brackets(long, [(i, k, lo, hi) for i, (k, _, lo, hi, _) in open_.items()]).groupBy("b", "v").agg(F.count(F.lit(1)).alias("n"))
        found = hist.limit(collect + 1).toArrow()
        if found.num_rows <= collect:
            b, v, n = (found[c].to_numpy() for c in ("b", "v", "n"))
            for i, (k, r, _, _, below) in open_.items():
                own = b == (k if first else i)
                order = np.argsort(v[own], kind="stable")
                ends = below + np.cumsum(n[own][order])
                at[k, r] = float(v[own][order][np.searchsorted(ends, r, side="right")])
            return at
        m = 3.0 / accuracy
        spans = long.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect() if first else (
            _in_brackets(long, [(i, k, lo, hi) for i, (k, _, lo, hi, _) in open_.items()]).groupBy(F.col("b").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect())
        size = {r["k"]: r["n"] for r in spans}
        inner = long.withColumnRenamed("k", "b") if first else _in_brackets(long, [(i, k, lo, hi) for i, (k, _, lo, hi, _) in open_.items()])
        asked = {}
        for i, (k, r, _, _, below) in open_.items():
            g = k if first else i
            place = (r - below) / max(size[g] - 1, 1)
            asked.setdefault(g, {})[i] = [max(0.0, place - m), min(1.0, place + m)]
        probes = sorted({p for by in asked.values() for two in by.values() for p in two})
        approx = {r["b"]: r["p"] for r in inner.groupBy("b").agg(F.percentile_approx("v", probes, accuracy).alias("p")).collect()}
        for g, by in asked.items():
            for i, two in by.items():
                open_[i][2:4] = [approx[g][probes.index(two[0])], approx[g][probes.index(two[1])]]
        # exact numbers below and inside; a bracket that missed its rank is moved to the side that has it
        sides = long.join(F.broadcast(long.sparkSession.createDataFrame([(i, k, lo, hi) for i, (k, _, lo, hi, _) in open_.items()],
                                                                        "b int, bk int, lo double, hi double")), F.col("k") == F.col("bk"))
        for row in sides.groupBy("b").agg(F.count_if(F.col("v") < F.col("lo")).alias("under"), F.count_if(F.col("v") <= F.col("hi")).alias("upto")).collect():
            k, r, lo, hi, _ = open_[row["b"]]
            if r < row["under"]:
                open_[row["b"]] = [k, r, -inf, float(np.nextafter(lo, -inf)), 0]
            elif r >= row["upto"]:
                open_[row["b"]] = [k, r, float(np.nextafter(hi, inf)), inf, row["upto"]]
            else:
                open_[row["b"]][4] = row["under"]
                if lo == hi:
                    at[k, r] = lo
        open_ = {i: x for i, x in open_.items() if (x[0], x[1]) not in at}
        first = False
    return at


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 100000,
                    collect: int = COLLECT) -> dict[str, list[float | None]]:
    """Quantiles of each column with linear interpolation (nulls and NaN skipped); all-null -> None."""
    cols = list(cols)
    if not cols:
        return {}
    number = lambda c: F.col(c).cast("double")
    sizes = df.agg(*[F.count_if(number(c).isNotNull() & ~F.isnan(number(c))).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    ranks = {i: [_ranks(n, q) for q in probs] for i, n in enumerate(sizes) if n}
    at = _values_at(_long(df, cols), {k: {r for lo, hi, _ in rs for r in (lo, hi)} for k, rs in ranks.items()}, accuracy, collect)
    out: dict = {c: [None] * len(probs) for c in cols}
    for k, rs in ranks.items():
        out[cols[k]] = [at[k, lo] + (at[k, hi] - at[k, lo]) * share if share else at[k, lo] for lo, hi, share in rs]
    return out


def exact_medians(df: DataFrame, cols: Sequence[str], accuracy: int = 100000) -> dict:
    """Exact median of each column (nulls and NaN skipped); all-null -> None."""
    return {c: v[0] for c, v in exact_quantiles(df, cols, [0.5], accuracy).items()}


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row a column: count, mean, std, min, 25, 50 and 75 % (exact, interpolated), max."""
    spark = df.sparkSession
    stats = [f(c).cast("double").alias(f"{n}_{i}") for i, c in enumerate(cols)
             for n, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev), ("min", F.min), ("max", F.max))]
    row = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).agg(*stats).first()
    quantiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = [(c, int(row[f"count_{i}"]), row[f"mean_{i}"], row[f"std_{i}"], row[f"min_{i}"], *quantiles[c], row[f"max_{i}"]) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "column string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double")
