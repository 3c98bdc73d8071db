"""Per-entity seasonal model: piecewise-linear trend, yearly and monthly waves, regressors.

``y = trend + waves + regressors`` (additive) or ``y = trend (1 + waves + regressors)``
(multiplicative, fitted by alternating between the trend and the rest).  The trend is a line
with up to ``CHANGEPOINTS`` slope changes in the first 80 % of an entity's training rows; changes carry an
absolute-value penalty of scale ``changepoint_scale`` (reweighted ridge), waves and
regressors a weak ridge.  The interval is the fit plus and minus the normal quantile times the
residual deviation.

An entity's series is bounded by the calendar, so each becomes one row of arrays (one shuffle by
entity); tasks stack a batch of series into one design tensor, sum its Gram matrices and solve
them in one batched call.  No Python loop over entities or months; nothing passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.splits import holdout_split
from panelcast.spec import LOG_CLIP_HIGH, LOG_CLIP_LOW

CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
YEAR_DAYS, YEAR_ORDER = 365.25, 10
MONTH_DAYS, MONTH_ORDER = 30.5, 5
#: Prior deviation of waves and regressors, on targets scaled to a maximum of 1.
WAVE_SCALE = 10.0
#: The residual deviation counts so many rows of this share of the target's spread, so that a
#: short series, which the terms can follow exactly, keeps an interval and its penalties.
PRIOR_ROWS, PRIOR_SHARE = 4, 0.25
#: Solves of the reweighted penalty; alternations between trend and waves.
ROUNDS, ALTERNATIONS = 8, 6
#: Series stacked into one tensor.
STACK = 128


@dataclass(frozen=True)
class SeasonalSpec:
    """A published variant; ``positives_only`` and ``log`` go with each other in the final one."""
    mode: str = "additive"
    changepoint_scale: float = 0.02
    monthly: bool = False
    regressors: tuple[str, ...] = ()
    interval: float = 0.80
    target: str = "demand_target"
    positives_only: bool = True
    log: bool = True
    min_rows: int = 6
    min_train: int = 4
    yearly_order: int = YEAR_ORDER


#: The three published variants.
VARIANTS = {
    "final": SeasonalSpec(),
    "v2": SeasonalSpec("multiplicative", 0.05, target="composite_demand", positives_only=False, log=False, min_rows=1, min_train=12),
    "v1": SeasonalSpec("multiplicative", 0.05, True, ("dfsi", "corrected_flooded_area", "census_population"),
                       target="resource_demand_score", positives_only=False, log=False, min_rows=1, min_train=12),
}


def _waves(day: np.ndarray, period: float, order: int) -> np.ndarray:
    angle = 2 * math.pi * day[..., None] * np.arange(1, order + 1) / period
    return np.concatenate((np.sin(angle), np.cos(angle)), axis=-1)


def _solve(x: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Batched ridge solutions from Gram sums; x: series x rows x terms, penalty: series x terms."""
    gram = np.einsum("elp,elq->epq", x, x)
    gram[:, np.arange(gram.shape[1]), np.arange(gram.shape[1])] += penalty + 1e-9
    return np.linalg.solve(gram, np.einsum("elp,el->ep", x, y)[..., None])[..., 0]


class Fit:
    """Batched fits; ``day``, ``y``, ``train`` are series x rows, ``extra`` series x rows x regressors."""

    def __init__(self, spec: SeasonalSpec, day, y, train, extra):
        self.spec = spec
        w = train.astype(float)
        n = np.maximum(w.sum(axis=1), 1.0)
        first = np.where(train, day, np.inf).min(axis=1)
        last = np.where(train, day, -np.inf).max(axis=1)
        t = (day - first[:, None]) / np.maximum(last - first, 1.0)[:, None]
        self.scale = np.maximum(np.abs(np.where(train, y, 0.0)).max(axis=1), 1e-12)
        mean = (extra * w[..., None]).sum(axis=1) / n[:, None]
        spread = np.sqrt((np.square(extra - mean[:, None]) * w[..., None]).sum(axis=1) / n[:, None])
        extra = np.where(spread[:, None] > 1e-12, (extra - mean[:, None]) / np.maximum(spread, 1e-12)[:, None], 0.0)  # constants have no effect
        # slope changes at evenly spaced training rows of the first part
        order = np.sort(np.where(train, t, np.inf), axis=1)
        most = np.minimum(CHANGEPOINTS, np.maximum(np.floor(CHANGEPOINT_RANGE * n).astype(int) - 1, 0))
        place = np.minimum(np.round((np.arange(1, CHANGEPOINTS + 1)[None, :] / np.maximum(most, 1)[:, None]) * (np.floor(CHANGEPOINT_RANGE * n) - 1)[:, None]),
                           (n - 1)[:, None]).astype(int)
        at = np.take_along_axis(order, np.maximum(place, 0), axis=1)
        used = np.arange(CHANGEPOINTS)[None, :] < most[:, None]
        bends = np.where(used[:, None, :], np.maximum(t[..., None] - np.where(used, at, 0.0)[:, None, :], 0.0), 0.0)
        trend = np.concatenate((np.ones_like(t)[..., None], t[..., None], bends), axis=2)
        waves = [_waves(day, YEAR_DAYS, spec.yearly_order)] + ([_waves(day, MONTH_DAYS, MONTH_ORDER)] if spec.monthly else []) + [extra]
        waves = np.concatenate(waves, axis=2)
        target = y / self.scale[:, None]
        self.trend, self.waves = trend, waves
        if spec.mode == "additive":
            beta, self.sigma = self._fit(np.concatenate((trend, waves), axis=2), target, w, trend.shape[2])
            self.base, self.wave = beta[:, :trend.shape[2]], beta[:, trend.shape[2]:]
        else:
            # waves are centred on the training rows, so that the trend carries the level
            waves = waves - (waves * w[..., None]).sum(axis=1, keepdims=True) / n[:, None, None]
            self.waves = waves
            self.wave = np.zeros((len(y), waves.shape[2]))
            for _ in range(ALTERNATIONS):
                swing = 1.0 + np.einsum("elp,ep->el", waves, self.wave)
                self.base, self.sigma = self._fit(trend * swing[..., None], target, w, trend.shape[2])
                level = np.einsum("elp,ep->el", trend, self.base)
                self.wave, self.sigma = self._fit(waves * level[..., None], target - level, w, 0)

    def _fit(self, x, y, w, bent: int):
        """Reweighted ridge over the first ``bent`` terms' bends, ridge over the rest."""
        x = x * w[..., None]
        y = y * w
        n = np.maximum(w.sum(axis=1), 1.0)
        middle = y.sum(axis=1) / n
        spread = np.sqrt(np.maximum(np.square(y).sum(axis=1) / n - middle ** 2, 0.0)) if bent else np.sqrt(np.square(y).sum(axis=1) / n)
        sigma = np.maximum(0.5 * spread, 1e-6)
        size = np.full((len(y), x.shape[2]), 1.0)
        for _ in range(ROUNDS):
            penalty = np.zeros_like(size)
            if bent:
                penalty[:, 2:bent] = 1.0 / (self.spec.changepoint_scale * np.maximum(np.abs(size[:, 2:bent]), 1e-4))
            penalty[:, bent:] = 1.0 / WAVE_SCALE ** 2
            size = _solve(x, y, penalty * np.square(sigma)[:, None])
            rest = y - np.einsum("elp,ep->el", x, size)
            sigma = np.sqrt((np.square(rest).sum(axis=1) + PRIOR_ROWS * np.square(PRIOR_SHARE * spread)) / (n + PRIOR_ROWS))
            sigma = np.maximum(sigma, 1e-6)
        return size, sigma

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """Fitted values and half widths of the interval, on the target's scale."""
        level, swing = np.einsum("elp,ep->el", self.trend, self.base), np.einsum("elp,ep->el", self.waves, self.wave)
        fitted = level + swing if self.spec.mode == "additive" else level * (1.0 + swing)
        z = NormalDist().inv_cdf(0.5 + self.spec.interval / 2)
        return fitted * self.scale[:, None], np.broadcast_to((z * self.sigma * self.scale)[:, None], fitted.shape)


def seasonal_forecasts(df: DataFrame, spec: SeasonalSpec, entity: str = "entity") -> DataFrame:
    """entity, date, y, is_train, n_train, yhat, lower, upper of every usable row; ``date`` and the
    target come from ``df``; the first 80 % of an entity's rows in time are training."""
    data = df.where(F.col(spec.target) > 0) if spec.positives_only else df.where(F.col(spec.target).isNotNull())
    y = F.log1p(spec.target) if spec.log else F.col(spec.target).cast("double")
    split = holdout_split(data.select(entity, "date", y.alias("y"), *spec.regressors), entity, "date")
    split = split.where((F.col("n") >= spec.min_rows) & (F.col("n_train") >= spec.min_train))
    row = F.struct(F.unix_date("date").cast("double").alias("day"), "y", F.col("is_train").cast("double").alias("train"),
                   *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"r{i}") for i, c in enumerate(spec.regressors)])
    series = split.groupBy(entity).agg(F.array_sort(F.collect_list(row)).alias("rows"), F.first("n_train").alias("n_train"))
    fields = ["day", "y", "train", *[f"r{i}" for i in range(len(spec.regressors))]]
    series = series.select(F.col(entity).cast("string").alias("entity"), "n_train", *[F.col(f"rows.{f}").alias(f) for f in fields])

    def fit(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, STACK):
                batch = whole.slice(s, STACK)
                columns = {f: batch.column(batch.schema.get_field_index(f)).to_pylist() for f in fields}
                sizes = [len(v) for v in columns["day"]]
                inside = np.arange(max(sizes))[None, :] < np.array(sizes)[:, None]
                block = {f: np.zeros(inside.shape) for f in fields}
                for f, v in columns.items():
                    block[f][inside] = np.concatenate(v)
                extra = np.stack([block[f] for f in fields[3:]], axis=2) if len(fields) > 3 else np.zeros((*inside.shape, 0))
                done = Fit(spec, block["day"], block["y"], (block["train"] > 0) & inside, extra).predict()
                names = np.repeat(np.arange(batch.num_rows), sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(names)), batch.column(1).take(pa.array(names)), pa.array(block["day"][inside].astype(np.int32)),
                     pa.array(block["y"][inside]), pa.array(block["train"][inside] > 0), pa.array(done[0][inside]), pa.array(done[1][inside])],
                    ["entity", "n_train", "day", "y", "is_train", "yhat", "half"])
    out = series.mapInArrow(fit, "entity string, n_train int, day int, y double, is_train boolean, yhat double, half double")
    return out.select("entity", F.date_from_unix_date("day").alias("date"), "y", "is_train", "n_train", "yhat",
                      (F.col("yhat") - F.col("half")).alias("lower"), (F.col("yhat") + F.col("half")).alias("upper"))


def seasonal_scores(forecasts: DataFrame, spec: SeasonalSpec, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """Per entity over its test rows: mae, rmse, mape on the original scale (logged targets are
    clipped, raised back and floored at 0), share of rows inside the interval, n_train, n_test."""
    test = forecasts.where(~F.col("is_train"))
    back = (lambda c: F.greatest(F.expm1(F.least(F.greatest(F.col(c), F.lit(LOG_CLIP_LOW)), F.lit(LOG_CLIP_HIGH))), F.lit(0.0))) if spec.log else F.col
    truth = F.greatest(F.expm1("y"), F.lit(0.0)) if spec.log else F.col("y")
    e = test.select(*keys, "n_train", back("yhat").alias("p"), truth.alias("t"), F.col("y").between(F.col("lower"), F.col("upper")).alias("inside"))
    gap = F.col("t") - F.col("p")
    share = F.avg(F.when(F.col("t") > 0, F.abs(gap) / F.col("t")))
    mape = F.when(F.sum(F.when(F.col("t") > 0, F.col("p"))) > 0, share) if spec.log else F.coalesce(share, F.lit(0.0))
    return e.groupBy(*keys).agg(F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"), mape.alias("mape"),
                                F.avg(F.col("inside").cast("double")).alias("coverage"), F.first("n_train").alias("n_train"),
                                F.count(F.lit(1)).alias("n_test"))
