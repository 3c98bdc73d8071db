"""Metric and planning semantics against brute force and FIXTURES edge rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from panelcast.operators import metrics as mx
from panelcast.operators import planning as pl
from panelcast.plans import targets as tg


def brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    if not pos or not neg:
        return 0.0
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def brute_pr_auc(ys, ss):
    P = sum(ys)
    pts = [(0.0, 1.0)]
    for t in sorted(set(ss), reverse=True):
        tp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 1)
        n = sum(1 for s in ss if s >= t)
        pts.append((tp / P, tp / n))
    return sum((r1 - r0) * (p1 + p0) / 2 for (r0, p0), (r1, p1) in zip(pts, pts[1:]))


def test_curve_metrics_with_ties(spark):
    rnd = random.Random(3)
    rows = [(g, rnd.randint(0, 1), rnd.randint(0, 9) / 10.0) for g in range(3) for _ in range(300)]
    df = spark.createDataFrame(rows, "g int, y int, s double")
    roc = {r.g: r.roc_auc for r in mx.roc_auc(df, "g", "s", "y").collect()}
    pr = {r.g: r.pr_auc for r in mx.pr_auc(df, "g", "s", "y").collect()}
    for g in range(3):
        ys = [y for gg, y, _ in rows if gg == g]
        ss = [s for gg, _, s in rows if gg == g]
        assert abs(roc[g] - brute_auc(ys, ss)) < 1e-12
        assert abs(pr[g] - brute_pr_auc(ys, ss)) < 1e-12


def test_one_class_fold(spark):
    df = spark.createDataFrame([(0, 0, 0.2), (0, 0, 0.7)], "g int, y int, s double")
    assert mx.roc_auc(df, "g", "s", "y").first().roc_auc == 0.0
    assert mx.pr_auc(df, "g", "s", "y").first().pr_auc is None
    c = mx.confusion_metrics(df.withColumn("p", (F.col("s") > 0.5).cast("int")), "g", "p", "y").first()
    assert (c.precision, c.recall, c.f1, c.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_mape_without_positives(spark):
    df = spark.createDataFrame([(0, 0.0, 1.0), (0, 0.0, 2.0)], "g int, y double, p double")
    assert mx.regression_metrics(df, "g", "y", "p").first().mape is None
    assert mx.regression_metrics(df, "g", "y", "p", empty_mape=0.0).first().mape == 0.0
    r = mx.regression_metrics(df, "g", "y", "p").first()
    assert r.mae == 1.5 and abs(r.rmse - (2.5 ** 0.5)) < 1e-12


def _forecast_rows(spark, p, demand, steps=12):
    rows = [("E", s, dt.date(2001, s, 1), s, p, demand) for s in range(1, steps + 1)]
    f = spark.createDataFrame(rows, "entity string, step int, date date, month int, flood_probability double, expected_demand double")
    ci = F.lit(0.1) + F.col("step") * 0.02
    return (f.withColumn("prob_lower", F.greatest(F.lit(0.0), F.col("flood_probability") - ci))
            .withColumn("prob_upper", F.least(F.lit(1.0), F.col("flood_probability") + ci))
            .withColumn("demand_lower", F.col("expected_demand") * 0.5)
            .withColumn("demand_upper", F.col("expected_demand") * 2.0))


def test_allocation_cap(spark):
    f = _forecast_rows(spark, 0.5, 5.0)
    pop = spark.createDataFrame([("E", 1000000)], "entity string, total_population long")
    a = {r.resource: r.amount for r in pl.allocation_long(f, pop).collect()}
    assert a == {"Medical Kits": 300, "ORS Packets": 60000, "Tarpaulin Sheets": 60000,
                 "Drinking Water": 135000000, "Dry Rations": 3600000}
    assert pl.allocation_long(f, pop).first().affected_population == 300000
    none = spark.createDataFrame([], "entity string, total_population long")
    assert pl.allocation_long(f, none).first().affected_population == 450000  # default 1,500,000


def test_kpi_horizon_days(spark):
    f = _forecast_rows(spark, 0.5, 1.0).withColumn("expected_demand", F.col("step").cast("double"))
    panel = spark.createDataFrame([("E", dt.date(2000, 12, 1), 1)], "entity string, date date, flood_occurrence int")
    got = [pl.kpi_row(f, panel, "2024-01-01", d).first().avg_demand for d in (7, 29, 30)]
    assert got == [1.0, 1.0, 1.5]


def test_seasonal_forecast_bands(spark):
    rows = [("E", y, m, dt.date(y, m, 1), 1 if (m == 7 or (m == 1 and y == 2000)) else 0, 2.0 if m == 7 else 0.0, 1.0)
            for y in (2000, 2001) for m in range(1, 13)]
    panel = spark.createDataFrame(rows, "entity string, year int, month int, date date, flood_occurrence int, "
                                        "severity double, resource_demand_score double")
    f = {r.step: r for r in pl.seasonal_forecast(panel).collect()}
    assert f[7].flood_probability == 1.0 and f[7].prob_upper == 1.0 and f[7].expected_demand == 2.0
    assert f[1].flood_probability == 0.5 and abs(f[1].expected_demand - 1.0) < 1e-12
    assert f[2].flood_probability == 0.0 and f[2].prob_lower == 0.0 and abs(f[2].expected_demand - 0.1) < 1e-12
    assert str(f[12].date) == "2002-12-01"


def test_v2_zero_population(spark):
    df = spark.createDataFrame([(0.0, 1.0, 1, 5.0), (0.0, 0.0, 1, 5.0), (100.0, 50.0, 1, 5.0)],
                               "census_population double, displaced double, flood_occurrence int, severity double")
    out = tg.targets_v2(df).collect()
    assert out[0].medical_kits == 0.0 and out[1].medical_kits is None and out[2].medical_kits == 0.0
    assert out[2].ors_packets == round(100 * (0.25 + 0.15 + 0.2) * 0.2)
