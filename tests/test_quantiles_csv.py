"""Exact quantiles, the typed CSV reader and number display against pandas and plain Python."""

import io

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.functions import stats
from panelcast.operators import planning as pl
from panelcast.sources import files as fs
from panelcast.spec import NULL_SENTINELS


@pytest.mark.parametrize("collect", [200_000, 40, 5])
def test_quantiles_as_pandas(spark, collect):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=3000), "hot": np.where(rng.random(3000) < 0.6, 7.0, rng.random(3000)),
                        "few": rng.integers(0, 3, 3000).astype(float), "neg": -rng.exponential(size=3000)})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("none", F.lit(None).cast("double")).repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    # a low accuracy makes brackets wide and wrong ones likely: several rounds
    got = stats.exact_quantiles(df, [*pdf.columns, "none"], probs, accuracy=50 if collect < 100 else 100_000, collect=collect)
    for c in pdf.columns:
        assert np.allclose(got[c], pdf[c].quantile(probs), rtol=0, atol=1e-12), c
    assert got["none"] == [None] * len(probs)


def test_no_window_and_no_columnwide_task(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"))
    plans = []
    stats.exact_quantiles(df, ["x"], [0.5])
    plans.append(stats._long(df, ["x"]).groupBy("k", "v").count()._jdf.queryExecution().toString())
    assert not any("Window" in p for p in plans)


def test_display_of_all_amounts(spark):
    df = spark.range(1001, 100_001).select("id", pl.thousands_text(F.col("id")).alias("t"))
    wrong = [r.id for r in df.toLocalIterator() if r.t != f"{r.id / 1000:.1f}K"]
    big = [10 ** 9 + 50, 123_456_789_050, 2 ** 52 - 46, 10 ** 15 + 250]
    got = {r.id: r.t for r in spark.createDataFrame([(b,) for b in big], "id long").select("id", pl.thousands_text(F.col("id")).alias("t")).collect()}
    assert not wrong and all(got[b] == f"{b / 1000:.1f}K" for b in big)


def test_null_markers_are_the_readers(spark):
    texts = [*NULL_SENTINELS, "-", "none", " NA", "NA ", "nil", "0", "Nan", "N.A."]
    read = pd.read_csv(io.StringIO("k,v\n" + "\n".join(f"{i},{t}" for i, t in enumerate(texts))), dtype={"v": str})
    df = spark.createDataFrame(list(enumerate(texts)), "k int, v string")
    from panelcast.functions.text import null_sentinels
    got = {r.k: r.n for r in df.select("k", null_sentinels("v").isNull().alias("n")).collect()}
    assert [got[i] for i in range(len(texts))] == list(read.v.isna())


def test_typed_csv_good_and_rejected_are_all_lines(spark, tmp_path):
    lines = ["key,day,name,n,x", "1,02-03-2001,a,5,1.5", "2,,NA,n/a,nan", "3,31-02-2001,b,1,1", "4,01-01-2001,c,1.5,1", "5,01-01-2001,d,7,1e3",
             "6,01-01-2001,e", "7,01-01-2001,f,1,2,3,4", '8,01-01-2001,"g, h",-3,.5', "x,01-01-2001,i,1,1", "9,01-01-2001,,<NA>,12d"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    good, bad = fs.read_typed_csv(spark, str(tmp_path), {"key": "long", "day": "date", "name": "string", "n": "int", "x": "double"})
    rows = {r.key: (r.name, r.n, r.x) for r in good.collect()}
    assert rows == {1: ("a", 5, 1.5), 2: (None, None, None), 5: ("d", 7, 1000.0), 8: ("g, h", -3, 0.5)}
    why = sorted((r.reason, r.value) for r in bad.collect() if r.reason != "malformed")
    assert why == [("day", "31-02-2001"), ("key", "x"), ("n", "1.5"), ("x", "12d")]
    assert {r.line for r in bad.collect() if r.reason == "malformed"} == {"6,01-01-2001,e", "7,01-01-2001,f,1,2,3,4"}
    assert good.count() + bad.count() == len(lines) - 1
    assert not fs.path_exists(spark, str(tmp_path / "absent")) and fs.path_exists(spark, str(tmp_path))
