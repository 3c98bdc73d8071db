"""Physical-plan properties of registered queries (sf0.001 tables)."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

QUERIES = ["event_explode", "panel_upsert", "theta_name_match", "coverage_counts", "alternate_lookup",
           "fold_summary", "year_distribution", "source_counts", "name_variants", "label_encode",
           "metric_roc_auc", "unmatched_anti"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_cartesian_or_nested_loop(spark, name):
    import __spark_entry__ as E
    p = plan_of(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_event_filter_and_pruning_reach_the_scan(spark):
    import __spark_entry__ as E
    df = E.queries()["event_explode"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderpriority,1-URGENT)" in text and "PushedFilters: [IsNotNull(o_orderpriority)" in text
    assert "struct<l_orderkey:bigint,l_suppkey:bigint>" in text  # line items: two columns read


def test_windows_profiles_and_forecasts_need_no_exchange_on_the_laid_out_panel(spark):
    from panelcast.operators import features as fx
    from panelcast.operators import planning as pl
    from panelcast.plans import panel as pp
    panel = pp.analogue_panel(spark, SF)
    spec = pp.analogue_spec()
    base = panel.drop(*[c for c in panel.columns if c.startswith(("flood_lag", "flood_roll"))])
    plans = {"lags": fx.add_lags(base, spec), "rolling": fx.add_rolling(base, spec), "profile": pl.month_profile(panel),
             "forecast": pl.seasonal_forecast(panel), "trailing": pl.trailing_events(panel), "compare": panel.groupBy("entity").count()}
    for name, df in plans.items():
        assert "Exchange" not in plan_of(df), name
    # the same rows as the windows give over a panel in any layout
    loose = base.repartition(3)
    cols = ["entity", "year", "month", *[f"flood_lag_{n}m" for n in spec.lags]]
    assert fx.add_lags(base, spec).select(cols).exceptAll(fx.add_lags(loose, spec).select(cols)).isEmpty()


def test_unmatched_events_are_a_filter(spark):
    import __spark_entry__ as E
    df = E.queries()["unmatched_anti"](spark, SF)
    assert "LeftAnti" not in plan_of(df)


def test_panel_table_refreshes_changed_years_only(spark, tmp_path):
    from pyspark.sql import functions as F

    from panelcast.sources import panel_table as pt
    rows = [(f"e{i}", y, m, float(i + m)) for i in range(5) for y in (2000, 2001, 2002) for m in (1, 2)]
    df = spark.createDataFrame(rows, "entity string, year int, month int, v double")
    t = pt.save_panel(df, "panel_refresh_test", str(tmp_path / "t"), buckets=3)
    assert t.exceptAll(df).isEmpty() and t.count() == 30
    pt.refresh_years(df.where("year = 2001 and month = 1").withColumn("v", F.lit(-1.0)), "panel_refresh_test")
    got = sorted(tuple(r) for r in spark.table("panel_refresh_test").select(*df.columns).collect())
    assert got == sorted([r for r in rows if r[1] != 2001] + [(e, y, m, -1.0) for e, y, m, _ in rows if y == 2001 and m == 1])
    again = spark.table("panel_refresh_test").groupBy("entity").count()
    assert "Exchange" not in plan_of(again)
    spark.sql("DROP TABLE panel_refresh_test")


def test_stored_panel_follows_its_files(spark, tmp_path):
    from panelcast.sources import panel_table as pt
    source, built = str(tmp_path / "in"), []

    def build():
        built.append(1)
        return spark.read.parquet(source)
    df = spark.createDataFrame([("a", 2000, 1, 1.0)], "entity string, year int, month int, v double")
    df.write.parquet(source)
    for _ in range(2):
        assert pt.stored_panel(spark, [source], "s", build).count() == 1
    assert len(built) == 1
    df.unionByName(df).write.mode("overwrite").parquet(source)
    assert pt.stored_panel(spark, [source], "s", build).count() == 2 and len(built) == 2
