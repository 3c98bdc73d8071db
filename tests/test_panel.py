"""Panel semantics on hand-made events (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators import features as fx
from panelcast.operators import panel as px
from panelcast.operators.names import entity_domain
from panelcast.spec import PanelSpec

SPEC = PanelSpec(alias={"Balasore": "Baleshwar"}, start="2000-01-01", end="2000-12-01",
                 measures=("severity", "fatalities", "displaced", "duration"))
EV_SCHEMA = ("event_id long, event_seq long, start_date date, state string, districts string, "
             "severity string, fatalities string, displaced string, duration string")


def events(spark, rows):
    return spark.createDataFrame(rows, EV_SCHEMA)


@pytest.fixture(scope="module")
def domain(spark):
    names = spark.createDataFrame([("Puri",), ("Baleshwar",), ("Cuttack",)], "raw_name string")
    return entity_domain(names, "raw_name", SPEC.alias)


def build(spark, domain, rows):
    ev = events(spark, rows)
    cells = px.event_cells(ev, domain, SPEC)
    return px.upsert(px.calendar(domain, SPEC), cells, SPEC), cells


def cell(panel, entity, month):
    return panel.where((F.col("entity") == entity) & (F.col("month") == month) & (F.col("year") == 2000)).first()


def test_calendar_is_dense(spark, domain):
    p, _ = build(spark, domain, [])
    assert p.count() == 3 * 12
    assert p.agg(F.sum("flood_occurrence")).first()[0] == 0


def test_last_non_null_and_alias(spark, domain):
    d = dt.date(2000, 7, 3)
    rows = [(1, 1, d, "Odisha", "Puri, Balasore", "4.0", "1", "10", "2"),
            (2, 2, d, "Odisha", "Puri", "6.0", None, None, None),
            (3, 3, d, "Odisha", "Puri, Baleshwar", None, "3", None, None)]
    p, _ = build(spark, domain, rows)
    puri = cell(p, "Puri", 7)
    assert (puri.flood_occurrence, puri.severity, puri.fatalities, puri.displaced) == (1, 6.0, 3.0, 10.0)
    bal = cell(p, "Baleshwar", 7)  # Balasore -> Baleshwar, and the same entity twice is one cell
    assert (bal.flood_occurrence, bal.severity, bal.fatalities) == (1, 4.0, 3.0)
    assert p.count() == 36


def test_last_non_numeric_gives_zero(spark, domain):
    d = dt.date(2000, 3, 1)
    p, _ = build(spark, domain, [(1, 1, d, "x", "Cuttack", "4", None, None, None),
                                 (2, 2, d, "x", "Cuttack", "abc", None, None, None)])
    assert cell(p, "Cuttack", 3).severity == 0.0


def test_null_list_blank_parts_and_bad_dates(spark, domain):
    rows = [(1, 1, dt.date(2000, 5, 1), "x", None, "1", None, None, None),
            (2, 2, dt.date(2000, 5, 1), "x", "Puri, Cuttack,,", "1", None, None, None),
            (3, 3, None, "x", "Puri", "9", None, None, None)]
    p, cells = build(spark, domain, rows)
    assert cells.count() == 3  # Puri, Cuttack from event 2; event 3 keeps a null month
    assert p.agg(F.sum("flood_occurrence")).first()[0] == 2
    assert cell(p, "Puri", 5).severity == 1.0


def test_outside_calendar_is_reported_not_merged(spark, domain):
    rows = [(1, 1, dt.date(1999, 6, 1), "x", "Puri", "1", None, None, None),
            (2, 2, dt.date(2024, 6, 1), "x", "Puri", "1", None, None, None),
            (3, 3, dt.date(2000, 6, 1), "x", "Puri", "1", None, None, None)]
    p, cells = build(spark, domain, rows)
    cal = px.calendar(domain, SPEC)
    un = px.unmatched_events(cells, SPEC)
    assert sorted(r.year for r in un.collect()) == [1999, 2024]
    rec = px.merge_reconciliation(cells, SPEC).first()
    assert (rec.total, rec.matched, rec.failed) == (3, 1, 2)
    assert p.agg(F.sum("flood_occurrence")).first()[0] == 1


def test_lags_and_rolling(spark, domain):
    rows = [(1, 1, dt.date(2000, 1, 1), "x", "Puri", "1", None, None, None),
            (2, 2, dt.date(2000, 3, 1), "x", "Puri", "1", None, None, None)]
    p, _ = build(spark, domain, rows)
    f = fx.add_rolling(fx.add_lags(p, SPEC, fill_zero=True), SPEC).where("entity = 'Puri'").orderBy("month").collect()
    assert f[0].flood_lag_1m == 0.0 and f[1].flood_lag_1m == 1.0 and f[3].flood_lag_3m == 1.0
    assert [round(r.flood_roll_3m, 4) for r in f[:3]] == [1.0, 0.5, 0.6667]
    lf = fx.add_rolling(p, SPEC, leak_free=True).where("entity = 'Puri'").orderBy("month").collect()
    assert lf[0].flood_roll_3m is None and lf[1].flood_roll_3m == 1.0


def test_census_last_row_wins(spark, domain):
    census = spark.createDataFrame([(1, "PURI", 10, 1, 1, 0), (2, " puri ", 20, 2, 1, 1)],
                                   "row_seq long, district_name string, population long, households long, "
                                   "rural_households long, urban_households long")
    c = px.census_lookup(domain, census, SPEC).where("entity = 'Puri'").first()
    assert c.census_population == 20.0


def test_median_impute_and_all_null(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", None, None), ("c", 3.0, None), ("d", 10.0, None)],
                               "entity string, x double, y double")
    out = fx.fill_zero(fx.impute_medians(df, ["x", "y"])).orderBy("entity").collect()
    assert [r.x for r in out] == [1.0, 3.0, 3.0, 10.0]
    assert [r.y for r in out] == [0.0] * 4


def test_leak_free_options(spark, domain):
    rows = [(1, 1, dt.date(2000, 1, 1), "x", "Puri", "4", None, None, None),
            (2, 2, dt.date(2000, 2, 1), "x", "Puri", "6", None, None, None)]
    p, _ = build(spark, domain, rows)
    p = p.withColumn("census_population", F.lit(100000.0)).withColumn("corrected_flooded_area", F.lit(None).cast("double"))
    cur = fx.add_exposure(p, SPEC).where("entity = 'Puri'").orderBy("month").collect()
    lag = fx.add_exposure(p, SPEC, leak_free=True).where("entity = 'Puri'").orderBy("month").collect()
    assert [r.pop_x_flood_severity for r in cur[:3]] == [4.0, 6.0, 0.0]
    assert [r.pop_x_flood_severity for r in lag[:3]] == [0.0, 4.0, 6.0]
    assert cur[0].flood_exposed_pop == 0.0


def test_calendar_tasks_are_bounded(spark):
    """Entities of one partition are dealt out by their number, so no task makes the whole calendar."""
    names = spark.range(50).select(F.concat(F.lit("E"), F.col("id").cast("string")).alias("entity")).coalesce(1)
    cal = px.calendar(names, SPEC, task_rows=60)
    per_task = [r["n"] for r in cal.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert cal.rdd.getNumPartitions() == 10 and max(per_task) < 300 and sum(per_task) == 600
    assert cal.exceptAll(px.calendar(names, SPEC)).count() == 0


def test_lines_are_dealt_by_their_number(spark):
    """Rows follow the join keys to as many tasks as the rows ask for, and none is lost."""
    from panelcast.sources.tables import _dealt
    lines = spark.range(1000).select((F.col("id") % 300).alias("k"), "id")
    keys = spark.range(0, 600, 2).select(F.col("id").alias("k"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * 5
    dealt = _dealt(keys, "k", 1000, task_rows=1000 // parts)
    assert dealt.rdd.getNumPartitions() == -(-1000 // (1000 // parts))
    assert _dealt(keys, "k", 1000).rdd.getNumPartitions() == keys.rdd.getNumPartitions()
    got = lines.join(dealt.hint("merge"), "k", "left_semi")
    assert got.rdd.getNumPartitions() == dealt.rdd.getNumPartitions()
    assert sorted(r.id for r in got.collect()) == [i for i in range(1000) if i % 300 % 2 == 0]
