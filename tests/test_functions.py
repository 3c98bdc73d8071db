"""Expression-level edge cases (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from panelcast.functions import text as tx
from panelcast.functions import calendar as cal
from panelcast.operators.names import canonical_name
from panelcast.operators.planning import quantity_display, risk_tier

ALIAS = {"Balasore": "Baleshwar", "Jagatsinghpur": "Jagatsinghapur"}


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_alias_and_strip(spark):
    assert one(spark, canonical_name("v", ALIAS), " balasore ") == "Baleshwar"
    assert one(spark, canonical_name("v", ALIAS), "PURI") == "Puri"
    assert one(spark, canonical_name("v", ALIAS), None) is None


def test_title_case_like_python(spark):
    for s in ["y.s.r. o'neil north-24", "nATION_5", "", "a  b", "24 parganas"]:
        assert one(spark, tx.title_case("v"), s) == s.title()


def test_split_list(spark):
    assert one(spark, tx.split_list("v"), None) == []
    assert one(spark, tx.split_list("v"), "Puri, Cuttack,,") == ["Puri", "Cuttack", "", ""]


def test_day_first_dates(spark):
    import datetime as dt
    assert one(spark, tx.parse_day_first("v"), "5/7/2001") == dt.date(2001, 7, 5)
    assert one(spark, tx.parse_day_first("v"), "31-31-2001") is None
    assert one(spark, tx.parse_day_first("v"), "2001-07-05") == dt.date(2001, 7, 5)
    assert one(spark, tx.parse_day_first("v"), "05.07.2001") == dt.date(2001, 7, 5)


def test_numeric_text(spark):
    got = [one(spark, F.coalesce(tx.coerce_numeric("v"), F.lit(0.0)), s) for s in [" 12 ", "12d", "1,200", "1e3", "-.5"]]
    assert got == [12.0, 0.0, 0.0, 1000.0, -0.5]


def test_null_sentinels(spark):
    assert [one(spark, tx.null_sentinels("v"), s) for s in ["NA", " N/A ", "None", "x"]] == [None, " N/A ", None, "x"]


def test_seasons(spark):
    assert one(spark, cal.season_two_way("v"), 10, "v int") == "Monsoon"
    assert one(spark, cal.season_four_way("v"), 10, "v int") == "Post-Monsoon"
    assert one(spark, cal.season_two_way("v"), None, "v int") == "Non-Monsoon"
    assert [one(spark, cal.season_four_way("v"), m, "v int") for m in (1, 4, 7, 11, 12)] == \
        ["Winter", "Pre-Monsoon", "Monsoon", "Post-Monsoon", "Winter"]


def test_half_even(spark):
    assert [one(spark, F.bround("v", 0), x, "v double") for x in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]


def test_risk_edges(spark):
    assert [one(spark, risk_tier(F.col("v")), x, "v double") for x in (0.1, 0.1001, 0.3, 0.3001)] == \
        ["LOW", "MODERATE", "MODERATE", "HIGH"]


def test_quantity_display(spark):
    disp, prog = quantity_display(F.col("v"))
    assert [one(spark, disp, x, "v bigint") for x in (999, 1000, 1250, 1350, 60000)] == \
        ["999", "1000", "1.2K", "1.4K", "60.0K"]
    assert one(spark, prog, 300000, "v bigint") == 1.0
