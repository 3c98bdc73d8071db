"""Sources and sinks: headed CSV with sentinels, JSON lines, reports, defaults."""

import math
import os
import tempfile

from pyspark.sql import functions as F

from panelcast.sources import files as fs


def _tmp():
    return tempfile.mkdtemp(prefix="panelcast-src-")


def test_blank_header_csv_with_sentinels(spark):
    d = _tmp()
    with open(os.path.join(d, "index.csv"), "w") as f:
        f.write(",DFSI,Note\nPuri,1.5,NA\nCuttack,N/A,x\nGanjam, 2 ,None\n")
    df = fs.read_headed_csv(spark, d, key_name="district", sentinel_cols=["DFSI", "Note"])
    assert df.columns == ["district", "DFSI", "Note"]
    from panelcast.functions.text import coerce_numeric
    rows = {r.district: (r.v, r.Note) for r in df.select("district", coerce_numeric("DFSI").alias("v"), "Note").collect()}
    assert rows == {"Puri": (1.5, None), "Cuttack": (None, "x"), "Ganjam": (2.0, None)}


def test_json_lines_drop_malformed_and_absent(spark):
    d = _tmp()
    with open(os.path.join(d, "f.geojsonl"), "w") as f:
        f.write('{"properties": {"name": "A", "code": 1}}\n{"properties": {"name": "B"\n{"properties": {"name": "C", "code": 3}}\n')
    schema = "properties struct<name:string, code:long>"
    df = fs.read_json_lines(spark, d, schema)
    assert sorted(r.properties.name for r in df.collect()) == ["A", "C"]
    keys = df.select(F.json_object_keys(F.to_json("properties")).alias("k")).first().k
    assert sorted(keys) == ["code", "name"]
    assert fs.read_json_lines(spark, os.path.join(d, "missing"), schema).count() == 0


def test_report_document_with_nan_and_defaults(spark):
    d = _tmp()
    with open(os.path.join(d, "report.json"), "w") as f:
        f.write('{\n  "classifier": {"avg_roc_auc": 0.9916, "avg_pr_auc": NaN},\n  "regressor": {"avg_mape": null}\n}\n')
    schema = "classifier struct<avg_roc_auc:double, avg_pr_auc:double>, regressor struct<avg_mape:double>"
    r = fs.read_report(spark, d, schema).first()
    assert r.classifier.avg_roc_auc == 0.9916 and math.isnan(r.classifier.avg_pr_auc) and r.regressor.avg_mape is None
    assert fs.read_report(spark, os.path.join(d, "absent"), schema).count() == 0


def test_panel_sink_roundtrip_partitioned(spark):
    d = os.path.join(_tmp(), "panel")
    df = spark.createDataFrame([("A", 2000, 1, 1.0), ("A", 2001, 1, 2.0)], "entity string, year int, month int, v double")
    fs.write_panel(df, d)
    back = fs.read_panel(spark, d)
    assert sorted(map(tuple, back.select("entity", "year", "month", "v").collect())) == [("A", 2000, 1, 1.0), ("A", 2001, 1, 2.0)]
    assert os.path.isdir(os.path.join(d, "year=2000"))


def test_ensure_columns_only_when_absent(spark):
    df = spark.createDataFrame([(None,)], "severity double")
    out = fs.ensure_columns(df, {"severity": 0.0, "duration": 0.0, "area": (None, "double")}).first()
    assert out.severity is None and out.duration == 0.0 and out.area is None
