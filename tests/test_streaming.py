"""The streaming refresh gives the same panel as the one-shot build."""

import datetime as dt
import tempfile

from panelcast.operators import panel as px
from panelcast.operators.names import entity_domain
from panelcast.spec import PanelSpec
from panelcast.streaming.refresh import panel_from_log, start_refresh

SPEC = PanelSpec(start="2000-01-01", end="2000-12-01")
SCHEMA = ("event_id long, event_seq long, start_date date, state string, districts string, "
          "severity double, fatalities double, displaced double, duration double")


def test_refresh_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="panelcast-stream-")
    domain = entity_domain(spark.createDataFrame([("Puri",), ("Cuttack",)], "raw_name string"), "raw_name", {})
    d = dt.date(2000, 7, 1)
    batches = [
        [(1, 1, d, "x", "Puri, Cuttack", 4.0, 1.0, None, None), (2, 2, d, "x", "Puri", None, 2.0, 5.0, None)],
        [(3, 3, d, "x", "Puri", 6.0, None, None, None), (4, 4, dt.date(2001, 1, 1), "x", "Puri", 1.0, 1.0, 1.0, 1.0)],
        [(5, 5, d, "x", "Cuttack", None, None, None, 9.0)],
    ]
    landing = f"{root}/landing"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{landing}/b{i}")
    stream = (spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", 1).parquet(landing))  # several micro-batches
    q = start_refresh(stream, domain, SPEC, f"{root}/log", f"{root}/ckpt")
    q.awaitTermination(120)
    cal = px.calendar(domain, SPEC)
    got = sorted(map(tuple, panel_from_log(spark, f"{root}/log", cal, SPEC).collect()))
    all_events = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    want = sorted(map(tuple, px.upsert(cal, px.event_cells(all_events, domain, SPEC), SPEC).collect()))
    assert got == want
    puri = [r for r in got if r[0] == "Puri" and r[2] == 7][0]
    assert puri[3:] == (1, 6.0, 2.0, 5.0, 0.0)
