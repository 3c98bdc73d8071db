"""The weekly re-run as Structured Streaming.

New event files land in a folder; each micro-batch is reduced to per-cell last
values (value and event sequence per measure) and written, idempotently per epoch,
to a cell log under the shared checkpoint folder.  The panel is the batch upsert
over the whole log: for every cell and measure the value with the highest event
sequence wins, which is the same last-non-null rule as the one-shot build, however
the events were split into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelcast.functions.calendar import first_of_month
from panelcast.operators.panel import _numeric, event_cells
from panelcast.spec import PanelSpec


def cell_log_batch(events: DataFrame, domain: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per (entity, year, month): last non-null value and its sequence per measure."""
    cells = event_cells(events, domain, spec)
    seq = F.col(spec.seq_col)
    aggs = []
    for m in spec.measures:
        ok = F.col(m).isNotNull()
        aggs += [F.max_by(m, F.when(ok, seq)).alias(m), F.max(F.when(ok, seq)).alias(f"{m}__seq")]
    return cells.groupBy(spec.entity_col, "year", "month").agg(*aggs)


def start_refresh(events_stream: DataFrame, domain: DataFrame, spec: PanelSpec, log_path: str,
                  checkpoint_location: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the refresh query; ``trigger`` e.g. ``{"availableNow": True}`` or
    ``{"processingTime": "7 days"}``."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # overwrite of the epoch's own partition makes a retried batch idempotent
        (cell_log_batch(batch, domain, spec).withColumn("epoch", F.lit(epoch_id))
         .write.mode("overwrite").partitionBy("epoch").option("partitionOverwriteMode", "dynamic")
         .parquet(log_path))

    w = (events_stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def panel_from_log(spark: SparkSession, log_path: str, calendar: DataFrame, spec: PanelSpec) -> DataFrame:
    """Upsert the logged cells into the calendar (events outside it are ignored)."""
    e, ms = spec.entity_col, list(spec.measures)
    log = spark.read.parquet(log_path)
    lo, hi = F.to_date(F.lit(spec.start)), F.to_date(F.lit(spec.end))
    log = log.where(first_of_month("year", "month").between(lo, hi))
    types = {f.name: f.dataType for f in log.schema.fields}
    ev = log.select(e, "year", "month", F.lit(1).alias("flood_occurrence"),
                    *[c for m in ms for c in (F.col(m), F.col(f"{m}__seq"))])
    base = calendar.select(e, "year", "month", F.lit(0).alias("flood_occurrence"),
                           *[c for m in ms for c in (F.lit(None).cast(types[m]).alias(m),
                                                     F.lit(None).cast(types[f"{m}__seq"]).alias(f"{m}__seq"))])
    g = base.unionByName(ev).groupBy(e, "year", "month").agg(
        F.max("flood_occurrence").alias("flood_occurrence"),
        *[F.max_by(m, f"{m}__seq").alias(m) for m in ms])
    return g.select(e, "year", "month", F.col("flood_occurrence").cast("int").alias("flood_occurrence"),
                    *[F.coalesce(_numeric(m, types[m]), F.lit(0.0)).alias(m) for m in ms])
