"""Event explode, dense calendar, last-value upsert and attribute attachment.

Plan shape at scale: events are exploded and reduced to one row per
(entity, year, month) with a partial (map-side) aggregate; the dense calendar is a
generator per entity (no join; entities are dealt so that a task makes at most about
``CALENDAR_ROWS`` rows, which its map-side aggregate holds), and the upsert is a union of calendar and event
cells followed by one aggregate - a single shuffle on the cell key.  Entity-level
attributes are joined once at entity grain, then attached to the panel.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelcast.functions.calendar import first_of_month
from panelcast.functions.text import coerce_numeric, split_list, strip
from panelcast.operators.names import canonical_name, in_domain
from panelcast.spec import PanelSpec

#: Calendar rows that one task makes.
CALENDAR_ROWS = 250_000


def filter_region(events: DataFrame, pattern: str | None, col: str = "state") -> DataFrame:
    """Case-sensitive regex containment on the region column; null never matches."""
    if pattern is None:
        return events
    return events.where(F.coalesce(F.col(col).rlike(pattern), F.lit(False)))


def add_year_month(events: DataFrame, spec: PanelSpec) -> DataFrame:
    d = F.col(spec.date_col)
    return events.withColumn("year", F.year(d)).withColumn("month", F.month(d))


def explode_places(events: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per (event, listed place); null lists give no rows."""
    keep = [c for c in events.columns if c != spec.list_col]
    return events.select(*keep, F.posexplode(split_list(spec.list_col)).alias("pos", "part"))


def event_cells(events: DataFrame, domain: DataFrame, spec: PanelSpec) -> DataFrame:
    """Exploded event x entity records restricted to the entity domain."""
    x = explode_places(add_year_month(events, spec), spec)
    x = x.withColumn(spec.entity_col, canonical_name("part", spec.alias))
    x = in_domain(x, domain, spec.entity_col)
    return x.select(spec.entity_col, "year", "month", spec.seq_col, *spec.measures)


def calendar(entities: DataFrame, spec: PanelSpec, task_rows: int = CALENDAR_ROWS) -> DataFrame:
    """Every entity x every month from ``spec.start`` to ``spec.end`` (a generator).  Few input
    partitions hold many entities, so these are dealt to tasks by their number first."""
    first, last = (dt.date.fromisoformat(str(x)[:10]) for x in (spec.start, spec.end))
    per_task = max(1, task_rows // max(1, 12 * (last.year - first.year) + last.month - first.month + 1))
    parts = -(-entities.count() // per_task)
    if parts > 1:
        entities = entities.repartition(parts, spec.entity_col)
    months = F.explode(F.sequence(F.to_date(F.lit(spec.start)), F.to_date(F.lit(spec.end)),
                                  F.expr("INTERVAL 1 MONTH")))
    return (entities.select(spec.entity_col, months.alias("date"))
            .select(spec.entity_col, F.year("date").alias("year"), F.month("date").alias("month"), "date"))


def _numeric(c: str, dtype) -> F.Column:
    col = F.col(c)
    return coerce_numeric(col) if isinstance(dtype, StringType) else col.cast("double")


def upsert(cal: DataFrame, cells: DataFrame, spec: PanelSpec) -> DataFrame:
    """Mark event cells and keep, per measure, the last non-null value in event order.

    Events outside the calendar are ignored.  The value is coerced to a number after
    the last-value choice, so a final non-numeric value yields 0.
    """
    e, m = spec.entity_col, list(spec.measures)
    lo, hi = F.to_date(F.lit(spec.start)), F.to_date(F.lit(spec.end))
    inside = cells.where(first_of_month("year", "month").between(lo, hi))
    types = {f.name: f.dataType for f in cells.schema.fields}
    ev = inside.select(e, "year", "month", F.lit(1).alias("flood_occurrence"),
                       F.col(spec.seq_col).alias("_seq"),
                       *[F.col(c) for c in m])
    base = cal.select(e, "year", "month", F.lit(0).alias("flood_occurrence"),
                      F.lit(None).cast(ev.schema["_seq"].dataType).alias("_seq"),
                      *[F.lit(None).cast(types[c]).alias(c) for c in m])
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_seq"))).alias(c) for c in m]
    g = base.unionByName(ev).groupBy(e, "year", "month").agg(
        F.max("flood_occurrence").alias("flood_occurrence"), *last)
    return g.select(e, "year", "month", F.col("flood_occurrence").cast("int").alias("flood_occurrence"),
                    *[F.coalesce(_numeric(c, types.get(c, StringType())), F.lit(0.0)).alias(c) for c in m])


def _in_calendar(spec: PanelSpec) -> F.Column:
    """Whether a record's month is one of the calendar's; false for a missing date."""
    inside = first_of_month("year", "month").between(F.to_date(F.lit(spec.start)), F.to_date(F.lit(spec.end)))
    return F.coalesce(inside, F.lit(False))


def unmatched_events(cells: DataFrame, spec: PanelSpec) -> DataFrame:
    """Event records whose (entity, year, month) has no calendar cell.  ``event_cells`` keeps the
    domain's entities only and each has every month, so this is a filter: nothing is shuffled."""
    return cells.where(~_in_calendar(spec))


def merge_reconciliation(cells: DataFrame, spec: PanelSpec) -> DataFrame:
    """matched / total / failed counts of event records against the calendar."""
    return cells.agg(F.count(F.lit(1)).alias("total"), F.count_if(_in_calendar(spec)).alias("matched"),
                     F.count_if(~_in_calendar(spec)).alias("failed"))


def dedupe_last(df: DataFrame, key: F.Column, order_col: str, cols: list[str], key_name: str) -> DataFrame:
    """Keep the last row (highest ``order_col``) per key."""
    packed = F.struct(*[F.col(c) for c in cols])
    return (df.select(key.alias(key_name), order_col, packed.alias("_row"))
            .groupBy(key_name).agg(F.max_by("_row", order_col).alias("_row"))
            .select(key_name, "_row.*"))


def census_lookup(entities: DataFrame, census: DataFrame, spec: PanelSpec,
                  name_col: str = "district_name", order_col: str = "row_seq") -> DataFrame:
    """Case-insensitive exact name match (stripped), last matching row wins."""
    cols = {"population": "census_population", "households": "households",
            "rural_households": "rural_hh", "urban_households": "urban_hh"}
    d = dedupe_last(census, F.lower(strip(name_col)), order_col, list(cols), "_key")
    d = d.select("_key", *[F.col(k).cast("double").alias(v) for k, v in cols.items()])
    return (entities.select(spec.entity_col).withColumn("_key", F.lower(spec.entity_col))
            .join(d, "_key", "left").drop("_key"))


def entity_attributes(entities: DataFrame, index_src: DataFrame, area_src: DataFrame,
                      impact_src: DataFrame, census_src: DataFrame, spec: PanelSpec) -> DataFrame:
    """Static attributes at entity grain (left joins keep every entity)."""
    e, a = spec.entity_col, spec.alias
    idx = index_src.select(canonical_name("_c0", a).alias(e), F.col("dfsi").cast("double"))
    area = area_src.select(canonical_name("dist_name", a).alias(e),
                           F.col("percent_flooded_area").cast("double"),
                           F.col("corrected_flooded_area").cast("double"))
    imp = impact_src.select(canonical_name("dist_name", a).alias(e),
                            F.col("population").cast("double"),
                            F.col("mean_flood_duration").cast("double"))
    cen = census_lookup(entities, census_src, spec)
    return (entities.select(e).join(idx, e, "left").join(area, e, "left")
            .join(imp, e, "left").join(cen, e, "left"))
