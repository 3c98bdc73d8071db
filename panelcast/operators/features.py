"""Panel features: lags, rolling means, cyclic month, exposure, score, imputation,
label encoding and one-hot seasons.

All window features share one window specification (partition by entity, order by
year and month), so Spark evaluates them in a single Window operator after one
shuffle by entity.  A single entity's series is as long as the calendar, so the
window partitions stay small no matter how many events feed the panel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import first_of_month, month_cos, month_sin, season_four_way
from panelcast.functions.stats import exact_medians
from panelcast.spec import SCORE_SCALES, SCORE_WEIGHTS, SEASON_CATEGORIES, PanelSpec

FILL_MEDIAN_COLS = ("dfsi", "percent_flooded_area", "corrected_flooded_area", "population",
                    "mean_flood_duration", "census_population", "households",
                    "flood_exposed_pop", "pop_x_flood_severity")


def _w(spec: PanelSpec):
    return Window.partitionBy(spec.entity_col).orderBy("year", "month")


def add_lags(panel: DataFrame, spec: PanelSpec, col: str = "flood_occurrence",
             fill_zero: bool = False) -> DataFrame:
    """``lag(col, n)`` per entity; the calendar is dense so a row offset is a month offset."""
    cols = {}
    for n in spec.lags:
        v = F.lag(col, n).over(_w(spec)).cast("double")
        cols[f"flood_lag_{n}m"] = F.coalesce(v, F.lit(0.0)) if fill_zero else v
    return panel.withColumns(cols)


def add_rolling(panel: DataFrame, spec: PanelSpec, col: str = "flood_occurrence",
                leak_free: bool = False) -> DataFrame:
    """Trailing mean over n rows with at least one row.  By default the current row is
    included (published behaviour); ``leak_free`` uses the n previous rows only."""
    cols = {}
    for n in spec.rolls:
        frame = _w(spec).rowsBetween(-n, -1) if leak_free else _w(spec).rowsBetween(-(n - 1), 0)
        cols[f"flood_roll_{n}m"] = F.avg(F.col(col).cast("double")).over(frame)
    return panel.withColumns(cols)


def add_calendar_features(panel: DataFrame) -> DataFrame:
    return panel.withColumns({"season": season_four_way("month"), "month_sin": month_sin("month"),
                              "month_cos": month_cos("month")})


def add_exposure(panel: DataFrame, spec: PanelSpec | None = None, leak_free: bool = False) -> DataFrame:
    """Exposed population and population x severity (before any imputation).  With
    ``leak_free`` the interaction uses the previous month's severity."""
    sev = F.col("severity")
    if leak_free:
        sev = F.coalesce(F.lag("severity", 1).over(_w(spec or PanelSpec())), F.lit(0.0))
    return panel.withColumns({
        "flood_exposed_pop": F.col("census_population") * (F.coalesce("corrected_flooded_area", F.lit(0.0)) / 100.0),
        "pop_x_flood_severity": F.col("census_population") * sev / 100000.0})


def demand_score(occ="flood_occurrence", sev="severity", disp="displaced", fat="fatalities") -> F.Column:
    """Weighted score clipped below at 0 (a null score stays null)."""
    z = F.lit(0.0)
    s = (F.col(occ) * SCORE_WEIGHTS["occurrence"]
         + (F.coalesce(F.col(sev), z) / SCORE_SCALES["severity"]) * SCORE_WEIGHTS["severity"]
         + (F.coalesce(F.col(disp), z) / SCORE_SCALES["displaced"]) * SCORE_WEIGHTS["displaced"]
         + (F.coalesce(F.col(fat), z) / SCORE_SCALES["fatalities"]) * SCORE_WEIGHTS["fatalities"])
    return F.when(s.isNotNull(), F.greatest(s, z))


def impute_medians(panel: DataFrame, cols: Sequence[str] = FILL_MEDIAN_COLS,
                   accuracy: int = 100000) -> DataFrame:
    """Fill each column's nulls with its exact global median (computed distributed)."""
    present = [c for c in cols if c in panel.columns]
    med = exact_medians(panel, present, accuracy)
    fills = {c: v for c, v in med.items() if v is not None}
    return panel.fillna(fills) if fills else panel


def fill_zero(panel: DataFrame) -> DataFrame:
    num = [f.name for f in panel.schema.fields
           if f.dataType.typeName() in ("double", "float", "integer", "long", "short")]
    return panel.fillna(0, subset=num)


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """Dense index of the sorted distinct labels (0-based).  The distinct labels are
    range-sorted and numbered with per-partition offsets (no single-partition window),
    then joined back by label."""
    from panelcast.operators.splits import global_row_index
    labels = df.select(col).where(F.col(col).isNotNull()).distinct()
    idx = global_row_index(labels, [col], out).withColumn(out, F.col(out).cast("int"))
    return df.join(idx, col, "left")


def one_hot_season(df: DataFrame, col: str = "season", prefix: str = "season",
                   categories: Sequence[str] = SEASON_CATEGORIES) -> DataFrame:
    return df.withColumns({f"{prefix}_{c}": (F.col(col) == c).cast("int") for c in categories})


def add_date(panel: DataFrame) -> DataFrame:
    return panel.withColumn("date", first_of_month("year", "month"))
