"""The feature panel: events -> entity x month panel with attributes and features.

Order matters and is kept: exposure and interaction use the population before
its median fill, and the last raw measure value is chosen before coercion.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators import features as fx
from panelcast.operators import panel as px
from panelcast.operators.names import entity_domain
from panelcast.session import materialize
from panelcast.sources import tables
from panelcast.sources.panel_table import stored_panel
from panelcast.spec import PanelSpec

PANEL_COLUMNS = [
    "entity", "year", "month", "flood_occurrence", "severity", "fatalities", "displaced", "duration",
    "entity_norm", "dfsi", "percent_flooded_area", "corrected_flooded_area", "population",
    "mean_flood_duration", "census_population", "households", "rural_hh", "urban_hh", "season",
    "month_sin", "month_cos", "flood_lag_1m", "flood_lag_3m", "flood_lag_6m", "flood_lag_12m",
    "flood_roll_3m", "flood_roll_12m", "flood_exposed_pop", "pop_x_flood_severity",
    "resource_demand_score", "date",
]


@dataclass
class PanelInputs:
    events: DataFrame
    entity_names: DataFrame  # column raw_name
    index_src: DataFrame
    area_src: DataFrame
    impact_src: DataFrame
    census_src: DataFrame


class AnalogueInputs:
    """Inputs on the test tables.  The three line-item attribute sources share one
    statistics table, materialized lazily (once per inputs object, only when an
    attribute source is used)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.events = tables.event_inventory(spark, sf_dir)
        self.entity_names = tables.entity_names(spark, sf_dir)
        self.index_src = tables.index_source(spark, sf_dir)

    def domain(self, spec: PanelSpec) -> DataFrame:
        """Distinct canonical entity names, written once per inputs object: the
        calendar, the membership test and the attribute joins all read it."""
        key = tuple(sorted(spec.alias.items())) + (spec.entity_col,)
        cache = self.__dict__.setdefault("_domains", {})
        if key not in cache:
            cache[key] = materialize(entity_domain(self.entity_names, "raw_name", spec.alias, spec.entity_col),
                                     "domain")
        return cache[key]

    @cached_property
    def _stats(self) -> DataFrame:
        return materialize(tables.line_stats(self.spark, self.sf_dir), "line-stats")

    @cached_property
    def area_src(self) -> DataFrame:
        return tables.area_source(self.spark, self.sf_dir, self._stats)

    @cached_property
    def impact_src(self) -> DataFrame:
        return tables.impact_source(self.spark, self.sf_dir, self._stats)

    @cached_property
    def census_src(self) -> DataFrame:
        return tables.census_source(self.spark, self.sf_dir, self._stats)


def analogue_spec() -> PanelSpec:
    return PanelSpec(alias=dict(tables.ANALOGUE_ALIAS))


def analogue_inputs(spark: SparkSession, sf_dir: str) -> AnalogueInputs:
    return AnalogueInputs(spark, sf_dir)


def domain_of(inp, spec: PanelSpec) -> DataFrame:
    if hasattr(inp, "domain"):
        return inp.domain(spec)
    return entity_domain(inp.entity_names, "raw_name", spec.alias, spec.entity_col)


def upserted_panel(inp: PanelInputs, spec: PanelSpec) -> DataFrame:
    domain = domain_of(inp, spec)
    ev = px.filter_region(inp.events, spec.region_pattern, spec.region_col)
    cells = px.event_cells(ev, domain, spec)
    return px.upsert(px.calendar(domain, spec), cells, spec)


def raw_feature_panel(inp: PanelInputs, spec: PanelSpec, leak_free: bool = False) -> DataFrame:
    """Panel with attributes and features, before imputation."""
    domain = domain_of(inp, spec)
    attrs = px.entity_attributes(domain, inp.index_src, inp.area_src, inp.impact_src,
                                 inp.census_src, spec)
    p = upserted_panel(inp, spec).join(attrs, spec.entity_col, "left")
    p = fx.add_calendar_features(p.withColumn("entity_norm", F.col(spec.entity_col)))
    p = fx.add_rolling(fx.add_lags(p, spec), spec, leak_free=leak_free)
    p = fx.add_exposure(p, spec, leak_free=leak_free)
    return p.withColumn("resource_demand_score", fx.demand_score())


def feature_panel(inp: PanelInputs, spec: PanelSpec, leak_free: bool = False,
                  checkpoint: bool = True) -> DataFrame:
    """The complete panel (31 columns)."""
    p = raw_feature_panel(inp, spec, leak_free)
    if checkpoint:  # the median passes and the final plan reuse it; cut the lineage once
        p = materialize(p, "raw-panel")
    p = fx.impute_medians(p, accuracy=spec.median_accuracy)
    p = fx.fill_zero(p)
    p = fx.add_date(p)
    return p.select(*PANEL_COLUMNS)


def analogue_panel(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """The panel of the test tables, read from its laid-out table while the tables' files stay the same."""
    spec = analogue_spec()
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables.PANEL_TABLES]
    return stored_panel(spark, paths, repr((spec, sorted(kw.items()))),
                        lambda: feature_panel(analogue_inputs(spark, sf_dir), spec, **kw)).select(*PANEL_COLUMNS)
