"""Registered queries: every operator of the inventory run on the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Doubles are
rounded to 6 decimals at the end so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from panelcast.functions import calendar as cal
from panelcast.functions import text as tx
from panelcast.session import materialize
from panelcast.operators import features as fx
from panelcast.operators import metrics as mx
from panelcast.operators import names as nm
from panelcast.operators import panel as px
from panelcast.operators import planning as pl
from panelcast.operators import quality as qx
from panelcast.operators import splits as sx
from panelcast.plans import panel as pp
from panelcast.plans import targets as tg
from panelcast.sources import tables as tb

# Parameters of the registered queries.
REGION_PATTERN = "AMERICA|MIDDLE"
TODAY = "2024-07-15"
HORIZON_DAYS = 14
TRACE_YEAR = 1998
TRACE_NEEDLE = "supplier_7"
N_SPLITS = 5

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    cols = [F.round(F.col(f"`{f.name}`"), 6).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(*cols)


def _setup(spark, d):
    spec = pp.analogue_spec()
    return spec, pp.analogue_inputs(spark, d)


# ---- explode, names, filters -------------------------------------------------

@register("event_explode")
def q_event_explode(spark, d):
    spec, inp = _setup(spark, d)
    ev = px.add_year_month(inp.events, spec).dropna(subset=["year", "month", spec.list_col])
    x = px.explode_places(ev, spec).withColumn("entity", nm.canonical_name("part", spec.alias))
    x = nm.in_domain(x, pp.domain_of(inp, spec))
    return r6(x.select("event_id", "pos", "part", "entity", "year", "month", "event_seq",
                       "severity", "fatalities", "displaced", "duration"))


def _raw_parts(inp, spec):
    return inp.events.select("event_id", F.explode(F.split(spec.list_col, ",")).alias("raw_part"))


@register("name_normalize")
def q_name_normalize(spark, d):
    spec, inp = _setup(spark, d)
    return (_raw_parts(inp, spec).select("raw_part", tx.title_case(tx.strip("raw_part")).alias("normalized"))
            .distinct())


@register("alias_lookup")
def q_alias_lookup(spark, d):
    spec, inp = _setup(spark, d)
    t = _raw_parts(inp, spec).select(tx.title_case(tx.strip("raw_part")).alias("normalized")).distinct()
    return t.select("normalized", nm.canonical_name("normalized", spec.alias).alias("canonical"))


@register("domain_semi")
def q_domain_semi(spark, d):
    spec, inp = _setup(spark, d)
    x = px.explode_places(inp.events, spec).withColumn("entity", nm.canonical_name("part", spec.alias))
    return nm.in_domain(x, pp.domain_of(inp, spec)).select("event_id", "pos", "entity")


@register("region_filter")
def q_region_filter(spark, d):
    spec, inp = _setup(spark, d)
    return (px.filter_region(inp.events, REGION_PATTERN, "state")
            .select("event_id", "state", F.col("districts").alias("places"), "start_date"))


def _date_texts(inp):
    dt = F.col("start_date")
    k = F.col("event_id") % 5
    text = (F.when(k == 0, F.date_format(dt, "d-M-yyyy"))
            .when(k == 1, F.date_format(dt, "yyyy-MM-dd"))
            .when(k == 2, F.concat(F.lit("31-31-"), F.year(dt).cast("string")))
            .otherwise(F.date_format(dt, "d/M/yyyy")))
    return inp.events.select("event_id", text.alias("date_text"))


@register("date_parse")
def q_date_parse(spark, d):
    spec, inp = _setup(spark, d)
    p = _date_texts(inp).withColumn("parsed_date", tx.parse_day_first("date_text"))
    return p.select("event_id", "date_text", "parsed_date", F.year("parsed_date").alias("year"),
                    F.month("parsed_date").alias("month"))


@register("numeric_coerce")
def q_numeric_coerce(spark, d):
    o = tb.read(spark, d, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_orderkey") % 4
    c = F.col("o_custkey").cast("string")
    text = (F.when(k == 0, F.concat(F.lit(" "), c, F.lit(" ")))
            .when(k == 1, F.concat(c, F.lit("d")))
            .when(k == 2, F.concat(F.lit("1,"), (F.col("o_custkey") % 1000).cast("string")))
            .otherwise(F.concat((F.col("o_custkey") % 10).cast("string"), F.lit("e2"))))
    return r6(o.select("o_orderkey", text.alias("raw_text"))
              .withColumn("value", F.coalesce(tx.coerce_numeric("raw_text"), F.lit(0.0))))


@register("season_two_way")
def q_season_two_way(spark, d):
    spec, inp = _setup(spark, d)
    e = px.add_year_month(inp.events, spec)
    return e.select("event_id", "month", cal.season_two_way("month").alias("season"))


@register("season_four_way")
def q_season_four_way(spark, d):
    spec, inp = _setup(spark, d)
    c = px.calendar(pp.domain_of(inp, spec), spec)
    return c.select("entity", "year", "month", cal.season_four_way("month").alias("season"))


# ---- calendar, upsert, joins ---------------------------------------------------

@register("calendar_densify")
def q_calendar_densify(spark, d):
    spec, inp = _setup(spark, d)
    c = px.calendar(pp.domain_of(inp, spec), spec)
    return r6(c.select("entity", "year", "month", cal.first_of_month("year", "month").alias("date"),
                       F.lit(0).alias("flood_occurrence"),
                       *[F.lit(0.0).alias(m) for m in spec.measures]))


@register("panel_upsert")
def q_panel_upsert(spark, d):
    spec, inp = _setup(spark, d)
    return r6(pp.upserted_panel(inp, spec))


@register("panel_left_dims")
def q_panel_left_dims(spark, d):
    spec, inp = _setup(spark, d)
    dom = pp.domain_of(inp, spec)
    attrs = px.entity_attributes(dom, inp.index_src, inp.area_src, inp.impact_src, inp.census_src, spec)
    attrs = attrs.select("entity", "dfsi", "percent_flooded_area", "corrected_flooded_area",
                         "population", "mean_flood_duration")
    return r6(pp.upserted_panel(inp, spec).join(attrs, "entity", "left"))


@register("census_lookup")
def q_census_lookup(spark, d):
    spec, inp = _setup(spark, d)
    return r6(px.census_lookup(pp.domain_of(inp, spec), inp.census_src, spec))


def _cells(inp, spec):
    return px.event_cells(inp.events, pp.domain_of(inp, spec), spec)


@register("unmatched_anti")
def q_unmatched_anti(spark, d):
    spec, inp = _setup(spark, d)
    return px.unmatched_events(_cells(inp, spec), spec).select("entity", "year", "month", "event_seq")


@register("merge_reconciliation")
def q_merge_reconciliation(spark, d):
    """How many event records found their calendar cell."""
    spec, inp = _setup(spark, d)
    return px.merge_reconciliation(_cells(inp, spec), spec)


@register("theta_name_match")
def q_theta_name_match(spark, d):
    spec, inp = _setup(spark, d)
    parts = px.explode_places(inp.events, spec)
    return nm.theta_match_counts(parts, "part", pp.domain_of(inp, spec))


@register("alternate_lookup")
def q_alternate_lookup(spark, d):
    spec, inp = _setup(spark, d)
    return nm.alternate_lookup(pp.domain_of(inp, spec), "entity", spec.alias, inp.impact_src, "dist_name")


# ---- features ---------------------------------------------------------------------

@register("median_impute")
def q_median_impute(spark, d):
    return r6(pp.analogue_panel(spark, d))


def _upserted_sorted(spark, d):
    spec, inp = _setup(spark, d)
    return spec, pp.upserted_panel(inp, spec)


@register("lag_features")
def q_lag_features(spark, d):
    spec, up = _upserted_sorted(spark, d)
    p = fx.add_lags(up, spec, fill_zero=True)
    return r6(p.select("entity", "year", "month", "flood_occurrence",
                       *[f"flood_lag_{n}m" for n in spec.lags]).orderBy("entity", "year", "month"))


@register("rolling_features")
def q_rolling_features(spark, d):
    spec, up = _upserted_sorted(spark, d)
    p = fx.add_rolling(up, spec)
    return r6(p.select("entity", "year", "month", *[f"flood_roll_{n}m" for n in spec.rolls]))


@register("cyclic_month")
def q_cyclic_month(spark, d):
    spec, inp = _setup(spark, d)
    c = px.calendar(pp.domain_of(inp, spec), spec)
    return r6(c.select("entity", "year", "month", cal.month_sin("month").alias("month_sin"),
                       cal.month_cos("month").alias("month_cos")))


@register("exposure_interaction")
def q_exposure_interaction(spark, d):
    spec, inp = _setup(spark, d)
    p = pp.raw_feature_panel(inp, spec)
    return r6(p.select("entity", "year", "month", "flood_exposed_pop", "pop_x_flood_severity"))


@register("demand_score")
def q_demand_score(spark, d):
    spec, up = _upserted_sorted(spark, d)
    return r6(up.select("entity", "year", "month", fx.demand_score().alias("resource_demand_score")))


@register("demand_norms_final")
def q_demand_norms_final(spark, d):
    t = tg.targets_final(pp.analogue_panel(spark, d))
    return r6(t.select("entity", "year", "month", *tg.FINAL_COLUMNS))


@register("demand_norms_v2")
def q_demand_norms_v2(spark, d):
    t = tg.targets_v2(pp.analogue_panel(spark, d))
    return r6(t.select("entity", "year", "month", *tg.V2_COLUMNS))


@register("label_binary")
def q_label_binary(spark, d):
    p = pp.analogue_panel(spark, d)
    t = tg.targets_v2(tg.targets_final(p))
    return t.select("entity", "year", "month", "flood_event", "flood_event_v2")


@register("positive_rows_summary")
def q_positive_rows_summary(spark, d):
    t = tg.targets_final(pp.analogue_panel(spark, d))
    return r6(t.agg(F.count(F.lit(1)).alias("n_rows"), F.avg("flood_event").alias("event_rate"),
                    F.count_if(F.col("demand_target") > 0).alias("n_positive_demand"),
                    F.avg(F.when(F.col("demand_target") > 0, F.col("demand_target"))).alias("mean_positive_demand"),
                    F.avg(F.when(F.col("flood_event") == 1, F.col("affected_capped").cast("double"))).alias("saturation_rate")))


@register("label_encode")
def q_label_encode(spark, d):
    spec, inp = _setup(spark, d)
    c = px.calendar(pp.domain_of(inp, spec), spec)
    return fx.label_encode(c, "entity", "entity_index").select("entity", "year", "month", "entity_index")


@register("one_hot_season")
def q_one_hot_season(spark, d):
    spec, inp = _setup(spark, d)
    c = px.calendar(pp.domain_of(inp, spec), spec).withColumn("season", cal.season_four_way("month"))
    return fx.one_hot_season(c).drop("date")


# ---- planning -------------------------------------------------------------------------

@register("month_profile")
def q_month_profile(spark, d):
    p = pl.month_profile(pp.analogue_panel(spark, d))
    return r6(p.select("entity", "month", "month_prob", "month_sev", "max_month_sev", "mean_score"))


@register("horizon_generate")
def q_horizon_generate(spark, d):
    return pl.horizon(pp.analogue_panel(spark, d))


def _forecast(spark, d):
    p = pp.analogue_panel(spark, d)
    return p, pl.seasonal_forecast(p)


@register("seasonal_forecast")
def q_seasonal_forecast(spark, d):
    _, f = _forecast(spark, d)
    return r6(f.select("entity", "step", "date", "month", "flood_probability", "expected_demand"))


@register("probability_band")
def q_probability_band(spark, d):
    _, f = _forecast(spark, d)
    return r6(f.select("entity", "step", "flood_probability", "prob_lower", "prob_upper"))


@register("demand_band")
def q_demand_band(spark, d):
    _, f = _forecast(spark, d)
    return r6(f.select("entity", "step", "expected_demand", "demand_lower", "demand_upper"))


def _allocation(spark, d):
    p, f = _forecast(spark, d)
    return pl.allocation_long(f, pl.first_population(p))


@register("allocation_long")
def q_allocation_long(spark, d):
    return r6(_allocation(spark, d))


@register("allocation_wide")
def q_allocation_wide(spark, d):
    return pl.allocation_wide(_allocation(spark, d))


@register("quantity_display")
def q_quantity_display(spark, d):
    a = _allocation(spark, d)
    disp, prog = pl.quantity_display(F.col("amount"))
    return r6(a.select("entity", "resource", "amount", disp.alias("display"), prog.alias("progress")))


@register("risk_tier")
def q_risk_tier(spark, d):
    _, f = _forecast(spark, d)
    return r6(pl.forecast_risk(f))


@register("kpi_row")
def q_kpi_row(spark, d):
    p, f = _forecast(spark, d)
    return r6(pl.kpi_row(f, p, TODAY, HORIZON_DAYS).select(
        "entity", "risk_3m", "risk_flag", "avg_demand", "events_5yr", "current_season"))


@register("entity_compare")
def q_entity_compare(spark, d):
    return r6(pl.entity_compare(pp.analogue_panel(spark, d)))


@register("trailing_five_year")
def q_trailing_five_year(spark, d):
    return pl.trailing_events(pp.analogue_panel(spark, d))


@register("history_forecast_union")
def q_history_forecast_union(spark, d):
    p, f = _forecast(spark, d)
    hist = p.select("entity", "date", "resource_demand_score", F.lit("Historical").alias("kind"))
    fc = f.select("entity", "date", F.col("expected_demand").alias("resource_demand_score"),
                  F.lit("Forecast").alias("kind"))
    return r6(hist.unionByName(fc))


@register("top_risk_entities")
def q_top_risk_entities(spark, d):
    _, f = _forecast(spark, d)
    return r6(pl.top_risk(f, 3))


@register("escalation_flags")
def q_escalation_flags(spark, d):
    _, f = _forecast(spark, d)
    return r6(pl.escalation(f, TODAY))


@register("trust_flag")
def q_trust_flag(spark, d):
    p, f = _forecast(spark, d)
    return r6(pl.trust_flag(f, p, TODAY).select("entity", "n_events", "band_width", "flood_probability", "trusted"))


@register("kit_budget")
def q_kit_budget(spark, d):
    p, f = _forecast(spark, d)
    return r6(pl.kit_budget(f, pl.first_population(p)))


# ---- splits and metrics ------------------------------------------------------------------

def _panel_folds(spark, d):
    t = tg.targets_final(pp.analogue_panel(spark, d))
    idx = sx.global_row_index(t, ["date", "entity"])
    n = idx.count()
    return sx.expanding_folds(idx, n, N_SPLITS)


@register("ts_split_folds")
def q_ts_split_folds(spark, d):
    return _panel_folds(spark, d).select("entity", "year", "month", "row_idx", "val_fold")


@register("holdout_split")
def q_holdout_split(spark, d):
    t = tg.targets_final(pp.analogue_panel(spark, d)).where(F.col("demand_target") > 0)
    h = sx.holdout_split(t, "entity", "date")
    return h.select("entity", "date", "rn", "n", "n_train", "is_train")


@register("fold_skip")
def q_fold_skip(spark, d):
    c = sx.fold_label_counts(_panel_folds(spark, d), "flood_event", N_SPLITS)
    return c.withColumn("skipped", F.col("pos_val") == 0)


@register("class_weights")
def q_class_weights(spark, d):
    return r6(mx.class_weights(sx.fold_label_counts(_panel_folds(spark, d), "flood_event", N_SPLITS)))


def _scored_orders(spark, d, all_rows=False):
    """Deterministic scores and predictions on every order, in date-ordered folds; ``all_rows``
    keeps the rows before the first fold, which only train."""
    o = tb.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    label = (F.col("o_orderstatus") == "F").cast("int")
    score = ((F.col("o_orderkey") % 97) + F.when(F.col("o_orderstatus") == "F", 35).otherwise(0)) / 132.0
    y = F.col("o_totalprice") / 1000.0
    pred = y * (1 + ((F.col("o_custkey") % 41) - 20) / 100.0)
    s = o.select("o_orderkey", F.to_date("o_orderdate").alias("odate"), label.alias("label"),
                 score.alias("score"), y.alias("y_true"), pred.alias("y_pred"))
    idx = sx.global_row_index(s, ["odate", "o_orderkey"])
    n = idx.count()
    folds = sx.expanding_folds(idx, n, N_SPLITS).withColumnRenamed("val_fold", "fold")
    return folds if all_rows else folds.where(F.col("fold").isNotNull())


@register("metric_regression")
def q_metric_regression(spark, d):
    return r6(mx.regression_metrics(_scored_orders(spark, d), "fold", "y_true", "y_pred"))


@register("metric_roc_auc")
def q_metric_roc_auc(spark, d):
    return r6(mx.roc_auc(_scored_orders(spark, d), "fold", "score", "label"))


@register("metric_pr_auc")
def q_metric_pr_auc(spark, d):
    return r6(mx.pr_auc(_scored_orders(spark, d), "fold", "score", "label"))


@register("metric_classification")
def q_metric_classification(spark, d):
    s = _scored_orders(spark, d).withColumn("pred", (F.col("score") > 0.5).cast("int"))
    return r6(mx.confusion_metrics(s, "fold", "pred", "label"))


@register("fold_summary")
def q_fold_summary(spark, d):
    s = materialize(_scored_orders(spark, d), "scored")
    cls = mx.roc_auc(s, "fold", "score", "label").join(mx.pr_auc(s, "fold", "score", "label"), "fold")
    reg = mx.regression_metrics(s, "fold", "y_true", "y_pred")
    return r6(mx.fold_summary(cls, reg))


@register("report_dataset")
def q_report_dataset(spark, d):
    """The report's dataset section, from the panel with targets."""
    return r6(mx.dataset_section(tg.targets_final(pp.analogue_panel(spark, d))))


@register("report_folds")
def q_report_folds(spark, d):
    """The report's classifier folds: F1 and class counts next to the curves' areas."""
    s = _scored_orders(spark, d, all_rows=True)
    return r6(mx.classifier_folds(s))


# ---- quality reports ----------------------------------------------------------------------

@register("source_counts")
def q_source_counts(spark, d):
    spec, inp = _setup(spark, d)
    ev = inp.events.agg(F.count(F.lit(1)).alias("n_events"),
                        F.count_if(F.col("districts").isNotNull()).alias("n_events_with_list"),
                        F.countDistinct("state").alias("n_states"),
                        F.min("start_date").alias("min_date"), F.max("start_date").alias("max_date"))
    n_entities = pp.domain_of(inp, spec).count()  # one scalar
    return ev.withColumn("n_entities", F.lit(n_entities).cast("bigint"))


@register("year_distribution")
def q_year_distribution(spark, d):
    spec, inp = _setup(spark, d)
    return qx.year_distribution(inp.events, "start_date", int(spec.start[:4]), "districts")


@register("coverage_counts")
def q_coverage_counts(spark, d):
    spec, inp = _setup(spark, d)
    cands = pp.domain_of(inp, spec).select(F.col("entity").alias("candidate")).unionByName(
        spark.createDataFrame([(a,) for a in spec.alias], "candidate string"))
    return nm.text_hit_counts(inp.events, "districts", "event_id", cands, "candidate")


@register("event_months_by_entity")
def q_event_months_by_entity(spark, d):
    spec, up = _upserted_sorted(spark, d)
    return qx.event_months(up)


@register("name_variants")
def q_name_variants(spark, d):
    spec, inp = _setup(spark, d)
    return qx.name_variants(px.explode_places(inp.events, spec), "part", spec.alias)


@register("event_trace")
def q_event_trace(spark, d):
    spec, inp = _setup(spark, d)
    return qx.event_trace(inp.events, pp.domain_of(inp, spec), TRACE_YEAR, TRACE_NEEDLE, spec.alias)
