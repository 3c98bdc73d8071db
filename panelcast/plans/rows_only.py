"""Registered queries for sources, sinks, reports and models.

Sinks write under the shared checkpoint folder and read the result back.  Model
fits are checked on rows and invariants (Spark ML grows its trees by level, so equal
scores are not promised).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from panelcast.functions.stats import describe
from panelcast.operators import metrics as mx
from panelcast.operators import models as ml
from panelcast.operators import seasonal as sn
from panelcast.operators import splits as sx
from panelcast.plans import panel as pp
from panelcast.plans import targets as tg
from panelcast.plans.catalog import N_SPLITS, r6, register
from panelcast.session import materialize, scratch_path
from panelcast.sources import files as fs
from panelcast.sources import json_values as jv
from panelcast.sources import profile as pf
from panelcast.sources import tables as tb
from panelcast.spec import NULL_SENTINELS



@register("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    """Write the event inventory as headed CSV (blank key header, textual null
    markers), read it back as text and re-type it."""
    ev = tb.event_inventory(spark, d)
    marker = F.element_at(F.array(*[F.lit(s) for s in NULL_SENTINELS]), (F.col("event_id") % len(NULL_SENTINELS) + 1).cast("int"))
    out = ev.select(F.col("event_id").alias(""), "date_text", "state", "districts",
                    F.coalesce(F.col("severity").cast("string"), marker).alias("severity"))
    path = scratch_path(spark, "csv")
    fs.write_headed_csv(out, path)
    back = fs.read_headed_csv(spark, path, key_name="event_id", sentinel_cols=["severity", "districts", "state"])
    from panelcast.functions.text import coerce_numeric, parse_day_first
    return r6(back.select(F.col("event_id").cast("bigint").alias("event_id"),
                          parse_day_first("date_text").alias("start_date"), "state", "districts",
                          coerce_numeric("severity").alias("severity")))


@register("csv_typed")
def q_csv_typed(spark, d):
    """Event lines with every null marker, unreadable numbers (every 23rd key) and surplus fields
    (every 29th), read with a declared schema: rows that are good and rejects by reason."""
    ev = tb.event_inventory(spark, d)
    marker = F.element_at(F.array(*[F.lit(s) for s in NULL_SENTINELS]), (F.col("event_id") % len(NULL_SENTINELS) + 1).cast("int"))
    number = F.when(F.col("event_id") % 23 == 0, F.lit("about 3")).otherwise(F.coalesce(F.col("severity").cast("string"), marker))
    quoted = lambda c: F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"'))
    line = F.concat_ws(",", F.col("event_id").cast("string"), quoted("date_text"), quoted("state"), number,
                       F.when((F.col("event_id") % 29 == 0) & (F.col("event_id") % 23 != 0), F.lit("surplus")))
    path = scratch_path(spark, "lines")
    ev.select(line.alias("value")).write.mode("overwrite").text(path)
    good, rejects = fs.read_typed_csv(spark, path, {"event_id": "long", "start_date": "date", "state": "string", "severity": "double"}, header=False)
    kept = good.select(F.lit("good").alias("status"), "severity", F.col("severity").isNull().alias("missing"), F.lit(False).alias("odd"))
    lost = rejects.select(F.col("reason").alias("status"), F.lit(None).cast("double").alias("severity"), F.lit(False).alias("missing"),
                          (F.col("reason") != "malformed").__and__(F.col("value") != "about 3").alias("odd"))
    return r6(kept.unionByName(lost).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("missing")).alias("n_missing"),
                                                           F.sum("severity").alias("sum_severity"), F.count_if(F.col("odd")).alias("n_odd")))


@register("default_columns")
def q_default_columns(spark, d):
    spec, inp = pp.analogue_spec(), pp.analogue_inputs(spark, d)
    up = pp.upserted_panel(inp, spec).drop("duration")
    out = fs.ensure_columns(up, {"duration": 0.0, "severity": 0.0, "area_affected": (None, "double")})
    return r6(out.select("entity", "year", "month", "severity", "duration", "area_affected"))


@register("panel_sink")
def q_panel_sink(spark, d):
    path = scratch_path(spark, "panel")
    fs.write_panel(pp.analogue_panel(spark, d), path)
    from panelcast.plans.catalog import r6
    return r6(fs.read_panel(spark, path))


@register("jsonl_scan")
def q_jsonl_scan(spark, d):
    """Event properties as JSON lines (error events written truncated, i.e. malformed);
    read back dropping malformed lines, with the key list of each object."""
    e = tb.read(spark, d, "events")
    line = F.when(F.col("event_type") == "error", F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    rec = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "properties": '), line, F.lit("}"))
    path = scratch_path(spark, "jsonl")
    e.select(rec.alias("value")).write.mode("overwrite").text(path)
    back = fs.read_json_lines(spark, path, "event_id long, properties struct<k:long>")
    keys = F.array_join(F.array_sort(F.json_object_keys(F.to_json("properties"))), ",")
    return back.select("event_id", "properties.k", keys.alias("property_keys"))


@register("json_paths")
def q_json_paths(spark, d):
    """Event records with nested properties and a geometry, some truncated, read without a
    schema: every key at any depth with its kinds, and the number of lines that are no JSON."""
    docs, bad = _event_documents(spark, d)
    return jv.list_paths(docs).unionByName(bad.agg(F.lit("").alias("path"), F.lit("malformed").alias("kind"), F.count(F.lit(1)).alias("n")))


@register("json_fields")
def q_json_fields(spark, d):
    """Fields of the same documents by their paths; an absent path gives null."""
    docs, _ = _event_documents(spark, d)
    return r6(docs.select(jv.field("$.event_id", "long").alias("event_id"), jv.field("$.properties.detail.k", "long").alias("k"),
                          jv.field("$.properties.tags[1]", "string").alias("second_tag"), jv.field("$.geometry.type", "string").alias("shape"),
                          jv.field("$.geometry.coordinates[0]", "double").alias("lon"), jv.field("$.properties.none", "string").alias("absent")))


def _event_documents(spark, d):
    e = tb.read(spark, d, "events")
    tags = F.when(F.col("event_id") % 3 == 0, F.lit("[]")).otherwise(F.concat(F.lit('["a", "'), F.col("event_type"), F.lit('"]')))
    geometry = F.when(F.col("event_id") % 5 == 0, F.lit("null")).otherwise(F.concat(
        F.lit('{"type": "Point", "coordinates": ['), (F.col("event_id") % 360).cast("string"), F.lit(", "), (F.col("event_id") % 90).cast("string"), F.lit(".5]}")))
    rec = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "properties": {"detail": '), F.col("props"),
                   F.lit(', "tags": '), tags, F.lit('}, "geometry": '), geometry, F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit("}")))
    path = scratch_path(spark, "documents")
    e.select(rec.alias("value")).write.mode("overwrite").text(path)
    return jv.read_json_values(spark, path)


@register("file_order_last")
def q_file_order_last(spark, d):
    """Events written to several CSV files in key order; the last line of each state wins."""
    ev = tb.event_inventory(spark, d).select("state", "event_id", "date_text")
    path = scratch_path(spark, "ordered")
    ev.repartitionByRange(5, "event_id").sortWithinPartitions("event_id").write.mode("overwrite").csv(path)
    back = fs.with_file_order(spark.read.schema("state string, event_id long, date_text string").csv(path))
    return fs.last_by_file_order(back, ["state"])


def _profiles(spark, d):
    """Sketches of the event inventory by batch (a year is one), stored, then merged."""
    ev = tb.event_inventory(spark, d).select("event_id", "start_date", "state", "districts", "severity", "fatalities")
    years = [r[0] for r in ev.select(F.year("start_date").alias("y")).distinct().orderBy("y").collect()]
    batches = [pf.sketch(ev.where(F.year("start_date") == y)) for y in years]
    return pf.read_profile(pf.merge(materialize(reduce(lambda a, b: a.unionByName(b), batches), "profiles")))


@register("source_profile")
def q_source_profile(spark, d):
    return _profiles(spark, d)


@register("source_profile_exact")
def q_source_profile_exact(spark, d):
    """The exact part of the merged profile."""
    return _profiles(spark, d).select("column", "n_rows", "n_nulls", F.when(F.col("kind") == "bigint", F.col("least").cast("double").cast("bigint").cast("string"))
                                      .otherwise(F.col("least")).alias("least")).where(F.col("column") != "severity")


def _features(spark, d):
    """Feature frame with its time-ordered row index (written once), row count, feature names."""
    t = tg.targets_final(pp.analogue_panel(spark, d))
    feats, cols = ml.feature_frame(t)
    idx = materialize(sx.global_row_index(feats, ["date", "entity"]), "features")
    return idx, idx.count(), cols


@register("report_write")
def q_report_write(spark, d):
    """Nested report (classifier folds with F1 and class counts, regressor folds, seasonal summary,
    dataset section) written as JSON and read back."""
    s = materialize(_scored_orders_frame(spark, d), "report-scores")
    valid = s.where(F.col("fold").isNotNull())
    cls = materialize(mx.classifier_folds(s), "report-folds")
    reg = mx.regression_metrics(valid, "fold", "y_true", "y_pred")
    summ = mx.fold_summary(cls, reg).first()
    folds = cls.join(reg, "fold", "full")  # at most one row per fold
    cls_s = F.when(F.col("roc_auc").isNotNull(), F.struct("fold", "roc_auc", "pr_auc", "f1", "n_pos_train", "n_pos_val"))
    reg_s = F.when(F.col("mae").isNotNull(), F.struct("fold", "mae", "rmse", "mape", "n_val"))
    dataset = mx.dataset_section(tg.targets_final(pp.analogue_panel(spark, d))).first()
    rep = (folds.agg(F.sort_array(F.collect_list(cls_s)).alias("c"), F.sort_array(F.collect_list(reg_s)).alias("r"))
           .select(F.struct(F.lit(summ["avg_roc_auc"]).alias("avg_roc_auc"), F.lit(summ["avg_pr_auc"]).alias("avg_pr_auc"),
                            F.lit(summ["n_valid_folds"]).alias("n_valid_folds"), F.col("c").alias("fold_scores")).alias("classifier"),
                   F.struct(F.lit(summ["avg_mae"]).alias("avg_mae"), F.lit(summ["median_mae"]).alias("median_mae"),
                            F.lit(summ["avg_mape"]).cast(DoubleType()).alias("avg_mape"),
                            F.lit(summ["n_folds_used"]).alias("n_folds_used"), F.col("r").alias("fold_scores")).alias("regressor"),
                   F.struct(*[F.lit(dataset[c]).alias(c) for c in dataset.__fields__]).alias("dataset")))
    path = scratch_path(spark, "report")
    seas = _seasonal_section(spark, d, f"{path}-per-entity").first()["seasonal"]
    rep = rep.withColumn("seasonal", F.struct(F.lit(seas["avg_mae"]).cast(DoubleType()).alias("avg_mae"),
                                              F.lit(seas["avg_mape"]).cast(DoubleType()).alias("avg_mape"),
                                              F.lit(seas["entities_trained"]).cast("long").alias("entities_trained")))
    fs.write_report(rep, path)
    return fs.read_report(spark, path, rep.schema)


def _seasonal_section(spark, d, per_entity_path: str | None = None):
    """Seasonal summary (computed, not left empty).  Per-entity metrics grow with the
    entity count, so they are written as their own table next to the report instead
    of being gathered into the report row."""
    t = tg.targets_final(pp.analogue_panel(spark, d))
    m = ml.seasonal_evaluate(t)
    if per_entity_path:
        m.write.mode("overwrite").json(per_entity_path)
    return m.agg(F.struct(F.avg("mae").alias("avg_mae"), F.avg("mape").alias("avg_mape"),
                          F.count(F.lit(1)).alias("entities_trained")).alias("seasonal"))


def _scored_orders_frame(spark, d):
    from panelcast.plans.catalog import _scored_orders
    return _scored_orders(spark, d, all_rows=True)


@register("report_read")
def q_report_read(spark, d):
    """Read a written report; nested fields with defaults, formatted for display.
    A missing report reads as an empty frame."""
    rep = q_report_write(spark, d)
    fmt = lambda c: F.coalesce(F.format_number(c, 2), F.lit("N/A"))
    pct = lambda c: F.coalesce(F.concat(F.format_number(c * 100, 1), F.lit("%")), F.lit("N/A"))
    missing = fs.read_report(spark, scratch_path(spark, "absent"), rep.schema)
    return rep.unionByName(missing).select(fmt(F.col("classifier.avg_roc_auc")).alias("roc_auc_text"),
                                           fmt(F.col("classifier.avg_pr_auc")).alias("pr_auc_text"),
                                           pct(F.col("regressor.avg_mape")).alias("mape_text"))


PROFILED = ("flood_occurrence", "resource_demand_score", "severity", "dfsi", "census_population")


@register("profile_summary")
def q_profile_summary(spark, d):
    """Count, mean, deviation, extremes and exact quartiles of the panel's main columns."""
    return r6(describe(pp.analogue_panel(spark, d), PROFILED))


@register("feature_vector")
def q_feature_vector(spark, d):
    t = tg.targets_final(pp.analogue_panel(spark, d))
    feats, cols = ml.feature_frame(t)
    return feats.select("entity", "date", "features", F.lit(len(cols)).alias("n_features"))


@register("gbt_classifier")
def q_gbt_classifier(spark, d):
    """Published final classifier: 500 rounds at most, patience 30 on the fold's AUC."""
    idx, n, _ = _features(spark, d)
    scores, _ = ml.fit_classifier_folds(idx, n, N_SPLITS)
    return spark.createDataFrame(scores, ml.CLS_SCHEMA)


@register("gbt_regressor")
def q_gbt_regressor(spark, d):
    """Published final regressor: 500 rounds at most, patience 30 on the fold's MAE."""
    idx, _, _ = _features(spark, d)
    scores, _ = ml.fit_regressor_folds(idx)
    return spark.createDataFrame(scores, ml.REG_SCHEMA)


@register("seasonal_regression")
def q_seasonal_regression(spark, d):
    t = tg.targets_final(pp.analogue_panel(spark, d))
    return r6(ml.seasonal_evaluate(t))


@register("seasonal_variants")
def q_seasonal_variants(spark, d):
    """The three published seasonal models, scored per entity on their last fifth of rows."""
    panel = pp.analogue_panel(spark, d)
    both = tg.targets_final(panel)
    frames = {"final": both, "v2": tg.targets_v2(panel), "v1": both}
    out = []
    for name, spec in sn.VARIANTS.items():
        keep = dict.fromkeys(["entity", "date", spec.target, *spec.regressors])
        data = materialize(frames[name].select(*keep), f"seasonal-{name}")
        out.append(sn.seasonal_scores(sn.seasonal_forecasts(data, spec), spec).select(F.lit(name).alias("variant"), "*"))
    return r6(reduce(lambda a, b: a.unionByName(b), out))


@register("feature_importance")
def q_feature_importance(spark, d):
    """Split counts of the two packaged models, classifier and regressor."""
    idx, n, cols = _features(spark, d)
    (_, cls), (_, reg) = ml.fit_packaged(idx, n, N_SPLITS)
    found = [ml.feature_importance(f, cols, spark).select(F.lit(k).alias("model"), "feature", "splits")
             for k, fits in (("classifier", cls), ("regressor", reg)) for f in fits if f is not None]
    return reduce(lambda a, b: a.unionByName(b), found)


@register("flat_forecast")
def q_flat_forecast(spark, d):
    """The regressor's prediction on the last row, repeated for 12 months."""
    idx, n, cols = _features(spark, d)
    _, fits = ml.fit_regressor_folds(idx, first_only=True)
    if not fits or fits[0] is None:  # too few positive rows for a regressor
        return spark.createDataFrame([], "step int, prediction double")
    return ml.flat_forecast(fits[0].model, idx.where(F.col("row_idx") == n - 1), 12)


@register("model_refit")
def q_model_refit(spark, d):
    """The classifier refitted on every row with the first valid fold's best round."""
    idx, n, _ = _features(spark, d)
    _, fits = ml.fit_classifier_folds(idx, n, N_SPLITS, first_only=True)
    if not fits:  # no fold has validation positives
        return spark.createDataFrame([], "prediction double, n long, positives long, rounds int")
    model = ml.fit_classifier_all(idx, max_iter=fits[0].best)
    scored = model.transform(idx).select("flood_event", "prediction")
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.sum("flood_event").alias("positives"),
                                            F.lit(model.getNumTrees).alias("rounds"))


@register("model_package")
def q_model_package(spark, d):
    """The first valid folds' models, packed with the scores of all folds."""
    idx, n, cols = _features(spark, d)
    (scores, cls), (reg_scores, reg) = ml.fit_packaged(idx, n, N_SPLITS, first_only=False)
    path = scratch_path(spark, "model")
    encoder = idx.select("entity", "entity_index").distinct()
    model = ml.package(cls[0], cols, path, reg[0], encoder, spark.createDataFrame(scores, ml.CLS_SCHEMA), spark,
                       spark.createDataFrame(reg_scores, ml.REG_SCHEMA))
    scored = model.transform(idx.drop("features")).select("flood_event", "prediction")
    return (scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.sum("flood_event").alias("positives"))
            .withColumn("features", F.lit(spark.read.json(f"{path}/features").count())))
