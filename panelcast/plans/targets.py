"""Demand targets from per-capita norms (final and v2 formulas).

Global normalisers (column maxima, the population median) are one-row aggregates
collected as scalars, so the per-row arithmetic stays a narrow projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.stats import exact_medians
from panelcast.spec import (AFFECTED_CAP, AFFECTED_WEIGHTS, COMPOSITE_FINAL, COMPOSITE_FINAL_SCALES,
                            COMPOSITE_V2_SCALES,
                            NORM_KITS_PER, NORM_ORS, NORM_RATIONS_KG, NORM_TARP_PER, SUPPLY_DAYS,
                            V2_RATIONS_KG_PER_DAY, V2_WEIGHTS, WATER_L_PER_DAY)

FINAL_COLUMNS = ["medical_kits_demand", "ors_demand", "tarpaulin_demand", "water_demand_l",
                 "rations_demand_kg", "demand_target", "demand_log", "flood_event", "affected_capped"]
V2_COLUMNS = ["medical_kits", "ors_packets", "tarpaulin_sheets", "water_litres", "dry_rations_kg",
              "composite_demand", "flood_event_v2"]


def _clip(c, lo=None, hi=None):
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)  # null stays null


def _population(panel: DataFrame, n_missing: int | None = None, accuracy: int = 100000):
    """Population with missing values at the median (skipped when none is missing)."""
    if n_missing is None:
        n_missing = panel.agg(F.count_if(F.col("census_population").isNull())).first()[0]
    if not n_missing:
        return F.col("census_population")
    med = exact_medians(panel, ["census_population"], accuracy)["census_population"]
    return F.coalesce(F.col("census_population"), F.lit(med).cast("double"))


def targets_final(panel: DataFrame) -> DataFrame:
    """Affected population = pop x clip(.15 sev/max + .25 displaced/pop + .35 area/max
    + .25 index/max, 0, .3); quantities per norm; composite and its log1p (taken
    before non-event months are zeroed); binary event label."""
    mx = panel.agg(F.max(F.coalesce("severity", F.lit(0.0))).alias("sev"),
                   F.max("corrected_flooded_area").alias("area"), F.max("dfsi").alias("dfsi"),
                   F.count_if(F.col("census_population").isNull()).alias("pop_missing")).first()
    floor1 = lambda v: max(v, 1.0) if v is not None else None
    pop = _population(panel, mx["pop_missing"])
    sev_n = F.coalesce("severity", F.lit(0.0)) / F.lit(floor1(mx["sev"]))
    disp_f = F.coalesce("displaced", F.lit(0.0)) / _clip(pop, 1.0)
    area_n = F.coalesce("corrected_flooded_area", F.lit(0.0)) / F.lit(floor1(mx["area"]))
    dfsi_n = F.col("dfsi") / F.lit(floor1(mx["dfsi"]))
    w = AFFECTED_WEIGHTS
    raw = sev_n * w["severity"] + disp_f * w["displaced"] + area_n * w["area"] + dfsi_n * w["index"]
    frac = _clip(raw, 0.0, AFFECTED_CAP)
    aff = F.coalesce(pop * frac, F.lit(0.0))
    kits, ors, tarp = aff / NORM_KITS_PER, aff * NORM_ORS, aff / NORM_TARP_PER
    water, rations = aff * WATER_L_PER_DAY * SUPPLY_DAYS, aff * NORM_RATIONS_KG
    c = COMPOSITE_FINAL
    cs = COMPOSITE_FINAL_SCALES  # ORS / 10 * .15 and water / 1000 * .2, operation order kept
    composite = (kits * c["kits"] + ors / cs["ors"] * c["ors"] + tarp * c["tarp"]
                 + water / cs["water"] * c["water"] + rations * c["rations"])
    event = F.col("flood_occurrence") > 0
    z = lambda x: F.when(event, x).otherwise(F.lit(0.0))
    return panel.select("*", z(kits).alias("medical_kits_demand"), z(ors).alias("ors_demand"),
                        z(tarp).alias("tarpaulin_demand"), z(water).alias("water_demand_l"),
                        z(rations).alias("rations_demand_kg"), z(composite).alias("demand_target"),
                        F.log1p(composite).alias("demand_log"), event.cast("int").alias("flood_event"),
                        F.coalesce(raw >= AFFECTED_CAP, F.lit(False)).alias("affected_capped"))


def targets_v2(panel: DataFrame) -> DataFrame:
    """v2: multiplier = .5 clip(sev/10, 0, 1) + .3 clip(displaced/pop, 0, 1) + .2 occ;
    half-even rounded quantities; composite = clip(log1p(1000 sum(q/scale)), 0, 10)."""
    pop = _population(panel)
    sev_n = _clip(F.col("severity") / 10.0, 0.0, 1.0)
    disp = F.coalesce("displaced", F.lit(0.0))
    disp_f = (F.when(pop == 0, F.when(disp > 0, F.lit(1.0)).when(disp < 0, F.lit(0.0)))
              .otherwise(_clip(disp / pop, 0.0, 1.0)))
    w = V2_WEIGHTS
    mult = sev_n * w["severity"] + disp_f * w["displaced"] + F.col("flood_occurrence") * w["occurrence"]
    aff = pop * mult
    kits = F.bround(aff / NORM_KITS_PER, 0)
    ors = F.bround(aff * NORM_ORS, 0)
    tarp = F.bround(aff / NORM_TARP_PER, 0)
    water = F.bround(aff * WATER_L_PER_DAY * SUPPLY_DAYS, 0)
    rations = F.bround(aff * V2_RATIONS_KG_PER_DAY * SUPPLY_DAYS, 1)
    s = COMPOSITE_V2_SCALES
    parts = kits / s["kits"] + ors / s["ors"] + tarp / s["tarp"] + water / s["water"] + rations / s["rations"]
    comp = _clip(F.log1p(parts * 1000.0), 0.0, 10.0)
    return panel.select("*", kits.alias("medical_kits"), ors.alias("ors_packets"),
                        tarp.alias("tarpaulin_sheets"), water.alias("water_litres"),
                        rations.alias("dry_rations_kg"), comp.alias("composite_demand"),
                        F.coalesce(comp > 0, F.lit(False)).cast("int").alias("flood_event_v2"))
