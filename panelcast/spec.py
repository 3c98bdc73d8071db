"""Parameters of a panel build and the fixed values the formulas depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published behaviour for results to agree.
# ---------------------------------------------------------------------------

# Two-way event season: months 6, 7, 8, 9, 10 are "Monsoon", all else "Non-Monsoon".
MONSOON_MONTHS_EVENT = (6, 7, 8, 9, 10)
# Four-way panel season: 3-5 Pre-Monsoon, 6-9 Monsoon, 10-11 Post-Monsoon, else Winter.
SEASONS_FOUR_WAY = (("Pre-Monsoon", (3, 4, 5)), ("Monsoon", (6, 7, 8, 9)),
                    ("Post-Monsoon", (10, 11)))
SEASON_OTHER = "Winter"
# One-hot categories in the order a sorted dummy encoding produces.
SEASON_CATEGORIES = ("Monsoon", "Post-Monsoon", "Pre-Monsoon", "Winter")

# Texts that a headed CSV file's fields are read as null for, compared unstripped.
NULL_SENTINELS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                  "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Weighted demand score: .3*occurrence + .3*severity/10 + .2*displaced/1000 + .2*fatalities/10
SCORE_WEIGHTS = {"occurrence": 0.3, "severity": 0.3, "displaced": 0.2, "fatalities": 0.2}
SCORE_SCALES = {"severity": 10.0, "displaced": 1000.0, "fatalities": 10.0}

# Norm-based demand (final): affected fraction weights and cap.
AFFECTED_WEIGHTS = {"severity": 0.15, "displaced": 0.25, "area": 0.35, "index": 0.25}
AFFECTED_CAP = 0.3
# Per-person norms: kits per 1000, ORS packets 0.2, tarpaulin 1 per 5, water 15 L x 30 days,
# rations 12 kg.
NORM_KITS_PER = 1000.0
NORM_ORS = 0.2
NORM_TARP_PER = 5.0
WATER_L_PER_DAY = 15.0
SUPPLY_DAYS = 30.0
NORM_WATER_L = WATER_L_PER_DAY * SUPPLY_DAYS
NORM_RATIONS_KG = 12.0
# Composite (final): .2*kits + .15*ORS/10 + .2*tarpaulin + .2*water/1000 + .25*rations
COMPOSITE_FINAL = {"kits": 0.2, "ors": 0.15, "tarp": 0.2, "water": 0.2, "rations": 0.25}
COMPOSITE_FINAL_SCALES = {"ors": 10.0, "water": 1000.0}
# Composite (v2): log1p(1000 * (kits/1e4 + ors/5e4 + tarp/5e3 + water/1e7 + rations/1e5)), clip 0..10
COMPOSITE_V2_SCALES = {"kits": 1e4, "ors": 5e4, "tarp": 5e3, "water": 1e7, "rations": 1e5}
V2_WEIGHTS = {"severity": 0.5, "displaced": 0.3, "occurrence": 0.2}
V2_RATIONS_KG_PER_DAY = 0.4

# Forecast bands: probability +/- (0.1 + 0.02*step); demand x0.5 / x2.0.
PROB_BAND_BASE = 0.1
PROB_BAND_STEP = 0.02
DEMAND_BAND_LOW = 0.5
DEMAND_BAND_HIGH = 2.0
# Expected demand: p > 0.1 -> mean score * (1 + sev_m / max(max_sev, 1)), else 0.1 * mean score.
DEMAND_PROB_THRESHOLD = 0.1
DEMAND_LOW_FACTOR = 0.1
# Risk tiers on the 12-month mean probability.
RISK_HIGH = 0.3
RISK_MODERATE = 0.1
# Allocation: affected = population * min(score / 10, 0.3); default population 1,500,000.
ALLOC_SCORE_SCALE = 10.0
ALLOC_CAP = 0.3
DEFAULT_POPULATION = 1500000
# Resource table: (resource, unit, per-capita quantity)
RESOURCES = (
    ("Medical Kits", "kits", 1.0 / 1000.0),
    ("ORS Packets", "packets", 0.2),
    ("Tarpaulin Sheets", "sheets", 1.0 / 5.0),
    ("Drinking Water", "litres", 450.0),
    ("Dry Rations", "kg", 12.0),
)
# Quantity display: > 1000 shown as x.xK; progress = min(q / 100000, 1).
DISPLAY_THOUSANDS = 1000
PROGRESS_SCALE = 100000.0
# Operating-guide rules: mobilise above 0.3, full protocol above 0.5; pre-position 30% in
# pre-monsoon, at least 60% when HIGH; trust when > 5 events, month 6-9, band < 50% of mean.
MOBILISE_AT = 0.3
FULL_PROTOCOL_AT = 0.5
PREPOSITION_PRE_MONSOON = 0.3
PREPOSITION_HIGH = 0.6
TRUST_MIN_EVENTS = 5
TRUST_MONTHS = (6, 7, 8, 9)
TRUST_BAND_RATIO = 0.5
# Kit table of the guide: (kit, weight kg, cost)
KITS = (("Medical Kit", 5.0, 1200.0), ("Family Kit", 25.0, 3500.0))
# Targets in code: classifier ROC-AUC >= 0.8; regressor MAPE < 0.20.
GATE_ROC_AUC = 0.8
GATE_MAPE = 0.20
# Fold filters before averaging: ROC > 0; MAE > 0; MAPE not null and > 0.001.
MAPE_MIN = 0.001
# Seasonal model clip of the log prediction.
LOG_CLIP_LOW = -5.0
LOG_CLIP_HIGH = 20.0


@dataclass(frozen=True)
class PanelSpec:
    """Where the columns are and which calendar the panel covers."""

    entity_col: str = "entity"
    seq_col: str = "event_seq"
    date_col: str = "start_date"
    list_col: str = "districts"
    measures: tuple[str, ...] = ("severity", "fatalities", "displaced", "duration")
    start: str = "1996-01-01"  # first calendar month (inclusive)
    end: str = "2000-12-01"    # last calendar month (inclusive)
    alias: dict[str, str] = field(default_factory=dict)
    region_col: str = "state"
    region_pattern: str | None = None
    lags: tuple[int, ...] = (1, 3, 6, 12)
    rolls: tuple[int, ...] = (3, 12)
    median_accuracy: int = 100000
