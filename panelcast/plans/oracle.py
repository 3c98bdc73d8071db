"""DuckDB formulations of the registered queries (the correctness oracle).

Written independently of the Spark code: the same semantics stated as plain SQL
over the pre-registered tables.  Doubles are rounded to 6 decimals (plus 0.0 to
normalise negative zero).
"""

from __future__ import annotations

from panelcast.plans import catalog as C
from panelcast.sources import tables as T
from panelcast.spec import PanelSpec

SPEC = PanelSpec(alias=dict(T.ANALOGUE_ALIAS))
START, END = SPEC.start, SPEC.end


def R(expr: str, name: str) -> str:
    return f"(round({expr}, 6) + 0.0) AS \"{name}\""


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def title(x: str) -> str:
    return (rf"array_to_string(list_transform(regexp_extract_all({x}, '(\p{{L}}+|[^\p{{L}}]+)', 1), "
            r"lambda t: upper(t[1]) || lower(t[2:])), '')")


def canon(x: str) -> str:
    t = title(strip(x))
    whens = " ".join(f"WHEN '{a}' THEN '{c}'" for a, c in SPEC.alias.items())
    return f"(CASE {t} {whens} ELSE {t} END)"


LABEL = "('SUPPLIER_' || CAST({k} AS VARCHAR))"


def label(k: str) -> str:
    return LABEL.format(k=k)


MEASURES = ["severity", "fatalities", "displaced", "duration"]

BASE = f"""
ev AS (
  SELECT o.o_orderkey AS event_id, o.o_orderkey AS event_seq, CAST(o.o_orderdate AS DATE) AS start_date,
         st.state, pl.districts,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_totalprice / 50000.0 END AS severity,
         CAST(o.o_orderkey % 13 AS DOUBLE) AS fatalities, CAST(o.o_orderkey % 1000 AS DOUBLE) AS displaced,
         pl.duration, o.o_custkey
  FROM orders o
  LEFT JOIN (SELECT c_custkey, r_name AS state FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey) st ON o.o_custkey = st.c_custkey
  LEFT JOIN (SELECT l_orderkey, array_to_string(list_sort(list_distinct(list({label('l_suppkey')}))), ', ') AS districts,
                    CAST(count(*) AS DOUBLE) AS duration
             FROM lineitem GROUP BY l_orderkey) pl ON o.o_orderkey = pl.l_orderkey
  WHERE o.o_orderpriority = '{T.EVENT_PRIORITY}' AND o.o_totalprice > {T.EVENT_MIN_PRICE}
),
dom AS (SELECT DISTINCT {canon(label('s_suppkey'))} AS entity FROM supplier),
parts AS (
  SELECT ev.*, CAST(unnest(range(0, len(string_split(districts, ',')))) AS INTEGER) AS pos,
         unnest(string_split(districts, ',')) AS raw_part
  FROM ev WHERE districts IS NOT NULL
),
recs AS (
  SELECT p.*, {strip('raw_part')} AS part, {canon('raw_part')} AS entity,
         CAST(year(start_date) AS INTEGER) AS year, CAST(month(start_date) AS INTEGER) AS month
  FROM parts p
),
cells AS (
  SELECT entity, year, month, event_seq, {", ".join(MEASURES)}
  FROM recs WHERE entity IN (SELECT entity FROM dom)
),
cal AS (
  SELECT entity, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, CAST(m AS DATE) AS date
  FROM dom, (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 MONTH)) AS m) g
),
cellagg AS (
  SELECT entity, year, month,
         {", ".join(f"arg_max({m}, event_seq) FILTER (WHERE {m} IS NOT NULL) AS {m}" for m in MEASURES)}
  FROM cells WHERE make_date(year, month, 1) BETWEEN DATE '{START}' AND DATE '{END}'
  GROUP BY entity, year, month
),
up AS (
  SELECT c.entity, c.year, c.month, CAST(CASE WHEN a.entity IS NULL THEN 0 ELSE 1 END AS INTEGER) AS flood_occurrence,
         {", ".join(f"coalesce(a.{m}, 0.0) AS {m}" for m in MEASURES)}
  FROM cal c LEFT JOIN cellagg a ON c.entity = a.entity AND c.year = a.year AND c.month = a.month
),
idx AS (SELECT {canon('_c0')} AS entity, dfsi FROM (SELECT {label('s_suppkey')} AS _c0, s_acctbal / 1000.0 AS dfsi FROM supplier)),
lst AS (
  SELECT l_suppkey, l_returnflag, count(*) AS n_lines, sum(l_discount) AS sum_discount, sum(l_tax) AS sum_tax,
         sum(l_quantity) AS sum_quantity, count(*) FILTER (WHERE l_discount < 0.05) AS n_low_discount
  FROM lineitem GROUP BY l_suppkey, l_returnflag
),
area AS (
  SELECT {canon('dist_name')} AS entity, percent_flooded_area, corrected_flooded_area
  FROM (SELECT {label('l_suppkey')} AS dist_name, sum(sum_discount) / sum(n_lines) * 100.0 AS percent_flooded_area,
               sum(sum_tax) / sum(n_lines) * 100.0 AS corrected_flooded_area FROM lst GROUP BY l_suppkey)
),
imp_src AS (
  SELECT {label('l_suppkey')} AS dist_name, CAST(sum(n_lines) * 100 AS DOUBLE) AS population,
         sum(sum_quantity) / sum(n_lines) / 10.0 AS mean_flood_duration
  FROM lst
  WHERE l_suppkey IN (SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey WHERE regexp_matches(r_name, '{T.IMPACT_REGION_PATTERN}'))
  GROUP BY l_suppkey
),
imp AS (SELECT {canon('dist_name')} AS entity, population, mean_flood_duration FROM imp_src),
cen_src AS (
  SELECT CAST(l_suppkey * 1000 + ascii(l_returnflag) AS BIGINT) AS row_seq,
         CASE l_returnflag WHEN 'A' THEN lower({label('l_suppkey')})
                           WHEN 'N' THEN ' ' || {label('l_suppkey')} || ' '
                           ELSE {label('l_suppkey')} END AS district_name,
         n_lines * 1000 AS population, n_lines * 200 AS households,
         n_low_discount * 200 AS rural_households, (n_lines - n_low_discount) * 200 AS urban_households
  FROM lst
),
cen AS (
  SELECT lower({strip('district_name')}) AS _key,
         CAST(arg_max(population, row_seq) AS DOUBLE) AS census_population,
         CAST(arg_max(households, row_seq) AS DOUBLE) AS households,
         CAST(arg_max(rural_households, row_seq) AS DOUBLE) AS rural_hh,
         CAST(arg_max(urban_households, row_seq) AS DOUBLE) AS urban_hh
  FROM cen_src GROUP BY 1
),
attrs AS (
  SELECT d.entity, idx.dfsi, area.percent_flooded_area, area.corrected_flooded_area, imp.population,
         imp.mean_flood_duration, cen.census_population, cen.households, cen.rural_hh, cen.urban_hh
  FROM dom d LEFT JOIN idx ON d.entity = idx.entity LEFT JOIN area ON d.entity = area.entity
  LEFT JOIN imp ON d.entity = imp.entity LEFT JOIN cen ON lower(d.entity) = cen._key
),
raw AS (
  SELECT u.*, a.dfsi, a.percent_flooded_area, a.corrected_flooded_area, a.population, a.mean_flood_duration,
         a.census_population, a.households, a.rural_hh, a.urban_hh, u.entity AS entity_norm,
         CASE WHEN u.month IN (3, 4, 5) THEN 'Pre-Monsoon' WHEN u.month IN (6, 7, 8, 9) THEN 'Monsoon'
              WHEN u.month IN (10, 11) THEN 'Post-Monsoon' ELSE 'Winter' END AS season,
         sin(2 * pi() * u.month / 12.0) AS month_sin, cos(2 * pi() * u.month / 12.0) AS month_cos,
         {", ".join(f"CAST(lag(u.flood_occurrence, {n}) OVER (PARTITION BY u.entity ORDER BY u.year, u.month) AS DOUBLE) AS flood_lag_{n}m" for n in SPEC.lags)},
         {", ".join(f"avg(CAST(u.flood_occurrence AS DOUBLE)) OVER (PARTITION BY u.entity ORDER BY u.year, u.month ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS flood_roll_{n}m" for n in SPEC.rolls)},
         a.census_population * (coalesce(a.corrected_flooded_area, 0.0) / 100.0) AS flood_exposed_pop,
         a.census_population * u.severity / 100000.0 AS pop_x_flood_severity,
         greatest(u.flood_occurrence * 0.3 + (coalesce(u.severity, 0.0) / 10.0) * 0.3
                  + (coalesce(u.displaced, 0.0) / 1000.0) * 0.2 + (coalesce(u.fatalities, 0.0) / 10.0) * 0.2, 0.0)
           AS resource_demand_score
  FROM up u LEFT JOIN attrs a ON u.entity = a.entity
),
med AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in ("dfsi", "percent_flooded_area", "corrected_flooded_area", "population", "mean_flood_duration", "census_population", "households", "flood_exposed_pop", "pop_x_flood_severity"))} FROM raw),
panel AS (
  SELECT entity, year, month, flood_occurrence, severity, fatalities, displaced, duration, entity_norm,
         {", ".join(f"coalesce({c}, m_{c}, 0.0) AS {c}" for c in ("dfsi", "percent_flooded_area", "corrected_flooded_area", "population", "mean_flood_duration", "census_population", "households"))},
         coalesce(rural_hh, 0.0) AS rural_hh, coalesce(urban_hh, 0.0) AS urban_hh, season, month_sin, month_cos,
         {", ".join(f"coalesce(flood_lag_{n}m, 0.0) AS flood_lag_{n}m" for n in SPEC.lags)},
         {", ".join(f"coalesce(flood_roll_{n}m, 0.0) AS flood_roll_{n}m" for n in SPEC.rolls)},
         coalesce(flood_exposed_pop, m_flood_exposed_pop, 0.0) AS flood_exposed_pop,
         coalesce(pop_x_flood_severity, m_pop_x_flood_severity, 0.0) AS pop_x_flood_severity,
         coalesce(resource_demand_score, 0.0) AS resource_demand_score,
         make_date(year, month, 1) AS date
  FROM raw, med
)"""

PANEL_DOUBLES = ["severity", "fatalities", "displaced", "duration", "dfsi", "percent_flooded_area",
                 "corrected_flooded_area", "population", "mean_flood_duration", "census_population",
                 "households", "rural_hh", "urban_hh", "month_sin", "month_cos",
                 *[f"flood_lag_{n}m" for n in SPEC.lags], *[f"flood_roll_{n}m" for n in SPEC.rolls],
                 "flood_exposed_pop", "pop_x_flood_severity", "resource_demand_score"]
PANEL_COLS = ["entity", "year", "month", "flood_occurrence", "severity", "fatalities", "displaced",
              "duration", "entity_norm", "dfsi", "percent_flooded_area", "corrected_flooded_area",
              "population", "mean_flood_duration", "census_population", "households", "rural_hh",
              "urban_hh", "season", "month_sin", "month_cos", "flood_lag_1m", "flood_lag_3m",
              "flood_lag_6m", "flood_lag_12m", "flood_roll_3m", "flood_roll_12m", "flood_exposed_pop",
              "pop_x_flood_severity", "resource_demand_score", "date"]


def sel(cols, doubles=()) -> str:
    return ", ".join(R(c, c) if c in doubles else f'"{c}"' for c in cols)


TARGETS = """
tmax AS (SELECT greatest(max(coalesce(severity, 0.0)), 1.0) AS sev_max,
                greatest(max(corrected_flooded_area), 1.0) AS area_max,
                greatest(max(dfsi), 1.0) AS dfsi_max,
                median(census_population) AS pop_med FROM panel),
tf0 AS (
  SELECT p.*, coalesce(census_population, pop_med) AS pop,
         coalesce(severity, 0.0) / sev_max * 0.15
         + coalesce(displaced, 0.0) / greatest(coalesce(census_population, pop_med), 1.0) * 0.25
         + coalesce(corrected_flooded_area, 0.0) / area_max * 0.35
         + dfsi / dfsi_max * 0.25 AS frac_raw
  FROM panel p, tmax
),
tf1 AS (SELECT *, coalesce(pop * least(greatest(frac_raw, 0.0), 0.3), 0.0) AS aff, coalesce(frac_raw >= 0.3, false) AS affected_capped FROM tf0),
tf2 AS (SELECT *, aff / 1000.0 AS k, aff * 0.2 AS o, aff / 5.0 AS t, aff * 15.0 * 30.0 AS w, aff * 12.0 AS r FROM tf1),
tf3 AS (SELECT *, k * 0.2 + o / 10.0 * 0.15 + t * 0.2 + w / 1000.0 * 0.2 + r * 0.25 AS comp FROM tf2),
tfin AS (
  SELECT *, CASE WHEN flood_occurrence > 0 THEN k ELSE 0.0 END AS medical_kits_demand,
         CASE WHEN flood_occurrence > 0 THEN o ELSE 0.0 END AS ors_demand,
         CASE WHEN flood_occurrence > 0 THEN t ELSE 0.0 END AS tarpaulin_demand,
         CASE WHEN flood_occurrence > 0 THEN w ELSE 0.0 END AS water_demand_l,
         CASE WHEN flood_occurrence > 0 THEN r ELSE 0.0 END AS rations_demand_kg,
         CASE WHEN flood_occurrence > 0 THEN comp ELSE 0.0 END AS demand_target,
         ln(1 + comp) AS demand_log, CAST(flood_occurrence > 0 AS INTEGER) AS flood_event
  FROM tf3
),
v0 AS (
  SELECT p.*, coalesce(census_population, pop_med) AS pop2,
         least(greatest(severity / 10.0, 0.0), 1.0) AS sev_n,
         CASE WHEN coalesce(census_population, pop_med) = 0
              THEN CASE WHEN coalesce(displaced, 0.0) > 0 THEN 1.0 WHEN coalesce(displaced, 0.0) < 0 THEN 0.0 END
              ELSE least(greatest(coalesce(displaced, 0.0) / coalesce(census_population, pop_med), 0.0), 1.0) END AS disp_f
  FROM tfin p, tmax
),
v1 AS (SELECT *, pop2 * (sev_n * 0.5 + disp_f * 0.3 + flood_occurrence * 0.2) AS aff2 FROM v0),
v2 AS (
  SELECT *, round_even(aff2 / 1000.0, 0) AS medical_kits, round_even(aff2 * 0.2, 0) AS ors_packets,
         round_even(aff2 / 5.0, 0) AS tarpaulin_sheets, round_even(aff2 * 15.0 * 30.0, 0) AS water_litres,
         round_even(aff2 * 0.4 * 30.0, 1) AS dry_rations_kg
  FROM v1
),
vfin AS (
  SELECT *, least(greatest(ln(1 + (medical_kits / 10000.0 + ors_packets / 50000.0 + tarpaulin_sheets / 5000.0
                                   + water_litres / 10000000.0 + dry_rations_kg / 100000.0) * 1000.0), 0.0), 10.0)
            AS composite_demand
  FROM v2
)"""

FORECAST = """
mp0 AS (SELECT entity, month, avg(flood_occurrence) AS month_prob, avg(severity) AS month_sev FROM panel GROUP BY entity, month),
ment AS (SELECT entity, avg(resource_demand_score) AS mean_score, max(date) AS last_date FROM panel GROUP BY entity),
mmax AS (SELECT entity, greatest(max(month_sev), 1.0) AS max_month_sev FROM mp0 GROUP BY entity),
hz AS (SELECT entity, CAST(s AS INTEGER) AS step, CAST(last_date + to_months(CAST(s AS INTEGER)) AS DATE) AS date
       FROM ment, (SELECT unnest(range(1, 13)) AS s) g),
fc0 AS (
  SELECT h.entity, h.step, h.date, CAST(month(h.date) AS INTEGER) AS month,
         coalesce(m.month_prob, 0.0) AS p, coalesce(m.month_sev, 0.0) AS sev, e.mean_score, x.max_month_sev
  FROM hz h JOIN ment e ON h.entity = e.entity JOIN mmax x ON h.entity = x.entity
  LEFT JOIN mp0 m ON h.entity = m.entity AND month(h.date) = m.month
),
fc AS (
  SELECT entity, step, date, month, p AS flood_probability,
         greatest(0.0, p - (0.1 + step * 0.02)) AS prob_lower, least(1.0, p + (0.1 + step * 0.02)) AS prob_upper,
         CASE WHEN round(p, 9) > 0.1 THEN mean_score * (1 + sev / max_month_sev) ELSE mean_score * 0.1 END AS expected_demand
  FROM fc0
),
fcb AS (SELECT *, expected_demand * 0.5 AS demand_lower, expected_demand * 2.0 AS demand_upper FROM fc),
fpop AS (SELECT entity, CAST(trunc(arg_min(census_population, date)) AS BIGINT) AS total_population FROM panel GROUP BY entity),
alloc0 AS (
  SELECT f.entity, CAST(coalesce(p.total_population, 1500000) AS DOUBLE) * least(f.expected_demand / 10.0, 0.3) AS aff
  FROM fcb f LEFT JOIN fpop p ON f.entity = p.entity WHERE f.step = 1
),
alloc AS (
  SELECT entity, CAST(trunc(aff) AS BIGINT) AS affected_population, resource, unit, per_capita, CAST(trunc(q) AS BIGINT) AS amount
  FROM (SELECT entity, aff, unnest([
          {'resource': 'Medical Kits', 'unit': 'kits', 'per_capita': 1.0 / 1000.0, 'q': aff / 1000.0},
          {'resource': 'ORS Packets', 'unit': 'packets', 'per_capita': 0.2, 'q': aff * 0.2},
          {'resource': 'Tarpaulin Sheets', 'unit': 'sheets', 'per_capita': 1.0 / 5.0, 'q': aff / 5.0},
          {'resource': 'Drinking Water', 'unit': 'litres', 'per_capita': 450.0, 'q': aff * 15.0 * 30.0},
          {'resource': 'Dry Rations', 'unit': 'kg', 'per_capita': 12.0, 'q': aff * 12.0}], recursive := true) FROM alloc0)
),
risk AS (SELECT entity, avg(flood_probability) AS risk_score FROM fcb GROUP BY entity),
riskt AS (SELECT entity, risk_score, CASE WHEN round(risk_score, 9) > 0.3 THEN 'HIGH' WHEN round(risk_score, 9) > 0.1 THEN 'MODERATE' ELSE 'LOW' END AS risk_tier FROM risk),
t5 AS (SELECT p.entity, count(*) FILTER (WHERE p.date >= e.last_date - INTERVAL 60 MONTH AND p.flood_occurrence > 0) AS events_5yr
       FROM panel p JOIN ment e ON p.entity = e.entity GROUP BY p.entity)"""


def W(body: str, *extra: str) -> str:
    return "WITH " + ",\n".join([BASE, *extra]) + "\n" + body


ORDERS_FOLDS = f"""
so AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS odate, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
         ((o_orderkey % 97) + CASE WHEN o_orderstatus = 'F' THEN 35 ELSE 0 END) / 132.0 AS score,
         o_totalprice / 1000.0 AS y_true,
         (o_totalprice / 1000.0) * (1 + ((o_custkey % 41) - 20) / 100.0) AS y_pred
  FROM orders
),
soi AS (SELECT *, row_number() OVER (ORDER BY odate, o_orderkey) - 1 AS row_idx, count(*) OVER () AS n FROM so),
sof AS (
  SELECT *, CAST(floor((row_idx - (n - {C.N_SPLITS} * (n // {C.N_SPLITS + 1}))) / (n // {C.N_SPLITS + 1})) AS INTEGER) AS fold
  FROM soi WHERE row_idx >= n - {C.N_SPLITS} * (n // {C.N_SPLITS + 1})
),
roc0 AS (SELECT fold, score, sum(label) AS tp, sum(1 - label) AS fp FROM sof GROUP BY fold, score),
roc1 AS (SELECT *, coalesce(sum(fp) OVER (PARTITION BY fold ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fp_below FROM roc0),
roc AS (SELECT fold, CASE WHEN sum(tp) > 0 AND sum(fp) > 0 THEN sum(tp * (fp_below + fp / 2.0)) / (sum(tp) * sum(fp)) ELSE 0.0 END AS roc_auc FROM roc1 GROUP BY fold),
pr0 AS (SELECT fold, score, sum(label) AS tp, count(*) AS cnt FROM sof GROUP BY fold, score),
pr1 AS (SELECT *, sum(tp) OVER (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctp,
               sum(cnt) OVER (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ccnt,
               sum(tp) OVER (PARTITION BY fold) AS P FROM pr0),
pr2 AS (SELECT *, ctp / P AS rec, ctp / ccnt AS pre FROM pr1),
pr3 AS (SELECT *, coalesce(lag(rec) OVER (PARTITION BY fold ORDER BY score DESC), 0.0) AS rec0,
               coalesce(lag(pre) OVER (PARTITION BY fold ORDER BY score DESC), 1.0) AS pre0 FROM pr2),
pr AS (SELECT fold, CASE WHEN max(P) > 0 THEN sum((rec - rec0) * (pre + pre0) / 2.0) END AS pr_auc FROM pr3 GROUP BY fold),
reg AS (SELECT fold, avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
               avg(CASE WHEN y_true > 0 THEN abs(y_true - y_pred) / y_true END) AS mape, count(*) AS n_val
        FROM sof GROUP BY fold)"""

PANEL_FOLDS = f"""
pfi AS (SELECT *, row_number() OVER (ORDER BY date, entity) - 1 AS row_idx, count(*) OVER () AS n FROM tfin),
pf AS (SELECT *, CASE WHEN row_idx >= n - {C.N_SPLITS} * (n // {C.N_SPLITS + 1})
                      THEN CAST(floor((row_idx - (n - {C.N_SPLITS} * (n // {C.N_SPLITS + 1}))) / (n // {C.N_SPLITS + 1})) AS INTEGER) END AS val_fold
       FROM pfi),
blk AS (SELECT coalesce(val_fold, -1) AS block, count(*) AS n_blk, CAST(sum(flood_event) AS BIGINT) AS pos_blk FROM pf GROUP BY 1),
fcnt AS (SELECT block AS fold,
                CAST(sum(n_blk) OVER (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS n_train,
                CAST(sum(pos_blk) OVER (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS pos_train,
                n_blk AS n_val, pos_blk AS pos_val FROM blk)"""

EXPLODE_RAW = "ev_parts AS (SELECT event_id, unnest(string_split(districts, ',')) AS raw_part FROM ev WHERE districts IS NOT NULL)"

ALIAS_ROWS = ", ".join(f"('{c}', '{a}', {i + 1})" for i, (a, c) in enumerate(SPEC.alias.items()))

EVENT_DOCUMENTS = """docs AS (SELECT event_type, json_extract(rec, '$') AS doc FROM (SELECT event_type,
          '{"event_id": ' || event_id || ', "properties": {"detail": ' || props || ', "tags": ' || CASE WHEN event_id % 3 = 0 THEN '[]' ELSE '["a", "' || event_type || '"]' END
          || '}, "geometry": ' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '{"type": "Point", "coordinates": [' || event_id % 360 || ', ' || event_id % 90 || '.5]}' END || '}' AS rec
          FROM events) WHERE event_type <> 'error')"""

SQL: dict[str, str] = {
    "event_explode": W(f"""SELECT event_id, pos, part, entity, year, month, event_seq,
        {R('severity', 'severity')}, {R('fatalities', 'fatalities')}, {R('displaced', 'displaced')}, {R('duration', 'duration')}
        FROM recs WHERE entity IN (SELECT entity FROM dom) AND year IS NOT NULL AND month IS NOT NULL"""),
    "name_normalize": W(f"SELECT DISTINCT raw_part, {title(strip('raw_part'))} AS normalized FROM ev_parts", EXPLODE_RAW),
    "alias_lookup": W(f"SELECT normalized, {canon('normalized')} AS canonical FROM (SELECT DISTINCT {title(strip('raw_part'))} AS normalized FROM ev_parts)", EXPLODE_RAW),
    "domain_semi": W("SELECT event_id, pos, entity FROM recs WHERE entity IN (SELECT entity FROM dom)"),
    "region_filter": W(f"SELECT event_id, state, districts AS places, start_date FROM ev WHERE coalesce(regexp_matches(state, '{C.REGION_PATTERN}'), false)"),
    "date_parse": W(r"""SELECT event_id, date_text, parsed_date, CAST(year(parsed_date) AS INTEGER) AS year, CAST(month(parsed_date) AS INTEGER) AS month
        FROM (SELECT event_id, date_text,
                CAST(coalesce(try_strptime(date_text, '%d/%m/%Y'), try_strptime(date_text, '%d-%m-%Y'),
                              try_strptime(date_text, '%d.%m.%Y'), try_strptime(date_text, '%Y-%m-%d')) AS DATE) AS parsed_date
              FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(start_date, '%-d-%-m-%Y')
                                                       WHEN 1 THEN strftime(start_date, '%Y-%m-%d')
                                                       WHEN 2 THEN '31-31-' || CAST(year(start_date) AS VARCHAR)
                                                       ELSE strftime(start_date, '%-d/%-m/%Y') END AS date_text FROM ev))"""),
    "numeric_coerce": r"""SELECT o_orderkey, raw_text,
        (round(coalesce(CASE WHEN regexp_matches(raw_text, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')
                   THEN TRY_CAST(regexp_replace(raw_text, '^\s+|\s+$', '', 'g') AS DOUBLE) END, 0.0), 6) + 0.0) AS value
        FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
                                                     WHEN 1 THEN CAST(o_custkey AS VARCHAR) || 'd'
                                                     WHEN 2 THEN '1,' || CAST(o_custkey % 1000 AS VARCHAR)
                                                     ELSE CAST(o_custkey % 10 AS VARCHAR) || 'e2' END AS raw_text FROM orders)""",
    "season_two_way": W("SELECT event_id, CAST(month(start_date) AS INTEGER) AS month, CASE WHEN month(start_date) IN (6, 7, 8, 9, 10) THEN 'Monsoon' ELSE 'Non-Monsoon' END AS season FROM ev"),
    "season_four_way": W("SELECT entity, year, month, CASE WHEN month IN (3, 4, 5) THEN 'Pre-Monsoon' WHEN month IN (6, 7, 8, 9) THEN 'Monsoon' WHEN month IN (10, 11) THEN 'Post-Monsoon' ELSE 'Winter' END AS season FROM cal"),
    "calendar_densify": W("SELECT entity, year, month, date, CAST(0 AS INTEGER) AS flood_occurrence, 0.0::DOUBLE AS severity, 0.0::DOUBLE AS fatalities, 0.0::DOUBLE AS displaced, 0.0::DOUBLE AS duration FROM cal"),
    "panel_upsert": W(f"SELECT entity, year, month, flood_occurrence, {', '.join(R(m, m) for m in MEASURES)} FROM up"),
    "panel_left_dims": W(f"""SELECT u.entity, u.year, u.month, u.flood_occurrence, {', '.join(R('u.' + m, m) for m in MEASURES)},
        {R('a.dfsi', 'dfsi')}, {R('a.percent_flooded_area', 'percent_flooded_area')}, {R('a.corrected_flooded_area', 'corrected_flooded_area')},
        {R('a.population', 'population')}, {R('a.mean_flood_duration', 'mean_flood_duration')}
        FROM up u LEFT JOIN attrs a ON u.entity = a.entity"""),
    "census_lookup": W(f"SELECT entity, {R('census_population', 'census_population')}, {R('households', 'households')}, {R('rural_hh', 'rural_hh')}, {R('urban_hh', 'urban_hh')} FROM attrs"),
    "merge_reconciliation": W("""SELECT count(*) AS total, count(k.entity) AS matched, count(*) - count(k.entity) AS failed
        FROM cells c LEFT JOIN cal k ON k.entity = c.entity AND k.year = c.year AND k.month = c.month"""),
    "report_dataset": W(f"""SELECT count(*) AS records, count(DISTINCT entity) AS entities, {R('avg(flood_event)', 'flood_event_rate')},
        count(*) FILTER (WHERE demand_target > 0) AS positive_demand_samples,
        CAST(min(date) AS DATE)::VARCHAR || ' to ' || CAST(max(date) AS DATE)::VARCHAR AS date_range FROM tfin""", TARGETS),
    "report_folds": W(f"""SELECT f.fold, {R('roc_auc', 'roc_auc')}, {R('pr_auc', 'pr_auc')},
        {R('2.0 * tp / (2 * tp + fp + fn)', 'f1')},
        (SELECT CAST(sum(label) AS BIGINT) FROM soi WHERE row_idx < n - ({C.N_SPLITS} - f.fold) * (n // {C.N_SPLITS + 1})) AS n_pos_train,
        n_pos_val
        FROM (SELECT fold, CAST(sum(label) AS BIGINT) AS n_pos_val, count(*) FILTER (WHERE score > 0.5 AND label = 1) AS tp,
                     count(*) FILTER (WHERE score > 0.5 AND label = 0) AS fp, count(*) FILTER (WHERE score <= 0.5 AND label = 1) AS fn
              FROM sof GROUP BY fold HAVING sum(label) > 0) f JOIN roc USING (fold) JOIN pr USING (fold)""", ORDERS_FOLDS),
    "unmatched_anti": W("SELECT c.entity, c.year, c.month, c.event_seq FROM cells c WHERE NOT EXISTS (SELECT 1 FROM cal k WHERE k.entity = c.entity AND k.year = c.year AND k.month = c.month)"),
    "theta_name_match": W("""SELECT d.entity, CAST(count(p.p) AS BIGINT) AS n_matches FROM dom d
        LEFT JOIN (SELECT lower(part) AS p FROM recs) p ON contains(p.p, lower(d.entity)) OR contains(lower(d.entity), p.p)
        GROUP BY d.entity"""),
    "alternate_lookup": W(f"""SELECT d.entity, coalesce(h.found_as, 'NOT FOUND') AS found_as FROM dom d LEFT JOIN (
          SELECT entity, arg_min(probe, priority) AS found_as FROM probes p
          WHERE EXISTS (SELECT 1 FROM imp_src s WHERE contains(lower(s.dist_name), lower(p.probe))) GROUP BY entity) h
        ON d.entity = h.entity""",
        f"""probes AS (SELECT entity, entity AS probe, 0 AS priority FROM dom
            UNION ALL SELECT * FROM (VALUES {ALIAS_ROWS}) v(entity, probe, priority) WHERE entity IN (SELECT entity FROM dom))"""),
    "median_impute": W(f"SELECT {sel(PANEL_COLS, PANEL_DOUBLES)} FROM panel"),
    "lag_features": W(f"SELECT entity, year, month, flood_occurrence, {', '.join(R(f'coalesce(flood_lag_{n}m, 0.0)', f'flood_lag_{n}m') for n in SPEC.lags)} FROM raw"),
    "rolling_features": W(f"SELECT entity, year, month, {', '.join(R(f'flood_roll_{n}m', f'flood_roll_{n}m') for n in SPEC.rolls)} FROM raw"),
    "cyclic_month": W(f"SELECT entity, year, month, {R('sin(2 * pi() * month / 12.0)', 'month_sin')}, {R('cos(2 * pi() * month / 12.0)', 'month_cos')} FROM cal"),
    "exposure_interaction": W(f"SELECT entity, year, month, {R('flood_exposed_pop', 'flood_exposed_pop')}, {R('pop_x_flood_severity', 'pop_x_flood_severity')} FROM raw"),
    "demand_score": W(f"SELECT entity, year, month, {R('resource_demand_score', 'resource_demand_score')} FROM raw"),
    "demand_norms_final": W(f"SELECT entity, year, month, {sel(['medical_kits_demand', 'ors_demand', 'tarpaulin_demand', 'water_demand_l', 'rations_demand_kg', 'demand_target', 'demand_log'], ['medical_kits_demand', 'ors_demand', 'tarpaulin_demand', 'water_demand_l', 'rations_demand_kg', 'demand_target', 'demand_log'])}, flood_event, affected_capped FROM tfin", TARGETS),
    "demand_norms_v2": W(f"SELECT entity, year, month, {sel(['medical_kits', 'ors_packets', 'tarpaulin_sheets', 'water_litres', 'dry_rations_kg', 'composite_demand'], ['medical_kits', 'ors_packets', 'tarpaulin_sheets', 'water_litres', 'dry_rations_kg', 'composite_demand'])}, CAST(coalesce(composite_demand > 0, false) AS INTEGER) AS flood_event_v2 FROM vfin", TARGETS),
    "label_binary": W("SELECT entity, year, month, flood_event, CAST(coalesce(composite_demand > 0, false) AS INTEGER) AS flood_event_v2 FROM vfin", TARGETS),
    "positive_rows_summary": W(f"SELECT count(*) AS n_rows, {R('avg(flood_event)', 'event_rate')}, count(*) FILTER (WHERE demand_target > 0) AS n_positive_demand, {R('avg(CASE WHEN demand_target > 0 THEN demand_target END)', 'mean_positive_demand')}, {R('avg(CASE WHEN flood_event = 1 THEN CAST(affected_capped AS DOUBLE) END)', 'saturation_rate')} FROM tfin", TARGETS),
    "label_encode": W("SELECT entity, year, month, CAST(dense_rank() OVER (ORDER BY entity) - 1 AS INTEGER) AS entity_index FROM cal"),
    "one_hot_season": W("""SELECT entity, year, month, season,
        CAST(season = 'Monsoon' AS INTEGER) AS "season_Monsoon", CAST(season = 'Post-Monsoon' AS INTEGER) AS "season_Post-Monsoon",
        CAST(season = 'Pre-Monsoon' AS INTEGER) AS "season_Pre-Monsoon", CAST(season = 'Winter' AS INTEGER) AS "season_Winter"
        FROM (SELECT *, CASE WHEN month IN (3, 4, 5) THEN 'Pre-Monsoon' WHEN month IN (6, 7, 8, 9) THEN 'Monsoon' WHEN month IN (10, 11) THEN 'Post-Monsoon' ELSE 'Winter' END AS season FROM cal)"""),
    "month_profile": W(f"SELECT m.entity, CAST(m.month AS INTEGER) AS month, {R('m.month_prob', 'month_prob')}, {R('m.month_sev', 'month_sev')}, {R('x.max_month_sev', 'max_month_sev')}, {R('e.mean_score', 'mean_score')} FROM mp0 m JOIN mmax x ON m.entity = x.entity JOIN ment e ON m.entity = e.entity", FORECAST),
    "horizon_generate": W("SELECT entity, step, date, CAST(month(date) AS INTEGER) AS month FROM hz", FORECAST),
    "seasonal_forecast": W(f"SELECT entity, step, date, month, {R('flood_probability', 'flood_probability')}, {R('expected_demand', 'expected_demand')} FROM fcb", FORECAST),
    "probability_band": W(f"SELECT entity, step, {R('flood_probability', 'flood_probability')}, {R('prob_lower', 'prob_lower')}, {R('prob_upper', 'prob_upper')} FROM fcb", FORECAST),
    "demand_band": W(f"SELECT entity, step, {R('expected_demand', 'expected_demand')}, {R('demand_lower', 'demand_lower')}, {R('demand_upper', 'demand_upper')} FROM fcb", FORECAST),
    "allocation_long": W(f"SELECT entity, affected_population, resource, unit, {R('per_capita', 'per_capita')}, amount FROM alloc", FORECAST),
    "allocation_wide": W("""SELECT entity, affected_population,
        max(amount) FILTER (WHERE resource = 'Medical Kits') AS medical_kits, max(amount) FILTER (WHERE resource = 'ORS Packets') AS ors_packets,
        max(amount) FILTER (WHERE resource = 'Tarpaulin Sheets') AS tarpaulin_sheets, max(amount) FILTER (WHERE resource = 'Drinking Water') AS water_l,
        max(amount) FILTER (WHERE resource = 'Dry Rations') AS dry_rations_kg
        FROM alloc GROUP BY entity, affected_population""", FORECAST),
    "quantity_display": W(f"""SELECT entity, resource, amount,
        CASE WHEN amount > 1000 THEN printf('%.1fK', CAST(amount AS DOUBLE) / 1000.0::DOUBLE)
             ELSE CAST(amount AS VARCHAR) END AS display,
        {R('least(amount / 100000.0, 1.0)', 'progress')} FROM alloc""", FORECAST),
    "risk_tier": W(f"SELECT entity, {R('risk_score', 'risk_score')}, risk_tier FROM riskt", FORECAST),
    "kpi_row": W(f"""SELECT r.entity, {R('r.risk_3m', 'risk_3m')}, CASE WHEN round(r.risk_3m, 9) > 0.3 THEN 'High' ELSE 'Low' END AS risk_flag,
        {R('r.avg_demand', 'avg_demand')}, t5.events_5yr,
        CASE WHEN month(DATE '{C.TODAY}') IN (3, 4, 5) THEN 'Pre-Monsoon' WHEN month(DATE '{C.TODAY}') IN (6, 7, 8, 9) THEN 'Monsoon'
             WHEN month(DATE '{C.TODAY}') IN (10, 11) THEN 'Post-Monsoon' ELSE 'Winter' END AS current_season
        FROM (SELECT entity, avg(CASE WHEN step <= 3 THEN flood_probability END) AS risk_3m,
                     avg(CASE WHEN step <= {C.HORIZON_DAYS // 30 + 1} THEN expected_demand END) AS avg_demand FROM fcb GROUP BY entity) r
        LEFT JOIN t5 ON r.entity = t5.entity""", FORECAST),
    "entity_compare": W(f"""SELECT entity, CAST(sum(flood_occurrence) AS BIGINT) AS total_events, {R('avg(resource_demand_score)', 'mean_score')},
        {R('arg_min(dfsi, date) FILTER (WHERE dfsi IS NOT NULL)', 'dfsi')}, {R('arg_min(census_population, date) FILTER (WHERE census_population IS NOT NULL)', 'census_population')}
        FROM panel GROUP BY entity"""),
    "trailing_five_year": W("SELECT entity, events_5yr FROM t5", FORECAST),
    "history_forecast_union": W(f"""SELECT entity, date, {R('resource_demand_score', 'resource_demand_score')}, 'Historical' AS kind FROM panel
        UNION ALL SELECT entity, date, {R('expected_demand', 'resource_demand_score')}, 'Forecast' AS kind FROM fcb""", FORECAST),
    "top_risk_entities": W(f"SELECT entity, {R('risk_score', 'risk_score')}, risk_tier FROM riskt ORDER BY round(risk_score, 9) DESC, entity LIMIT 3", FORECAST),
    "escalation_flags": W(f"""SELECT entity, {R('risk_score', 'risk_score')}, risk_tier, round(risk_score, 9) > 0.3 AS mobilise, round(risk_score, 9) > 0.5 AS full_protocol,
        {R(f"CAST(CASE WHEN risk_tier = 'HIGH' THEN 0.6 WHEN month(DATE '{C.TODAY}') IN (3, 4, 5) THEN 0.3 ELSE 0.0 END AS DOUBLE)", 'preposition_share')}
        FROM riskt""", FORECAST),
    "trust_flag": W(f"""SELECT f.entity, e.n_events, {R('f.prob_upper - f.prob_lower', 'band_width')}, {R('f.flood_probability', 'flood_probability')},
        (e.n_events > 5 AND month(DATE '{C.TODAY}') IN (6, 7, 8, 9) AND round(f.prob_upper - f.prob_lower, 9) < round(0.5 * f.flood_probability, 9)) AS trusted
        FROM fcb f LEFT JOIN (SELECT entity, CAST(sum(flood_occurrence) AS BIGINT) AS n_events FROM panel GROUP BY entity) e ON f.entity = e.entity
        WHERE f.step = 1""", FORECAST),
    "kit_budget": W(f"""SELECT entity, kit, n_low, n_high, {R('n_low * cost', 'budget_low')}, {R('n_high * cost', 'budget_high')},
        {R('n_low * weight_kg', 'weight_low_kg')}, {R('n_high * weight_kg', 'weight_high_kg')}
        FROM (SELECT a.entity, k.kit, k.weight_kg, k.cost,
                     CAST(trunc(CASE WHEN k.kit = 'Medical Kit' THEN a.aff_lo / 1000.0 ELSE a.aff_lo / 5.0 END) AS BIGINT) AS n_low,
                     CAST(trunc(CASE WHEN k.kit = 'Medical Kit' THEN a.aff_hi / 1000.0 ELSE a.aff_hi / 5.0 END) AS BIGINT) AS n_high
              FROM (SELECT f.entity,
                           CAST(coalesce(p.total_population, 1500000) AS DOUBLE) * least(f.demand_lower / 10.0, 0.3) AS aff_lo,
                           CAST(coalesce(p.total_population, 1500000) AS DOUBLE) * least(f.demand_upper / 10.0, 0.3) AS aff_hi
                    FROM fcb f LEFT JOIN fpop p ON f.entity = p.entity WHERE f.step = 1) a,
                   (SELECT kit, CAST(weight_kg AS DOUBLE) AS weight_kg, CAST(cost AS DOUBLE) AS cost FROM (VALUES ('Medical Kit', 5.0, 1200.0), ('Family Kit', 25.0, 3500.0)) v(kit, weight_kg, cost)) k)""", FORECAST),
    "ts_split_folds": W("SELECT entity, year, month, row_idx, val_fold FROM pf", TARGETS, PANEL_FOLDS),
    "holdout_split": W("""SELECT entity, date, CAST(rn AS INTEGER) AS rn, n, CAST(floor(n * 0.8) AS INTEGER) AS n_train, rn <= floor(n * 0.8) AS is_train
        FROM (SELECT entity, date, row_number() OVER (PARTITION BY entity ORDER BY date) AS rn, count(*) OVER (PARTITION BY entity) AS n
              FROM tfin WHERE demand_target > 0)""", TARGETS),
    "fold_skip": W("SELECT fold, n_train, pos_train, n_val, pos_val, pos_val = 0 AS skipped FROM fcnt WHERE fold >= 0", TARGETS, PANEL_FOLDS),
    "class_weights": W(f"""SELECT fold, {R('CASE WHEN n_train - pos_train > 0 THEN n_train / (2.0 * (n_train - pos_train)) END', 'weight_neg')},
        {R('CASE WHEN pos_train > 0 THEN n_train / (2.0 * pos_train) END', 'weight_pos')},
        {R('(n_train - pos_train) / greatest(pos_train, 1)', 'scale_pos_weight')} FROM fcnt WHERE fold >= 0""", TARGETS, PANEL_FOLDS),
    "metric_regression": W(f"SELECT fold, {R('mae', 'mae')}, {R('rmse', 'rmse')}, {R('mape', 'mape')}, n_val FROM reg", ORDERS_FOLDS),
    "metric_roc_auc": W(f"SELECT fold, {R('roc_auc', 'roc_auc')} FROM roc", ORDERS_FOLDS),
    "metric_pr_auc": W(f"SELECT fold, {R('pr_auc', 'pr_auc')} FROM pr", ORDERS_FOLDS),
    "metric_classification": W(f"""SELECT fold, {R('CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0.0 END', 'accuracy')},
        {R('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END', 'precision')},
        {R('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END', 'recall')},
        {R('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END', 'f1')}
        FROM (SELECT fold, count(*) FILTER (WHERE score > 0.5 AND label = 1)::DOUBLE AS tp, count(*) FILTER (WHERE score > 0.5 AND label = 0)::DOUBLE AS fp,
                     count(*) FILTER (WHERE score <= 0.5 AND label = 1)::DOUBLE AS fn, count(*) FILTER (WHERE score <= 0.5 AND label = 0)::DOUBLE AS tn,
                     count(*)::DOUBLE AS n FROM sof GROUP BY fold)""", ORDERS_FOLDS),
    "fold_summary": W(f"""SELECT {R('c.avg_roc_auc', 'avg_roc_auc')}, {R('c.avg_pr_auc', 'avg_pr_auc')}, c.n_valid_folds,
        {R('r.avg_mae', 'avg_mae')}, {R('r.median_mae', 'median_mae')}, {R('r.std_mae', 'std_mae')}, {R('r.avg_mape', 'avg_mape')},
        {R('r.median_mape', 'median_mape')}, {R('r.avg_mape_all', 'avg_mape_all')}, {R('r.best_fold_mape', 'best_fold_mape')}, r.n_folds_used,
        c.avg_roc_auc >= 0.8 AS roc_gate, coalesce(r.avg_mape < 0.2, false) AS mape_gate
        FROM (SELECT coalesce(avg(CASE WHEN roc_auc > 0 THEN roc_auc END), 0.0) AS avg_roc_auc, coalesce(avg(pr_auc), 0.0) AS avg_pr_auc,
                     count(*) AS n_valid_folds FROM roc JOIN pr USING (fold)) c,
             (SELECT coalesce(avg(CASE WHEN mae > 0 THEN mae END), 0.0) AS avg_mae, coalesce(median(CASE WHEN mae > 0 THEN mae END), 0.0) AS median_mae,
                     stddev_pop(CASE WHEN mae > 0 THEN mae END) AS std_mae,
                     avg(CASE WHEN mape IS NOT NULL AND NOT isnan(mape) AND mape > 0.001 THEN mape END) AS avg_mape,
                     median(CASE WHEN mape IS NOT NULL AND NOT isnan(mape) AND mape > 0.001 THEN mape END) AS median_mape,
                     avg(CASE WHEN mape IS NOT NULL AND NOT isnan(mape) THEN mape END) AS avg_mape_all,
                     min(CASE WHEN mape IS NOT NULL AND NOT isnan(mape) AND mape > 0.001 THEN mape END) AS best_fold_mape,
                     count(*) FILTER (WHERE mae > 0) AS n_folds_used FROM reg) r""", ORDERS_FOLDS),
    "source_counts": W("""SELECT count(*) AS n_events, count(*) FILTER (WHERE districts IS NOT NULL) AS n_events_with_list,
        count(DISTINCT state) AS n_states, min(start_date) AS min_date, max(start_date) AS max_date, (SELECT count(*) FROM dom) AS n_entities FROM ev"""),
    "year_distribution": W(f"""SELECT y.year, y.n_events, y.year < {int(START[:4])} AS pre_cutoff, CAST(floor(y.year / 10) * 10 AS INTEGER) AS decade,
        t.n_valid_year, t.n_pre_cutoff, t.n_post_cutoff, t.n_with_list
        FROM (SELECT CAST(year(start_date) AS INTEGER) AS year, count(*) AS n_events FROM ev WHERE start_date IS NOT NULL GROUP BY 1) y,
             (SELECT count(*) FILTER (WHERE start_date IS NOT NULL) AS n_valid_year, count(*) FILTER (WHERE year(start_date) < {int(START[:4])}) AS n_pre_cutoff,
                     count(*) FILTER (WHERE year(start_date) >= {int(START[:4])}) AS n_post_cutoff, count(*) FILTER (WHERE districts IS NOT NULL) AS n_with_list FROM ev) t"""),
    "coverage_counts": W(f"""SELECT c.candidate, (SELECT count(*) FROM ev WHERE districts IS NOT NULL AND contains(lower(districts), lower(c.candidate))) AS n_texts
        FROM (SELECT entity AS candidate FROM dom UNION ALL SELECT * FROM (VALUES {", ".join(f"('{a}')" for a in SPEC.alias)}) v(candidate)) c"""),
    "event_months_by_entity": W("SELECT entity, count(*) FILTER (WHERE flood_occurrence > 0) AS event_months, count(*) AS total_months FROM up GROUP BY entity"),
    "name_variants": W("""SELECT f.entity, v.variant, coalesce(c.n, 0) AS n_variants
        FROM (SELECT DISTINCT entity FROM fam) f
        LEFT JOIN (SELECT DISTINCT fam.entity, p.part AS variant FROM fam JOIN (SELECT DISTINCT part FROM recs) p
                   ON contains(lower(p.part), fam.probe)) v ON f.entity = v.entity
        LEFT JOIN (SELECT entity, count(DISTINCT p.part) AS n FROM fam JOIN (SELECT DISTINCT part FROM recs) p
                   ON contains(lower(p.part), fam.probe) GROUP BY entity) c ON f.entity = c.entity""",
        "fam AS (SELECT * FROM (VALUES " + ", ".join([f"('{c}', '{c.lower()}')" for c in sorted(set(SPEC.alias.values()))] + [f"('{c}', '{a.lower()}')" for a, c in SPEC.alias.items()]) + ") v(entity, probe))"),
    "event_trace": W(f"""SELECT r.event_id, substring(r.districts, 1, 200) AS list_prefix, r.pos, r.part, {title('r.part')} AS normalized, r.entity,
        r.entity IN (SELECT entity FROM dom) AS in_domain
        FROM recs r WHERE year(r.start_date) = {C.TRACE_YEAR} AND contains(lower(r.districts), '{C.TRACE_NEEDLE}')"""),
    "csv_roundtrip": W(f"SELECT event_id, start_date, state, districts, {R('severity', 'severity')} FROM ev"),
    "csv_typed": W(f"""SELECT status, count(*) AS n, count(*) FILTER (status = 'good' AND severity IS NULL) AS n_missing,
        {R("sum(severity) FILTER (status = 'good')", 'sum_severity')}, CAST(0 AS BIGINT) AS n_odd
        FROM (SELECT severity, CASE WHEN event_id % 23 = 0 THEN 'severity' WHEN event_id % 29 = 0 THEN 'malformed' ELSE 'good' END AS status FROM ev)
        GROUP BY status"""),
    "profile_summary": W(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, {R(f'avg({c})', 'mean')}, {R(f'stddev_samp({c})', 'std')},
        {R(f'CAST(min({c}) AS DOUBLE)', 'min')}, {R(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 'p25')}, {R(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 'p50')},
        {R(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 'p75')}, {R(f'CAST(max({c}) AS DOUBLE)', 'max')} FROM panel"""
        for c in ("flood_occurrence", "resource_demand_score", "severity", "dfsi", "census_population"))),
    "default_columns": W(f"SELECT entity, year, month, {R('severity', 'severity')}, 0.0::DOUBLE AS duration, NULL::DOUBLE AS area_affected FROM up"),
    "json_paths": "WITH " + EVENT_DOCUMENTS + """
        SELECT regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[]', 'g') AS path,
               CASE WHEN t.type IN ('OBJECT', 'ARRAY', 'BOOLEAN', 'NULL') THEN lower(t.type) WHEN t.type = 'VARCHAR' THEN 'string' ELSE 'number' END AS kind,
               count(*) AS n FROM docs, json_tree(doc) t GROUP BY 1, 2
        UNION ALL SELECT '', 'malformed', count(*) FROM events WHERE event_type = 'error'""",
    "json_fields": "WITH " + EVENT_DOCUMENTS + f"""
        SELECT CAST(doc->>'$.event_id' AS BIGINT) AS event_id, CAST(doc->>'$.properties.detail.k' AS BIGINT) AS k, doc->>'$.properties.tags[1]' AS second_tag,
               doc->>'$.geometry.type' AS shape, {R("CAST(doc->>'$.geometry.coordinates[0]' AS DOUBLE)", 'lon')}, doc->>'$.properties.none' AS absent FROM docs""",
    "file_order_last": W("SELECT state, event_id, date_text FROM (SELECT state, event_id, strftime(start_date, '%-d/%-m/%Y') AS date_text, row_number() OVER (PARTITION BY state ORDER BY event_id DESC) AS k FROM ev) WHERE k = 1"),
    "source_profile_exact": W(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_nulls, CAST(min({c}) AS VARCHAR) AS least FROM ev"""
                              for c in ("event_id", "start_date", "state", "districts", "fatalities"))),
    "jsonl_scan": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        array_to_string(list_sort(json_keys(props)), ',') AS property_keys FROM events WHERE event_type <> 'error'""",
    "panel_sink": W(f"SELECT {sel(PANEL_COLS, PANEL_DOUBLES)} FROM panel"),
}
