"""Independent SQL for the registered queries, for DuckDB on the same tables.

Written from the rules, row by row and without the shortcuts the Spark side takes:
every window test compares each event with time zero by whole hours, ranks are
plain ``row_number`` and anti-joins are ``NOT EXISTS``.
"""

from __future__ import annotations

# Clinical tables derived from events and customer, as in encounters.py.
_CLINICAL = """
ev AS (SELECT *, user_id AS subject_id, user_id * 10 + (day(ts) - 1) // 7 AS hadm_id FROM events),
adm AS (SELECT subject_id, hadm_id, min(ts) AS admittime FROM ev GROUP BY ALL),
pat AS (SELECT c_custkey AS subject_id, DATE '1950-01-01' + (c_custkey * 7919 % 24000)::INT AS dob
        FROM customer),
dx AS (SELECT subject_id, hadm_id, ['99591', '99592', '78552', '4019', '0389', '99592', '78552'][1 + event_id % 7] AS code
       FROM ev WHERE event_type = 'signup'),
stay AS (SELECT subject_id, hadm_id, event_id AS icustay_id, ts AS intime
         FROM ev WHERE event_type = 'signup' AND event_id % 4 = 0),
micro AS (SELECT subject_id, hadm_id, [70012, 70079, 70012, 70013, 70012][1 + event_id % 5] AS spec,
                 ['BLOOD CULTURE', 'URINE', 'BLOOD CULTURE', 'Fluid (blood)', 'Blood culture'][1 + event_id % 5] AS kind,
                 if(event_id % 11 = 3, NULL, ts) AS ts, ts::DATE AS day FROM ev WHERE event_type = 'error'),
cul AS (SELECT subject_id, hadm_id, ts FROM micro WHERE spec = 70012 AND ts IS NOT NULL),
pre AS (SELECT subject_id, hadm_id, ts, ts::DATE::TIMESTAMP + INTERVAL 12 HOUR AS noon,
               ['CefePIME', 'Aspirin', 'Vancomycin 1 g', NULL, 'PIPERACILLIN-Tazobactam', 'Heparin', 'Zosyn', 'cefepime', 'Linezolid',
                NULL][1 + event_id % 10] AS drug,
               [NULL, 'Meropenem', NULL, 'cefazolin', NULL, NULL, 'UNASYN', 'insulin', NULL, NULL, 'Aztreonam'][1 + event_id % 11] AS poe,
               ['Cefepime', NULL, 'vancomycin HCl', 'heparin', NULL, 'PiperaciLLin', 'Vancomycin', 'aspirin',
                'ceftriaxone'][1 + event_id % 9] AS generic
        FROM ev WHERE event_type = 'purchase'),
rx AS (FROM pre WHERE regexp_matches(drug, 'cefepime|vancomycin|piperacillin', 'i')),
rxs AS (FROM pre WHERE regexp_matches(concat_ws(' / ', drug, generic), 'cefepime|vancomycin|piperacillin', 'i')),
labs AS (SELECT subject_id, hadm_id, ts, if(event_id % 13 = 5, NULL, value / 25) AS v, event_id,
                [50813, 50954, 50813, 51222, 50813, 50885, 50813][1 + event_id % 7] AS item
         FROM ev WHERE event_type = 'view'),
lab AS (FROM labs WHERE item = 50813),
chart AS (SELECT subject_id, hadm_id, ts, if(event_id % 17 = 6, NULL, value) AS v, event_id,
                 [30061, 221906, 52, 30062, 221289, 456, 30063, 221749, 6702, 30064, 222315, 443, 30061, 221662, 220052, 30062, 220045,
                  220181, 30063, 221906, 225312, 221653, 51, 220050][1 + event_id % 24] AS item
          FROM ev WHERE event_type = 'click'),
wt AS (SELECT subject_id, hadm_id, ts, value AS v, event_id FROM ev WHERE event_type = 'click')"""

_COHORT = f"""{_CLINICAL},
coh AS (
  SELECT adm.subject_id, adm.hadm_id, adm.admittime,
         (year(adm.admittime) - year(pat.dob))::INT AS age_at_admission,
         max((code = '99592')::INT) AS severe_sepsis, max((code = '78552')::INT) AS septic_shock
  FROM adm JOIN pat USING (subject_id) JOIN dx USING (subject_id, hadm_id)
  WHERE code IN ('99591', '99592', '78552') AND year(adm.admittime) - year(pat.dob) >= 18
  GROUP BY ALL),
z AS (
  SELECT coh.*, c.t AS first_culture, r.t AS first_antibiotic,
         coalesce(least(c.t, r.t), TIMESTAMP '9999-12-31') AS t0
  FROM coh
  LEFT JOIN (SELECT hadm_id, min(ts) AS t FROM cul GROUP BY 1) c USING (hadm_id)
  LEFT JOIN (SELECT hadm_id, min(noon) AS t FROM rx GROUP BY 1) r USING (hadm_id))"""


def _any(table: str, condition: str) -> str:
    return f"(SELECT coalesce(max(({condition})::INT), 0) FROM {table} x WHERE x.hadm_id = z.hadm_id)"


_H = "date_sub('hour', z.t0, x.ts)"
_STEPS = f"""{_COHORT},
st AS (
  SELECT z.*,
    {_any('lab', f'{_H} <= 3')} AS lactate_measured_3h,
    (SELECT max(x.v) FROM lab x WHERE x.hadm_id = z.hadm_id AND {_H} <= 3) AS initial_lactate_value,
    {_any('cul', f'{_H} <= 3')} AS blood_culture_3h,
    {_any('rx', "date_sub('hour', z.t0, x.noon) <= 3")} AS antibiotics_3h,
    {_any('chart', f'{_H} <= 3 AND x.item IN (30061, 30062, 30063)')} AS fluids_administered_3h,
    {_any('lab', f'{_H} BETWEEN 3 AND 6')} AS repeat_lactate_6h,
    {_any('chart', f'{_H} <= 6 AND x.item IN (221906, 221289, 221749, 222315, 221662)')} AS vasopressors_administered_6h,
    {_any('chart', f'{_H} BETWEEN 3 AND 6 AND x.item IN (52, 456, 6702, 443, 220052, 220181, 225312) AND x.v < 65')}
      AS persistent_hypotension_6h
  FROM z)"""


def _bundles(source: str) -> str:
    """Composite flags by arithmetic on 0/1 columns; ``six`` is the ungated 6-hour flag."""
    return f"""
bu AS (
  SELECT *, lactate_measured_3h * blood_culture_3h * antibiotics_3h AS basic,
         coalesce(initial_lactate_value, 0) AS lac,
         CASE severe_sepsis + 2 * septic_shock WHEN 0 THEN 'none' WHEN 2 THEN 'shock'
              ELSE 'severe' END AS path
  FROM {source}),
co AS (
  SELECT *,
    CASE path WHEN 'severe' THEN basic WHEN 'shock' THEN basic * fluids_administered_3h
              ELSE 0 END AS three,
    CASE path WHEN 'severe' THEN (lac <= 2 OR repeat_lactate_6h = 1)::INT
              WHEN 'shock' THEN vasopressors_administered_6h
                                * (persistent_hypotension_6h = 1 OR lac >= 4)::INT
              ELSE 0 END AS six
  FROM bu)"""


def _flag_columns(t0: str = "t0") -> str:
    return f"""subject_id, hadm_id, age_at_admission, severe_sepsis, septic_shock,
  nullif({t0}, TIMESTAMP '9999-12-31') AS sepsis_time_zero,
  lactate_measured_3h, initial_lactate_value, blood_culture_3h, antibiotics_3h,
  if(septic_shock = 1, fluids_administered_3h, NULL) AS fluids_administered_3h,
  if(severe_sepsis = 1, repeat_lactate_6h, NULL) AS repeat_lactate_6h,
  if(septic_shock = 1, vasopressors_administered_6h, NULL) AS vasopressors_administered_6h,
  if(septic_shock = 1, persistent_hypotension_6h, NULL) AS persistent_hypotension_6h"""


_BASELINE = f"""WITH {_STEPS}, {_bundles('st')}
SELECT {_flag_columns()}, three AS bundle_complete_3h, six AS bundle_complete_6h,
  (three * six) AS bundle_complete_overall
FROM co"""

# Severity from flags and codes together; antibiotic from its true start, half-open window.
_FINAL_CTES = f"""{_STEPS},
code AS (SELECT hadm_id, max((code = '78552')::INT) AS shock, max((code IN ('99592', '78552'))::INT) AS either
         FROM dx GROUP BY 1),
fx AS (
  SELECT st.* REPLACE (
    (CASE WHEN st.severe_sepsis = 1 THEN st.septic_shock = 0
          ELSE c.either = 1 AND c.shock = 0 END)::INT AS severe_sepsis,
    greatest(st.septic_shock, c.shock) AS septic_shock,
    (EXISTS (FROM rxs WHERE rxs.hadm_id = st.hadm_id AND rxs.ts >= st.t0
             AND rxs.ts < st.t0 + INTERVAL 3 HOUR))::INT AS antibiotics_3h)
  FROM st JOIN code c USING (hadm_id)),
{_bundles('fx')}"""
_FINAL = f"""WITH {_FINAL_CTES}
SELECT {_flag_columns()}, three AS bundle_complete_3h, three * six AS bundle_complete_6h,
  three * six AS bundle_complete_overall
FROM co"""


def _md5(*parts: str) -> str:
    return f"concat('0x', substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"


_MONTHS = "om AS (SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS month_key FROM orders)"
_RATES = f"""ra AS (
  SELECT month_key,
    (38 + {_md5('month_key', '101')} % 31) / 100.0::DOUBLE AS p_pass3,
    (29 + {_md5('month_key', '202')} % 22) / 100.0::DOUBLE AS p_shock,
    (51 + {_md5('month_key', '303')} % 19) / 100.0::DOUBLE AS p_pass6
  FROM (SELECT DISTINCT month_key FROM om))"""


def _chosen(name: str, source: str, rate: str, salt: int, jitter: int) -> str:
    return f"""{name} AS (
  SELECT o_orderkey, month_key
  FROM (SELECT o_orderkey, month_key,
               row_number() OVER (PARTITION BY month_key
                 ORDER BY {_md5('o_orderkey', 'month_key', str(salt))}, o_orderkey) AS rn,
               count(*) OVER (PARTITION BY month_key) AS cnt
        FROM {source}) JOIN ra USING (month_key)
  WHERE rn <= greatest(0, least(cnt,
          floor({rate} * cnt)::BIGINT + {_md5('month_key', str(jitter))} % 3 - 1)))"""


_SHOCK_CHOICE = _chosen("sh", "om", "p_shock", 5150, 31)
_GROUPS = f"""{_MONTHS}, {_RATES}, {_SHOCK_CHOICE}, {_chosen('p3', 'om', 'p_pass3', 5150, 33)},
{_chosen('p6', 'sh', 'p_pass6', 6160, 32)}"""
_MEMBER = ", ".join(
    f"(o_orderkey IN (SELECT o_orderkey FROM {t}))::INT AS {name}"
    for name, t in {"pass3": "p3", "shock": "sh", "pass6": "p6"}.items()
)
_PATTERNS = "n LIKE '%economy%' OR n LIKE '%brand#1%' OR n LIKE '%red%' OR n LIKE '%large%' OR n LIKE '%s%g%'"
_NAMES = "SELECT lower(unnest([p_name, p_type, p_brand])) AS n FROM part"
_DAY_LABS = """dl AS (SELECT event_id, hadm_id, ts::DATE AS chartday,
  (50813 + event_id % 2)::INT AS itemid, v AS valuenum FROM labs)"""


_ANTIBIOTICS = (
    "cefepime|ceftazidime|piperacillin|tazobactam|zosyn|meropenem|imipenem|doripenem|aztreonam|levofloxacin|ciprofloxacin|"
    "moxifloxacin|vancomycin|linezolid|daptomycin|ampicillin/sulbactam|unasyn|ticarcillin|clavulanate"
)
# Dictionary labels in the order of the parts' remainders.
_LABELS = """['Admission Weight (Kg)', 'Daily Weight', 'Height', 'WEIGHT change', 'Weighted score', 'Mean BP', 'Arterial Mean Blood BP',
  'ART BP Mean', 'Non Invasive Blood Pressure mean', 'MAP (mmHg)', 'Bitmap', 'Normal Saline 500 ml', 'NaCl 0.9%', 'Na Cl 0.9%',
  'Sodium Chloride 0.9%  (Flush)', 'Sodium Chloride 0.45%', 'Lactated Ringers', 'Ringer''s Lactate', 'Ringers solution', 'Plasma-Lyte A',
  'Plasma', '0.9% saline', 'Norepinephrine', 'LEVOPHED drip', 'Epinephrine', 'Vasopressin', 'Dopamine', 'Dobutamine',
  'Phenylephrine 10 mg', 'Ephedrine']"""


def _items(labels: str) -> str:
    """Dictionary items with one of the labels."""
    return f"""
SELECT itemid, label FROM (SELECT p_partkey::INT AS itemid, {_LABELS}[1 + p_partkey % 30] AS label FROM part)
WHERE label IN ({labels})"""


def _raised(extra: str) -> str:
    return f"""WITH {_CLINICAL}, {_DAY_LABS},
f AS (SELECT hadm_id, min(chartday) AS chartday FROM dl WHERE itemid = 50813
      AND hadm_id IN (SELECT hadm_id FROM dx WHERE code = '78552') GROUP BY 1)
SELECT dl.event_id, dl.hadm_id, dl.chartday, dl.itemid,
  CASE WHEN f.hadm_id IS NOT NULL {extra} AND (dl.valuenum IS NULL OR dl.valuenum < 4) THEN 4.3
       ELSE dl.valuenum END AS valuenum
FROM dl LEFT JOIN f USING (hadm_id, chartday)"""


ORACLES: dict[str, str] = {
    "concept_search": """
SELECT DISTINCT p_partkey, p_name, p_type FROM part
WHERE p_name SIMILAR TO '.*(red|blue).*' AND NOT contains(p_name, 'bolt')""",
    "concept_search_wildcards": """
SELECT DISTINCT p_name, p_brand FROM part
WHERE regexp_matches(lower(p_name), 're.* b.*t') OR regexp_matches(lower(p_name), 's.*l.*ring')""",
    "concept_search_all_rows": "SELECT p_name, p_type FROM part WHERE contains(lower(p_name), 'widget')",
    "concept_counts": """
SELECT p_partkey, p_name, count(*)::BIGINT AS n FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_name LIKE '%ring%' AND p_name NOT LIKE '%small%' GROUP BY ALL""",
    "label_codes": """
SELECT l_orderkey, l_linenumber, p_partkey, p_name, l_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "coded_admissions": """
SELECT o_orderkey, o_custkey, o_orderdate, p_partkey, p_name, p_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE p_name LIKE '%red%' OR p_name LIKE '%small ring%'""",
    "alias_inventory": f"SELECT DISTINCT n AS name, 1::BIGINT AS cnt FROM ({_NAMES}) WHERE {_PATTERNS}",
    "alias_inventory_counts": f"""
SELECT n AS name, count(*)::BIGINT AS cnt FROM ({_NAMES}) WHERE {_PATTERNS} GROUP BY n""",
    "value_sample": f"""
WITH {_CLINICAL} SELECT hadm_id, ts AS charttime, 50813::INT AS itemid, v AS valuenum,
  'mmol/L' AS valueuom FROM lab ORDER BY ts, event_id LIMIT 200""",
    "first_event": """
SELECT user_id AS subject_id, min(if(event_id % 5 = 0, ts::DATE::TIMESTAMP, ts)) AS first_time
FROM events WHERE event_type = 'error' GROUP BY 1""",
    "first_event_top": f"""
WITH {_CLINICAL} SELECT subject_id, hadm_id, min(coalesce(ts, day::TIMESTAMP)) AS first_time FROM micro
GROUP BY ALL ORDER BY first_time, subject_id, hadm_id LIMIT 100""",
    "nearest_measurement": f"""
WITH {_CLINICAL},
w AS (SELECT hadm_id, ts, event_id, event_id % 2 AS lb,
             CASE event_id % 2 WHEN 0 THEN v ELSE v * 0.453592 END AS kg FROM wt)
SELECT subject_id, hadm_id, icustay_id, intime, ts AS charttime,
       round(kg::DECIMAL(18, 8), 1)::DOUBLE AS weight_kg
FROM (FROM stay QUALIFY row_number() OVER (PARTITION BY hadm_id ORDER BY intime, icustay_id) = 1)
JOIN w USING (hadm_id) WHERE kg >= 30 AND kg <= 300
QUALIFY row_number() OVER (PARTITION BY icustay_id
  ORDER BY lb, abs(date_sub('hour', intime, ts)), ts, w.event_id) = 1""",
    "adult_cohort": f"""
WITH {_COHORT} SELECT coh.*, (icustay_id IS NOT NULL)::INT AS in_icu
FROM coh LEFT JOIN stay USING (subject_id, hadm_id)""",
    "adult_cohort_by_admission": f"""
WITH {_COHORT} SELECT coh.*, (hadm_id IN (SELECT hadm_id FROM stay))::INT AS in_icu FROM coh""",
    "time_zero": f"""
WITH {_COHORT} SELECT subject_id, hadm_id, first_culture, first_antibiotic,
  nullif(t0, TIMESTAMP '9999-12-31') AS sepsis_time_zero FROM z""",
    "time_zero_null": f"""
WITH {_STEPS} SELECT subject_id, hadm_id, nullif(t0, TIMESTAMP '9999-12-31') AS sepsis_time_zero,
  if(year(t0) = 9999, 0, lactate_measured_3h) AS lactate_measured_3h,
  if(year(t0) = 9999, 0, vasopressors_administered_6h) AS vasopressors_administered_6h FROM st""",
    "other_measure": f"""
WITH {_CLINICAL},
c AS (
  SELECT adm.subject_id, adm.hadm_id, (year(admittime) - year(dob))::INT AS age_at_admission,
         max((code = '4019')::INT) AS hypertension, max((code = '0389')::INT) AS septicemia
  FROM adm JOIN pat USING (subject_id) JOIN dx USING (subject_id, hadm_id)
  WHERE code IN ('4019', '0389') AND year(admittime) - year(dob) >= 18 GROUP BY ALL),
z AS (
  SELECT c.*, t AS t0 FROM c
  LEFT JOIN (SELECT hadm_id, min(coalesce(ts, day::TIMESTAMP)) AS t FROM micro WHERE spec = 70012 GROUP BY 1) m USING (hadm_id)),
p AS (SELECT hadm_id, ts, v FROM chart WHERE item IN (52, 456, 6702, 443, 220052, 220181, 225312)),
s AS (
  SELECT z.*,
    {_any('p', "x.ts >= z.t0 AND x.ts < z.t0 + INTERVAL 24 HOUR AND x.v >= 60")} AS high_pressure_24h,
    {_any('p', "x.ts >= z.t0 AND x.ts < z.t0 + INTERVAL 24 HOUR AND x.v <= 30")} AS low_pressure_24h,
    {_any('chart', f"{_H} <= 12 AND x.item IN (221906, 221289, 221749, 222315, 221662)")} AS vp,
    {_any('lab', f"{_H} <= 24 AND x.v > 2")} AS lactate_above_2
  FROM z),
t AS (SELECT *, CASE WHEN septicemia = 1 THEN vp WHEN hypertension = 1 THEN 1 - high_pressure_24h ELSE 0 END AS treated FROM s)
SELECT subject_id, hadm_id, age_at_admission, hypertension, septicemia, t0 AS first_culture_time, high_pressure_24h, low_pressure_24h,
  if(septicemia = 1, vp, NULL) AS vasopressor_12h, lactate_above_2, treated,
  (treated = 1 AND high_pressure_24h = 0 AND low_pressure_24h = 0)::INT AS steady FROM t""",
    "strict_measure": f"""
WITH {_STEPS},
f AS (SELECT z.hadm_id, sum(x.v) AS ml FROM z JOIN chart x ON x.hadm_id = z.hadm_id
      WHERE {_H} <= 3 AND x.item IN (30061, 30062, 30063) GROUP BY 1),
w AS (SELECT z.hadm_id, max(x.v) AS kg FROM z JOIN wt x ON x.hadm_id = z.hadm_id
      WHERE {_H} <= 1000 AND x.event_id % 2 = 0 GROUP BY 1),
d AS (SELECT st.*, ml, kg, (first_culture IS NOT NULL AND (first_antibiotic IS NULL OR first_culture <= first_antibiotic))::INT AS cf,
        coalesce(kg > 0 AND ml / kg >= 2, false)::INT AS ef
      FROM st LEFT JOIN f USING (hadm_id) LEFT JOIN w USING (hadm_id))
SELECT subject_id, hadm_id, round(ml, 6) AS fluid_ml_3h, kg AS weight_kg, cf AS culture_first, ef AS enough_fluid,
  blood_culture_3h * cf * ef AS strict_3h FROM d""",
    "family_events": f"""
WITH {_CLINICAL}, e AS (
  SELECT 'culture' AS family, ts, NULL::DOUBLE AS v FROM micro WHERE spec = 70012
  UNION ALL SELECT 'antibiotic', noon, NULL FROM rx UNION ALL SELECT 'antibiotic_start', ts, NULL FROM rxs
  UNION ALL SELECT 'lactate', ts, v FROM labs WHERE item = 50813
  UNION ALL SELECT 'fluid', ts, v FROM chart WHERE item IN (30061, 30062, 30063)
  UNION ALL SELECT 'vasopressor', ts, v FROM chart WHERE item IN (221906, 221289, 221749, 222315, 221662)
  UNION ALL SELECT 'pressure', ts, v FROM chart WHERE item IN (52, 456, 6702, 443, 220052, 220181, 225312))
SELECT family, ts::DATE AS day, count(*) AS n, round(sum(v), 3) AS total FROM e GROUP BY ALL""",
    "window_flags": f"""
WITH {_STEPS} SELECT subject_id, hadm_id, lactate_measured_3h, initial_lactate_value,
  blood_culture_3h, antibiotics_3h, fluids_administered_3h, repeat_lactate_6h,
  vasopressors_administered_6h, persistent_hypotension_6h FROM st""",
    "window_values": f"""
WITH {_COHORT} SELECT z.subject_id, z.hadm_id, max(x.v) AS max_lactate, first(x.v ORDER BY x.ts, x.v) FILTER (x.v IS NOT NULL) AS first_lactate
FROM z LEFT JOIN lab x ON x.hadm_id = z.hadm_id AND {_H} <= 3 GROUP BY ALL""",
    "half_open_flags": f"""
WITH {_COHORT} SELECT subject_id, hadm_id, (hadm_id IN (SELECT rxs.hadm_id FROM rxs
  JOIN z y USING (hadm_id) WHERE rxs.ts >= y.t0 AND rxs.ts < y.t0 + INTERVAL 3 HOUR))::INT
  AS antibiotics_3h FROM z""",
    "code_status": f"""
WITH {_CLINICAL} SELECT hadm_id, max((code = '78552')::INT) AS shock_icd,
  max((code IN ('99592', '78552'))::INT) AS sepsis_icd FROM dx GROUP BY 1""",
    "reconcile_status": f"""
WITH {_CLINICAL},
b AS (SELECT subject_id, hadm_id, max((icustay_id % 8 = 0)::INT) AS sev,
             coalesce(max((icustay_id % 3 = 0)::INT) FILTER (icustay_id % 3 <> 1), 0) AS sho
      FROM stay GROUP BY ALL),
c AS (SELECT hadm_id, bool_or(code = '78552') AS shock, bool_or(code IN ('99592', '78552')) AS either
      FROM dx GROUP BY 1)
SELECT subject_id, hadm_id,
  (CASE WHEN sev = 1 THEN sho = 0 ELSE coalesce(either AND NOT shock, false) END)::INT AS severe_sepsis,
  (sho = 1 OR coalesce(shock, false))::INT AS septic_shock
FROM b LEFT JOIN c USING (hadm_id)""",
    "masked_components": f"""
WITH {_STEPS} SELECT subject_id, hadm_id, severe_sepsis, septic_shock,
  if(septic_shock = 1, fluids_administered_3h, NULL) AS fluids_administered_3h,
  if(severe_sepsis = 1, repeat_lactate_6h, NULL) AS repeat_lactate_6h,
  if(septic_shock = 1, vasopressors_administered_6h, NULL) AS vasopressors_administered_6h,
  if(septic_shock = 1, persistent_hypotension_6h, NULL) AS persistent_hypotension_6h FROM st""",
    "composites": f"""
WITH {_STEPS}, {_bundles('st')}
SELECT subject_id, hadm_id, three AS bundle_complete_3h, six AS bundle_complete_6h,
  three * six AS bundle_complete_overall, three * six AS gated_6h FROM co""",
    "baseline_flags": f"SELECT f.* FROM ({_BASELINE}) f LEFT JOIN (WITH {_CLINICAL} FROM stay) s USING (hadm_id)",
    "baseline_flags_by_admission": _BASELINE,
    "final_flags": _FINAL,
    "published_view": _FINAL,
    "published_table": _FINAL,
    "final_flags_by_stay": f"SELECT f.* FROM ({_FINAL}) f LEFT JOIN (WITH {_CLINICAL} FROM stay) s USING (hadm_id)",
    "update_same_names": """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 1 AND p_partkey % 3 <> 0 THEN p_retailprice + 5 ELSE p_retailprice END AS p_retailprice
FROM part""",
    "hash_rank_null_stratum": f"""
WITH l AS (SELECT o_orderkey, if(o_custkey % 10 <> 0, o_orderpriority, NULL) AS priority FROM orders)
SELECT o_orderkey, priority, row_number() OVER (PARTITION BY priority ORDER BY {_md5('o_orderkey', 'priority', '77')}, o_orderkey) AS rn,
  count(*) OVER (PARTITION BY priority) AS cnt FROM l""",
    "snapshot_parquet": _FINAL,
    "snapshot_csv": _FINAL,
    "cohort_summary": f"""
WITH {_FINAL_CTES} SELECT count(*)::BIGINT AS cohort, sum(three)::BIGINT AS pass3,
  sum(septic_shock)::BIGINT AS shock, sum(three * six)::BIGINT AS pass6 FROM co""",
    "period_cohort": """
WITH f AS (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem
           WHERE l_linestatus = 'F' GROUP BY 1)
SELECT DISTINCT o_custkey, o_orderkey, o_orderdate, first_ship
FROM orders JOIN f ON l_orderkey = o_orderkey
JOIN (FROM lineitem WHERE l_returnflag = 'R') r ON r.l_orderkey = o_orderkey
WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1998-04-01'
  AND date_diff('day', o_orderdate, first_ship) BETWEEN 0 AND 365""",
    "stratum_rates": f"WITH {_MONTHS}, {_RATES} FROM ra",
    "hash_rank": f"""
WITH {_MONTHS} SELECT o_orderkey, month_key,
  row_number() OVER (PARTITION BY month_key
    ORDER BY {_md5('o_orderkey', 'month_key', '5150')}, o_orderkey) AS rn,
  count(*) OVER (PARTITION BY month_key) AS cnt FROM om""",
    "select_fraction": f"WITH {_MONTHS}, {_RATES}, {_SHOCK_CHOICE} FROM sh",
    "select_nested": f"WITH {_MONTHS}, {_RATES}, {_SHOCK_CHOICE}, {_chosen('p6', 'sh', 'p_pass6', 6160, 32)} FROM p6",
    "group_flags": f"WITH {_GROUPS} SELECT o_orderkey, month_key, {_MEMBER} FROM om",
    "group_summary": f"""
WITH {_GROUPS}, m AS (SELECT {_MEMBER} FROM om)
SELECT count(*)::BIGINT AS cohort, sum(pass3)::BIGINT AS pass3, sum(shock)::BIGINT AS shock,
  sum(pass6)::BIGINT AS pass6 FROM m""",
    "surrogate_ids": """
SELECT o_orderkey, (SELECT max(o_orderkey) + 100 FROM orders)
  + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS new_id FROM orders""",
    "month_grid": f"""
WITH {_MONTHS}, g AS (SELECT month_key, unnest(generate_series(1, greatest(1, count(*) // 10))) AS n
                      FROM om GROUP BY month_key)
SELECT month_key, n, (SELECT max(o_orderkey) + 100 FROM orders)
  + row_number() OVER (ORDER BY month_key, n) AS new_id FROM g""",
    "scalar_summary": "SELECT coalesce(max(o_orderkey), 1000000) AS max_value, count(*) AS n FROM orders",
    "append_absent": f"""
WITH {_CLINICAL},
new AS (SELECT subject_id, hadm_id,
               admittime + to_minutes((12 + {_md5('hadm_id', '41')} % 17)::INT) AS charttime
        FROM adm WHERE hadm_id IN (SELECT hadm_id FROM dx WHERE code = '99592')
          AND NOT EXISTS (FROM micro WHERE micro.hadm_id = adm.hadm_id))
SELECT subject_id, hadm_id, spec::INT AS spec_itemid, kind AS spec_type_desc,
       ts AS charttime, day AS chartdate FROM micro
UNION ALL
SELECT subject_id, hadm_id, 70012::INT, NULL, charttime, charttime::DATE FROM new""",
    "append_absent_code": f"""
WITH {_CLINICAL}
SELECT subject_id, hadm_id, code AS icd9_code FROM dx
UNION ALL
SELECT DISTINCT subject_id, hadm_id, '78552' FROM micro
WHERE NOT EXISTS (FROM dx WHERE dx.hadm_id = micro.hadm_id AND dx.code = '78552')""",
    "append_absent_range": f"""
WITH {_CLINICAL}
SELECT subject_id, hadm_id, ts AS charttime, item::INT AS itemid, v AS valuenum FROM chart
UNION ALL
SELECT subject_id, hadm_id, admittime + to_minutes((95 + {_md5('hadm_id', '44')} % 50)::INT),
       (30061 + {_md5('hadm_id', '45')} % 3)::INT, 1000.0::DOUBLE
FROM adm WHERE NOT EXISTS (FROM chart WHERE chart.hadm_id = adm.hadm_id AND item IN (30061, 30062, 30063)
  AND ts BETWEEN admittime - INTERVAL 1 HOUR AND admittime + INTERVAL 6 HOUR)""",
    "drug_names": f"""
WITH {_CLINICAL}, n AS (SELECT lower(unnest([drug, poe, generic])) AS name FROM pre)
SELECT name, count(*) AS cnt FROM n WHERE regexp_matches(name, '{_ANTIBIOTICS}') GROUP BY name""",
    "drug_names_found": f"""
WITH {_CLINICAL}, n AS (SELECT lower(unnest([drug, poe, generic])) AS name FROM pre)
SELECT DISTINCT name, 1::BIGINT AS cnt FROM n WHERE regexp_matches(name, '{_ANTIBIOTICS}')""",
    "blood_specimens": f"""
WITH {_CLINICAL} SELECT DISTINCT spec::INT AS spec_itemid, kind AS spec_type_desc FROM micro WHERE contains(lower(kind), 'blood')""",
    "sepsis_admissions": f"""
WITH {_CLINICAL} SELECT adm.subject_id, adm.hadm_id, admittime, t.* FROM adm JOIN dx USING (subject_id, hadm_id) JOIN (VALUES
  ('99591', 'Sepsis', 'Sepsis'), ('99592', 'Severe sepsis', 'SEVERE SEPSIS'), ('78552', 'Septic shock', 'Septic shock'),
  ('0389', 'Septicemia NOS', 'Unspecified septicemia')) t(icd9_code, short_title, long_title) ON t.icd9_code = dx.code""",
    "lactate_items": f"""
WITH {_CLINICAL} SELECT DISTINCT item::INT AS itemid, if(item = 50813, 'Lactate', 'LACTATE, venous') AS label, 'Blood' AS fluid,
  if(item = 50813, 'Blood Gas', 'Chemistry') AS category, 'L-' || item AS loinc_code FROM labs WHERE item IN (50813, 50885)""",
    "lactate_counts": f"""
WITH {_CLINICAL} SELECT item::INT AS itemid, if(item = 50813, 'Lactate', 'LACTATE, venous') AS label, count(*) AS n
FROM labs WHERE item IN (50813, 50885) GROUP BY ALL""",
    "lactate_sample": f"""
WITH {_CLINICAL} SELECT hadm_id, ts AS charttime, 50813::INT AS itemid, v AS valuenum, 'mmol/L' AS valueuom
FROM lab ORDER BY ts, hadm_id, v NULLS FIRST LIMIT 200""",
    "first_cultures": f"""
WITH {_CLINICAL} SELECT subject_id, hadm_id, min(coalesce(ts, day::TIMESTAMP)) AS first_time FROM micro WHERE spec = 70012
GROUP BY ALL ORDER BY first_time, subject_id, hadm_id LIMIT 100""",
    "weight_items": _items("'Admission Weight (Kg)', 'Daily Weight', 'WEIGHT change', 'Weighted score'"),
    "pressure_items": _items("'Mean BP', 'Arterial Mean Blood BP', 'MAP (mmHg)', 'Bitmap'"),
    "crystalloid_items": _items(
        "'Normal Saline 500 ml', 'Na Cl 0.9%', 'Sodium Chloride 0.9%  (Flush)', 'Lactated Ringers', "
        "'Ringer''s Lactate', 'Plasma-Lyte A', '0.9% saline'"
    ),
    "vasopressor_items": _items(
        "'Norepinephrine', 'LEVOPHED drip', 'Epinephrine', 'Vasopressin', 'Dopamine', 'Phenylephrine 10 mg'"
    ),
    "nearest_weights": f"""
WITH {_CLINICAL},
w AS (SELECT icustay_id, wt.ts, [226512, 226531][1 + event_id % 2] AS item, v
      FROM wt JOIN (SELECT subject_id, hadm_id, max(icustay_id) AS icustay_id FROM stay GROUP BY ALL) USING (subject_id, hadm_id)
      QUALIFY row_number() OVER (PARTITION BY icustay_id, wt.ts ORDER BY item, v) = 1),
k AS (SELECT icustay_id, ts, item, if(item = 226512, v, v * 0.453592) AS kg FROM w)
SELECT subject_id, hadm_id, icustay_id, intime, k.ts AS charttime, round(kg::DECIMAL(18, 8), 1)::DOUBLE AS weight_kg
FROM stay JOIN k USING (icustay_id) WHERE kg >= 30 AND kg <= 300
QUALIFY row_number() OVER (PARTITION BY icustay_id ORDER BY item, abs(date_sub('hour', intime, k.ts)), k.ts) = 1""",
    "append_rows": f"""
WITH {_CLINICAL}
SELECT subject_id, hadm_id, ts AS charttime, item::INT AS itemid, v AS valuenum, 'mmol/L' AS valueuom
FROM labs UNION ALL
SELECT subject_id, hadm_id, ts, [226512, 226531][1 + event_id % 2]::INT, v, NULL FROM wt""",
    "bucketed_flags": _BASELINE,
    "refreshed_flags": _BASELINE,
    "stored_view": _FINAL,
    "refused_rows": """
SELECT event_id, concat_ws(', ', CASE WHEN event_id % 97 = 5 THEN 'wrong ts' END, CASE WHEN event_id % 97 IN (6, 7) THEN 'missing ts' END,
                           CASE WHEN event_id % 89 = 3 THEN 'wrong value' END) AS reasons
FROM events WHERE event_id % 97 IN (5, 6, 7) OR event_id % 89 = 3""",
    "accepted_rows": """
SELECT event_type, count(*) AS n, sum(event_id % 1000)::BIGINT AS total, min(date_trunc('second', ts)) AS first_ts
FROM events WHERE event_id % 97 NOT IN (5, 6, 7) AND event_id % 89 <> 3 GROUP BY event_type""",
    "registered_ids": """
SELECT c_custkey, 100 + row_number() OVER (ORDER BY c_custkey % 2 = 0, c_custkey) AS id FROM customer""",
    "update_from_join": """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' AND s IS NOT NULL
  THEN s + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate, o_totalprice
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS s FROM lineitem GROUP BY 1)
  ON l_orderkey = o_orderkey""",
    "raise_first_value": _raised(""),
    "raise_first_value_rechecked": _raised("AND dl.itemid = 50813"),
    "rows_at_first": f"""
WITH {_CLINICAL}, {_DAY_LABS}
SELECT dl.* FROM dl JOIN (SELECT hadm_id, min(chartday) AS d FROM dl WHERE itemid = 50813 GROUP BY 1) f
  ON f.hadm_id = dl.hadm_id AND f.d = dl.chartday""",
    "present_absent": """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
EXCEPT SELECT c_custkey, c_name FROM customer JOIN orders ON o_custkey = c_custkey
WHERE o_orderstatus = 'O'""",
    "time_functions": """
SELECT event_id,
  date_sub('hour', TIMESTAMP '2024-01-15 06:30:30', ts) AS hours,
  date_diff('minute', TIMESTAMP '2024-01-15 06:30:30', ts) AS minutes,
  date_diff('hour', TIMESTAMP '2024-01-15 06:30:30', ts) AS hour_marks,
  date_diff('day', TIMESTAMP '2024-01-15 06:30:30', ts) AS days,
  date_diff('year', ts::DATE - 20, ts)::INT AS years,
  date_trunc('month', ts)::DATE AS month_key,
  ts::DATE::TIMESTAMP + INTERVAL 12 HOUR AS noon,
  ts + to_minutes((event_id % 97)::INT) AS later,
  ts - INTERVAL 1 HOUR AS hour_before,
  least(ts::DATE::TIMESTAMP + INTERVAL 12 HOUR, ts) AS earliest
FROM events""",
    "value_functions": """
SELECT l_orderkey, l_linenumber, l_partkey,
  l_quantity * CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 0.5::DOUBLE WHEN 3 THEN 2 END AS scaled,
  CASE l_linenumber WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 3 END::INT AS priority,
  greatest(-10, least(10, l_quantity - 25)) AS clamped,
  ['a', 'b', 'c'][1 + l_orderkey % 3] AS chosen,
  if(l_returnflag = 'R', l_quantity, NULL) AS masked,
  if(l_linenumber > 3, l_linenumber, 0)::INT AS defaulted,
  (l_quantity >= 10 AND l_quantity <= 20)::INT AS in_range,
  (year(l_shipdate) = 1997)::INT AS in_1997,
  (l_linenumber = 1)::INT AS known,
  upper(l_returnflag) || '-' || lower(l_linestatus) AS tag,
  abs(floor(l_quantity / 3) - 8)::INT AS third
FROM lineitem""",
    "hash_functions": f"""
SELECT o_orderkey, {_md5('o_orderkey', 'o_orderdate::DATE', '7')} AS hash,
  {_md5('o_orderkey', '1')} % 60 AS below_60 FROM orders""",
    "text_filters": """
SELECT p_partkey, p_name, if(p_partkey % 3 <> 0, p_type, NULL) AS alt FROM part
WHERE p_size IN (1, 2, 3, 5, 8, 13, 21, 34)
  AND (contains(lower(p_name), 'bolt') OR contains(lower(p_name), 'promo')
       OR (p_partkey % 3 <> 0 AND (contains(lower(p_type), 'promo') OR contains(lower(p_type), 'bolt'))))""",
    "literal_lookup": """
SELECT n_nationkey, n_name, note, count(*) AS n
FROM nation JOIN (VALUES (1, 'first'), (2, 'second'), (3, 'third')) v(k, note) ON k = n_regionkey
JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""",
    "materialised_twice": f"""
WITH {_CLINICAL} SELECT subject_id, hadm_id, if(max(v) >= 4, 'high', 'low') AS level, count(*) AS n
FROM labs GROUP BY subject_id, hadm_id HAVING max(v) IS NOT NULL""",
    "ordered_before": f"""
WITH {_COHORT} SELECT subject_id, hadm_id,
  (first_culture IS NOT NULL AND (first_antibiotic IS NULL OR first_culture <= first_antibiotic))::INT
  AS culture_first FROM z""",
    "dose_per_kg": f"""
WITH {_CLINICAL},
d AS (SELECT hadm_id, sum(trunc(v * 100)::BIGINT)::BIGINT AS total_dose FROM chart WHERE item IN (30061, 30062, 30063) GROUP BY 1),
w AS (SELECT subject_id, hadm_id, max(v) AS kg FROM wt
      WHERE event_id % 2 = 0 AND v BETWEEN 30 AND 300 GROUP BY ALL)
SELECT subject_id, hadm_id, total_dose, coalesce(total_dose / kg >= 30, false)::INT AS dose_reached
FROM d JOIN w USING (hadm_id)""",
}
# Stored tables end as the tables of the plain operators do, however often a change is repeated.
ORACLES["stored_update"] = ORACLES["update_from_join"]
ORACLES["stored_append"] = ORACLES["append_absent"]
