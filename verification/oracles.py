"""The registered queries in plain SQL, for an engine that sees the supplied tables as views.

All queries share one chain of common table expressions; unused ones cost nothing. Rounding goes
through DECIMAL(18,6) on this side too, and counts and sums are cast to the widths Spark returns.
"""

from __future__ import annotations


def _round(value: str, scale: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(18,6)), {scale}) AS DOUBLE)"


def _avg(column: str, scale: int) -> str:
    return _round(f"CAST(SUM({column}) AS DOUBLE) / NULLIF(COUNT({column}), 0)", scale)


def _avg_exact(column: str, scale: int) -> str:
    return _round(f"CAST(SUM(CAST({column} AS DECIMAL(18,3))) AS DOUBLE) / NULLIF(COUNT({column}), 0)",
                  scale)


def _total(column: str) -> str:
    return f"SUM(CAST({column} AS DECIMAL(28,2)))"


def _millions(column: str = "total_revenue_usd") -> str:
    return _round(f"CAST({_total(column)} AS DOUBLE) / 1e6", 2)


def _big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def _pct(part: str, whole: str, scale: int = 2) -> str:
    return _round(f"100.0 * CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE)", scale)


def _status(column: str = "readmission_rate_pct") -> str:
    return (f"CASE WHEN {column} > 20 THEN 'CRITICAL' WHEN {column} > 15 THEN 'WARNING' "
            "ELSE 'OK' END")


def _rolling(column: str, order: str) -> str:
    return _round(f"AVG({column}) OVER (PARTITION BY department ORDER BY {order} "
                  "ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", 2)


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _day(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def _label(value: str) -> str:
    def text(v):
        return (f"regexp_replace(CAST(ROUND(CAST({v} AS DECIMAL(28,6)), 1) AS VARCHAR), "
                r"'\.0+$', '')")
    return (f"'$' || CASE WHEN ABS({value}) >= 1e6 THEN {text(f'({value}) / 1e6')} || 'M' "
            f"WHEN ABS({value}) >= 1e3 THEN {text(f'({value}) / 1e3')} || 'K' "
            f"ELSE {text(value)} END")


_SILVER = """admission_id, patient_id, {adm} AS admission_date, {dis} AS discharge_date, department,
  diagnosis, age, gender, attending_doctor, insurance_id, insurer_name, readmission, icu_stay,
  num_procedures, CAST(total_cost_usd AS DOUBLE) AS total_cost_usd, length_of_stay_days, age_group,
  cost_tier, admission_year, admission_month, admission_quarter, dq_flag""".format(
    adm=_day("admission_date"), dis=_day("discharge_date"))

_LABS = f"""lab_id, patient_id, admission_id, test_name, marker, result_value, unit, reference_low,
  reference_high, is_critical, {_ts("collected_at")} AS collected_at,
  {_ts("resulted_at")} AS resulted_at, lab_status, result_interpretation, deviation_from_range,
  tat_minutes, dq_flag"""

_MEASURES = f"""
  {_avg("length_of_stay_days", 2)} AS avg_los_days,
  {_round("STDDEV_SAMP(length_of_stay_days)", 2)} AS {{stddev}},
  MIN(length_of_stay_days) AS min_los_days, MAX(length_of_stay_days) AS max_los_days,
  COUNT(*) FILTER (WHERE readmission) AS {{readmissions}},
  {_pct("COUNT(*) FILTER (WHERE readmission)", "COUNT(*)")} AS readmission_rate_pct,
  {_avg("total_cost_usd", 2)} AS avg_cost_usd,
  CAST(ROUND(SUM(total_cost_usd), 2) AS DOUBLE) AS total_revenue_usd,
  {_avg("age", 1)} AS avg_patient_age,
  COUNT(*) FILTER (WHERE icu_stay) AS icu_admissions"""

_VERSION = """patient_id, age, gender, insurance_id, insurer_name, total_admissions,
  last_admission_date"""


def _snapshot(where: str) -> str:
    return f"""SELECT patient_id,
    ARG_MAX(age, o) AS age, ARG_MAX(gender, o) AS gender, ARG_MAX(insurance_id, o) AS insurance_id,
    ARG_MAX(insurer_name, o) AS insurer_name, COUNT(*) AS total_admissions,
    MAX(admission_date) AS last_admission_date
  FROM (SELECT *, CAST(admission_date - DATE '1970-01-01' AS HUGEINT) * 100000000000
                  + admission_id AS o FROM {where}) GROUP BY patient_id"""


CTES = f"""
WITH adm AS (
  SELECT CAST(o_orderkey AS BIGINT) AS admission_id, CAST(o_custkey AS BIGINT) AS patient_id,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS admission_date,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE)
      + CAST((o_orderkey * 37) % 53 - 4 + CASE WHEN o_orderkey % 211 = 0 THEN 400 ELSE 0 END AS INT)
      END AS discharge_date,
    CONCAT(' ', LOWER(o_orderpriority), ' ') AS department, c_mktsegment AS diagnosis,
    CAST((o_custkey * 13) % 131 - 4 AS INT) AS age,
    CASE WHEN o_custkey % 2 = 0 THEN 'm' ELSE 'F ' END AS gender,
    CONCAT('dr', LPAD(CAST(o_orderkey % 50 AS VARCHAR), 4, '0')) AS attending_doctor,
    CASE WHEN o_orderkey % 6 = 5 THEN NULL
      ELSE CONCAT('INS', CAST(1000 + o_orderkey % 9000 AS VARCHAR)) END AS insurance_id,
    CASE o_orderkey % 6 WHEN 0 THEN 'Aetna' WHEN 1 THEN 'BlueCross' WHEN 2 THEN 'UnitedHealth'
      WHEN 3 THEN 'Cigna' WHEN 4 THEN 'Humana' END AS insurer_name,
    (o_orderkey % 7 = 0) AS readmission,
    (o_orderpriority = '1-URGENT' OR o_orderkey % 20 = 0) AS icu_stay,
    CAST(o_orderkey % 9 AS INT) AS num_procedures,
    CASE WHEN o_orderkey % 401 = 0 THEN CAST(0 AS DECIMAL(16,4))
      ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.12 AS DECIMAL(3,2)) AS DECIMAL(16,4))
      END AS total_cost_usd
  FROM orders JOIN customer ON o_custkey = c_custkey
),
clean AS (
  SELECT admission_id, patient_id, admission_date, discharge_date,
    UPPER(TRIM(department)) AS department, UPPER(TRIM(diagnosis)) AS diagnosis, age,
    UPPER(TRIM(gender)) AS gender, UPPER(TRIM(attending_doctor)) AS attending_doctor,
    COALESCE(insurance_id, 'SELF_PAY') AS insurance_id,
    CASE WHEN UPPER(TRIM(COALESCE(insurer_name, 'UNKNOWN'))) = 'UNKNOWN' THEN 'SELF_PAY'
      ELSE UPPER(TRIM(insurer_name)) END AS insurer_name,
    readmission, icu_stay, num_procedures, total_cost_usd,
    CAST(discharge_date - admission_date AS INT) AS length_of_stay_days,
    CASE WHEN age < 30 THEN '18-29' WHEN age < 45 THEN '30-44' WHEN age < 60 THEN '45-59'
      WHEN age < 75 THEN '60-74' ELSE '75+' END AS age_group,
    CASE WHEN total_cost_usd < 5000 THEN 'LOW' WHEN total_cost_usd < 20000 THEN 'MEDIUM'
      WHEN total_cost_usd < 50000 THEN 'HIGH' ELSE 'VERY_HIGH' END AS cost_tier,
    CAST(YEAR(admission_date) AS INT) AS admission_year,
    CAST(MONTH(admission_date) AS INT) AS admission_month,
    CASE WHEN admission_date IS NULL THEN NULL
      ELSE CONCAT('Q', CAST(QUARTER(admission_date) AS VARCHAR)) END AS admission_quarter
  FROM adm
),
flagged AS (
  SELECT *, CASE WHEN length_of_stay_days < 0 THEN 'INVALID_LOS:discharge_before_admission'
      WHEN age < 0 THEN 'INVALID_AGE:negative' WHEN age > 120 THEN 'INVALID_AGE:unrealistic'
      WHEN admission_date IS NULL THEN 'NULL_DATE:admission'
      WHEN discharge_date IS NULL THEN 'NULL_DATE:discharge'
      WHEN length_of_stay_days > 365 THEN 'SUSPICIOUS_LOS:over_365_days'
      WHEN total_cost_usd <= 0 THEN 'INVALID_COST:non_positive' ELSE 'VALID' END AS dq_flag
  FROM clean
),
valid AS (SELECT * FROM flagged WHERE dq_flag = 'VALID'),
deliveries AS (
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(admission_id % 3 AS INT))
      AS _ingested_at, '1' AS _batch_id FROM adm
  UNION ALL
  SELECT * REPLACE (num_procedures + 1 AS num_procedures),
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(admission_id % 5 AS INT)), '2' FROM adm
),
lab AS (
  SELECT l_orderkey * 10 + l_linenumber AS lab_id, CAST(o_custkey AS BIGINT) AS patient_id,
    CAST(l_orderkey AS BIGINT) AS admission_id, l_returnflag AS test_name,
    CONCAT('M', CAST(l_partkey % 4 AS VARCHAR)) AS marker,
    CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE l_quantity END AS result_value, 'u' AS unit,
    CAST(5 + l_partkey % 10 AS DOUBLE) AS reference_low,
    CAST(25 + l_partkey % 15 AS DOUBLE) AS reference_high,
    (l_suppkey % 20 = 0) AS is_critical,
    l_shipdate + to_hours(CAST(l_partkey % 48 AS INT)) AS collected_at,
    l_shipdate + to_hours(CAST(l_partkey % 48 + l_suppkey % 26 - 1 AS INT)) AS resulted_at,
    CASE l_linestatus WHEN 'F' THEN 'final' ELSE ' preliminary' END AS lab_status,
    l_partkey AS _tiebreak_part, l_suppkey AS _tiebreak_supp, l_extendedprice AS _tiebreak_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
lab_one AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lab_id, marker
    ORDER BY _tiebreak_part, _tiebreak_supp, _tiebreak_price) AS rn FROM lab) WHERE rn = 1
),
lab_clean AS (
  SELECT lab_id, patient_id, admission_id, UPPER(TRIM(test_name)) AS test_name, marker,
    result_value, unit, reference_low, reference_high, is_critical, collected_at, resulted_at,
    UPPER(TRIM(lab_status)) AS lab_status,
    CASE WHEN result_value IS NULL THEN 'UNKNOWN' WHEN result_value < reference_low THEN 'LOW'
      WHEN result_value > reference_high THEN 'HIGH' ELSE 'NORMAL' END AS result_interpretation,
    CASE WHEN result_value IS NULL THEN 0.0
      ELSE {_round("GREATEST(reference_low - result_value, result_value - reference_high, 0.0)", 3)}
      END AS deviation_from_range,
    {_round("(epoch(resulted_at) - epoch(collected_at)) / 60.0", 1)} AS tat_minutes
  FROM lab_one
),
lab_flagged AS (
  SELECT *, CASE WHEN result_value IS NULL THEN 'NULL_RESULT_VALUE'
      WHEN collected_at IS NULL THEN 'NULL_COLLECTION_TIME'
      WHEN tat_minutes < 0 THEN 'INVALID_TAT:negative' ELSE 'VALID' END AS dq_flag
  FROM lab_clean
),
lab_valid AS (SELECT * FROM lab_flagged WHERE dq_flag = 'VALID'),
kpi_base AS (
  SELECT department, strftime(admission_date, '%Y-%m') AS year_month, admission_year,
    admission_quarter, COUNT(*) AS total_admissions, COUNT(DISTINCT patient_id) AS unique_patients,
    {_MEASURES.format(stddev="stddev_los_days", readmissions="readmissions")}
  FROM valid GROUP BY department, strftime(admission_date, '%Y-%m'), admission_year,
    admission_quarter
),
kpis AS (
  SELECT *, {_rolling("avg_los_days", "year_month")} AS rolling_3mo_avg_los,
    {_rolling("readmission_rate_pct", "year_month")} AS rolling_3mo_readmission_pct,
    {_status()} AS readmission_status
  FROM kpi_base
),
readmit AS (
  SELECT *, CASE WHEN readmission_rate_pct > 25 THEN 'HIGH_RISK'
      WHEN readmission_rate_pct > 15 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END
      AS readmission_risk_tier
  FROM (SELECT department, diagnosis, age_group, COUNT(*) AS total_admissions,
          COUNT(*) FILTER (WHERE readmission) AS readmissions,
          {_pct("COUNT(*) FILTER (WHERE readmission)", "COUNT(*)")} AS readmission_rate_pct,
          {_avg("length_of_stay_days", 2)} AS avg_los, {_avg("total_cost_usd", 2)} AS avg_cost
        FROM valid GROUP BY department, diagnosis, age_group HAVING COUNT(*) >= 10)
),
fin AS (
  SELECT department, insurer_name, admission_year, admission_quarter, cost_tier,
    COUNT(*) AS admissions, CAST(ROUND(SUM(total_cost_usd), 2) AS DOUBLE) AS total_revenue_usd,
    {_avg("total_cost_usd", 2)} AS avg_revenue_per_admission,
    {_round("MIN(total_cost_usd)", 2)} AS min_cost, {_round("MAX(total_cost_usd)", 2)} AS max_cost,
    {_avg("num_procedures", 2)} AS avg_procedures
  FROM valid GROUP BY department, insurer_name, admission_year, admission_quarter, cost_tier
),
crit AS (
  SELECT l.lab_id, l.patient_id, l.admission_id, v.department, v.attending_doctor, l.test_name,
    l.marker, l.result_value, l.reference_low, l.reference_high, l.unit, l.result_interpretation,
    l.deviation_from_range, l.lab_status, l.collected_at, l.resulted_at, l.tat_minutes,
    v.admission_date,
    {_round("(epoch(TIMESTAMP '2005-01-01 00:00:00') - epoch(l.collected_at)) / 3600.0", 1)}
      AS hours_since_collection
  FROM lab_valid l LEFT JOIN valid v ON l.admission_id = v.admission_id WHERE l.is_critical
),
los_month AS (
  SELECT department, CAST(date_trunc('month', admission_date) AS DATE) AS admission_month,
    COUNT(DISTINCT admission_id) AS total_admissions,
    COUNT(DISTINCT patient_id) AS unique_patients,
    {_MEASURES.format(stddev="stddev_los_days", readmissions="readmission_count")}
  FROM valid GROUP BY department, CAST(date_trunc('month', admission_date) AS DATE)
),
los AS (
  SELECT *, {_rolling("avg_los_days", "admission_month")} AS rolling_3mo_avg_los,
    {_status()} AS readmission_status FROM los_month
),
mart_base AS (
  SELECT department, CAST(date_trunc('month', admission_date) AS DATE) AS month_start,
    strftime(admission_date, '%Y-%m') AS year_month, admission_year, admission_quarter,
    COUNT(*) AS total_admissions, COUNT(DISTINCT patient_id) AS unique_patients,
    COUNT(DISTINCT attending_doctor) AS active_doctors,
    {_MEASURES.format(stddev="stddev_los", readmissions="readmission_count")},
    CAST(percentile_cont(0.5) WITHIN GROUP (ORDER BY length_of_stay_days) AS DOUBLE)
      AS median_los_days,
    {_avg("num_procedures", 2)} AS avg_procedures,
    {_round("MIN(total_cost_usd)", 2)} AS min_cost_usd,
    {_round("MAX(total_cost_usd)", 2)} AS max_cost_usd
  FROM valid GROUP BY ALL
),
mart AS (
  SELECT *, {_rolling("avg_los_days", "month_start")} AS rolling_3mo_avg_los,
    {_rolling("readmission_rate_pct", "month_start")} AS rolling_3mo_readmission_pct,
    {_rolling("total_revenue_usd", "month_start")} AS rolling_3mo_revenue,
    LAG(total_admissions) OVER by_month AS prev_month_admissions,
    {_round("100.0 * (total_admissions - LAG(total_admissions) OVER by_month) "
            "/ NULLIF(CAST(LAG(total_admissions) OVER by_month AS DOUBLE), 0)", 1)}
      AS mom_admissions_change_pct,
    {_status()} AS readmission_status
  FROM mart_base WINDOW by_month AS (PARTITION BY department ORDER BY month_start)
),
facts AS (
  SELECT CAST(o_custkey AS BIGINT) AS patient_id, CAST(o_orderkey AS BIGINT) AS admission_id,
    CAST(o_orderdate AS DATE) AS admission_date, CAST((o_custkey * 13) % 131 - 4 AS INT) AS age,
    CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
    CASE WHEN o_orderkey % 6 = 5 THEN 'SELF_PAY'
      ELSE CONCAT('INS', CAST(1000 + o_orderkey % 9000 AS VARCHAR)) END AS insurance_id,
    CASE o_orderkey % 6 WHEN 0 THEN 'AETNA' WHEN 1 THEN 'BLUECROSS' WHEN 2 THEN 'UNITEDHEALTH'
      WHEN 3 THEN 'CIGNA' WHEN 4 THEN 'HUMANA' ELSE 'SELF_PAY' END AS insurer_name
  FROM orders
),
day_state AS (
  SELECT patient_id, admission_date AS day, ARG_MAX(insurer_name, admission_id) AS insurer_name,
    COUNT(*) AS n FROM facts GROUP BY patient_id, admission_date
),
islands AS (
  SELECT *, SUM(CASE WHEN prev IS NULL OR prev <> insurer_name THEN 1 ELSE 0 END)
      OVER (PARTITION BY patient_id ORDER BY day) AS island
  FROM (SELECT *, LAG(insurer_name) OVER (PARTITION BY patient_id ORDER BY day) AS prev
        FROM day_state)
),
island_rows AS (
  SELECT patient_id, island, MIN(insurer_name) AS insurer_name, MIN(day) AS valid_from,
    MAX(day) AS last_admission_date, SUM(n) AS n FROM islands GROUP BY patient_id, island
),
history AS (
  SELECT patient_id, insurer_name,
    {_big("SUM(n) OVER (PARTITION BY patient_id ORDER BY island)")} AS total_admissions,
    last_admission_date, valid_from,
    COALESCE(CAST(LEAD(valid_from) OVER w - INTERVAL 1 DAY AS DATE), DATE '9999-12-31')
      AS valid_to,
    LEAD(valid_from) OVER w IS NULL AS is_current
  FROM island_rows WINDOW w AS (PARTITION BY patient_id ORDER BY island)
),
snap1 AS ({_snapshot("facts WHERE admission_date < DATE '1998-01-01'")}),
snap2 AS ({_snapshot("facts WHERE admission_date >= DATE '1998-01-01'")}),
vit AS (
  SELECT event_id,
    CONCAT('VIT-', CAST(user_id AS VARCHAR), '-', CAST(event_id AS VARCHAR)) AS message_id,
    CAST(user_id AS VARCHAR) AS patient_id,
    CASE event_type WHEN 'error' THEN 'ICU' WHEN 'purchase' THEN 'Cardiology'
      WHEN 'signup' THEN 'Neurology' ELSE 'Emergency' END AS department,
    strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
    CAST(ts AS TIMESTAMP) AS event_ts,
    CASE WHEN event_type = 'error' THEN 'deteriorating' ELSE 'stable' END AS patient_state,
    (event_type = 'error') AS is_anomaly, CAST(25 + event_id % 170 AS INT) AS heart_rate,
    CAST(65 + (event_id * 7) % 145 AS INT) AS systolic_bp,
    CAST(35 + (event_id * 11) % 95 AS INT) AS diastolic_bp,
    CAST(80 + (event_id * 3) % 21 AS INT) AS spo2_pct,
    CAST((340 + (event_id * 13) % 75) / 10.0 AS DOUBLE) AS temperature_c,
    CAST(4 + (event_id * 5) % 36 AS INT) AS resp_rate
  FROM events WHERE event_id % 50 <> 0
),
readings AS (
  SELECT *, CASE WHEN reading < cl OR reading > ch THEN 'CRITICAL'
                 WHEN reading < nl OR reading > nh THEN 'ABNORMAL' END AS severity
  FROM (
    SELECT message_id, 'heart_rate' AS vital, CAST(heart_rate AS DOUBLE) AS reading,
      55 AS nl, 100 AS nh, 30 AS cl, 180 AS ch FROM vit
    UNION ALL SELECT message_id, 'systolic_bp', systolic_bp, 100, 135, 70, 200 FROM vit
    UNION ALL SELECT message_id, 'diastolic_bp', diastolic_bp, 65, 85, 40, 120 FROM vit
    UNION ALL SELECT message_id, 'spo2_pct', spo2_pct, 95, 100, 85, 100 FROM vit
    UNION ALL SELECT message_id, 'temperature_c', temperature_c, 36.5, 37.5, 35.0, 40.5 FROM vit
    UNION ALL SELECT message_id, 'resp_rate', resp_rate, 12, 20, 6, 35 FROM vit)
),
alerts AS (
  SELECT v.message_id, v.patient_id, v.department, v.event_ts, r.vital, r.reading, r.severity,
    v.is_anomaly FROM vit v JOIN readings r ON v.message_id = r.message_id
  WHERE r.severity IS NOT NULL
  UNION ALL
  SELECT message_id, patient_id, department, event_ts, 'device_flag', NULL, 'ABNORMAL', is_anomaly
  FROM vit WHERE is_anomaly AND message_id NOT IN
    (SELECT message_id FROM readings WHERE severity IS NOT NULL)
),
recon AS (
  SELECT *, records_in - records_out AS dropped FROM (
    SELECT 'ingest_admissions' AS step, 'bronze' AS layer, 'success' AS status,
      (SELECT COUNT(*) FROM adm) AS records_in, (SELECT COUNT(*) FROM adm) AS records_out,
      '' AS notes
    UNION ALL SELECT 'ingest_labs', 'bronze', 'success', (SELECT COUNT(*) FROM lab),
      (SELECT COUNT(*) FROM lab), ''
    UNION ALL SELECT 'transform_admissions', 'silver', 'success', (SELECT COUNT(*) FROM adm),
      (SELECT COUNT(*) FROM valid), CONCAT('quarantined=', CAST(
        (SELECT COUNT(*) FROM flagged WHERE dq_flag <> 'VALID') AS VARCHAR))
    UNION ALL SELECT 'transform_labs', 'silver', 'success', (SELECT COUNT(*) FROM lab),
      (SELECT COUNT(*) FROM lab_valid), ''
    UNION ALL SELECT 'build_dept_kpis', 'gold', 'success', (SELECT COUNT(*) FROM valid),
      (SELECT COUNT(*) FROM kpis), ''
    UNION ALL SELECT 'build_readmission_analysis', 'gold', 'success',
      (SELECT COUNT(*) FROM valid), (SELECT COUNT(*) FROM readmit), ''
    UNION ALL SELECT 'build_financial_summary', 'gold', 'success', (SELECT COUNT(*) FROM valid),
      (SELECT COUNT(*) FROM fin), ''
    UNION ALL SELECT 'build_critical_labs_watch', 'gold', 'success',
      (SELECT COUNT(*) FROM lab_valid), (SELECT COUNT(*) FROM crit), '')
)
"""

_RAW_ADM = f"""admission_id, patient_id,
  CASE WHEN admission_date IS NULL THEN 'not a date' ELSE {_day("admission_date")} END
    AS admission_date, {_day("discharge_date")} AS discharge_date, department, diagnosis,
  CAST(age AS VARCHAR) AS age, gender, attending_doctor, insurance_id, insurer_name,
  CAST(readmission AS VARCHAR) AS readmission, CAST(icu_stay AS VARCHAR) AS icu_stay,
  CAST(num_procedures AS VARCHAR) AS num_procedures,
  CAST(total_cost_usd AS VARCHAR) AS total_cost_usd"""


# What Silver casts the text columns of an admission to.
_ADM_KINDS = {
    "patient_id": "string", "admission_id": "string", "admission_date": "date",
    "discharge_date": "date", "department": "string", "diagnosis": "string", "age": "long",
    "gender": "string", "attending_doctor": "string", "insurance_id": "string",
    "insurer_name": "string", "readmission": "boolean", "icu_stay": "boolean",
    "num_procedures": "long", "total_cost_usd": "decimal",
}


def _profile() -> str:
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS declared, TRIM(CAST({c} AS VARCHAR)) AS v FROM raw"
        for c, k in _ADM_KINDS.items())
    day, moment = r"\d{4}-\d{2}-\d{2}", r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
    holds = {
        "boolean": "LOWER(v) IN ('true', 'false')",
        "long": "regexp_full_match(v, '[+-]?[0-9]{1,18}')",
        "decimal": r"regexp_full_match(v, '[+-]?[0-9]{1,18}(\.[0-9]+)?')",
        "date": f"regexp_full_match(v, '{day}') AND TRY_CAST(v AS DATE) IS NOT NULL",
        "timestamp": f"regexp_full_match(v, '{moment}') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL",
    }
    counts = ", ".join(f"COUNT(*) FILTER (WHERE {h}) AS as_{k}" for k, h in holds.items())
    kinds = " ".join(f"WHEN as_{k} = filled THEN '{k}'" for k in holds)
    return f"""SELECT * FROM (WITH raw AS (SELECT {_RAW_ADM} FROM adm),
      counted AS (SELECT column_name, declared, COUNT(*) AS rows,
          COUNT(*) FILTER (WHERE v <> '') AS filled, {counts}
        FROM ({values}) GROUP BY column_name, declared),
      named AS (SELECT *, CASE WHEN filled = 0 THEN 'none' {kinds} ELSE 'string' END AS inferred
        FROM counted)
      SELECT *, declared = 'string' OR inferred = 'none' OR declared = inferred
        OR (declared = 'decimal' AND inferred = 'long') AS fits FROM named)"""


def _raw_lab(partition: str) -> str:
    def hours(c):
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
    return f"""SELECT lab_id, patient_id, admission_id, test_name, marker,
      CAST(result_value AS VARCHAR) AS result_value, unit,
      CAST(CAST(reference_low AS BIGINT) AS VARCHAR) AS reference_low,
      CAST(CAST(reference_high AS BIGINT) AS VARCHAR) AS reference_high,
      CAST(is_critical AS VARCHAR) AS is_critical, {hours("collected_at")} AS collected_at,
      {hours("resulted_at")} AS resulted_at, lab_status, _tiebreak_part, _tiebreak_supp,
      _tiebreak_price
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {partition}
      ORDER BY _tiebreak_part, _tiebreak_supp, _tiebreak_price) AS rn FROM lab) WHERE rn = 1"""


def _expectations(table: str, name: str, tests: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{test}' AS test, "
        f"{_big(failures)} AS failures FROM {table}" for column, test, failures in tests)


def _failing(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


_OPEN = "DATE '9999-12-31'"

_FINALS = {
    # ingest
    "bronze_ingest": f"""SELECT {_RAW_ADM}, '20240101_020000' AS _batch_id,
        'admissions_csv_batch' AS _source FROM adm""",
    "write_verify": "SELECT COUNT(*) AS rows, COUNT(DISTINCT department) AS partitions FROM adm",
    "load_history": f"""SELECT _batch_id, COUNT(*) AS rows, {_ts("MIN(t)")} AS first_ingested_at,
        {_ts("MAX(t)")} AS last_ingested_at
      FROM (SELECT COALESCE(strftime(admission_date, '%Y%m'), 'undated') AS _batch_id,
              CAST(admission_date AS TIMESTAMP) AS t FROM adm)
      GROUP BY _batch_id ORDER BY MAX(t) DESC NULLS LAST, _batch_id DESC LIMIT 3""",
    "delivery_profile": _profile(),
    "warehouse_export": f"""SELECT CAST(admission_id AS VARCHAR) AS admission_id,
        CAST(patient_id AS VARCHAR) AS patient_id, {_day("admission_date")} AS admission_date,
        {_day("discharge_date")} AS discharge_date, department, diagnosis, age,
        SUBSTR(gender, 1, 1) AS gender, attending_doctor, insurance_id, insurer_name, readmission,
        icu_stay, num_procedures,
        CAST(CAST(total_cost_usd AS DECIMAL(10,2)) AS DOUBLE) AS total_cost_usd,
        length_of_stay_days, age_group, cost_tier, admission_year, admission_month,
        admission_quarter, dq_flag FROM valid""",
    "warehouse_rejects": """SELECT admission_id, concat_ws(', ',
        CASE WHEN admission_id % 53 = 0 THEN 'attending_doctor' END,
        CASE WHEN admission_id % 59 = 0 THEN 'total_cost_usd' END) AS misfit_columns
      FROM valid WHERE admission_id % 53 = 0 OR admission_id % 59 = 0""",
    # cleaning
    "dedup_admissions": f"""SELECT admission_id, CAST(num_procedures AS VARCHAR) AS num_procedures,
        {_ts("_ingested_at")} AS _ingested_at, _batch_id
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY admission_id
              ORDER BY _ingested_at DESC, _batch_id DESC) AS rn FROM deliveries) WHERE rn = 1""",
    "dedup_labs": _raw_lab("lab_id, marker"),
    "dedup_labs_compat": _raw_lab("lab_id"),
    "silver_admissions": f"SELECT {_SILVER} FROM valid",
    "silver_incremental": f"SELECT {_SILVER} FROM valid",
    "silver_labs": f"SELECT {_LABS} FROM lab_valid",
    "stg_admissions": f"SELECT {_SILVER} FROM valid",
    # quality
    "dq_flag_admissions": """SELECT admission_id, length_of_stay_days, age,
        CAST(total_cost_usd AS DOUBLE) AS total_cost_usd, dq_flag FROM flagged""",
    "dq_flag_labs": "SELECT lab_id, marker, result_value, tat_minutes, dq_flag FROM lab_flagged",
    "quarantine_admissions": f"SELECT {_SILVER} FROM flagged WHERE dq_flag <> 'VALID'",
    "quarantine_labs": f"SELECT {_LABS} FROM lab_flagged WHERE dq_flag <> 'VALID'",
    "quarantine_breakdown": """SELECT dq_flag, COUNT(*) AS rows FROM flagged
      WHERE dq_flag <> 'VALID' GROUP BY dq_flag""",
    "dq_summary": f"""SELECT bronze_rows, null_patient_ids, null_insurance_ids, deduplicated_rows,
        valid_rows, deduplicated_rows - valid_rows AS quarantined_rows,
        bronze_rows - deduplicated_rows AS duplicates_removed,
        {_pct("valid_rows", "bronze_rows", 1)} AS valid_pct,
        {_pct("deduplicated_rows - valid_rows", "bronze_rows", 1)} AS quarantined_pct
      FROM (SELECT COUNT(*) AS bronze_rows,
              COUNT(*) FILTER (WHERE patient_id IS NULL) AS null_patient_ids,
              COUNT(*) FILTER (WHERE insurance_id IS NULL) AS null_insurance_ids,
              COUNT(DISTINCT admission_id) AS deduplicated_rows FROM deliveries),
           (SELECT COUNT(*) AS valid_rows FROM valid)""",
    "expectations_admissions": _expectations("flagged", "silver.admissions", [
        ("admission_id", "not_null", _failing("admission_id IS NULL")),
        ("admission_id", "unique", "COUNT(admission_id) - COUNT(DISTINCT admission_id)"),
        ("patient_id", "not_null", _failing("patient_id IS NULL")),
        ("department", "not_null", _failing("department IS NULL")),
        ("dq_flag", "accepted_values", _failing(
            "dq_flag NOT IN ('VALID', 'INVALID_LOS:discharge_before_admission', "
            "'INVALID_AGE:negative', 'INVALID_AGE:unrealistic', 'NULL_DATE:admission', "
            "'NULL_DATE:discharge', 'SUSPICIOUS_LOS:over_365_days', "
            "'INVALID_COST:non_positive')")),
    ]),
    "expectations_labs": _expectations("lab_flagged", "silver.labs", [
        ("lab_id", "not_null", _failing("lab_id IS NULL")),
        ("lab_id, marker", "unique", "COUNT(*) - COUNT(DISTINCT (lab_id, marker))"),
        ("admission_id", "not_null", _failing("admission_id IS NULL")),
    ]),
    "expectations_kpis": _expectations("los", "gold.avg_los_by_department", [
        ("department", "not_null", _failing("department IS NULL")),
        ("department", "accepted_values", _failing(
            "department NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')")),
        ("admission_month", "not_null", _failing("admission_month IS NULL")),
        ("total_admissions", "not_null", _failing("total_admissions IS NULL")),
        ("avg_los_days", "not_null", _failing("avg_los_days IS NULL")),
        ("avg_los_days", "at_least_0", _failing("avg_los_days < 0")),
        ("readmission_rate_pct", "not_null", _failing("readmission_rate_pct IS NULL")),
        ("readmission_rate_pct", "between_0_100", _failing(
            "NOT (readmission_rate_pct BETWEEN 0 AND 100)")),
        ("readmission_status", "not_null", _failing("readmission_status IS NULL")),
        ("readmission_status", "accepted_values", _failing(
            "readmission_status NOT IN ('OK', 'WARNING', 'CRITICAL')")),
    ]),
    "quality_gates": """SELECT 'admissions_not_empty' AS gate, COUNT(*) > 0 AS passed FROM valid
      UNION ALL SELECT 'readmission_rate_sane',
        COALESCE(MAX(readmission_rate_pct) < 100, FALSE) FROM kpis""",
    "freshness_check": f"""SELECT {_day("MAX(admission_month)")} AS latest_month,
        COALESCE(DATE '2005-01-01' - MAX(admission_month) <= 3650, FALSE) AS is_fresh FROM los""",
    # gold and summaries
    "dept_monthly_kpis": "SELECT * FROM kpis",
    "kpis_from_state": "SELECT * FROM kpis",
    "readmission_analysis": "SELECT * FROM readmit",
    "financial_summary": "SELECT * FROM fin",
    "critical_labs_watch": f"""SELECT * REPLACE ({_ts("collected_at")} AS collected_at,
        {_ts("resulted_at")} AS resulted_at, {_day("admission_date")} AS admission_date)
      FROM crit""",
    "silver_dept_stats": f"""SELECT department, COUNT(*) AS admissions,
        {_avg("length_of_stay_days", 2)} AS avg_los, {_avg("total_cost_usd", 0)} AS avg_cost_usd,
        {_avg("age", 1)} AS avg_age, COUNT(*) FILTER (WHERE readmission) AS readmissions
      FROM valid GROUP BY department""",
    "interpretation_distribution": """SELECT result_interpretation, is_critical,
        COUNT(*) AS results FROM lab_valid GROUP BY result_interpretation, is_critical""",
    "tat_by_test": f"""SELECT test_name, {_avg_exact("tat_minutes", 1)} AS avg_tat_min,
        COUNT(*) AS results FROM lab_valid GROUP BY test_name""",
    "annual_los_by_dept": f"""SELECT department, {_avg_exact("avg_los_days", 2)} AS annual_avg_los,
        {_big("SUM(total_admissions)")} AS total_admissions FROM kpis GROUP BY department""",
    "revenue_by_dept": f"""SELECT department, {_millions()} AS total_revenue_millions_usd
      FROM fin GROUP BY department""",
    "critical_by_dept_test": f"""SELECT department, test_name, COUNT(*) AS critical_results,
        {_avg_exact("deviation_from_range", 2)} AS avg_deviation
      FROM crit GROUP BY department, test_name
      ORDER BY critical_results DESC, department NULLS FIRST, test_name LIMIT 10""",
    "annual_dept_summary": f"""SELECT department,
        {_big("SUM(total_admissions)")} AS total_admissions,
        {_avg_exact("avg_los_days", 2)} AS avg_los,
        {_avg_exact("readmission_rate_pct", 2)} AS readmission_rate,
        {_millions()} AS total_revenue_m FROM kpis GROUP BY department""",
    "high_risk_groups": """SELECT department, diagnosis, age_group, readmission_rate_pct,
        total_admissions FROM readmit WHERE readmission_risk_tier = 'HIGH_RISK'
      ORDER BY readmission_rate_pct DESC, total_admissions DESC, department, diagnosis, age_group
      LIMIT 10""",
    "critical_departments": """SELECT DISTINCT department FROM kpis
      WHERE readmission_status = 'CRITICAL'""",
    # SQL models
    "avg_los_by_department": f"""SELECT * REPLACE ({_day("admission_month")} AS admission_month)
      FROM los""",
    "mart_dept_monthly_kpis": f"SELECT * REPLACE ({_day('month_start')} AS month_start) FROM mart",
    # patient history
    "patient_snapshot": f"""SELECT * REPLACE ({_day("last_admission_date")} AS last_admission_date)
      FROM ({_snapshot("valid")})""",
    "scd2_initial": f"""SELECT * REPLACE ({_day("last_admission_date")} AS last_admission_date),
        {_day("last_admission_date")} AS valid_from, '9999-12-31' AS valid_to, TRUE AS is_current
      FROM ({_snapshot("facts")})""",
    "scd2_merge": f"""SELECT * REPLACE ({_day("last_admission_date")} AS last_admission_date,
        {_day("valid_from")} AS valid_from, {_day("valid_to")} AS valid_to) FROM history""",
    "scd2_missing_ids": f"""SELECT * FROM (WITH own AS (
        SELECT * REPLACE (CASE WHEN patient_id % 10 <> 0 THEN patient_id END AS patient_id)
        FROM facts
      ), days AS (
        SELECT patient_id, admission_date AS day,
          ARG_MAX(insurer_name, admission_id) AS insurer_name, COUNT(*) AS n
        FROM own GROUP BY patient_id, admission_date
      ), runs AS (
        SELECT *, SUM(CASE WHEN prev IS NULL OR prev <> insurer_name THEN 1 ELSE 0 END)
            OVER (PARTITION BY patient_id ORDER BY day) AS island
        FROM (SELECT *, LAG(insurer_name) OVER (PARTITION BY patient_id ORDER BY day) AS prev
              FROM days)
      ), spans AS (
        SELECT patient_id, island, MIN(insurer_name) AS insurer_name, MIN(day) AS valid_from,
          MAX(day) AS last_admission_date, SUM(n) AS n FROM runs GROUP BY patient_id, island
      )
      SELECT patient_id, insurer_name,
        {_big("SUM(n) OVER (PARTITION BY patient_id ORDER BY island)")} AS total_admissions,
        {_day("last_admission_date")} AS last_admission_date, {_day("valid_from")} AS valid_from,
        {_day("COALESCE(CAST(LEAD(valid_from) OVER w - INTERVAL 1 DAY AS DATE), DATE '9999-12-31')")}
          AS valid_to,
        LEAD(valid_from) OVER w IS NULL AS is_current
      FROM spans WINDOW w AS (PARTITION BY patient_id ORDER BY island))""",
    "scd2_history": f"""SELECT * REPLACE ({_day("last_admission_date")} AS last_admission_date,
        {_day("valid_from")} AS valid_from, {_day("valid_to")} AS valid_to) FROM history""",
    "scd2_late_rebuild": f"""SELECT * REPLACE ({_day("last_admission_date")} AS last_admission_date,
        {_day("valid_from")} AS valid_from, {_day("valid_to")} AS valid_to) FROM history
      WHERE patient_id IN (SELECT patient_id FROM facts
                           WHERE admission_date >= DATE '1998-01-01')""",
    "scd2_counts": """SELECT COUNT(*) AS total_versions,
        COUNT(*) FILTER (WHERE is_current) AS current_versions,
        COUNT(*) FILTER (WHERE NOT is_current) AS expired_versions FROM history""",
    "asof_insurer_join": f"""SELECT f.patient_id, {_day("f.admission_date")} AS admission_date,
        f.admission_id, f.insurer_name AS billed_insurer, h.insurer_name,
        {_day("h.valid_from")} AS valid_from, {_day("h.valid_to")} AS valid_to
      FROM facts f LEFT JOIN history h ON f.patient_id = h.patient_id
        AND f.admission_date BETWEEN h.valid_from AND h.valid_to""",
    # vital signs
    "vitals_parse": f"""SELECT * EXCLUDE (event_id) REPLACE ({_ts("event_ts")} AS event_ts)
      FROM vit""",
    "vitals_dead_letters": "SELECT '{bad' AS raw_value FROM events WHERE event_id % 50 = 0",
    "vitals_alerts": f"SELECT * REPLACE ({_ts('event_ts')} AS event_ts) FROM alerts",
    "vitals_alert_summary": f"""SELECT {_day("CAST(event_ts AS DATE)")} AS alert_date, department,
        severity, COUNT(*) AS alerts, COUNT(*) FILTER (WHERE is_anomaly) AS from_flagged_messages
      FROM alerts GROUP BY CAST(event_ts AS DATE), department, severity""",
    # service endpoints
    "serve_summary": f"""SELECT total_admissions, total_revenue_m, avg_readmission, departments,
        critical_labs, quarantined,
        {_pct("total_admissions", "(total_admissions + quarantined)", 1)} AS data_quality_pct
      FROM (SELECT {_big("SUM(n)")} AS total_admissions,
              {_round("CAST(SUM(revenue) AS DOUBLE) / 1e6", 2)} AS total_revenue_m,
              {_round("AVG(rate)", 2)} AS avg_readmission, COUNT(*) AS departments
            FROM (SELECT department, SUM(total_admissions) AS n,
                    {_total("total_revenue_usd")} AS revenue,
                    CAST(SUM(CAST(readmission_rate_pct AS DECIMAL(18,3))) AS DOUBLE) / COUNT(*)
                      AS rate
                  FROM kpis GROUP BY department)),
           (SELECT COUNT(*) AS critical_labs FROM crit),
           (SELECT COUNT(*) AS quarantined FROM flagged WHERE dq_flag <> 'VALID')""",
    "serve_dept_annual": f"""SELECT department,
        {_big("SUM(total_admissions)")} AS total_admissions,
        {_big("SUM(unique_patients)")} AS unique_patients, {_avg_exact("avg_los_days", 1)} AS avg_los,
        {_avg_exact("readmission_rate_pct", 1)} AS avg_readmit_rate,
        {_millions()} AS total_revenue_m, {_big("SUM(icu_admissions)")} AS icu_admissions,
        {_big(_avg_exact("avg_cost_usd", 0))} AS avg_cost FROM kpis GROUP BY department""",
    "serve_monthly_trends": "SELECT year_month, " + ", ".join(
        f"{_big(f'COALESCE(SUM(total_admissions) FILTER (WHERE department = {d!r}), 0)')} AS \"{d}\""
        for d in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    ) + " FROM kpis GROUP BY year_month",
    "serve_readmission_risk": f"""SELECT readmission_risk_tier,
        {_big("SUM(total_admissions)")} AS cases,
        {_avg_exact("readmission_rate_pct", 1)} AS avg_rate
      FROM readmit GROUP BY readmission_risk_tier""",
    "serve_critical_labs": f"""SELECT lab_id, patient_id, test_name, marker, unit,
        {_round("result_value", 3)} AS result_value, {_round("reference_low", 3)} AS reference_low,
        {_round("reference_high", 3)} AS reference_high,
        {_round("deviation_from_range", 3)} AS deviation_from_range, result_interpretation,
        lab_status, department, attending_doctor, {_ts("collected_at")} AS collected_at
      FROM crit ORDER BY lab_id, marker LIMIT 100""",
    "serve_insurer_revenue": f"""SELECT insurer_name, {_millions()} AS total_revenue_m,
        {_big("SUM(admissions)")} AS admissions,
        {_big(_avg_exact("avg_revenue_per_admission", 0))} AS avg_rev_per_adm
      FROM fin GROUP BY insurer_name""",
    "cost_tier_mix": f"""SELECT cost_tier, {_big("SUM(admissions)")} AS admissions,
        {_millions()} AS total_revenue_m FROM fin GROUP BY cost_tier""",
    "serve_doctor_alerts": """SELECT attending_doctor, COUNT(*) AS critical_labs,
        string_agg(DISTINCT department, ', ' ORDER BY department) AS departments,
        COUNT(*) FILTER (WHERE result_interpretation = 'HIGH') AS high_count,
        COUNT(*) FILTER (WHERE result_interpretation = 'LOW') AS low_count
      FROM crit WHERE attending_doctor IS NOT NULL GROUP BY attending_doctor
      ORDER BY critical_labs DESC, attending_doctor LIMIT 15""",
    "serve_quarterly": f"""SELECT admission_quarter, department,
        {_big("SUM(total_admissions)")} AS total_admissions,
        {_avg_exact("readmission_rate_pct", 1)} AS readmit_rate, {_millions()} AS total_revenue_m
      FROM kpis GROUP BY admission_quarter, department""",
    # dashboard views
    "shiny_overview": f"""SELECT {_big("SUM(total_admissions)")} AS total_admissions,
        {_avg_exact("avg_los_days", 1)} AS avg_los_days,
        CAST({_total("total_revenue_usd")} AS DOUBLE) AS total_revenue_usd,
        {_label(f'CAST({_total("total_revenue_usd")} AS DOUBLE)')} AS revenue_label,
        {_avg_exact("readmission_rate_pct", 1)} AS avg_readmission_pct FROM kpis""",
    "shiny_monthly": f"""SELECT department, year_month,
        {_big("SUM(total_admissions)")} AS admissions FROM kpis GROUP BY department, year_month""",
    "shiny_status_mix": """SELECT COALESCE(readmission_status, 'UNKNOWN') AS readmission_status,
        COUNT(*) AS months FROM kpis GROUP BY COALESCE(readmission_status, 'UNKNOWN')""",
    "latest_month_per_dept": """SELECT department, year_month, total_admissions, avg_los_days,
        readmission_rate_pct, icu_admissions, avg_cost_usd, total_revenue_usd, readmission_status
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY department ORDER BY year_month DESC) AS rn
            FROM kpis) WHERE rn = 1""",
    "shiny_finance": f"""SELECT CAST({_total("total_revenue_usd")} AS DOUBLE) AS total_revenue_usd,
        {_label(f'CAST({_total("total_revenue_usd")} AS DOUBLE)')} AS revenue_label,
        {_avg_exact("avg_revenue_per_admission", 0)} AS avg_revenue_per_admission FROM fin""",
    "top_dept_insurer": " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS dimension, {c} AS top_name,
              CAST({_total("total_revenue_usd")} AS DOUBLE) AS revenue_usd FROM fin GROUP BY {c}
            ORDER BY revenue_usd DESC, {c} LIMIT 1)""" for c in ("department", "insurer_name")),
    "shiny_quarterly_revenue": f"""SELECT department, admission_quarter, {_millions()} AS revenue_m
      FROM fin GROUP BY department, admission_quarter""",
    "shiny_finance_detail": f"""SELECT department, insurer_name,
        {_big("SUM(admissions)")} AS admissions,
        CAST({_total("total_revenue_usd")} AS DOUBLE) AS revenue_usd,
        {_avg_exact("avg_revenue_per_admission", 0)} AS avg_rev_per_adm,
        {_avg_exact("avg_procedures", 1)} AS avg_procedures
      FROM fin GROUP BY department, insurer_name""",
    "shiny_clinical": f"""SELECT critical_labs, departments, avg_tat_minutes, high_risk_groups
      FROM (SELECT COUNT(*) AS critical_labs,
              COUNT(DISTINCT department)
                + COALESCE(MAX(CASE WHEN department IS NULL THEN 1 ELSE 0 END), 0) AS departments,
              {_avg_exact("tat_minutes", 0)} AS avg_tat_minutes FROM crit),
           (SELECT COUNT(*) FILTER (WHERE readmission_risk_tier = 'HIGH_RISK') AS high_risk_groups
            FROM readmit)""",
    "shiny_risk_bubble": """SELECT department, diagnosis, age_group, avg_cost,
        readmission_rate_pct, total_admissions, readmission_risk_tier,
        '<b>' || diagnosis || '</b><br>Age group: ' || age_group || '<br>Department: '
        || department || '<br>Readm. rate: '
        || regexp_replace(CAST(ROUND(CAST(readmission_rate_pct AS DECIMAL(28,6)), 1) AS VARCHAR),
                          '\\.0+$', '')
        || '%<br>Avg cost: $'
        || format('{:,}', CAST(ROUND(CAST(avg_cost AS DECIMAL(18,6)), 0) AS BIGINT))
        || '<br>Total admissions: ' || CAST(total_admissions AS VARCHAR) AS hover FROM readmit""",
    "shiny_doctor_alerts": f"""SELECT attending_doctor, department, COUNT(*) AS critical_events,
        COUNT(DISTINCT test_name) AS distinct_tests,
        {_avg_exact("tat_minutes", 0)} AS avg_tat_minutes
      FROM crit GROUP BY attending_doctor, department
      ORDER BY critical_events DESC, attending_doctor NULLS FIRST, department NULLS FIRST
      LIMIT 20""",
    "critical_labs_filtered": """SELECT lab_id, patient_id, department, attending_doctor,
        test_name, marker, result_value, unit, reference_low, reference_high,
        result_interpretation, tat_minutes, lab_status
      FROM crit WHERE department = '1-URGENT' AND lab_status = 'FINAL'""",
    "filter_choices": " UNION ".join(
        f"SELECT '{c}' AS filter_name, {c} AS choice FROM crit WHERE {c} IS NOT NULL"
        for c in ("department", "test_name", "lab_status")),
    # audit
    "layer_reconciliation": "SELECT * FROM recon",
    "audit_kpis": f"""SELECT COUNT(*) AS steps, {_big("SUM(records_in)")} AS records_in,
        {_big("SUM(records_out)")} AS records_out FROM recon""",
}

ORACLES = {name: f"{CTES}\n{final}" for name, final in _FINALS.items()}
