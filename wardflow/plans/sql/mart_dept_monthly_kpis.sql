-- Executive mart: monthly volume, clinical, financial and trend figures per department.
-- Valid stays last 0 to 365 days, so (month, department, days) is a small table. Everything but
-- the distinct counts is built from it: one plain hash aggregate over the facts, and an exact
-- median from day counts instead of one buffer of raw values per month.
WITH stays AS (
  SELECT department, CAST(trunc(admission_date, 'MM') AS DATE) AS month_start,
         patient_id, attending_doctor, length_of_stay_days, readmission, icu_stay,
         num_procedures, age, total_cost_usd
  FROM {stg_admissions}
),
by_days AS (
  SELECT department, month_start, length_of_stay_days AS days,
         COUNT(*) AS n, count_if(readmission) AS readmitted, count_if(icu_stay) AS icu,
         SUM(num_procedures) AS procedures, COUNT(num_procedures) AS n_procedures,
         SUM(total_cost_usd) AS cost, COUNT(total_cost_usd) AS n_cost,
         MIN(total_cost_usd) AS min_cost, MAX(total_cost_usd) AS max_cost,
         SUM(age) AS ages, COUNT(age) AS n_age
  FROM stays GROUP BY department, month_start, days
),
months AS (
  SELECT department, month_start,
         SUM(n) AS total_admissions,
         ROUND(TRY_CAST(CAST(SUM(n * days) AS DOUBLE) / SUM(n) AS DECIMAL(38,6)), 2) AS avg_los_days,
         ROUND(TRY_CAST(SQRT(try_divide(
             GREATEST(CAST(SUM(n * days * days) AS DOUBLE)
                      - CAST(SUM(n * days) AS DOUBLE) * SUM(n * days) / SUM(n), 0.0D),
             CAST(SUM(n) - 1 AS DOUBLE))) AS DECIMAL(38,6)), 2) AS stddev_los,
         MIN(days) AS min_los_days, MAX(days) AS max_los_days,
         percentile(days, 0.5, n) AS median_los_days,
         SUM(readmitted) AS readmission_count,
         ROUND(TRY_CAST(100.0D * SUM(readmitted) / SUM(n) AS DECIMAL(38,6)), 2)
           AS readmission_rate_pct,
         SUM(icu) AS icu_admissions,
         ROUND(TRY_CAST(try_divide(CAST(SUM(procedures) AS DOUBLE), SUM(n_procedures)) AS DECIMAL(38,6)), 2) AS avg_procedures,
         ROUND(TRY_CAST(try_divide(CAST(SUM(cost) AS DOUBLE), SUM(n_cost)) AS DECIMAL(38,6)), 2)
           AS avg_cost_usd,
         ROUND(SUM(cost), 2) AS total_revenue_usd,
         ROUND(MIN(min_cost), 2) AS min_cost_usd, ROUND(MAX(max_cost), 2) AS max_cost_usd,
         ROUND(TRY_CAST(try_divide(CAST(SUM(ages) AS DOUBLE), SUM(n_age)) AS DECIMAL(38,6)), 1)
           AS avg_patient_age
  FROM by_days GROUP BY department, month_start
),
people AS (
  SELECT department, month_start, COUNT(DISTINCT patient_id) AS unique_patients
  FROM stays GROUP BY department, month_start
),
doctors AS (
  SELECT department, month_start, COUNT(DISTINCT attending_doctor) AS active_doctors
  FROM stays GROUP BY department, month_start
),
trends AS (
  SELECT m.*, p.unique_patients, d.active_doctors,
         ROUND(TRY_CAST(AVG(m.avg_los_days) OVER three_rows AS DECIMAL(38,6)), 2)
           AS rolling_3mo_avg_los,
         ROUND(TRY_CAST(AVG(m.readmission_rate_pct) OVER three_rows AS DECIMAL(38,6)), 2)
           AS rolling_3mo_readmission_pct,
         ROUND(CAST(AVG(m.total_revenue_usd) OVER three_rows AS DECIMAL(28,6)), 2)
           AS rolling_3mo_revenue,
         LAG(m.total_admissions) OVER (PARTITION BY m.department ORDER BY m.month_start)
           AS prev_month_admissions
  FROM months m
  JOIN people p ON m.department <=> p.department AND m.month_start <=> p.month_start
  JOIN doctors d ON m.department <=> d.department AND m.month_start <=> d.month_start
  WINDOW three_rows AS (PARTITION BY m.department ORDER BY m.month_start
                        ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)
SELECT department, month_start, date_format(month_start, 'yyyy-MM') AS year_month,
       year(month_start) AS admission_year,
       concat('Q', quarter(month_start)) AS admission_quarter,
       total_admissions, unique_patients, active_doctors,
       CAST(avg_los_days AS DOUBLE) AS avg_los_days, CAST(stddev_los AS DOUBLE) AS stddev_los,
       min_los_days, max_los_days, median_los_days, readmission_count,
       CAST(readmission_rate_pct AS DOUBLE) AS readmission_rate_pct, icu_admissions,
       CAST(avg_procedures AS DOUBLE) AS avg_procedures,
       CAST(avg_cost_usd AS DOUBLE) AS avg_cost_usd,
       CAST(total_revenue_usd AS DOUBLE) AS total_revenue_usd,
       CAST(min_cost_usd AS DOUBLE) AS min_cost_usd, CAST(max_cost_usd AS DOUBLE) AS max_cost_usd,
       CAST(avg_patient_age AS DOUBLE) AS avg_patient_age,
       CAST(rolling_3mo_avg_los AS DOUBLE) AS rolling_3mo_avg_los,
       CAST(rolling_3mo_readmission_pct AS DOUBLE) AS rolling_3mo_readmission_pct,
       CAST(rolling_3mo_revenue AS DOUBLE) AS rolling_3mo_revenue,
       prev_month_admissions,
       CAST(ROUND(TRY_CAST(try_divide(100.0D * (total_admissions - prev_month_admissions),
                                  CAST(prev_month_admissions AS DOUBLE)) AS DECIMAL(38,6)), 1)
            AS DOUBLE) AS mom_admissions_change_pct,
       CASE WHEN readmission_rate_pct > 20 THEN 'CRITICAL'
            WHEN readmission_rate_pct > 15 THEN 'WARNING' ELSE 'OK' END AS readmission_status
FROM trends
