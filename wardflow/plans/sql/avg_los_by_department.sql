-- Monthly length of stay per department. Admissions are unique in the staging model (and an
-- expectation proves it), so counting them is counting rows; patients are the one distinct count.
WITH stays AS (
  SELECT department, CAST(trunc(admission_date, 'MM') AS DATE) AS admission_month,
         admission_id, patient_id, length_of_stay_days, readmission, icu_stay, age, total_cost_usd
  FROM {stg_admissions}
),
measures AS (
  SELECT department, admission_month,
         ROUND(TRY_CAST(try_divide(CAST(SUM(length_of_stay_days) AS DOUBLE),
                        COUNT(length_of_stay_days)) AS DECIMAL(38,6)), 2) AS avg_los_days,
         ROUND(TRY_CAST(SQRT(try_divide(
             GREATEST(CAST(SUM(CAST(length_of_stay_days AS BIGINT) * length_of_stay_days) AS DOUBLE)
                      - CAST(SUM(length_of_stay_days) AS DOUBLE) * SUM(length_of_stay_days)
                        / COUNT(length_of_stay_days), 0.0D),
             CAST(COUNT(length_of_stay_days) - 1 AS DOUBLE))) AS DECIMAL(38,6)), 2)
           AS stddev_los_days,
         MIN(length_of_stay_days) AS min_los_days,
         MAX(length_of_stay_days) AS max_los_days,
         count_if(readmission) AS readmission_count,
         ROUND(TRY_CAST(100.0D * count_if(readmission) / COUNT(*) AS DECIMAL(38,6)), 2)
           AS readmission_rate_pct,
         ROUND(TRY_CAST(try_divide(CAST(SUM(total_cost_usd) AS DOUBLE), COUNT(total_cost_usd))
               AS DECIMAL(38,6)), 2) AS avg_cost_usd,
         ROUND(SUM(total_cost_usd), 2) AS total_revenue_usd,
         ROUND(TRY_CAST(try_divide(CAST(SUM(age) AS DOUBLE), COUNT(age)) AS DECIMAL(38,6)), 1)
           AS avg_patient_age,
         count_if(icu_stay) AS icu_admissions,
         COUNT(admission_id) AS total_admissions,
         COUNT(DISTINCT patient_id) AS unique_patients
  FROM stays GROUP BY department, admission_month
)
SELECT m.department, m.admission_month, m.total_admissions, m.unique_patients,
       CAST(m.avg_los_days AS DOUBLE) AS avg_los_days,
       CAST(m.stddev_los_days AS DOUBLE) AS stddev_los_days,
       m.min_los_days, m.max_los_days, m.readmission_count,
       CAST(m.readmission_rate_pct AS DOUBLE) AS readmission_rate_pct,
       CAST(m.avg_cost_usd AS DOUBLE) AS avg_cost_usd,
       CAST(m.total_revenue_usd AS DOUBLE) AS total_revenue_usd,
       CAST(m.avg_patient_age AS DOUBLE) AS avg_patient_age,
       m.icu_admissions,
       CAST(ROUND(TRY_CAST(AVG(m.avg_los_days) OVER three_rows AS DECIMAL(38,6)), 2) AS DOUBLE)
         AS rolling_3mo_avg_los,
       CASE WHEN m.readmission_rate_pct > 20 THEN 'CRITICAL'
            WHEN m.readmission_rate_pct > 15 THEN 'WARNING' ELSE 'OK' END AS readmission_status
FROM measures m
WINDOW three_rows AS (PARTITION BY m.department ORDER BY m.admission_month
                      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
