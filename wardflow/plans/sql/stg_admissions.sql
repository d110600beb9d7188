-- Staging contract: valid Silver admissions, the columns the models read.
SELECT admission_id, patient_id, attending_doctor, admission_date, discharge_date,
       age, age_group, gender, department, diagnosis, length_of_stay_days,
       readmission, icu_stay, num_procedures, insurance_id, insurer_name,
       total_cost_usd, cost_tier, admission_year, admission_month, admission_quarter, dq_flag
FROM {silver_admissions}
WHERE dq_flag = 'VALID'
