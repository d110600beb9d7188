"""Every label, threshold, format and column contract the results depend on."""

from __future__ import annotations

# --- formats -------------------------------------------------------------
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
OPEN_END = "9999-12-31"

# --- departments the KPI models accept
DEPARTMENTS = ["CARDIOLOGY", "NEUROLOGY", "ORTHOPEDICS", "EMERGENCY", "ICU", "ONCOLOGY"]

# --- labels --------------------------------------------------------------
VALID = "VALID"
SELF_PAY = "SELF_PAY"
UNKNOWN_INSURER = "UNKNOWN"
UNKNOWN_DEPARTMENT = "UNKNOWN"

# --- bands: (exclusive upper bound, label), then the label beyond the last bound
AGE_BANDS = [(30, "18-29"), (45, "30-44"), (60, "45-59"), (75, "60-74")]
AGE_BEYOND = "75+"
COST_BANDS = [(5000, "LOW"), (20000, "MEDIUM"), (50000, "HIGH")]
COST_BEYOND = "VERY_HIGH"
COST_TIER_ORDER = ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]

# --- alert levels: (strict lower bound, label), then the label below the last bound
RISK_LEVELS = [(25, "HIGH_RISK"), (15, "MEDIUM_RISK")]
RISK_BELOW = "LOW_RISK"
STATUS_LEVELS = [(20, "CRITICAL"), (15, "WARNING")]
STATUS_BELOW = "OK"

# --- admission quality flags, in order of precedence
LOS_NEGATIVE = "INVALID_LOS:discharge_before_admission"
AGE_NEGATIVE = "INVALID_AGE:negative"
AGE_UNREALISTIC = "INVALID_AGE:unrealistic"
ADMISSION_MISSING = "NULL_DATE:admission"
DISCHARGE_MISSING = "NULL_DATE:discharge"
LOS_SUSPICIOUS = "SUSPICIOUS_LOS:over_365_days"
COST_NON_POSITIVE = "INVALID_COST:non_positive"
# Flags of this library: rows that used to be merged, emptied or read as valid.
ADMISSION_ID_MISSING = "NULL_ID:admission"
AGE_UNPARSEABLE = "INVALID_AGE:unparseable"
COST_UNPARSEABLE = "INVALID_COST:unparseable"
PATIENT_ID_MISSING = "NULL_ID:patient"
DEPARTMENT_MISSING = "NULL_DEPARTMENT"
MAX_AGE = 120
MAX_STAY_DAYS = 365
ADMISSION_FLAGS = [
    VALID, LOS_NEGATIVE, AGE_NEGATIVE, AGE_UNREALISTIC, ADMISSION_MISSING,
    DISCHARGE_MISSING, LOS_SUSPICIOUS, COST_NON_POSITIVE,
    ADMISSION_ID_MISSING, AGE_UNPARSEABLE, COST_UNPARSEABLE, PATIENT_ID_MISSING,
    DEPARTMENT_MISSING,
]

# --- lab quality flags, in order of precedence
RESULT_MISSING = "NULL_RESULT_VALUE"
COLLECTION_MISSING = "NULL_COLLECTION_TIME"
TAT_NEGATIVE = "INVALID_TAT:negative"
# Flags of this library. A result of this size cannot be measured, rounded and summed exactly.
LAB_ID_MISSING = "NULL_ID:lab"
RESULT_OUT_OF_RANGE = "INVALID_RESULT:out_of_range"
MAX_RESULT = 1e15
LAB_FLAGS = [VALID, RESULT_MISSING, COLLECTION_MISSING, TAT_NEGATIVE, LAB_ID_MISSING,
             RESULT_OUT_OF_RANGE]

# --- vitals: normal low, normal high, critical low, critical high
VITAL_RANGES = {
    "heart_rate": (55, 100, 30, 180),
    "systolic_bp": (100, 135, 70, 200),
    "diastolic_bp": (65, 85, 40, 120),
    "spo2_pct": (95, 100, 85, 100),
    "temperature_c": (36.5, 37.5, 35.0, 40.5),
    "resp_rate": (12, 20, 6, 35),
}

# --- display text
LIST_SEPARATOR = ", "
NO_VALUE = "–"
RISK_HOVER = (
    "<b>%s</b><br>Age group: %s<br>Department: %s<br>Readm. rate: %s%%<br>"
    "Avg cost: $%s<br>Total admissions: %s"
)

# --- sources, topics, cadence
ADMISSIONS_SOURCE = "admissions_csv_batch"
LABS_SOURCE = "lab_results_csv_batch"
VITALS_TOPIC = "patient-vitals"
STREAM_TRIGGER = "30 seconds"
ALERTS_LATE_BY = "2 hours"

# --- group sizes and cut-offs
MIN_GROUP = 10
ROLLING_MONTHS = 3
MAX_SANE_RATE_PCT = 100
TOP_HIGH_RISK = 10
TOP_DEPT_TESTS = 10
TOP_CRITICAL_LABS = 100
TOP_ALERT_DOCTORS = 15
TOP_ALERT_DOCTOR_DEPTS = 20

# --- file, stream and warehouse contracts
ADMISSIONS_RAW_DDL = """
    patient_id string, admission_id string, admission_date string, discharge_date string,
    department string, diagnosis string, age string, gender string, attending_doctor string,
    insurance_id string, insurer_name string, readmission string, icu_stay string,
    num_procedures string, total_cost_usd string
"""
LABS_RAW_DDL = """
    lab_id string, patient_id string, admission_id string, test_name string, marker string,
    result_value string, unit string, reference_low string, reference_high string,
    is_critical string, collected_at string, resulted_at string, lab_status string
"""
SILVER_ADMISSIONS_DDL = """
    patient_id string, admission_id string, admission_date date, discharge_date date,
    department string, diagnosis string, age int, gender string, attending_doctor string,
    insurance_id string, insurer_name string, readmission boolean, icu_stay boolean,
    num_procedures int, total_cost_usd decimal(18,4), length_of_stay_days int, age_group string,
    cost_tier string, admission_year int, admission_month int, admission_quarter string,
    dq_flag string, _ingested_at timestamp, _silver_processed_at timestamp,
    _silver_batch_id string, outcome string
"""
SILVER_LABS_DDL = """
    lab_id string, patient_id string, admission_id string, test_name string, marker string,
    result_value double, unit string, reference_low double, reference_high double,
    is_critical boolean, collected_at timestamp, resulted_at timestamp, lab_status string,
    result_interpretation string, deviation_from_range double, tat_minutes double,
    dq_flag string, _ingested_at timestamp, _silver_processed_at timestamp,
    _silver_batch_id string, outcome string
"""
PATIENT_DIM_DDL = """
    patient_id string, age int, gender string, insurance_id string, insurer_name string,
    total_admissions bigint, last_admission_date date, valid_from date, valid_to date,
    is_current boolean
"""
VITALS_MESSAGE_DDL = """
    message_id string, patient_id string, department string, timestamp string,
    patient_state string, is_anomaly boolean, heart_rate int, systolic_bp int,
    diastolic_bp int, spo2_pct int, temperature_c double, resp_rate int
"""
VITALS_LANDED_DDL = """
    message_id string, patient_id string, department string, timestamp string,
    patient_state string, is_anomaly boolean, heart_rate int, systolic_bp int, diastolic_bp int,
    spo2_pct int, temperature_c double, resp_rate int, event_ts timestamp,
    _ingested_at timestamp
"""
AUDIT_DDL = """
    step string, layer string, status string, records_in bigint, records_out bigint,
    elapsed_sec bigint, notes string, finished_at timestamp
"""
WAREHOUSE_DDL = """
    admission_id string, patient_id string, admission_date date, discharge_date date,
    department string, diagnosis string, age int, gender string, attending_doctor string,
    insurance_id string, insurer_name string, readmission boolean, icu_stay boolean,
    num_procedures int, total_cost_usd decimal(10,2), length_of_stay_days int,
    age_group string, cost_tier string, admission_year int, admission_month int,
    admission_quarter string, dq_flag string, _silver_processed_at timestamp
"""
WAREHOUSE_WIDTHS = {
    "admission_id": 20, "patient_id": 20, "department": 50, "diagnosis": 100, "gender": 1,
    "attending_doctor": 20, "insurance_id": 20, "insurer_name": 50, "age_group": 10,
    "cost_tier": 10, "admission_quarter": 5, "dq_flag": 50,
}

# Kinds that Silver casts the text columns of a delivery to.
ADMISSIONS_KINDS = {
    "patient_id": "string", "admission_id": "string", "admission_date": "date",
    "discharge_date": "date", "department": "string", "diagnosis": "string", "age": "long",
    "gender": "string", "attending_doctor": "string", "insurance_id": "string",
    "insurer_name": "string", "readmission": "boolean", "icu_stay": "boolean",
    "num_procedures": "long", "total_cost_usd": "decimal",
}
LABS_KINDS = {
    "lab_id": "string", "patient_id": "string", "admission_id": "string", "test_name": "string",
    "marker": "string", "result_value": "decimal", "unit": "string", "reference_low": "decimal",
    "reference_high": "decimal", "is_critical": "boolean", "collected_at": "timestamp",
    "resulted_at": "timestamp", "lab_status": "string",
}
