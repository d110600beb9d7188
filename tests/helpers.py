"""Small inputs in the shape the operators read."""

from __future__ import annotations

from wardflow import constants as K

ADMISSION = {
    "patient_id": "P1", "admission_id": "A1", "admission_date": "2024-01-10",
    "discharge_date": "2024-01-15", "department": "Cardiology", "diagnosis": "Angina",
    "age": "50", "gender": "F", "attending_doctor": "dr0001", "insurance_id": "INS1",
    "insurer_name": "Aetna", "readmission": "false", "icu_stay": "false",
    "num_procedures": "2", "total_cost_usd": "10000.00",
}
LAB = {
    "lab_id": "L1", "patient_id": "P1", "admission_id": "A1", "test_name": "CBC", "marker": "WBC",
    "result_value": "5.0", "unit": "u", "reference_low": "4.0", "reference_high": "10.0",
    "is_critical": "false", "collected_at": "2024-01-11 08:00:00",
    "resulted_at": "2024-01-11 10:00:00", "lab_status": "final",
}


def _frame(spark, base, ddl, changes):
    return spark.createDataFrame([tuple({**base, **c}[k] for k in base) for c in changes], ddl)


def admissions(spark, *changes):
    """Raw admissions; row n is A<n> unless a change says otherwise."""
    numbered = [{"admission_id": f"A{i}", **c} for i, c in enumerate(changes, 1)]
    return _frame(spark, ADMISSION, K.ADMISSIONS_RAW_DDL, numbered)


def labs(spark, *changes):
    numbered = [{"lab_id": f"L{i}", **c} for i, c in enumerate(changes, 1)]
    return _frame(spark, LAB, K.LABS_RAW_DDL, numbered)


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
