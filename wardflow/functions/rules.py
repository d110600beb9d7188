"""Ordered quality rules folded into one flag column; the first rule that holds names the row."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow import constants as K


class Rule(NamedTuple):
    label: str
    broken: Column


def quality_flag(rules: list[Rule], passed: str = K.VALID) -> Column:
    flag = F.when(rules[0].broken, rules[0].label)
    for rule in rules[1:]:
        flag = flag.when(rule.broken, rule.label)
    return flag.otherwise(passed)


def admission_rules() -> list[Rule]:
    stay, age = F.col("length_of_stay_days"), F.col("age")
    return [
        Rule(K.LOS_NEGATIVE, stay < 0),
        Rule(K.AGE_NEGATIVE, age < 0),
        Rule(K.AGE_UNREALISTIC, age > K.MAX_AGE),
        Rule(K.ADMISSION_MISSING, F.col("admission_date").isNull()),
        Rule(K.DISCHARGE_MISSING, F.col("discharge_date").isNull()),
        Rule(K.LOS_SUSPICIOUS, stay > K.MAX_STAY_DAYS),
        Rule(K.COST_NON_POSITIVE, F.col("total_cost_usd") <= 0),
        Rule(K.ADMISSION_ID_MISSING, F.col("admission_id").isNull()),
        Rule(K.AGE_UNPARSEABLE, F.col("_unparsed_age")),
        Rule(K.COST_UNPARSEABLE, F.col("_unparsed_cost")),
        Rule(K.PATIENT_ID_MISSING, F.col("patient_id").isNull()),
        Rule(K.DEPARTMENT_MISSING, F.col("department").isNull()),
    ]


def lab_rules() -> list[Rule]:
    return [
        Rule(K.RESULT_MISSING, F.col("result_value").isNull()),
        Rule(K.COLLECTION_MISSING, F.col("collected_at").isNull()),
        Rule(K.TAT_NEGATIVE, F.col("tat_minutes") < 0),
        Rule(K.LAB_ID_MISSING, F.col("lab_id").isNull() | F.col("marker").isNull()),
        Rule(K.RESULT_OUT_OF_RANGE, F.abs("result_value") >= K.MAX_RESULT),
    ]
