from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from helpers import admissions
from wardflow import constants as K
from wardflow.operators.admissions import flagged_admissions


def one(spark, **change):
    return flagged_admissions(admissions(spark, change)).first().asDict()


@pytest.fixture(scope="module")
def by_id(spark):
    """All edge cases in one run, keyed by admission id."""
    ages = [("-1", "18-29", K.AGE_NEGATIVE), ("0", "18-29", K.VALID), ("29", "18-29", K.VALID),
            ("30", "30-44", K.VALID), ("44", "30-44", K.VALID), ("45", "45-59", K.VALID),
            ("59", "45-59", K.VALID), ("60", "60-74", K.VALID), ("74", "60-74", K.VALID),
            ("75", "75+", K.VALID), ("120", "75+", K.VALID), ("121", "75+", K.AGE_UNREALISTIC),
            (None, "75+", K.VALID), ("abc", "75+", K.AGE_UNPARSEABLE)]
    costs = [("4999.99", "LOW", K.VALID), ("5000", "MEDIUM", K.VALID), ("19999.99", "MEDIUM", K.VALID),
             ("20000", "HIGH", K.VALID), ("50000", "VERY_HIGH", K.VALID),
             ("0", "LOW", K.COST_NON_POSITIVE), ("-5", "LOW", K.COST_NON_POSITIVE),
             (None, "VERY_HIGH", K.VALID)]
    stays = [("2024-01-09", -1, K.LOS_NEGATIVE), ("2024-01-10", 0, K.VALID),
             ("2025-01-09", 365, K.VALID), ("2025-01-10", 366, K.LOS_SUSPICIOUS)]
    changes, expected = [], {}
    for i, (age, group, flag) in enumerate(ages):
        changes.append({"admission_id": f"age{i}", "age": age})
        expected[f"age{i}"] = {"age_group": group, "dq_flag": flag}
    for i, (cost, tier, flag) in enumerate(costs):
        changes.append({"admission_id": f"cost{i}", "total_cost_usd": cost})
        expected[f"cost{i}"] = {"cost_tier": tier, "dq_flag": flag}
    for i, (discharge, days, flag) in enumerate(stays):
        changes.append({"admission_id": f"stay{i}", "discharge_date": discharge})
        expected[f"stay{i}"] = {"length_of_stay_days": days, "dq_flag": flag}
    got = {r["admission_id"]: r.asDict()
           for r in flagged_admissions(admissions(spark, *changes)).collect()}
    return got, expected


def test_bands_and_flags_at_their_edges(by_id):
    got, expected = by_id
    assert len(got) == len(expected)
    for key, values in expected.items():
        assert {k: got[key][k] for k in values} == values, key


def test_stay_rule_wins_over_age_rule(spark):
    assert one(spark, age="-1", discharge_date="2024-01-01")["dq_flag"] == K.LOS_NEGATIVE


def test_unparseable_dates_are_flagged_not_raised(spark):
    row = one(spark, admission_date="garbage")
    assert row["admission_date"] is None and row["dq_flag"] == K.ADMISSION_MISSING
    assert row["admission_year"] is None and row["admission_quarter"] is None
    assert one(spark, discharge_date="31/12/2024")["dq_flag"] == K.DISCHARGE_MISSING


def test_text_and_insurer_cleaning(spark):
    changes = [{"department": d} for d in (" Cardiology ", "CARDIOLOGY", "cardiology")]
    departments = flagged_admissions(admissions(spark, *changes)).select("department").distinct()
    assert [r[0] for r in departments.collect()] == ["CARDIOLOGY"]
    for insurer in (None, "unknown", " Unknown "):
        assert one(spark, insurer_name=insurer)["insurer_name"] == K.SELF_PAY
    assert one(spark, insurance_id=None)["insurance_id"] == K.SELF_PAY
    assert one(spark, insurer_name=" aetna ")["insurer_name"] == "AETNA"


def test_types_and_calendar(spark):
    row = one(spark, admission_date="2024-08-31", discharge_date="2024-09-02", readmission="true",
              total_cost_usd="43457.29")
    assert row["admission_date"] == date(2024, 8, 31)
    assert (row["admission_year"], row["admission_month"], row["admission_quarter"]) == (
        2024, 8, "Q3")
    assert row["length_of_stay_days"] == 2 and row["readmission"] is True
    assert row["total_cost_usd"] == Decimal("43457.2900")


def test_every_row_is_either_accepted_or_quarantined(spark):
    from wardflow.operators.quality import accepted, quarantined
    rows = flagged_admissions(admissions(
        spark, {}, {"age": "-1"}, {"admission_date": None}, {"total_cost_usd": "0"}))
    assert accepted(rows).count() + quarantined(rows).count() == rows.count() == 4


def test_whole_numbers_and_text_that_is_none(spark):
    flagged = flagged_admissions(admissions(
        spark, {"age": "45.0", "num_procedures": "2.00"}, {"age": "old"}, {"age": "45.5"},
        {"total_cost_usd": "a lot"}, {"total_cost_usd": "2000000000000"},
        {"total_cost_usd": "1" + "0" * 20}, {"age": None}))
    got = {r["admission_id"]: (r["dq_flag"], r["age"], r["num_procedures"])
           for r in flagged.collect()}
    assert got["A1"] == (K.VALID, 45, 2) and got["A7"][0] == K.VALID
    assert got["A2"][0] == got["A3"][0] == K.AGE_UNPARSEABLE
    assert got["A4"][0] == got["A6"][0] == K.COST_UNPARSEABLE and got["A5"][0] == K.VALID
    from wardflow.operators import gold
    assert gold.financial_summary(flagged.filter("admission_id = 'A5'")).first()[
        "total_revenue_usd"] == 2e12
    assert gold.dept_monthly_kpis(flagged.filter("admission_id = 'A5'")).count() == 1


def test_rows_without_a_key_are_kept_and_rejected(spark):
    flagged = flagged_admissions(admissions(
        spark, {"admission_id": None, "patient_id": "P1"}, {"admission_id": None},
        {"admission_id": None}, {"admission_id": "A"}, {"admission_id": "A"}))
    flags = sorted(r["dq_flag"] for r in flagged.collect())
    assert flags == [K.ADMISSION_ID_MISSING] * 3 + [K.VALID]
