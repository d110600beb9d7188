from __future__ import annotations

from helpers import labs
from wardflow import constants as K
from wardflow.operators.dedup import LAB_KEY_COMPAT
from wardflow.operators.labs import flagged_labs


def by_id(df):
    return {r["lab_id"]: r.asDict() for r in df.collect()}


def test_interpretation_deviation_and_turnaround(spark):
    got = by_id(flagged_labs(labs(
        spark,
        {"result_value": "4.0"}, {"result_value": "10.0"}, {"result_value": "3.2504"},
        {"result_value": "12.5"}, {"result_value": None}, {"result_value": "n/a"},
        {"resulted_at": "2024-01-11 08:00:45"})))
    shape = {k: (v["result_interpretation"], v["deviation_from_range"]) for k, v in got.items()}
    assert shape["L1"] == ("NORMAL", 0.0) and shape["L2"] == ("NORMAL", 0.0)
    assert shape["L3"] == ("LOW", 0.75) and shape["L4"] == ("HIGH", 2.5)
    assert shape["L5"] == ("UNKNOWN", 0.0) and shape["L6"] == ("UNKNOWN", 0.0)
    assert got["L1"]["tat_minutes"] == 120.0 and got["L7"]["tat_minutes"] == 0.8


def test_flags_in_order(spark):
    got = by_id(flagged_labs(labs(
        spark, {"result_value": None, "collected_at": None}, {"collected_at": "yesterday"},
        {"resulted_at": "2024-01-11 07:59:00"}, {"resulted_at": None}, {})))
    assert [got[f"L{i}"]["dq_flag"] for i in range(1, 6)] == [
        K.RESULT_MISSING, K.COLLECTION_MISSING, K.TAT_NEGATIVE, K.VALID, K.VALID]


def test_a_panel_keeps_its_markers(spark):
    panel = labs(spark, {"lab_id": "L1", "marker": "WBC"}, {"lab_id": "L1", "marker": "RBC"},
                 {"lab_id": "L1", "marker": "RBC"})
    assert flagged_labs(panel).count() == 2
    assert flagged_labs(panel, keys=LAB_KEY_COMPAT).count() == 1


def test_text_cleaning(spark):
    row = flagged_labs(labs(spark, {"test_name": " cbc", "lab_status": " preliminary "})).first()
    assert (row["test_name"], row["lab_status"]) == ("CBC", "PRELIMINARY")


def test_no_single_value_stops_the_labs(spark):
    flagged = flagged_labs(labs(spark, *[{"result_value": v} for v in (
        "1e20", "2e12", "NaN", "Infinity", "-Infinity", "1e308", "5.0")], {"marker": None}))
    got = [r["dq_flag"] for r in flagged.orderBy("lab_id").collect()]
    assert got == [K.RESULT_OUT_OF_RANGE, K.VALID, *[K.RESULT_MISSING] * 3, K.RESULT_OUT_OF_RANGE,
                   K.VALID, K.LAB_ID_MISSING]
    assert flagged.filter("dq_flag = 'VALID' AND deviation_from_range IS NULL").count() == 0
