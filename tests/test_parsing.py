from __future__ import annotations

from datetime import date, datetime

from wardflow.functions.parsing import iso_date, iso_timestamp


def test_dates(spark):
    given = {"2024-02-29": date(2024, 2, 29), "2023-02-29": None, "2024-1-5": None, "2024": None,
             " 2024-01-05": None, "2024-01-05 ": None, "2024-01-05T00:00:00": None,
             "2024/01/05": None, "garbage": None, "": None, None: None, "0001-01-01": date(1, 1, 1),
             "2024-13-01": None, "2024-01-05\n": None}
    df = spark.createDataFrame([(t,) for t in given], "t string")
    assert [r[0] for r in df.select(iso_date("t")).collect()] == list(given.values())


def test_timestamps(spark):
    given = {"2024-01-05 23:59:59": datetime(2024, 1, 5, 23, 59, 59), "2024-01-05 24:00:00": None,
             "2024-01-05 10:00": None, "2024-01-05T10:00:00": None,
             "2024-01-05 10:00:00+01:00": None, "2024-01-05": None, None: None}
    df = spark.createDataFrame([(t,) for t in given], "t string")
    assert [r[0] for r in df.select(iso_timestamp("t")).collect()] == list(given.values())


def test_values_already_typed_pass(spark):
    df = spark.sql("SELECT DATE '2024-01-05' AS d, TIMESTAMP '2024-01-05 10:00:00' AS t")
    got = df.select(iso_date("d"), iso_timestamp("t")).first()
    assert tuple(got) == (date(2024, 1, 5), datetime(2024, 1, 5, 10))
