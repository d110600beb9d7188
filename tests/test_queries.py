"""Every registered query against its SQL over the smallest supplied tables."""

from __future__ import annotations

import inspect
import subprocess
import sys

import pytest

from conftest import ROOT
from verification.compare import differences
from verification.oracles import ORACLES
from verification.queries import QUERIES, Layers

import __spark_entry__


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, small, name):
    assert differences(spark, small, name) == []


def test_entry(spark, small):
    result = __spark_entry__.entry(spark)
    assert result.count() > 0 and "rolling_3mo_avg_los" in result.columns


def test_no_python_functions_and_no_pair_plans(spark, small):
    for name, query in QUERIES.items():
        plan = query(spark, small)._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
            assert word not in plan, (name, word)


def test_queries_take_session_and_folder():
    for query in QUERIES.values():
        assert list(inspect.signature(query, follow_wrapped=False).parameters) == [
            "spark", "sf_dir"]


def test_everything_else_works_without_the_training_text_package():
    """The package and its pipeline can be deleted; nothing else imports them."""
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as entry; "
            "names = set(entry.queries()); assert 'silver_labs' in names; "
            "assert set(entry.oracle_sql()) == names and 'pipeline' not in names")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_operators_keep_real_types(spark, small):
    """Registered queries render dates and decimals as text; the operators do not."""
    layers = Layers(spark, small)
    silver, history = dict(layers.valid.dtypes), dict(layers.insurer_history.dtypes)
    assert silver["admission_date"] == silver["discharge_date"] == "date"
    assert silver["total_cost_usd"] == "decimal(18,4)" and silver["readmission"] == "boolean"
    assert silver["age"] == silver["num_procedures"] == silver["admission_year"] == "int"
    assert dict(layers.valid_labs.dtypes)["collected_at"] == "timestamp"
    assert history["valid_from"] == history["last_admission_date"] == "date"
    assert history["total_admissions"] == "bigint" and history["is_current"] == "boolean"
    assert dict(layers.parsed_vitals.dtypes)["event_ts"] == "timestamp"
    assert dict(layers.critical.dtypes)["admission_date"] == "date"
