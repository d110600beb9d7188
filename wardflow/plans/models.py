"""SQL models in dependency order, run by ``spark.sql``.

Each model names its inputs in braces; ``build_models`` hands it the DataFrames built before it.
"""

from __future__ import annotations

from pathlib import Path
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

SQL_DIR = Path(__file__).parent / "sql"

# Source first, every model after the ones it reads.
MODEL_ORDER = ["stg_admissions", "avg_los_by_department", "mart_dept_monthly_kpis"]


def model_sql(name: str) -> str:
    return (SQL_DIR / f"{name}.sql").read_text()


def model_inputs(name: str) -> list[str]:
    return sorted({field for _, field, _, _ in Formatter().parse(model_sql(name)) if field})


def build_models(spark: SparkSession, silver_admissions: DataFrame,
                 only: str | None = None) -> dict[str, DataFrame]:
    """All models over one Silver table, or ``only`` the named one and what it reads."""
    built = {"silver_admissions": silver_admissions}
    for name in MODEL_ORDER:
        built[name] = spark.sql(model_sql(name), **{i: built[i] for i in model_inputs(name)})
        if name == only:
            break
    return built


def register_views(models: dict[str, DataFrame]) -> None:
    """Expose the models to ad-hoc SQL under their own names."""
    for name, model in models.items():
        model.createOrReplaceTempView(name)
