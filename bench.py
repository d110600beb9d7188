"""Time the headline queries over the supplied tables and print one JSON line.

BENCH_SF_DIR   folder of parquet tables   (default /root/testdata/sf0.1)
BENCH_CPUS     local threads              (default: all cores)
BENCH_ALL      set to 1 to time every registered query

Each query runs once to warm up and twice for the clock, its whole result going to the no-op
sink; the better run counts.
"""

from __future__ import annotations

import json
import os
import re
import time

from verification.queries import QUERIES
from wardflow.session import build_session

HEADLINE = [
    # cleaning and quality over whole tables
    "dedup_admissions", "dedup_labs", "silver_admissions", "silver_labs", "quarantine_admissions",
    "dq_summary", "expectations_admissions",
    # gold, models, joins
    "dept_monthly_kpis", "readmission_analysis", "financial_summary", "critical_labs_watch",
    "avg_los_by_department", "mart_dept_monthly_kpis",
    # patient history
    "patient_snapshot", "scd2_merge", "scd2_history", "asof_insurer_join",
    # vital signs
    "vitals_parse", "vitals_alerts", "vitals_alert_summary",
    # serving and reconciliation
    "serve_summary", "serve_monthly_trends", "serve_doctor_alerts", "shiny_clinical",
    "layer_reconciliation",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = list(QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    spark = build_session("bench", {
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    timed = {}
    for name in names:
        seconds(spark, name, sf_dir)
        timed[name] = round(min(seconds(spark, name, sf_dir) for _ in range(2)), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total" if names is HEADLINE else "all_queries_total",
        "value": round(sum(timed.values()), 3), "unit": "sec", "queries": timed,
        "sf": float(scale.group(1)) if scale else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
