"""Run registered queries next to their SQL and report every difference.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from verification.oracles import ORACLES
from verification.queries import QUERIES


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value)


def oracle_rows(sf_dir: str, sql: str) -> tuple[dict[str, str], list[tuple]]:
    with duckdb.connect() as con:
        for path in sorted(Path(sf_dir).glob("*.parquet")):
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        con.execute(sql)
        types = {d[0]: str(d[1]) for d in con.description}
        rows = con.fetchall()
    return types, rows


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows),
                  key=lambda r: tuple((v is None, v or "") for v in r))


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN"}


def differences(spark: SparkSession, sf_dir: str, name: str) -> list[str]:
    """Empty when columns, types, row counts and all values agree."""
    result = QUERIES[name](spark, sf_dir)
    types, expected = oracle_rows(sf_dir, ORACLES[name])
    actual = result.collect()
    problems = []
    if sorted(result.columns) != sorted(types):
        return [f"columns {sorted(result.columns)} != {sorted(types)}"]
    for column, kind in result.dtypes:
        if TYPE_NAMES.get(kind, kind) != types[column]:
            problems.append(f"type of {column}: {kind} != {types[column]}")
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    left, right = canonical(result.columns, actual), canonical(list(types), expected)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        names = sorted(result.columns)
        a, b = wrong[0]
        first = [f"{n}: {x} != {y}" for n, x, y in zip(names, a, b) if x != y]
        problems.append(f"{len(wrong)} rows differ, first: {first} in {a}")
    return problems


def main() -> int:
    from wardflow.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", {
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.time()
        try:
            problems = differences(spark, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s",
              *problems, sep="\n     " if problems else "", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
