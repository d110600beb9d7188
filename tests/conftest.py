from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wardflow.session import build_session
    session = build_session("tests", {
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }, checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).exists():
        pytest.skip("supplied tables are not here")
    return SMALL


def rows(df, *columns):
    """Collected rows as tuples, sorted, with only ``columns`` when given."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda t: tuple((v is None, str(v)) for v in t))
