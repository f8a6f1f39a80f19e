from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    from attestry.session import local_session

    session = local_session(cpus=4, memory="4g", name="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    if not DATA.exists():
        pytest.skip(f"no test tables at {DATA}")
    return str(DATA)


@pytest.fixture
def evaluate(spark):
    """Values of one expression over rows of a given schema."""

    def run(rows, schema, expression):
        frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
        picked = frame.select("_i", expression.alias("value")).collect()
        return [row["value"] for row in sorted(picked, key=lambda row: row["_i"])]

    return run
