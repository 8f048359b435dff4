"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from catalith.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        app="tests", master="local[8]", spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column over a single row of named values."""
    def run(column, **cells):
        names = list(cells) or ["_none"]
        kinds = {bool: "boolean", int: "bigint", float: "double", list: "array<double>"}
        schema = ", ".join(f"`{n}` {kinds.get(type(cells.get(n)), 'string')}" for n in names)
        row = tuple(cells.get(n) for n in names)
        return spark.createDataFrame([row], schema).select(column.alias("x")).first()["x"]
    return run
