from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from trendlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        {"spark.sql.shuffle.partitions": "4", "spark.sql.legacy.timeParserPolicy": "EXCEPTION"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def write(tmp_path):
    """Write text or a JSON value to a file below a fresh folder; returns the folder."""

    def put(name: str, content) -> str:
        path = tmp_path / "bronze" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))
        return str(tmp_path / "bronze")

    return put


def as_tuples(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
