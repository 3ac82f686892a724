import json
import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quotemart.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="2",
        spark__default__parallelism="2",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture
def land(tmp_path):
    """Write a landing file and return its folder."""

    def write(folder, name, content):
        target = tmp_path / folder
        target.mkdir(parents=True, exist_ok=True)
        text = content if isinstance(content, str) else json.dumps(content, indent=4)
        (target / name).write_text(text, encoding="utf-8")
        return str(target)

    return write


@pytest.fixture
def folder(tmp_path):
    """A fresh folder name."""
    return lambda name: str(tmp_path / f"{name}-{uuid.uuid4().hex}")
