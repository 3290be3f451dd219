from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from postolake.session import build_session

    s = build_session(
        "local[4]",
        app_name="postolake-tests",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="postolake-test-")


def bronze_rows(spark, rows, filename="a.csv"):
    """A raw bronze frame from dicts keyed by silver names (missing -> NULL)."""
    from postolake.constants import BRONZE_HEADER_MAP

    data = []
    for r in rows:
        fn = r.get("filename", filename)
        data.append(tuple(r.get(s) for _, s in BRONZE_HEADER_MAP) + (fn,))
    schema = ", ".join(f"`{h}` string" for h, _ in BRONZE_HEADER_MAP) + ", filename string"
    return spark.createDataFrame(data, schema)
