from __future__ import annotations

import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("crease-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def write_docs(folder, docs: dict[str, object]) -> str:
    """One file per document (the reference's multi-line layout); a str value
    is written verbatim (for corrupt files)."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, doc in docs.items():
        text = doc if isinstance(doc, str) else json.dumps(doc, indent=2)
        (folder / name).write_text(text)
    return str(folder)
