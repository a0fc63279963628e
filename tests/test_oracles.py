"""Every registered query against its SQL twin on the test tables."""

from __future__ import annotations

import os
import re
from pathlib import Path

import duckdb
import pytest

import checks.queries  # noqa: F401  (registers the checks)
from checks.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(SF_DIR) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
# These score rows in Python, batch by batch; all other queries stay in the JVM.
PYTHON = {"f6_fit_iforest", "f7_score_iforest", "f11_score_batch", "f13_placed_peers", "f13_saved_model", "m1_score_stream"}


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON:
        assert not re.search(r"ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)
    mine = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert mine
        return
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    types = {r[0]: KINDS.get(r[1], r[1]) for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {f.name: f.dataType.simpleString() for f in df.schema} == types
    assert len(mine) == len(theirs)
    left, right = _rows(df.columns, mine), _rows(columns, theirs)
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    assert not differing, f"{len(differing)} rows differ, first: {differing[0]}"
