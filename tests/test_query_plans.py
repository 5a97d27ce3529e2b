"""What registered queries must not do to be fit for larger tables."""

import os

import pytest

from marketloom.operators import merge
from marketloom.plans.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_new_rows_of_a_promotion_are_made_once(spark, monkeypatch):
    seen, made = [], merge.manifest
    monkeypatch.setattr(merge, "manifest", lambda existing, new: seen.append(new) or made(existing, new))
    QUERIES["staged_promotion"](spark, SF)
    assert seen and not [f for x in seen for f in x.inputFiles() if "lineitem" in f]


def test_paths_are_not_sorted(spark):
    plan = QUERIES["file_order"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    window = [x for x in plan.splitlines() if "Window [" in x][0]
    assert "task" in window and "file_path" not in plan
