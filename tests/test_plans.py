"""Physical-plan properties of every registered query."""

import re

import pytest

from palimpsest.plans.registry import all_queries

from .conftest import SMALL

QUERIES = all_queries()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, (fn, _sql) in QUERIES.items():
        df = fn(spark, SMALL)
        out[name] = df._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_row_python_udfs(plans):
    bad = {n for n, p in plans.items() if "BatchEvalPython" in p or "ArrowEvalPython" in p}
    assert not bad


def test_python_only_where_a_generator_runs(plans):
    with_python = {n for n, p in plans.items() if "MapInPandas" in p or "MapInArrow" in p or "FlatMapGroupsInPandas" in p}
    assert with_python <= {"arm_outputs", "arms_wide", "blank_by_arm", "long_text_corrected", "fetch_manifest", "fetch_again",
                           "transcribe", "image_arms", "image_arms_wide", "request_batches", "request_batches_tight", "request_batches_original",
                           "request_batches_single", "request_files"}


def test_no_cross_joins(plans):
    bad = {n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad


def test_unused_columns_are_pruned_at_the_scan(plans):
    for name, p in plans.items():
        for schema in re.findall(r"ReadSchema: (struct<[^\n]*>)", p) + re.findall(r"struct<[^>\]]*>", p):
            assert "html:" not in schema, name
            assert "props:" not in schema, name
