"""Plan shape: filters and column pruning reach the parquet scan; no registered query plans a cartesian or
nested-loop join (pairs are never emitted)."""

import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from quire.session import read_table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pushdown_and_pruning_reach_the_scan(spark):
    d = read_table(spark, SF_SMALL, "documents").where(F.col("lang") == "en").select("doc_id")
    plan = _plan(d)
    assert re.search(r"PushedFilters: \[.*EqualTo\(lang,en\)", plan)
    assert re.search(r"ReadSchema: struct<doc_id:bigint,lang:string>", plan)


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not n.startswith("classify")))
def test_no_pair_emitting_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
