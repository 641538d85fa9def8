"""Plan-quality guards for every registered query: no cross or nested-loop joins, no Python
evaluation in the plan, and column-pruned scans."""

import re

import pytest

from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _names():
    from __spark_entry__ import queries
    return sorted(queries())


@pytest.mark.parametrize("name", _names())
def test_plan_has_no_forbidden_operators(spark, name):
    from __spark_entry__ import queries
    df = queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], plan


def test_text_scans_read_only_the_text_column(spark):
    from __spark_entry__ import queries
    for name in ("word_count_raw", "word_count_unicode", "word_count_ascii", "word_total"):
        plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"ReadSchema: (struct<[^>]*>)", plan) == ["struct<text:string>"], name
