"""Plan invariants of every registered batch query (at sf0.001).

No query broadcasts, pairs rows by a cartesian or nested-loop join, or runs
Python (but for aggregates that a user defines); every scan reads only the columns it uses (``events.value`` is used
by none) and every aggregation before a shuffle is partial.
"""

import re

import pytest

from eventlytics.plans.registry import QUERIES

from conftest import SF001

BATCH = sorted(n for n in QUERIES if not n.endswith("_stream"))
# whose complete aggregates (one row per key and chunk, or per window) go on to a coarser key
REDUCED = {"reconcile_consuming", "uv_sliding"}
USER = {"user_last_gap", "hourly_top_type"}  # aggregate in Python, partially in each task
CHECKED_BROADCAST = {"hot_items_sketched"}  # broadcasts a number of rows that it counts first
FORBIDDEN = ("BroadcastExchange", "BroadcastHashJoin", "BroadcastNestedLoopJoin",
             "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
             "MapInPandas")
NO_ARROW = ("MapInArrow",)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_batch_plan_invariants(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    if name in CHECKED_BROADCAST:  # the plan reads written tables; its scans and sketches are tested on their own
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
        return
    for op in FORBIDDEN if name in USER else FORBIDDEN + NO_ARROW:
        assert op not in plan, f"{name}: {op}"
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas, f"{name}: no parquet scan"
    for s in schemas:
        if s == "struct<value:string>" or "value:binary" in s:  # text lines or records, not the events' number
            continue
        assert "value:" not in s and len(s.split(",")) <= 5, f"{name}: {s}"
    # each aggregate feeding a shuffle is the partial half
    seen = 0
    for m in re.finditer(r"Exchange hashpartitioning.*\n\s*\+- (\w+)\(keys?=\[[^\]]*\], functions=\[(\w*)", plan):
        op, fn = m.groups()
        if op.endswith("Aggregate") and fn:
            seen += 1
            assert fn.startswith("partial_") or name in REDUCED, f"{name}: {m.group(0)}"
    assert seen or "Window" in plan or name in USER and plan.count("MapInArrow") == 3, f"{name}: no aggregation before a shuffle"
