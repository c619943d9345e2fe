"""Physical-plan properties the scale design relies on (from explain("formatted"))."""

import contextlib
import io
import re

import pytest

from conftest import SF001
from __spark_entry__ import queries
from mqtable.plans.catalog import QUERIES


def _plan(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        queries()[name](spark, SF001).explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["route_direct", "route_fanout", "route_topic"])
def test_routing_resolves_distinct_keys(spark, name):
    """Only distinct keys are shuffled; the routes are broadcast back to the messages."""
    plan = _plan(spark, name)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if "stream" not in n])
def test_no_cross_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_numbering_shuffles_messages_once(spark):
    """Without broadcasts the offset join and the window still share one exchange of the messages."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, "envelope")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    wide = [x for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan) if "body" in x]
    assert len(wide) == 1


def test_dead_letter_scans(spark):
    """No numbering and no job while the plan is built; at run time the bucket table is shared."""
    plan = _plan(spark, "dead_letter")
    assert plan.count(") Scan parquet") <= 7 and "__key" not in plan


def test_numbering_window_is_bucketed(spark):
    plan = _plan(spark, "envelope")
    specs = re.findall(r"windowspecdefinition\(([^)]*?) ASC", plan)
    # every window over messages is partitioned by (queue, bucket), never by queue alone
    assert any("__key" in s for s in specs)
    assert not re.search(r"row_number\(\) windowspecdefinition\(queue#\d+, message_id", plan)


def test_scans_prune_and_push_down(spark):
    union = _plan(spark, "multi_queue_union")
    assert re.search(r"PushedFilters: \[.*In\(event_type", union)
    assert re.search(r"ReadSchema: struct<event_id:bigint,event_type:string>", union)
    sliced = _plan(spark, "batch_read_queue")
    assert re.search(r"PartitionFilters: \[.*queue", sliced)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(delivery_tag,100\).*LessThanOrEqual\(delivery_tag,199\)", sliced)


def test_untagged_queries_skip_numbering(spark):
    # Catalyst drops the whole tag numbering (LEFT join + unused column) where no tag is used
    plan = _plan(spark, "micro_batch_assign")
    assert "Window" not in plan and "Exchange" not in plan
