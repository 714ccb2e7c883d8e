"""What the physical plans must and must not contain."""

import os
import re

import pytest

from millrace.catalog import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan_of(spark, name):
    return REGISTRY[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return len(re.findall(r"Exchange (?:hash|range|SinglePartition)", plan))


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "q_filter_id")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    read = re.search(r"ReadSchema: struct<(.*?)>", plan_of(spark, "q_tumble")).group(1)
    assert "props" not in read and "event_id" not in read and "user_id" not in read


@pytest.mark.parametrize(
    "name",
    ["q_interval_join", "q_interval_join_late", "q_window_join", "q_broadcast_threshold",
     "q_connect_join", "q_part_broadcast", "q_idle_source_watermark", "q_allowed_lateness"],
)
def test_no_nested_loops(spark, name):
    plan = plan_of(spark, name)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", ["q_topn_window", "q_topn_two_phase", "q_udtaf_top2_grouped"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    assert plan_of(spark, name).count("WindowGroupLimit") >= 2


def test_ungrouped_rank_takes_a_few_rows_per_task(spark):
    plan = plan_of(spark, "q_udtaf_top2")
    assert plan.index("Window") < plan.index("TakeOrderedAndProject(limit=2")


@pytest.mark.parametrize(
    "name, most",
    [("q_map_id", 0), ("q_flatmap_conditional", 0), ("q_side_output_alert", 0), ("q_union", 0),
     ("q_tumble", 1), ("q_slide", 1), ("q_window_all", 1), ("q_wordcount_batch", 1),
     ("q_running_max", 1), ("q_state_top3", 1), ("q_state_ttl", 1), ("q_changelog_sum", 1),
     ("q_count_tumble", 1), ("q_count_slide", 1), ("q_session", 1), ("q_topn_window", 2)],
)
def test_shuffles(spark, name, most):
    assert exchanges(plan_of(spark, name)) <= most


def test_aggregates_fold_before_the_shuffle(spark):
    for name in ("q_tumble", "q_window_all", "q_wordcount_batch", "q_sql_group_sum"):
        assert "partial_" in plan_of(spark, name)
