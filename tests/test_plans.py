"""What the plans of the registered queries must and must not contain."""

import re

import pytest

from pulseweave.plans.catalog import QUERIES


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"table_sink_roundtrip"}))
def test_no_pairwise_joins_and_no_row_python(name, spark, small):
    plan = plan_of(QUERIES[name](spark, small))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


@pytest.mark.parametrize("name, filters", [
    ("threshold_filter", ["EqualTo(event_type,click)", "GreaterThan(value,120.0)"]),
    ("patient_records", ["EqualTo(user_id,7)"]),
    ("patient_drifts", ["EqualTo(user_id,7)"]),
    ("new_patients", ["LessThan(ts,2024-01-02"]),
])
def test_filters_reach_the_file(name, filters, spark, small):
    plan = plan_of(QUERIES[name](spark, small))
    pushed = " ".join(re.findall(r"PushedFilters: \[.*?\], ReadSchema", plan))
    for f in filters:
        assert f in pushed


@pytest.mark.parametrize("name, columns", [
    ("global_averages", {"ts", "event_type", "value"}),
    ("new_patients", {"ts", "user_id"}),
    ("period_counts", {"ts", "props"}),
])
def test_only_needed_columns_are_read(name, columns, spark, small):
    plan = plan_of(QUERIES[name](spark, small))
    read = {c.split(":")[0] for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan)
            for c in schema.split(",")}
    assert read == columns


def exchanges(frame):
    return re.findall(r"Exchange (hashpartitioning\([^\n]*?\)|SinglePartition)", plan_of(frame))


@pytest.mark.parametrize("name, count", [
    ("alerts", 0), ("route_units", 0), ("threshold_filter", 0), ("minutely", 1),
    ("global_averages", 1), ("drift_alerts", 1), ("session_union", 2), ("pack_hub_records", 1),
])
def test_number_of_shuffles(name, count, spark, small):
    assert len(exchanges(QUERIES[name](spark, small))) == count


def test_records_are_combined_before_a_hot_unit_is_shuffled(spark, small):
    plan = plan_of(QUERIES["global_averages"](spark, small))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_avg" in below.splitlines()[1]
