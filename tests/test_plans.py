"""What the physical plans must and must not contain."""

import pytest

from lakelayers.plans import queries as q
from lakelayers.plans.chain import Entity, transform
from lakelayers.sinks.tables import create_layer_table
from lakelayers.sources.tables import scan_table

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - {"file_digest_stream"}))
def test_no_python_and_no_product(spark, name):
    plan = plan_of(q.QUERIES[name](spark, SF_DIR))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", [
    "unnest_responses", "enrich_defaults", "bronze_normalize", "silver_standardize", "content_sha256",
    "mask_full", "mask_partial", "clip_text", "typed_parse", "validate_rules", "classify_messages",
    "classify_errors", "lineage_audit", "table_scan_filtered",
])
def test_row_wise_work_needs_no_shuffle(spark, name):
    assert "Exchange" not in plan_of(q.QUERIES[name](spark, SF_DIR))


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(q.table_scan_filtered(spark, SF_DIR).select("c_custkey"))
    assert "In(c_mktsegment" in plan and "EqualTo(c_nationkey,3)" in plan
    assert "c_acctbal" not in plan.split("ReadSchema:")[1]


def test_gold_reads_one_column_and_aggregates_before_the_shuffle(spark, table):
    ref = table("silver")
    create_layer_table(spark, ref, "silver")
    spec = Entity("a", "b", "/raw")
    plan = plan_of(transform(scan_table(spark, ref), spec, "gold"))
    assert "ReadSchema: struct<record_id:string>" in plan
    assert "partial_count" in plan


def test_merge_shuffles_once_after_partial_aggregation(spark):
    plan = plan_of(q.survivorship(spark, SF_DIR))
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("partial_min")


def test_numbering_moves_only_the_offsets(spark):
    """Rows meet the staged offsets by broadcast; nothing else is exchanged or sorted."""
    for name in ("landing_batch_ids", "landing_envelope"):
        plan = plan_of(q.QUERIES[name](spark, SF_DIR))
        assert plan.count("Exchange") == 1 and "BroadcastExchange" in plan
        assert "Window" not in plan and "Sort" not in plan
