"""Physical-plan checks that keep the queries fit for large inputs: no
cartesian or nested-loop joins, no Python evaluation in the data path,
partial aggregation before every aggregate shuffle, and pruned scans."""

import re

import pytest

from eventlens.operators import aggregates
from eventlens.plans.pipeline import Pipeline
from eventlens.registry import QUERIES, bronze_dir
from tests.conftest import SF_SMALL

BATCH_KEYS = sorted(k for k in QUERIES if not k.startswith("stream_"))


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_KEYS)
def test_no_cartesian_no_python(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("table", sorted(aggregates.SPECS))
def test_aggregates_combine_before_shuffle(spark, table):
    plan = plan_text(Pipeline.from_fixtures(spark, SF_SMALL).table(table))
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert exchanges, table
    for i in exchanges:
        below = "\n".join(lines[i + 1 : i + 3])
        assert "partial_" in below or "merge_" in below, f"{table}: no map-side combine under\n{lines[i]}"


@pytest.mark.parametrize("table", sorted(aggregates.SPECS))
def test_messages_are_parsed_once(spark, table):
    plan = Pipeline.from_fixtures(spark, SF_SMALL).table(table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_bronze_reads_prune_kind_and_columns(spark):
    df = Pipeline.from_bronze(spark, bronze_dir(spark, SF_SMALL)).table("payment_method_stats")
    plan = plan_text(df)
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "PartitionFilters: [isnotnull(data_type" in scan and "(data_type" in scan and "= transaction)" in scan
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    cols = {c.split(":")[0] for c in read_schema.split(",")}
    assert cols == {"transaction_amount", "payment_method", "event_time"}


def test_topk_panels_use_take_ordered(spark):
    for name in ("rpt_top10_users", "rpt_latest_anomalies"):
        assert "TakeOrderedAndProject" in plan_text(QUERIES[name](spark, SF_SMALL)), name
