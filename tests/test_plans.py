"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import lakeops.plans.catalogue  # noqa: F401  (fills the registry)
from lakeops.operators import fraud, search
from lakeops.registry import QUERIES

from .conftest import SF

# text hashing, chunking and embedding models run in Arrow workers; everything else stays in the JVM
PYTHON = {"chunk_documents", "embed_chunks", "isolation_scores", "knn_exact", "knn_filtered", "knn_chunks", "knn_lsh", "knn_lsh_recall", "retrieval_context", "batch_predict"}
EAGER = {"catalog_partitions", "run_metrics", "doc_classifier", "fraud_scores", "engagement_model", "lineage_downstream", "secure_ml_table", "lineage_lists", "knn_ivf", "knn_ivf_recall", "alerts_put", "fraud_models"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NAMES = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in EAGER and n not in ("land_events", "bronze_transactions", "incremental_etl"))


@pytest.mark.parametrize("name", NAMES[::2])
def test_no_cross_join_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BatchEvalPython" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON:
        assert "Python" not in text and "MapIn" not in text


def test_ordinary_accounts_cost_one_exchange(lake):
    text = plan(fraud.fraud_features(lake("v_txn")))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "Join" not in text and "Union" not in text


def test_hot_accounts_are_kept_apart_by_a_bounded_broadcast(lake):
    text = plan(fraud.distance_features(lake("v_txn"), floor=0))
    # the hot rows themselves are read from the table of their slices
    assert "LeftAnti" in text and "BroadcastExchange" in text and "Union" in text


def test_filters_and_columns_reach_the_scan(lake):
    df = search.search(lake("orders"), equals={"o_orderstatus": "F"}, at_least={"o_totalprice": 1000.0}).select("o_orderkey")
    text = df._jdf.queryExecution().toString()
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThanOrEqual(o_totalprice,1000.0)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "o_custkey" not in schema and "o_orderdate" not in schema


def test_partition_filter_prunes_days(spark):
    from lakeops.session import fresh_dir
    from lakeops.sources import scan, sinks

    path = fresh_dir(spark, "prune")
    sinks.write_partitioned(spark.range(30).select("id", F.expr("date_add(DATE'2024-01-01', CAST(id AS INT))").alias("date")), path, ["date"])
    text = plan(scan.scan_date_range(spark, path, "2024-01-05", 2))
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= ", text)


def test_top_n_per_group_is_cut_before_the_shuffle(lake):
    df = search.newest_per_group(lake("v_audit").select("tenant_id", "ts", "event_id"), ["tenant_id"], [F.desc("ts"), F.col("event_id")], 3)
    assert "WindowGroupLimit" in plan(df) and "Partial" in plan(df)


def test_top_n_uses_take_ordered(lake):
    assert "TakeOrderedAndProject" in plan(search.search(lake("orders"), order=[F.desc("o_totalprice")], limit=5))


def test_scratch_folders_go_with_their_block(spark):
    import os

    from lakeops.session import materialize, scratch, shared_dir

    kept = materialize(spark.range(3), "kept")
    before = set(os.listdir(shared_dir(spark).removeprefix("file://").removeprefix("file:")))
    with scratch(spark):
        assert materialize(spark.range(5), "gone").count() == 5
    assert set(os.listdir(shared_dir(spark).removeprefix("file://").removeprefix("file:"))) == before
    assert kept.count() == 3


def test_lookup_table_does_not_shuffle_the_facts(spark):
    from lakeops.operators import binning

    facts = spark.range(1000).selectExpr("CAST(id AS STRING) AS mcc")
    plan = binning.encode_merchants(facts, "mcc", binning.merchant_categories(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_month_reaches_the_scan(lake):
    from lakeops.operators import reports

    plan = reports.events_by_type(lake("events"), "2024-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
