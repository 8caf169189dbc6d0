"""What Spark is asked to do: pruning, pushdown, join choices and behaviour on skew."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import final_plan_of, plan_of
from tidewell import session
from tidewell.plans import gold, layer_queries, log_queries, silver
from tidewell.registry import REGISTRY, sample_lake
from tidewell.sources.lake import write_table

FOLDER = "/root/testdata/sf0.001"
NO_PAIRING = sorted(set(REGISTRY) - {
    # These set single-row results (a total, a bound, tile ends) against many rows.
    "net_http_status_distribution", "product_affinity", "product_affinity_ranked", "rfm_segments", "rfm_advanced",
    "bronze_ingest", "stream_database_logs", "stream_network_logs", "gold_product_performance",
})


@pytest.mark.parametrize("name", NO_PAIRING)
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = plan_of(REGISTRY[name](spark, FOLDER))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert not re.search("Python|InArrow|InPandas", plan)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    lake = sample_lake(spark, FOLDER)
    write_table(lake["database_logs"].limit(200), f"{root}/db", ["year", "month", "day", "hour"])
    write_table(lake["network_logs"].limit(200), f"{root}/net", ["year", "month", "day", "hour"])
    write_table(gold.daily_sales_summary(lake), f"{root}/daily", ["d_year", "d_month"])
    read = spark.read.parquet
    return {"database_logs": read(f"{root}/db"), "network_logs": read(f"{root}/net"),
            "gold_daily_sales_summary": read(f"{root}/daily")}


@pytest.mark.parametrize("query, columns", [
    (lambda t: log_queries.db_hourly_pattern(t, log_queries.Day(2024, 1, 1)), "year month day"),
    (lambda t: log_queries.net_hourly_traffic(t, log_queries.Day(2024, 1, 1)), "year month day"),
    (lambda t: log_queries.activity_correlation(t, log_queries.Day(2024, 1, 1)), "year month day"),
    (lambda t: log_queries.db_partition_scan(t, 2024, 1), "year month"),
    (lambda t: layer_queries.daily_sales_for_month(t, 2000, 12), "d_year d_month"),
    (lambda t: layer_queries.daily_sales_trend(t, 2000), "d_year"),
])
def test_directories_are_pruned(stored, query, columns):
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", plan_of(query(stored)))
    assert filters
    for found in filters:
        assert all(f"isnotnull({column}#" in found for column in columns.split())


def test_only_needed_columns_are_read(spark, stored):
    plan = plan_of(log_queries.db_slow_queries(stored))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "client_ip" not in schema and "error_message" not in schema
    assert "GreaterThan(execution_time_ms,5000.0)" in plan and "TakeOrderedAndProject" in plan


def test_rank_bounds_prune_before_the_exchange(spark):
    assert "WindowGroupLimit" in plan_of(REGISTRY["gold_top_products_by_store"](spark, FOLDER))
    assert "WindowGroupLimit" in plan_of(REGISTRY["top_products_by_category"](spark, FOLDER))
    assert "Window" not in plan_of(REGISTRY["category_performance"](spark, FOLDER))


def test_ticket_partitioning_serves_the_deduplication(spark):
    plan = plan_of(sample_lake(spark, FOLDER)["silver_store_sales"])
    # Two for the fact join, which the deduplication reuses, and one for the months of the calendar.
    assert plan.count("Exchange hashpartitioning") == 3 and "SortMergeJoin" in plan


def test_hot_ticket_is_split_in_the_fact_join(spark, setting, tmp_path):
    """A third of all lines in one order: AQE splits it although deduplication wants the ticket together."""
    setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
            spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
            spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
            spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
            spark__sql__shuffle__partitions="8")
    lines = spark.range(60_000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("l_orderkey"),
        F.col("id").alias("l_partkey"), F.lit(1).cast("bigint").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"), F.lit(3.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit(None).cast("timestamp_ntz").alias("l_shipdate"))
    orders = spark.range(5000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 10).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.expr("timestamp_ntz'2000-01-05 00:00:00'").alias("o_orderdate"),
        F.lit("1").alias("o_orderpriority"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    read = spark.read.parquet
    bronze = read(str(tmp_path / "lineitem.parquet")).hint("merge").join(
        read(str(tmp_path / "orders.parquet")), F.col("l_orderkey") == F.col("o_orderkey"),
    ).select(F.lit(20000105).alias("ss_sold_date_sk"), F.col("l_partkey").alias("ss_item_sk"),
             F.col("l_orderkey").alias("ss_ticket_number"), F.lit(1).alias("ss_quantity"),
             F.lit(1).cast("decimal(12,2)").alias("ss_sales_price"))
    calendar = spark.createDataFrame([(20000105, 2000, 1)], "d_date_sk int, d_year int, d_moy int")
    sales = silver.store_sales(bronze, calendar)
    plan = final_plan_of(sales)
    assert "skew=true" in plan
    assert sales.count() == 60_000


def test_cluster_session_must_name_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


@pytest.mark.parametrize("name, columns", [
    ("db_hourly_pattern", "year month day"), ("net_hourly_traffic", "year month day"),
    ("activity_correlation", "year month day"), ("db_partition_scan", "year month"),
    ("daily_sales_trend", "d_year"), ("daily_sales_for_month", "d_year d_month")])
def test_registered_queries_read_only_their_directories(spark, name, columns):
    plan = plan_of(REGISTRY[name](spark, FOLDER))
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert scans and all(f"isnotnull({column}#" in scan for scan in scans for column in columns.split())
    assert "DataFilters: []" in plan
