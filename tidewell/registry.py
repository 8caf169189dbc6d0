"""Every named query with the parameters that suit the supplied test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.masking import masked_connections, masked_customers, masked_queries
from tidewell.operators.quality import quarantine, sales_quality, sales_rules
from tidewell.plans import business, challenges, gold, incremental, layer_queries, log_queries, pipeline, silver
from tidewell.schemas import DATABASE_LOG, NETWORK_LOG
from tidewell.session import configure, fresh_folder
from tidewell.sources.compaction import pack_small_files
from tidewell.sources.delimited import ingest_tables
from tidewell.sources.lake import append_new, compact, register_layer, remove_folder, write_table
from tidewell.sources.samples import log_stream, sample_tables
from tidewell.sources.tables import DeclaredTables
from tidewell.streaming import logs
from tidewell.streaming.rollup import traffic_rollup, write_rollup_stream

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2001, 8, 1)
LTV_CUTS = gold.SegmentCuts(3_000_000, 2_000_000, 1_000_000)
VIP_CUTS = challenges.VipCuts(3_000_000, 12, 2_000_000, 1_000_000)
LOG_DAY = log_queries.Day(2024, 1, 5)
REFRESH_UNTIL, REFRESH_DAYS = dt.date(2001, 7, 20), 40


def sample_lake(spark: SparkSession, folder: str) -> DeclaredTables:
    configure(spark)
    lake = sample_tables(spark, folder).extended(silver.builders()).extended(gold.builders(LTV_CUTS))
    # Queries keep the best few ranks or none; the stored mart ranks in full, see gold.product_performance.
    return lake.extended({"gold_product_performance": gold.product_performance_view})


def _on_lake(function: Callable[..., DataFrame], **parameters) -> Query:
    return lambda spark, folder: function(sample_lake(spark, folder), **parameters)


def _plain_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def _parsed(table: str, schema) -> Query:
    """The stream's parser on the table's raw JSON form, as a batch."""
    return lambda spark, folder: _plain_time(
        logs.parse_logs(logs.as_records(sample_lake(spark, folder)[table], schema), schema))


def _streamed(table: str, schema) -> Query:
    """The whole stream: source, parser and hour-partitioned sink, drained once; returns the stored table."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        records = logs.as_records(log_stream(spark, folder, table), schema)
        parsed = logs.parse_logs(records, schema)
        stored, progress = fresh_folder(spark, table), fresh_folder(spark, f"{table}-progress")
        logs.write_log_stream(parsed, progress, path=stored, available_now=True).awaitTermination()
        return _plain_time(spark.read.schema(parsed.schema).parquet(stored)).select(*parsed.columns)
    return run


def _bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Delimited copies of the raw tables, ingested; per table its status and what is read back from the stored form.

    The checksum is the sum of the lengths of all values as text, so it covers every column.
    """
    lake = sample_lake(spark, folder)
    source, target = fresh_folder(spark, "delimited"), fresh_folder(spark, "bronze")
    names = ("store_sales", "customer", "date_dim", "item", "store")
    for name in names:
        lake[f"bronze_{name}"].write.option("sep", "|").csv(f"{source}/{name}")
    schemas = {name: lake[f"bronze_{name}"].schema for name in names}
    status = ingest_tables(spark, source, target, names, schemas).select("table_name", "status", "error")
    lengths = lambda name: reduce(lambda a, b: a + b, [
        F.coalesce(F.length(F.col(column).cast("string")), F.lit(0)) for column in schemas[name].names])
    read_back = reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{target}/{name}").agg(
            F.lit(name).alias("name"), F.count("*").alias("rows"), F.sum(lengths(name)).alias("checksum"))
        for name in names])
    return status.join(read_back, F.col("table_name") == F.col("name")).drop("name")


def _sales_appended(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads into one stored table, the second repeating the first; each ticket line is stored once."""
    lake = sample_lake(spark, folder)
    sales = silver.store_sales_keyed(lake["bronze_store_sales_dirty"], lake["bronze_date_dim"])
    path, keys = fresh_folder(spark, "appended"), ["ss_ticket_number", "ss_item_sk"]
    append_new(sales.filter("ss_ticket_number % 3 = 0"), path, keys, ["year"])
    append_new(sales, path, keys, ["year"])
    return spark.read.schema(sales.schema).parquet(path).select(*sales.columns)


def _registered_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of the catalog after their files changed: a month went, and one came whose quantities are wider."""
    sales = sample_lake(spark, folder)["silver_store_sales"]
    root = fresh_folder(spark, "layer")
    path, database = f"{root}/store_sales", f"layer_{root.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{fresh_folder(spark, 'catalog')}'")
    late = (F.col("year") == 2000) & (F.col("month") == 5)
    write_table(sales.filter(~late), path, ["year", "month"], stamp=False)
    register_layer(spark, root, "silver_", database)
    remove_folder(spark, f"{path}/year=1999/month=3")
    wider = sales.filter(late).withColumn("ss_quantity", F.col("ss_quantity").cast("bigint"))
    write_table(wider, path, ["year", "month"], mode="append", stamp=False)
    status = register_layer(spark, root, "silver_", database)
    if [row.status for row in status] != ["registered", "dropped year=1999/month=3"]:
        raise RuntimeError(f"unexpected status {status}")
    return spark.table(f"{database}.silver_store_sales").select(*sales.columns)


def _logs_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The stored log after one month of it was rewritten."""
    logs_now = sample_lake(spark, folder)["database_logs"]
    path = fresh_folder(spark, "compacted")
    write_table(logs_now, path, ["year", "month"], stamp=False)
    compact(spark, path, ["year", "month"], {"year": LOG_DAY.year, "month": LOG_DAY.month})
    return _plain_time(spark.read.schema(logs_now.schema).parquet(path)).select(*logs_now.columns)


def _daily_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """The stored daily mart after late sales: built without every tenth ticket, then refreshed for two months."""
    lake, root = sample_lake(spark, folder), fresh_folder(spark, "refreshed")
    early = lake.extended({"bronze_store_sales": lambda _: lake["bronze_store_sales"].filter("ss_ticket_number % 10 > 0")})
    tables = ("store_sales", "date_dim")
    pipeline.build_silver(spark, early, root, tables, job_id="first")
    inputs = pipeline.silver_inputs(spark, root)
    write_table(gold.daily_sales_summary(inputs), f"{root}/gold/daily_sales_summary",
                gold.PARTITIONS["daily_sales_summary"], job_id="first")
    pipeline.build_silver(spark, lake, root, tables, job_id="second")
    pipeline.refresh_recent_days(spark, root, REFRESH_UNTIL, REFRESH_DAYS)
    stored = spark.read.parquet(f"{root}/gold/daily_sales_summary")
    return stored.select(*gold.daily_sales_summary(inputs).columns)


class _Killed(RuntimeError):
    pass


def _arrive(lake: DeclaredTables, folder: str, part: int) -> None:
    """Write the source files of one of two days: dimensions and sales come in both, some days and items late."""
    early = {
        "store_sales": "ss_ticket_number % 10 < 7", "customer": "c_customer_sk % 3 > 0", "item": "i_item_sk % 5 > 0",
        "date_dim": "d_date_sk % 100 < 28", "store": "true"}
    for name, rule in early.items():
        rows = lake[f"bronze_{name}"].filter(rule if part == 0 else f"NOT ({rule})")
        rows.write.mode("append").option("sep", "|").csv(f"{folder}/{name}")


def loaded_lake(spark: SparkSession, folder: str) -> str:
    """A lake loaded from delimited files in two increments, the second killed on its way and run again."""
    lake, source, root = sample_lake(spark, folder), fresh_folder(spark, "arrived"), fresh_folder(spark, "lake")
    names = ("store_sales", "customer", "date_dim", "item", "store")
    schemas = {name: lake[f"bronze_{name}"].schema for name in names}

    def load(seen=lambda step: None):
        incremental.load_new_files(spark, source, root, names, schemas, LTV_CUTS, seen)

    def killed(step: str) -> None:
        if step == "gold_product_performance":
            raise _Killed(step)
    _arrive(lake, source, 0)
    load()
    _arrive(lake, source, 1)
    try:
        load(killed)
    except _Killed:
        load()
    return root


_LOADED: dict[tuple[str, str], str] = {}


def _loaded(spark: SparkSession, folder: str) -> str:
    """The incrementally loaded lake, which is loaded once per session and source."""
    known = (spark.sparkContext.applicationId, folder)
    if known not in _LOADED:
        _LOADED[known] = loaded_lake(spark, folder)
    return _LOADED[known]


def _load_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Per load and bronze table the lines of its files, and how many marts were written from them."""
    root = _loaded(spark, folder)
    files = incremental.lineage(spark, root).filter("rejected IS NOT NULL")
    lines = files.groupBy("batch", "output").agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"),
                                                 F.min("input").alias("file"))
    marts = reduce(DataFrame.unionByName, [
        incremental.built_from(spark, root, row.file).filter(F.startswith("output", F.lit("gold_")))
        .groupBy("batch").agg(F.count("*").alias("marts")).withColumn("output", F.lit(row.output))
        for row in lines.collect()])  # a row per load and table
    return lines.drop("file").join(marts, ["batch", "output"])


def _after_loads(mart: str) -> Query:
    """A mart of the incrementally loaded lake."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        root = _loaded(spark, folder)
        # Names of the lazy form: the stored product mart ranks as it is declared, over all sales once more.
        columns = sample_lake(spark, folder)[f"gold_{mart}"].columns
        return incremental.Lake(spark, root).read("gold", mart).select(*columns)
    return run


def _broken_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Database-log records of which every seventh is cut short and every eleventh has a count out of range."""
    data, place = F.col("data"), F.regexp_extract("data", r'"query_id":"q(\d+)"', 1).cast("long")
    records = logs.as_records(log_stream(spark, folder, "database_logs"), DATABASE_LOG)
    return records.select(
        F.when(place % 7 == 0, F.substring(data, F.lit(1), F.length(data) - 9))
        .when(place % 11 == 0, F.regexp_replace(data, r'"rows_affected":\d+', '"rows_affected":99999999999'))
        .otherwise(data).alias("data"))


def _split_stream(spark: SparkSession, folder: str) -> str:
    """The broken stream drained once into the hour table and the quarantine beside it."""
    configure(spark)
    stored, progress = fresh_folder(spark, "split"), fresh_folder(spark, "split-progress")
    judged = logs.judged_logs(_broken_stream(spark, folder), DATABASE_LOG)
    logs.write_split_stream(judged, progress, stored, available_now=True).awaitTermination()
    return stored


def _valid_logs(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_time(logs.read_valid(spark, _split_stream(spark, folder), DATABASE_LOG))


def _quarantined_logs(spark: SparkSession, folder: str) -> DataFrame:
    """The stored text is the record itself; of it, which record it is and whether it was cut short."""
    found = logs.read_rejected(spark, _split_stream(spark, folder), DATABASE_LOG)
    return found.select(F.regexp_extract("data", r'"query_id":"(q\d+)"', 1).alias("query_id"),
                        (~F.endswith("data", F.lit("}"))).alias("truncated"))


_STORED: dict[tuple[str, str], str] = {}


def stored_lake(spark: SparkSession, folder: str) -> DeclaredTables:
    """The log tables by hour and the daily mart by month, as stored tables, written once per session and source."""
    lake, known = sample_lake(spark, folder), (spark.sparkContext.applicationId, folder)
    hours, months = ["year", "month", "day", "hour"], list(gold.PARTITIONS["daily_sales_summary"])
    layout = {"database_logs": hours, "network_logs": hours, "gold_daily_sales_summary": months}
    if known not in _STORED:
        root = fresh_folder(spark, "stored")
        for name, columns in layout.items():
            write_table(lake[name], f"{root}/{name}", columns, stamp=False)
        _STORED[known] = root
    return lake.extended({
        name: (lambda _, name=name: spark.read.schema(lake[name].schema).parquet(f"{_STORED[known]}/{name}"))
        for name in layout})


def _on_stored(function: Callable[..., DataFrame], **parameters) -> Query:
    """Queries that name directories: of the stored tables only those are read."""
    return lambda spark, folder: function(stored_lake(spark, folder), **parameters)


def _dirty_sales(rule: Callable[..., DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        lake = sample_lake(spark, folder)
        return rule(lake["bronze_store_sales_dirty"], lake["bronze_date_dim"])
    return run


def _sales_quality(spark: SparkSession, folder: str) -> DataFrame:
    lake = sample_lake(spark, folder)
    return sales_quality(
        lake["bronze_store_sales_dirty"], lake["bronze_date_dim"], lake["bronze_customer"], lake["bronze_item"])


def _quarantined(spark: SparkSession, folder: str) -> DataFrame:
    rejected = quarantine(sample_lake(spark, folder)["bronze_store_sales_dirty"], sales_rules())[1]
    return rejected.withColumn("failed_checks", F.array_join("failed_checks", "; "))


def _rollup(spark: SparkSession, folder: str) -> DataFrame:
    rolled = traffic_rollup(sample_lake(spark, folder)["network_logs"], window="1 hour")
    return rolled.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")})


SLOT_DAYS, SLOTS, VERY_LATE, LATENESS = 6, 5, 3, "9 days"


def _rollup_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Traffic by hour of a log that comes in deliveries of six days, some records one delivery late, others three.

    After each delivery a query drains what has come and ends; the next one goes on with its state. Records one
    delivery late count, those three late meet closed windows; the last windows stay open.
    """
    lake, place = sample_lake(spark, folder), F.substring("connection_id", 2, 19).cast("long")
    late = F.when(place % 7 == 0, VERY_LATE).when(place % 10 == 0, 1).otherwise(0)
    slot = F.floor((F.col("day") - 1) / SLOT_DAYS)
    network = lake["network_logs"].filter(slot < SLOTS)
    inbox, progress, stored = (fresh_folder(spark, f"rollup-{name}") for name in ("in", "progress", "out"))
    for delivery in range(SLOTS + VERY_LATE):
        logs.as_records(network.filter(slot + late == delivery), NETWORK_LOG).write.mode("append").text(inbox)
        parsed = logs.parse_network_logs(logs.read_records(spark, "text", inbox))
        rolled = traffic_rollup(parsed, window="1 hour", lateness=LATENESS)
        write_rollup_stream(rolled, progress, stored, available_now=True).awaitTermination()
    found = spark.read.schema(rolled.schema).parquet(stored)
    return found.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")})


def _logs_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The stored log by hour, written in four appends and then merged by size."""
    logs_now = sample_lake(spark, folder)["database_logs"]
    path, place = fresh_folder(spark, "packed"), F.substring("query_id", 2, 19).cast("long")
    for part in range(4):
        write_table(logs_now.filter(place % 4 == part), path, ["year", "month", "day"], mode="append", stamp=False)
    pack_small_files(spark, path)
    return _plain_time(spark.read.schema(logs_now.schema).parquet(path)).select(*logs_now.columns)


REGISTRY: dict[str, Query] = {
    "bronze_ingest": _bronze_ingest,
    **{f"incremental_{mart}": _after_loads(mart) for mart in gold.MARTS},
    "incremental_lineage": _load_lineage,
    "registered_sales": _registered_sales,
    "silver_store_sales": _dirty_sales(silver.store_sales),
    "silver_store_sales_keyed": _dirty_sales(silver.store_sales_keyed),
    "silver_customer": lambda s, d: silver.customer(sample_lake(s, d)["bronze_customer_dirty"]),
    "silver_date_dim": lambda s, d: silver.date_dim(sample_lake(s, d)["bronze_date_dim_dirty"]),
    "silver_generic": lambda s, d: silver.generic(sample_lake(s, d)["bronze_item_dirty"]),
    "gold_daily_sales_summary": _on_lake(gold.daily_sales_summary),
    "gold_customer_lifetime_value": _on_lake(gold.customer_lifetime_value, cuts=LTV_CUTS),
    "gold_product_performance": _on_lake(gold.product_performance),
    "gold_monthly_trends": _on_lake(gold.monthly_trends),
    "gold_top_products_by_store": _on_lake(gold.top_products_by_store),
    "bronze_row_count": _on_lake(layer_queries.bronze_row_count),
    "bronze_sample": _on_lake(layer_queries.bronze_sample),
    "sales_by_year_month": _on_lake(layer_queries.sales_by_year_month),
    "customer_demographics": _on_lake(layer_queries.customer_demographics),
    "weekend_vs_weekday": _on_lake(layer_queries.weekend_vs_weekday),
    "daily_sales_trend": _on_stored(layer_queries.daily_sales_trend, year=2000),
    "top_customers_by_ltv": _on_lake(layer_queries.top_customers_by_ltv),
    "segment_distribution": _on_lake(layer_queries.segment_distribution),
    "top_products_by_category": _on_lake(layer_queries.top_products_by_category, year=2000),
    "monthly_revenue_growth": _on_lake(layer_queries.monthly_revenue_growth, from_year=1999),
    "yoy_comparison": _on_lake(layer_queries.yoy_comparison, before=1999, after=2000),
    "ltv_cohorts": _on_lake(layer_queries.ltv_cohorts),
    "category_performance": _on_lake(layer_queries.category_performance, year=2000),
    "yearly_sales": _on_lake(layer_queries.yearly_sales),
    "daily_sales_for_month": _on_stored(layer_queries.daily_sales_for_month, year=2000, month=12),
    "customer_retention": _on_lake(business.customer_retention),
    "rfm_segments": _on_lake(business.rfm_segments, as_of=AS_OF),
    "product_affinity": _on_lake(business.product_affinity, more_than=40),
    "product_lifecycle": _on_lake(business.product_lifecycle, as_of=AS_OF),
    "seasonality": _on_lake(business.seasonality),
    "day_of_week_performance": _on_lake(business.day_of_week_performance),
    "moving_average_sales": _on_lake(business.moving_average_sales),
    "cohort_revenue": _on_lake(business.cohort_revenue, as_of=AS_OF, look_back_months=60),
    "clv_prediction": _on_lake(business.clv_prediction),
    "customer_segments_vip": _on_lake(challenges.customer_segments_vip, cuts=VIP_CUTS),
    "cohort_retention": _on_lake(challenges.cohort_retention),
    "product_affinity_ranked": _on_lake(challenges.product_affinity_ranked, at_least=2),
    "forecast_features": _on_lake(challenges.forecast_features, since=dt.date(2000, 1, 1)),
    "rfm_advanced": _on_lake(challenges.rfm_advanced, as_of=AS_OF),
    "db_query_count": _on_lake(log_queries.db_query_count),
    "db_perf_by_type": _on_lake(log_queries.db_perf_by_type),
    "db_failed_queries": _on_lake(log_queries.db_failed_queries),
    "db_top_users": _on_lake(log_queries.db_top_users),
    "db_hourly_pattern": _on_stored(log_queries.db_hourly_pattern, on=LOG_DAY),
    "db_slow_queries": _on_lake(log_queries.db_slow_queries),
    "db_activity_by_database": _on_lake(log_queries.db_activity_by_database),
    "net_connection_count": _on_lake(log_queries.net_connection_count),
    "net_traffic_by_protocol": _on_lake(log_queries.net_traffic_by_protocol),
    "net_http_status_distribution": _on_lake(log_queries.net_http_status_distribution),
    "net_top_source_ips": _on_lake(log_queries.net_top_source_ips),
    "net_top_ports": _on_lake(log_queries.net_top_ports),
    "net_http_errors": _on_lake(log_queries.net_http_errors),
    "net_hourly_traffic": _on_stored(log_queries.net_hourly_traffic, on=LOG_DAY),
    "net_top_user_agents": _on_lake(log_queries.net_top_user_agents),
    "activity_correlation": _on_stored(log_queries.activity_correlation, on=LOG_DAY),
    "db_partition_scan": _on_stored(log_queries.db_partition_scan, year=2024, month=1),
    "parse_database_logs": _parsed("database_logs", DATABASE_LOG),
    "parse_network_logs": _parsed("network_logs", NETWORK_LOG),
    "stream_database_logs": _streamed("database_logs", DATABASE_LOG),
    "stream_network_logs": _streamed("network_logs", NETWORK_LOG),
    "valid_database_logs": _valid_logs,
    "quarantined_database_logs": _quarantined_logs,
    "sales_appended": _sales_appended,
    "logs_compacted": _logs_compacted,
    "logs_packed": _logs_packed,
    "daily_refreshed": _daily_refreshed,
    "sales_quality": _sales_quality,
    "sales_quarantine": _quarantined,
    "traffic_rollup": _rollup,
    "traffic_rollup_stream": _rollup_stream,
    "masked_customers": lambda s, d: masked_customers(sample_lake(s, d)["silver_customer"], salt="lake"),
    "masked_queries": lambda s, d: _plain_time(masked_queries(sample_lake(s, d)["database_logs"], salt="lake")),
    "masked_connections": lambda s, d: _plain_time(masked_connections(sample_lake(s, d)["network_logs"])),
}
