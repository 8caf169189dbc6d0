"""The lake's bronze and log tables, derived from the supplied test tables.

FIXTURES.md defines the mapping. Every frame is a lazy DataFrame over the whole
parquet table, so plans on top of it grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import size_shuffles
from tidewell.sources.tables import DeclaredTables

# Declared so that no read has to open parquet footers first.
_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _pick(index: Column, *values) -> Column:
    """The value at ``index``; the last value serves every index beyond."""
    chosen = F.lit(values[-1])
    for position in range(len(values) - 2, -1, -1):
        chosen = F.when(index == position, F.lit(values[position])).otherwise(chosen)
    return chosen


def _text(value: Column) -> Column:
    return value.cast("string")


class _Raw:
    """The supplied tables, read as a batch or, with a stream reader, as they arrive in the folder."""

    def __init__(self, reader, folder: str):
        self._reader, self._folder = reader, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self._reader().schema(_SCHEMAS[name]).option("pathGlobFilter", f"{name}.parquet").parquet(self._folder)


def _date_key(day: str) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def _sale_lines(raw: _Raw) -> DataFrame:
    """Two facts meet here, so they are merged by ticket at any size.

    The partitioning by ticket also serves the whole-row deduplication that
    follows; AQE splits a hot ticket (at the price of one more exchange).
    """
    return raw.lineitem.hint("merge").join(raw.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _store_sales(raw: _Raw) -> DataFrame:
    return _sale_lines(raw).select(
        _date_key("o_orderdate").alias("ss_sold_date_sk"),
        F.col("l_partkey").alias("ss_item_sk"),
        F.col("o_custkey").alias("ss_customer_sk"),
        F.col("l_suppkey").alias("ss_store_sk"),
        F.col("l_orderkey").alias("ss_ticket_number"),
        F.col("l_linenumber").alias("ss_line_number"),
        F.col("l_quantity").cast("int").alias("ss_quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("ss_sales_price"),
    )


def _store_sales_dirty(raw: _Raw) -> DataFrame:
    """Sales with missing keys, bad quantities and prices, and repeated rows, to exercise the silver rules."""
    ticket = F.col("l_orderkey")
    copies = F.explode(F.sequence(F.lit(1), F.when(ticket % 53 == 0, 2).otherwise(1)))
    price = (F.when(ticket % 83 == 0, -F.col("l_extendedprice"))
             .when(ticket % 79 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")))
    return _sale_lines(raw).withColumn("copy", copies).select(
        F.when(ticket % 97 != 0, _date_key("o_orderdate")).alias("ss_sold_date_sk"),
        F.col("l_partkey").alias("ss_item_sk"),
        F.col("o_custkey").alias("ss_customer_sk"),
        F.col("l_suppkey").alias("ss_store_sk"),
        ticket.alias("ss_ticket_number"),
        F.col("l_linenumber").alias("ss_line_number"),
        F.when(ticket % 101 == 0, F.lit(None)).when(ticket % 89 == 0, 0)
        .otherwise(F.col("l_quantity").cast("int")).alias("ss_quantity"),
        price.cast("decimal(12,2)").alias("ss_sales_price"),
    )


def _customer(raw: _Raw) -> DataFrame:
    name = F.col("c_name")
    part = lambda n: F.split_part(name, F.lit("#"), F.lit(n))
    return raw.customer.join(raw.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("c_customer_sk"),
        name.alias("c_customer_id"),
        part(1).alias("c_first_name"),
        part(2).alias("c_last_name"),
        F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("c_email_address"),
        F.col("n_name").alias("c_birth_country"),
        (F.lit(1930) + F.col("c_custkey") % 70).cast("int").alias("c_birth_year"),
    )


def _date_dim(raw: _Raw) -> DataFrame:
    day = F.col("d_date")
    days = raw.orders.select(F.col("o_orderdate").cast("date").alias("d_date")).distinct()
    return days.select(
        _date_key("d_date").alias("d_date_sk"),
        day,
        F.year(day).alias("d_year"),
        F.month(day).alias("d_moy"),
        F.date_format(day, "EEEE").alias("d_day_name"),
    )


def _customer_dirty(raw: _Raw) -> DataFrame:
    """Customers with missing keys, and repeated keys whose copies differ or lack a value."""
    key = F.col("c_customer_sk")
    copy = F.explode(F.sequence(F.lit(0), F.when(key % 7 == 0, 2).otherwise(0)))
    return _customer(raw).withColumn("copy", copy).withColumns({
        "c_customer_sk": F.when(key % 31 != 0, key),
        "c_last_name": F.when(F.col("copy") == 0, F.col("c_last_name")),
        "c_birth_year": (F.col("c_birth_year") + F.col("copy")).cast("int"),
    }).drop("copy")


def _date_dim_dirty(raw: _Raw) -> DataFrame:
    """Dates with missing keys and day names, and repeated keys of another day name."""
    key = F.col("d_date_sk")
    copy = F.explode(F.sequence(F.lit(0), F.when(key % 5 == 0, 1).otherwise(0)))
    return _date_dim(raw).withColumn("copy", copy).withColumns({
        "d_day_name": F.when(key % 11 == 0, F.lit(None)).when(F.col("copy") == 1, F.lit("Caturday"))
        .otherwise(F.col("d_day_name")),
        "d_date_sk": F.when(key % 13 != 0, key),
    }).drop("copy")


def _item_dirty(raw: _Raw) -> DataFrame:
    """Items of which every third stands twice, and every sixth once more under another brand."""
    key = F.col("i_item_sk")
    copy = F.explode(F.sequence(F.lit(0), F.when(key % 6 == 0, 2).when(key % 3 == 0, 1).otherwise(0)))
    return _item(raw).withColumn("copy", copy).withColumn(
        "i_brand", F.when(F.col("copy") == 2, F.lit("own brand")).otherwise(F.col("i_brand"))).drop("copy")


def _item(raw: _Raw) -> DataFrame:
    return raw.part.select(
        F.col("p_partkey").alias("i_item_sk"),
        F.concat(F.lit("ITEM"), _text(F.col("p_partkey"))).alias("i_item_id"),
        F.col("p_name").alias("i_item_desc"),
        F.col("p_type").alias("i_category"),
        F.col("p_brand").alias("i_brand"),
    )


def _store(raw: _Raw) -> DataFrame:
    return raw.supplier.select(F.col("s_suppkey").alias("s_store_sk"), F.col("s_name").alias("s_store_name"))


def _event_clock(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "event_timestamp": F.col("ts").cast("timestamp"),
        "timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts"), "hour": F.hour("ts"),
    })


def _database_logs(raw: _Raw) -> DataFrame:
    event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    failed = kind == "error"
    return _event_clock(raw.events).select(
        "timestamp",
        F.concat(F.lit("q"), _text(event)).alias("query_id"),
        _pick(event % 4, "ledger", "fleet", "archive", "people").alias("database"),
        _pick(user % 6, "invoices", "parcels", "shelves", "visits", "ratings", "coupons").alias("table"),
        F.when(kind == "view", "SELECT").when(kind == "signup", "INSERT").when(kind == "click", "MERGE")
        .when(failed, "CALL").otherwise("VACUUM").alias("query_type"),
        (F.col("value") * 50).alias("execution_time_ms"),
        (event % 50001).cast("int").alias("rows_affected"),
        F.concat(F.lit("user"), _text(user % 8)).alias("user"),
        F.concat(F.lit("10.0."), _text(user % 256), F.lit("."), _text(event % 254 + 1)).alias("client_ip"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, _pick(event % 3, "row version changed", "quota used up", "replica behind"))
        .alias("error_message"),
        "event_timestamp", "year", "month", "day", "hour",
    )


def _network_logs(raw: _Raw) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    http = event % 6 < 2
    whole = lambda value: value.cast("int")
    return _event_clock(raw.events).select(
        "timestamp",
        F.concat(F.lit("c"), _text(event)).alias("connection_id"),
        F.concat(F.lit("192.168.0."), _text(user)).alias("source_ip"),
        whole(1024 + event % 64512).alias("source_port"),
        F.concat(F.lit("10.1."), _text(event % 256), F.lit(".1")).alias("destination_ip"),
        _pick(user % 7, 70, 123, 514, 1883, 5683, 9418, 11211).alias("destination_port"),
        _pick(event % 6, "HTTP", "HTTPS", "MQTT", "NTP", "SYSLOG", "GIT").alias("protocol"),
        whole(100 + (event * 7919) % 999901).alias("bytes_sent"),
        whole(100 + (event * 104729) % 4999901).alias("bytes_received"),
        whole(10 + event % 4991).alias("duration_ms"),
        whole(1 + event % 1000).alias("packets_sent"),
        whole(1 + event % 2000).alias("packets_received"),
        F.when(http, _pick(user % 5, "GET", "HEAD", "OPTIONS", "TRACE", "CONNECT")).alias("http_method"),
        F.when(http, _pick(user % 8, 206, 202, 304, 308, 409, 418, 504, 507)).alias("status_code"),
        F.when(http, _pick(user % 4, "/tides", "/harbour/berths", "/log/today", "/map.png")).alias("url_path"),
        F.when(http, _pick(user % 3, "buoy/1.4", "lighthouse/0.9", "logbook/3.2")).alias("user_agent"),
        F.when(http & (event % 10 > 2), "https://example.com/log/today").alias("referer"),
        "event_timestamp", "year", "month", "day", "hour",
    )


def sample_tables(spark: SparkSession, folder: str) -> DeclaredTables:
    """Bronze retail tables and the two log tables over the parquet files in ``folder``."""
    raw = _Raw(lambda: spark.read, folder.rstrip("/"))
    size_shuffles(spark, [f"{folder.rstrip('/')}/{name}.parquet" for name in _SCHEMAS])
    makers = {
        "bronze_store_sales": _store_sales,
        "bronze_store_sales_dirty": _store_sales_dirty,
        "bronze_customer": _customer,
        "bronze_date_dim": _date_dim,
        "bronze_customer_dirty": _customer_dirty,
        "bronze_date_dim_dirty": _date_dim_dirty,
        "bronze_item_dirty": _item_dirty,
        "bronze_item": _item,
        "bronze_store": _store,
        "database_logs": _database_logs,
        "network_logs": _network_logs,
    }
    return DeclaredTables({name: (lambda _, make=make: make(raw)) for name, make in makers.items()})


def log_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """``database_logs`` or ``network_logs`` as a stream over the events file."""
    makers = {"database_logs": _database_logs, "network_logs": _network_logs}
    return makers[table](_Raw(lambda: spark.readStream, folder.rstrip("/")))
