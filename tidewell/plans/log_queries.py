"""Questions asked of the database and network log tables.

Both tables are laid out by year, month, day and hour; the queries on one day or
month filter on those columns, so only the matching directories are read.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import ascending, descending, percent, rounded, top

Tables = Mapping[str, DataFrame]


class Day(NamedTuple):
    year: int = 2026
    month: int = 1
    day: int = 5

    def covers(self) -> Column:
        return (F.col("year") == self.year) & (F.col("month") == self.month) & (F.col("day") == self.day)


def _count(name: str) -> Column:
    return F.count("*").alias(name)


def _avg(name: str) -> Column:
    return rounded(F.avg(name))


def db_query_count(t: Tables) -> DataFrame:
    return t["database_logs"].agg(_count("total_queries"))


def db_perf_by_type(t: Tables) -> DataFrame:
    spent = "execution_time_ms"
    return t["database_logs"].groupBy("query_type").agg(
        _count("query_count"), _avg(spent).alias("avg_execution_time_ms"),
        rounded(F.max(spent)).alias("max_execution_time_ms"), rounded(F.min(spent)).alias("min_execution_time_ms"),
    ).orderBy(*descending("query_count"), *ascending("query_type"))


def db_failed_queries(t: Tables, n: int = 20) -> DataFrame:
    where = ("database", "table", "query_type", "error_message")
    failures = t["database_logs"].filter(F.col("status") == "FAILED").groupBy(*where).agg(
        _count("failure_count"))
    return top(failures, n, *descending("failure_count"), *ascending(*where))


def db_top_users(t: Tables, n: int = 10) -> DataFrame:
    users = t["database_logs"].groupBy("user").agg(
        _count("query_count"), _avg("execution_time_ms").alias("avg_execution_time_ms"))
    return top(users, n, *descending("query_count"), *ascending("user"))


def db_hourly_pattern(t: Tables, on: Day = Day()) -> DataFrame:
    return t["database_logs"].filter(on.covers()).groupBy("year", "month", "day", "hour").agg(
        _count("query_count"), _avg("execution_time_ms").alias("avg_execution_time_ms"),
    ).orderBy("hour")


def db_slow_queries(t: Tables, over_ms: float = 5000, n: int = 50) -> DataFrame:
    slow = t["database_logs"].filter(F.col("execution_time_ms") > over_ms).select(
        "query_id", "database", "table", "query_type", "execution_time_ms", "user", "timestamp")
    return top(slow, n, *descending("execution_time_ms"), *ascending("query_id"))


def db_activity_by_database(t: Tables) -> DataFrame:
    return t["database_logs"].groupBy("database").agg(
        _count("total_queries"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful_queries"),
        F.count_if(F.col("status") == "FAILED").alias("failed_queries"),
        _avg("execution_time_ms").alias("avg_execution_time_ms"),
    ).orderBy(*descending("total_queries"), *ascending("database"))


def net_connection_count(t: Tables) -> DataFrame:
    return t["network_logs"].agg(_count("total_connections"))


def _traffic() -> list[Column]:
    return [_count("connection_count"), F.sum("bytes_sent").alias("total_bytes_sent"),
            F.sum("bytes_received").alias("total_bytes_received")]


def net_traffic_by_protocol(t: Tables) -> DataFrame:
    return t["network_logs"].groupBy("protocol").agg(*_traffic(), _avg("duration_ms").alias("avg_duration_ms")) \
        .orderBy(*descending("connection_count"), *ascending("protocol"))


def net_http_status_distribution(t: Tables) -> DataFrame:
    """Requests per status and their share; the total is the sum of the few group counts."""
    by_status = t["network_logs"].filter(F.col("protocol").isin("HTTP", "HTTPS")).groupBy("status_code").agg(
        _count("request_count"))
    whole = by_status.agg(F.sum("request_count").alias("all_requests"))
    return by_status.crossJoin(whole).select(
        "status_code", "request_count", rounded(percent("request_count", "all_requests")).alias("percentage"),
    ).orderBy(*descending("request_count"), *ascending("status_code"))


def net_top_source_ips(t: Tables, n: int = 20) -> DataFrame:
    return top(t["network_logs"].groupBy("source_ip").agg(*_traffic()), n,
               *descending("connection_count"), *ascending("source_ip"))


def net_top_ports(t: Tables, n: int = 15) -> DataFrame:
    where = ("destination_port", "protocol")
    return top(t["network_logs"].groupBy(*where).agg(_count("connection_count")), n,
               *descending("connection_count"), *ascending(*where))


def net_http_errors(t: Tables, n: int = 30) -> DataFrame:
    where = ("status_code", "http_method", "url_path")
    errors = t["network_logs"].filter(F.col("status_code") >= 400).groupBy(*where).agg(_count("error_count"))
    return top(errors, n, *descending("error_count"), *ascending(*where))


def net_hourly_traffic(t: Tables, on: Day = Day()) -> DataFrame:
    # Widened first: two 32-bit byte counts of one record may overflow their sum.
    volume = F.col("bytes_sent").cast("bigint") + F.col("bytes_received")
    return t["network_logs"].filter(on.covers()).groupBy("year", "month", "day", "hour").agg(
        _count("connection_count"), F.sum(volume).alias("total_bytes"),
    ).orderBy("hour")


def net_top_user_agents(t: Tables, n: int = 10) -> DataFrame:
    agents = t["network_logs"].filter(F.col("user_agent").isNotNull()).groupBy("user_agent").agg(
        _count("request_count"))
    return top(agents, n, *descending("request_count"), *ascending("user_agent"))


def activity_correlation(t: Tables, on: Day = Day()) -> DataFrame:
    """Distinct queries and connections per hour of a day.

    Each log is counted per hour before the hours meet, in place of pairing
    every query with every connection of its hour. An hour with queries but no
    connections counts 0.
    """
    def per_hour(log: str, key: str, name: str) -> DataFrame:
        return t[log].filter(on.covers()).groupBy("hour").agg(F.countDistinct(key).alias(name))

    queries = per_hour("database_logs", "query_id", "db_queries")
    connections = per_hour("network_logs", "connection_id", "network_connections")
    return queries.join(connections, "hour", "left").select(
        "hour", "db_queries", F.coalesce("network_connections", F.lit(0)).alias("network_connections"),
    ).orderBy("hour")


def db_partition_scan(t: Tables, year: int = 2026, month: int = 1) -> DataFrame:
    in_month = t["database_logs"].filter((F.col("year") == year) & (F.col("month") == month))
    keys = ("year", "month", "day", "hour")
    return in_month.groupBy(*keys).agg(_count("record_count")).orderBy(*keys)
