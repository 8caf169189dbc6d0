"""Silver layer: cleaned, deduplicated, typed tables.

Builders are pure: bronze frame in, silver frame out. ``load_timestamp`` is
added by the writers, so a result depends on its input only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.dedup import one_row_per_key, whole_rows


def _with_month(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Add year and month of the sold date, looked up in the date dimension (``d_date_sk, d_year, d_moy``).

    The key is a plain key: it need not be readable as a date. A key the calendar lacks gives NULLs. Both parts go as
    one number, which is aggregated by hash and not by sorting. A calendar has a row a day at any number of sales, so it
    is broadcast by a hint: left to its measured size, which is known only after its own shuffles, large sales were
    dealt out by day in the meantime, and then by ticket again.
    """
    months = calendar.filter(F.col("d_date_sk").isNotNull()).groupBy(F.col("d_date_sk").alias("_day")).agg(
        F.max(F.col("d_year") * 100 + F.col("d_moy")).alias("_month"))
    return sales.join(F.broadcast(months), F.col("ss_sold_date_sk") == F.col("_day"), "left").select(
        *sales.columns, F.expr("CAST(_month div 100 AS INT)").alias("year"), (F.col("_month") % 100).alias("month"))


def _sold(bronze: DataFrame) -> DataFrame:
    return bronze.filter(
        F.col("ss_sold_date_sk").isNotNull() & (F.col("ss_quantity") > 0) & (F.col("ss_sales_price") >= 0))


def store_sales(bronze: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dated sales of at least one unit at a non-negative price, each row once."""
    return _with_month(whole_rows(_sold(bronze)), calendar)


def store_sales_repeated(bronze: DataFrame, calendar: DataFrame) -> DataFrame:
    """The same rows as often as they come, for callers that ask which keys there are."""
    return _with_month(_sold(bronze), calendar)


def store_sales_keyed(bronze: DataFrame, calendar: DataFrame) -> DataFrame:
    """Variant: one row per ticket and item, dated sales only."""
    kept = one_row_per_key(bronze, ["ss_ticket_number", "ss_item_sk"])
    return _with_month(kept.filter(F.col("ss_sold_date_sk").isNotNull()), calendar)


def customer(bronze: DataFrame) -> DataFrame:
    known = bronze.filter(F.col("c_customer_sk").isNotNull())
    return one_row_per_key(known, ["c_customer_sk"]).withColumn(
        "full_name", F.concat_ws(" ", "c_first_name", "c_last_name"))


def date_dim(bronze: DataFrame) -> DataFrame:
    """Adds ``d_month`` (the month of year) and ``is_weekend``, which is false for an unknown day name."""
    known = bronze.filter(F.col("d_date_sk").isNotNull())
    weekend = F.coalesce(F.col("d_day_name").isin("Saturday", "Sunday"), F.lit(False))
    return one_row_per_key(known, ["d_date_sk"]).withColumns({"d_month": F.col("d_moy"), "is_weekend": weekend})


def generic(bronze: DataFrame) -> DataFrame:
    return whole_rows(bronze)


RULES = {"customer": customer, "date_dim": date_dim}

# Directory layout of the stored tables; everything else is unpartitioned.
PARTITIONS = {"store_sales": ("year", "month")}


def build(table: str, bronze: Mapping[str, DataFrame]) -> DataFrame:
    """The silver form of any bronze table; those without a rule of their own lose whole-row copies."""
    if table == "store_sales":
        return store_sales(bronze["bronze_store_sales"], bronze["bronze_date_dim"])
    return RULES.get(table, generic)(bronze[f"bronze_{table}"])


def builders(tables=("store_sales", "customer", "date_dim", "item", "store")) -> Mapping:
    """Silver tables by name, each declared from its bronze table."""
    return {f"silver_{name}": (lambda lake, name=name: build(name, lake)) for name in tables}
