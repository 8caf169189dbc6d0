"""Gold layer: aggregate marts over silver.

Facts are aggregated on their own keys before they meet a dimension wherever the
result allows it: partial aggregation flattens hot keys, and the join then sees
one row per key instead of one per sale. Dimensions that are not unique on their
key multiply rows in the join, so marts over them are summed once more on their
full key; that grouping contains the join key and needs no further exchange.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions import mean, ratio
from tidewell.operators.ranking import rank_within

Tables = Mapping[str, DataFrame]

PRICE = "ss_sales_price"


class SegmentCuts(NamedTuple):
    """Lower bounds (exclusive) of the three upper customer segments."""

    premium: float = 10000
    gold: float = 5000
    silver: float = 1000


def dated_sales(t: Tables) -> DataFrame:
    return t["silver_store_sales"].join(t["silver_date_dim"], F.col("ss_sold_date_sk") == F.col("d_date_sk"))


def sales_by_day(t: Tables) -> DataFrame:
    """Additive totals per calendar day, joined to the calendar after aggregation."""
    totals = t["silver_store_sales"].groupBy("ss_sold_date_sk").agg(
        F.count("*").alias("lines"),
        F.sum(PRICE).alias("revenue"),
        F.count(PRICE).alias("priced"),
        F.sum("ss_quantity").alias("quantity"),
    )
    return totals.join(t["silver_date_dim"], F.col("ss_sold_date_sk") == F.col("d_date_sk"))


def daily_sales_summary(t: Tables) -> DataFrame:
    return dated_sales(t).groupBy("d_date", "d_year", "d_month", "d_day_name").agg(
        F.sum(PRICE).alias("total_sales"),
        F.sum("ss_quantity").alias("total_quantity"),
        F.count("ss_ticket_number").alias("transaction_count"),
        mean(PRICE).alias("avg_sale_price"),
        F.countDistinct("ss_customer_sk").alias("unique_customers"),
    )


def segment(value: Column, cuts: SegmentCuts) -> Column:
    return (F.when(value > cuts.premium, "Premium").when(value > cuts.gold, "Gold")
            .when(value > cuts.silver, "Silver").otherwise("Bronze"))


def customer_lifetime_value(t: Tables, cuts: SegmentCuts = SegmentCuts()) -> DataFrame:
    """One row per buying customer. The purchase dates are date keys, as sold."""
    spent = t["silver_store_sales"].groupBy("ss_customer_sk").agg(
        F.sum(PRICE).alias("lifetime_value"),
        F.count("ss_ticket_number").alias("total_transactions"),
        mean(PRICE).alias("avg_transaction_value"),
        F.min("ss_sold_date_sk").alias("first_purchase_date"),
        F.max("ss_sold_date_sk").alias("last_purchase_date"),
    )
    return spent.join(t["silver_customer"], F.col("ss_customer_sk") == F.col("c_customer_sk")).select(
        "c_customer_sk", "c_customer_id", "full_name", "c_email_address", "c_birth_country",
        "lifetime_value", "total_transactions", "avg_transaction_value",
        "first_purchase_date", "last_purchase_date",
        segment(F.col("lifetime_value"), cuts).alias("customer_segment"),
    )


def product_sales(t: Tables) -> DataFrame:
    """Item by year, unranked."""
    yearly = dated_sales(t).groupBy("ss_item_sk", "d_year").agg(
        F.sum(PRICE).alias("revenue"), F.count(PRICE).alias("priced"),
        F.sum("ss_quantity").alias("units"), F.count("ss_ticket_number").alias("lines"),
    )
    return yearly.join(t["silver_item"], F.col("ss_item_sk") == F.col("i_item_sk")).groupBy(
        "i_item_sk", "i_item_id", "i_item_desc", "i_category", "i_brand", "d_year",
    ).agg(
        F.sum("revenue").cast("decimal(22,2)").alias("total_revenue"),
        F.sum("units").alias("units_sold"),
        F.sum("lines").alias("transaction_count"),
        ratio(F.sum("revenue"), F.sum("priced")).alias("avg_price"),
    )


def product_performance(t: Tables) -> DataFrame:
    """Item by year with its revenue rank in category and year.

    A category can hold most of the items, so the rank is taken over range
    partitions and not by one window task per category and year.
    """
    return rank_within(
        product_sales(t), ["i_category", "d_year"], "total_revenue",
        ["i_item_sk", "i_item_id", "i_item_desc", "i_brand"], "category_rank",
    )


def product_performance_view(t: Tables) -> DataFrame:
    """The same mart with a declarative rank, for queries that keep the best few or ignore the rank.

    A bound on the rank becomes a group limit in front of the exchange, and an
    unused rank is pruned with its window.
    """
    best = W.partitionBy("i_category", "d_year").orderBy(F.col("total_revenue").desc_nulls_last())
    return product_sales(t).withColumn("category_rank", F.rank().over(best))


def monthly_totals(t: Tables) -> DataFrame:
    return dated_sales(t).groupBy("d_year", "d_month", "d_moy").agg(
        F.sum(PRICE).alias("monthly_revenue"),
        F.sum("ss_quantity").alias("monthly_quantity"),
        F.count("ss_ticket_number").alias("monthly_transactions"),
        F.countDistinct("ss_customer_sk").alias("unique_customers"),
        mean(PRICE).alias("avg_transaction_value"),
    )


def with_growth(totals: DataFrame) -> DataFrame:
    """Months with growth over the month before; NULL when there is none or it sold nothing."""
    # The single-task window sees one row per calendar month.
    calendar = W.orderBy("d_year", "d_month", "d_moy")
    revenue, previous = F.col("monthly_revenue"), F.col("prev_month_revenue")
    return (
        totals.withColumn("prev_month_revenue", F.lag(revenue).over(calendar))
        .withColumn("revenue_growth_pct", ratio(revenue - previous, previous) * 100)
    )


def monthly_trends(t: Tables) -> DataFrame:
    return with_growth(monthly_totals(t))


def top_products_by_store(t: Tables, n: int = 10) -> DataFrame:
    """The ``n`` best-selling items per store by revenue.

    Spark turns the bound on row_number into a group limit before the exchange,
    so each map task sends at most ``n`` rows per store.
    """
    per_item = t["silver_store_sales"].groupBy("ss_store_sk", "ss_item_sk").agg(
        F.sum(PRICE).alias("revenue"), F.sum("ss_quantity").alias("units"))
    named = (
        per_item.join(t["silver_store"], F.col("ss_store_sk") == F.col("s_store_sk"))
        .join(t["silver_item"], F.col("ss_item_sk") == F.col("i_item_sk"))
        .groupBy("s_store_sk", "s_store_name", "i_item_sk", "i_item_desc")
        .agg(F.sum("revenue").cast("decimal(22,2)").alias("total_revenue"), F.sum("units").alias("units_sold"))
    )
    best = W.partitionBy("s_store_sk").orderBy(
        F.col("total_revenue").desc_nulls_last(), "i_item_sk", "s_store_name", "i_item_desc")
    return named.withColumn("store_rank", F.row_number().over(best)).filter(F.col("store_rank") <= n)


MARTS = {
    "daily_sales_summary": daily_sales_summary,
    "customer_lifetime_value": customer_lifetime_value,
    "product_performance": product_performance,
    "monthly_trends": monthly_trends,
    "top_products_by_store": top_products_by_store,
}

PARTITIONS = {
    "daily_sales_summary": ("d_year", "d_month"),
    "product_performance": ("d_year", "i_category"),
    "monthly_trends": ("d_year",),
}


def builders(cuts: SegmentCuts = SegmentCuts()) -> Mapping:
    makers = dict(MARTS, customer_lifetime_value=lambda t: customer_lifetime_value(t, cuts))
    return {f"gold_{name}": (lambda lake, make=make: make(lake)) for name, make in makers.items()}
