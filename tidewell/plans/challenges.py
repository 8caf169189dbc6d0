"""Longer analytics: segments, retention cohorts, ranked affinity, forecast features, yearly RFM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions import (
    ascending, descending, mean, month_gap, percent, ratio, rounded, top, weekday_number,
)
from tidewell.operators.baskets import PairQuery, strongest_pairs
from tidewell.plans.business import (
    _today, basket_count, basket_rows, customer_months, moving_average, rfm_measures, rfm_scores, rfm_segment,
)
from tidewell.plans.gold import PRICE, dated_sales

Tables = Mapping[str, DataFrame]


class VipCuts(NamedTuple):
    """Lower bounds (exclusive): VIP spending and tickets, then High Value and Regular spending."""

    vip: float = 10000
    vip_tickets: int = 20
    high: float = 5000
    regular: float = 1000


def customer_segments_vip(t: Tables, cuts: VipCuts = VipCuts()) -> DataFrame:
    per_customer = t["silver_store_sales"].groupBy("ss_customer_sk").agg(
        F.countDistinct("ss_ticket_number").alias("transaction_count"),
        F.sum(PRICE).alias("total_spent"),
        mean(PRICE).alias("avg_order_value"),
    )
    spent = F.col("total_spent")
    everyone = t["silver_customer"].join(per_customer, F.col("c_customer_sk") == F.col("ss_customer_sk"), "left")
    name = F.concat("c_first_name", F.lit(" "), "c_last_name")
    return everyone.filter(spent.isNotNull()).select(
        "c_customer_id",
        F.coalesce(name, F.lit("Unknown")).alias("customer_name"),
        "total_spent", "transaction_count",
        rounded("avg_order_value").alias("avg_order_value"),
        F.when((spent > cuts.vip) & (F.col("transaction_count") > cuts.vip_tickets), "VIP")
        .when(spent > cuts.high, "High Value").when(spent > cuts.regular, "Regular")
        .otherwise("Occasional").alias("customer_segment"),
    ).orderBy(*descending("total_spent"), *ascending("c_customer_id"))


def cohort_retention(t: Tables, months: int = 12) -> DataFrame:
    """Share of each cohort that buys again, by months since its first purchase."""
    bought = customer_months(t).filter(F.col("ss_customer_sk").isNotNull())
    first = F.min("purchase_month").over(W.partitionBy("ss_customer_sk"))
    active = bought.withColumn("cohort_month", first).groupBy("cohort_month", "purchase_month").agg(
        F.count("*").alias("customers"))
    # Everyone in a cohort bought in its first month, so that row holds the cohort size.
    cohort = W.partitionBy("cohort_month")
    at_start = F.when(F.col("purchase_month") == F.col("cohort_month"), F.col("customers"))
    return (
        active.withColumns({
            "months_since_first": month_gap("cohort_month", "purchase_month"),
            "cohort_size": F.max(at_start).over(cohort),
        })
        .filter(F.col("months_since_first") <= months)
        .select("cohort_month", "months_since_first", "customers", "cohort_size",
                rounded(percent("customers", "cohort_size")).alias("retention_pct"))
        .orderBy(*ascending("cohort_month", "months_since_first"))
    )


def product_affinity_ranked(t: Tables, at_least: int = 100, k: int = 50) -> DataFrame:
    """Item pairs by co-occurrence with their dense rank.

    The best ``k`` rows hold every count above their own, so ranking just them
    gives the same rank as ranking all pairs.
    """
    rows, items = basket_rows(t["silver_store_sales"]), t["silver_item"].select("i_item_sk", "i_item_desc", "i_category")
    # Pairs of unlisted items never reach the report; leaving them out early keeps the bound on the k-th count valid.
    listed = rows.join(items, F.col("item") == F.col("i_item_sk"), "left_semi")
    pairs = strongest_pairs(listed.withColumn("node", F.col("item")), PairQuery(at_least, k))
    side = lambda s: items.select(
        F.col("i_item_sk").alias(f"product_{s}"), F.col("i_item_desc").alias(f"product_{s}_desc"),
        F.col("i_category").alias(f"product_{s}_category"))
    counts = pairs.select(F.col("node_a").alias("product_a"), F.col("node_b").alias("product_b"),
                          F.col("pairs").alias("co_occurrence_count"))
    named = counts.join(side("a"), "product_a").join(side("b"), "product_b").crossJoin(basket_count(rows))
    best = top(
        named, k, *descending("co_occurrence_count"),
        *ascending("product_a", "product_b", "product_a_desc", "product_b_desc"),
    )
    return best.select(
        "product_a", "product_a_desc", "product_a_category", "product_b", "product_b_desc", "product_b_category",
        "co_occurrence_count",
        rounded(percent("co_occurrence_count", "tickets"), 4).alias("support_pct"),
        F.dense_rank().over(W.orderBy(F.col("co_occurrence_count").desc())).alias("affinity_rank"),
    )


def forecast_features(t: Tables, since: dt.date = dt.date(2023, 1, 1)) -> DataFrame:
    """Category by day with moving averages, growth and calendar flags; lags count rows."""
    daily = dated_sales(t).join(
        t["silver_item"].select("i_item_sk", "i_category"), F.col("ss_item_sk") == F.col("i_item_sk"),
    ).groupBy("d_date", "i_category").agg(
        F.sum(PRICE).alias("daily_revenue"),
        F.countDistinct("ss_ticket_number").alias("daily_transactions"),
    )
    # A category has one row per calendar day, which bounds these windows.
    series = W.partitionBy("i_category").orderBy("d_date")
    revenue = F.col("daily_revenue")

    def growth(rows: int):
        before = F.lag(revenue, rows).over(series)
        return rounded(percent(revenue - before, before))

    weekday = weekday_number("d_date")
    return daily.select(
        "d_date", "i_category", "daily_revenue", "daily_transactions",
        rounded(moving_average("daily_revenue", series, 7)).alias("moving_avg_7day"),
        rounded(moving_average("daily_revenue", series, 30)).alias("moving_avg_30day"),
        growth(1).alias("dod_growth_pct"),
        growth(7).alias("wow_growth_pct"),
        weekday.alias("day_of_week"), F.month("d_date").alias("month"), F.quarter("d_date").alias("quarter"),
        weekday.isin(0, 6).cast("int").alias("is_weekend"),
    ).filter(F.col("d_date") >= F.lit(since)).orderBy(*ascending("i_category", "d_date"))


def rfm_advanced(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """RFM over the twelve months up to ``as_of``, with the three digits joined to one score."""
    recent = dated_sales(t).filter(F.col("d_date") >= F.add_months(_today(as_of), -12))
    names = ("c_customer_id", "c_first_name", "c_last_name")
    scored = rfm_scores(rfm_measures(recent, t, as_of, *names))
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.select(
        "c_customer_id",
        F.concat("c_first_name", F.lit(" "), "c_last_name").alias("customer_name"),
        F.col("recency").alias("recency_days"), "frequency",
        F.round("monetary", 2).cast("decimal(22,2)").alias("monetary_value"),
        "r_score", "f_score", "m_score",
        F.concat(*[score.cast("string") for score in (r, f, m)]).alias("rfm_score"),
        rfm_segment(r, f, m).alias("customer_segment"),
    ).orderBy(*descending("r_score", "f_score", "m_score"), *ascending("c_customer_id"))
