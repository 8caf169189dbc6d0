"""Customer, product, time-series and cohort analytics over silver and gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions import ascending, descending, mean, month_gap, month_start, percent, ratio, rounded, top
from tidewell.operators.baskets import PairQuery, strongest_pairs
from tidewell.operators.ranking import tiles
from tidewell.plans.gold import PRICE, dated_sales, sales_by_day
from tidewell.session import pin

Tables = Mapping[str, DataFrame]

# RFM segment names by minimum recency, frequency and monetary score, first match wins.
CHAMPIONS, LOYAL, NEW, AT_RISK, LOST, OTHERS = (
    "Champions", "Loyal Customers", "New Customers", "At Risk", "Lost", "Regular")
# Days of the week in report order.
WEEK = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _today(as_of: dt.date | None) -> Column:
    return F.lit(as_of) if as_of else F.current_date()


def known_customers_only(df: DataFrame, t: Tables, key: str) -> DataFrame:
    customers = t["silver_customer"].select("c_customer_sk")
    return df.join(customers, F.col(key) == F.col("c_customer_sk"), "left_semi")


def customer_months(t: Tables) -> DataFrame:
    """One row per customer and month with purchases, with the month's revenue."""
    return dated_sales(t).groupBy("ss_customer_sk", month_start("d_date").alias("purchase_month")).agg(
        F.sum(PRICE).alias("revenue"))


def customer_retention(t: Tables) -> DataFrame:
    """Per month: active customers, and those who also bought in the month before."""
    # A customer has at most one row per calendar month, which bounds this window.
    history = W.partitionBy("ss_customer_sk").orderBy("purchase_month")
    bought = known_customers_only(customer_months(t), t, "ss_customer_sk").select(
        "purchase_month",
        (F.lag("purchase_month").over(history) == F.add_months("purchase_month", -1)).alias("retained"),
    )
    return bought.groupBy("purchase_month").agg(
        F.count("*").alias("active_customers"),
        F.count_if("retained").alias("retained_customers"),
    ).withColumn("retention_rate", rounded(percent("retained_customers", "active_customers"))) \
        .orderBy(*ascending("purchase_month"))


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), CHAMPIONS)
        .when((r >= 3) & (f >= 3), LOYAL)
        .when((r >= 4) & (f <= 2), NEW)
        .when((r <= 2) & (f >= 3), AT_RISK)
        .when((r <= 2) & (f <= 2), LOST)
        .otherwise(OTHERS)
    )


def rfm_measures(sales: DataFrame, t: Tables, as_of: dt.date | None, *customer_columns: str) -> DataFrame:
    """Days since the last purchase, tickets and spending per known customer."""
    per_customer = sales.groupBy("ss_customer_sk").agg(
        F.max("d_date").alias("last_day"),
        F.countDistinct("ss_ticket_number").alias("frequency"),
        F.sum(PRICE).alias("monetary"),
    )
    return per_customer.join(t["silver_customer"], F.col("ss_customer_sk") == F.col("c_customer_sk")).select(
        "c_customer_sk", *customer_columns,
        F.datediff(_today(as_of), "last_day").alias("recency"), "frequency", "monetary",
    )


def rfm_scores(measures: DataFrame) -> DataFrame:
    """Quintiles, 5 being the most recent, most frequent and highest spending."""
    return tiles(measures, "c_customer_sk", {
        "r_score": -F.col("recency"), "f_score": F.col("frequency"), "m_score": F.col("monetary"),
    }, 5)


def rfm_segments(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    scored = rfm_scores(rfm_measures(dated_sales(t), t, as_of, "full_name"))
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumns({"rfm_total": r + f + m, "customer_segment": rfm_segment(r, f, m)}) \
        .orderBy(*descending("rfm_total"), *ascending("c_customer_sk"))


def basket_rows(sales: DataFrame) -> DataFrame:
    """One row per ticket and item with its number of sale lines, stored for the passes that follow."""
    return pin(
        sales.groupBy(F.col("ss_ticket_number").alias("basket"), F.col("ss_item_sk").alias("item"))
        .agg(F.count("*").alias("lines"))
    )


def basket_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.countDistinct("basket").alias("tickets"))


def product_affinity(t: Tables, more_than: int = 100, k: int = 50) -> DataFrame:
    """Descriptions sold together most often, by the number of line pairs in a common ticket.

    An item key may carry several descriptions and a description several keys, so pairs are counted by description;
    a missing one is a value of its own.
    """
    items = t["silver_item"].select("i_item_sk", F.coalesce(
        F.concat(F.lit("="), "i_item_desc"), F.lit("")).alias("node")).distinct()
    rows = basket_rows(t["silver_store_sales"])
    described = rows.join(items, F.col("item") == F.col("i_item_sk")).drop("i_item_sk")
    pairs = strongest_pairs(described, PairQuery(more_than + 1, k))
    text = lambda node: F.when(F.col(node) != "", F.substring(F.col(node), F.lit(2), F.length(node)))
    named = (
        pairs.withColumns({"item_a_desc": text("node_a"), "item_b_desc": text("node_b")}).crossJoin(basket_count(rows))
        .select(
            "item_a_desc", "item_b_desc", F.col("pairs").alias("co_occurrence_count"),
            rounded(percent("pairs", "tickets")).alias("support_pct"),
        )
    )
    return top(named, k, *descending("co_occurrence_count"), *ascending("item_a_desc", "item_b_desc"))


def product_lifecycle(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """First and last sale of each item, and whether it still sells."""
    per_item = dated_sales(t).groupBy("ss_item_sk").agg(
        F.min("d_date").alias("first_day"), F.max("d_date").alias("last_day"),
        F.countDistinct("ss_ticket_number").alias("tickets"),
        F.sum("ss_quantity").alias("units"), F.sum(PRICE).alias("revenue"),
    )
    # Item rows equal in these three columns share their sales, hence max for the ticket count.
    named = per_item.join(t["silver_item"], F.col("ss_item_sk") == F.col("i_item_sk")).groupBy(
        "i_item_sk", "i_item_desc", "i_category",
    ).agg(
        F.min("first_day").alias("first_sale_date"), F.max("last_day").alias("last_sale_date"),
        F.max("tickets").alias("total_transactions"), F.sum("units").alias("total_units_sold"),
        F.sum("revenue").cast("decimal(22,2)").alias("total_revenue"),
    )
    silent_days = F.datediff(_today(as_of), "last_sale_date")
    return named.withColumns({
        "product_lifetime_days": F.datediff("last_sale_date", "first_sale_date"),
        "lifecycle_stage": F.when(silent_days < 30, "Active").when(silent_days < 90, "Declining")
                            .otherwise("Discontinued"),
    }).orderBy(*descending("total_revenue"), *ascending("i_item_sk", "i_item_desc"))


def seasonality(t: Tables) -> DataFrame:
    """Spread of monthly revenue by month of year; the deviation is given to the cent."""
    revenue = F.col("monthly_revenue")
    return t["gold_monthly_trends"].groupBy("d_month", "d_moy").agg(
        mean(revenue).alias("avg_monthly_revenue"),
        rounded(F.stddev_samp(revenue.cast("double"))).alias("revenue_stddev"),
        F.min(revenue).alias("min_revenue"),
        F.max(revenue).alias("max_revenue"),
    ).orderBy(*ascending("d_moy"))


def day_of_week_performance(t: Tables) -> DataFrame:
    place = F.array_position(F.array(*map(F.lit, WEEK)), F.col("d_day_name"))
    by_name = sales_by_day(t).groupBy("d_day_name").agg(
        F.sum("lines").alias("transaction_count"),
        F.sum("revenue").cast("decimal(22,2)").alias("total_sales"),
        ratio(F.sum("revenue"), F.sum("priced")).alias("avg_transaction_value"),
        F.sum("quantity").alias("total_quantity"),
    )
    return by_name.orderBy(F.nullif(place, F.lit(0)).asc_nulls_last())


def moving_average(value: str, window: W, rows: int) -> Column:
    frame = window.rowsBetween(1 - rows, W.currentRow)
    return ratio(F.sum(value).over(frame), F.count(value).over(frame))


def moving_average_sales(t: Tables, days: int = 90) -> DataFrame:
    daily = sales_by_day(t).groupBy("d_date").agg(F.sum("revenue").cast("decimal(22,2)").alias("daily_revenue"))
    # The single-task window sees one row per calendar day.
    calendar = W.orderBy("d_date")
    smoothed = daily.withColumns({
        "ma_7day": moving_average("daily_revenue", calendar, 7),
        "ma_30day": moving_average("daily_revenue", calendar, 30),
    })
    return top(smoothed, days, *descending("d_date"))


def cohort_revenue(t: Tables, as_of: dt.date | None = None, look_back_months: int = 12) -> DataFrame:
    """Revenue by month of first purchase and month of purchase, for the recent cohorts.

    The first month comes from a window over a customer's months (bounded by the
    calendar) in place of a join of the sales with their own minimum.
    """
    months = known_customers_only(customer_months(t), t, "ss_customer_sk")
    first = F.min("purchase_month").over(W.partitionBy("ss_customer_sk"))
    since = F.add_months(_today(as_of), -look_back_months)
    return (
        months.withColumn("cohort_month", first)
        .filter(F.col("cohort_month") >= since)
        .groupBy("cohort_month", "purchase_month")
        .agg(F.count("*").alias("customers"), F.sum("revenue").cast("decimal(22,2)").alias("revenue"))
        .withColumns({
            "months_since_first": month_gap("cohort_month", "purchase_month"),
            "revenue_per_customer": rounded(ratio("revenue", "customers")),
        })
        .orderBy(*ascending("cohort_month", "months_since_first"))
    )


def clv_prediction(t: Tables, n: int = 100) -> DataFrame:
    """Spending per year of active life, for customers with more than one ticket."""
    per_customer = dated_sales(t).groupBy("ss_customer_sk").agg(
        F.countDistinct("ss_ticket_number").alias("purchase_frequency"),
        mean(PRICE).alias("avg_order_value"),
        F.datediff(F.max("d_date"), F.min("d_date")).alias("customer_lifespan_days"),
        F.sum(PRICE).alias("total_spent"),
    ).filter(F.col("purchase_frequency") > 1)
    yearly = ratio(F.col("purchase_frequency") * F.col("avg_order_value") * 365.0, "customer_lifespan_days")
    predicted = F.when(F.col("customer_lifespan_days") > 0, rounded(yearly)).otherwise(F.col("avg_order_value"))
    scored = per_customer.withColumn("predicted_annual_value", predicted)
    return top(scored, n, *descending("predicted_annual_value"), *ascending("ss_customer_sk"))
