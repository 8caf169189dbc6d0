"""Questions asked of one layer: counts, samples and reports over silver and gold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import ascending, descending, mean, month_start, rounded, top
from tidewell.functions.columns import ratio
from tidewell.plans.gold import PRICE, sales_by_day

Tables = Mapping[str, DataFrame]


def bronze_row_count(t: Tables) -> DataFrame:
    return t["bronze_store_sales"].agg(F.count("*").alias("row_count"))


def bronze_sample(t: Tables, n: int = 10) -> DataFrame:
    """``n`` customers, those of the smallest keys, so that two looks show the same rows."""
    return t["bronze_customer"].orderBy("c_customer_sk").limit(n)


def sales_by_year_month(t: Tables) -> DataFrame:
    return t["silver_store_sales"].groupBy("year", "month").agg(
        F.count("*").alias("transaction_count"),
        F.sum(PRICE).alias("total_sales"),
        mean(PRICE).alias("avg_sale_price"),
    ).orderBy(*ascending("year", "month"))


def customer_demographics(t: Tables, n: int = 20) -> DataFrame:
    by_country = t["silver_customer"].filter(F.col("c_birth_country").isNotNull()).groupBy("c_birth_country").agg(
        F.count("*").alias("customer_count"),
        mean("c_birth_year").alias("avg_birth_year"),
    )
    return top(by_country, n, *descending("customer_count"), *ascending("c_birth_country"))


def weekend_vs_weekday(t: Tables) -> DataFrame:
    return sales_by_day(t).groupBy("is_weekend").agg(
        F.sum("lines").alias("transaction_count"),
        F.sum("revenue").cast("decimal(22,2)").alias("total_sales"),
        ratio(F.sum("revenue"), F.sum("priced")).alias("avg_sale"),
    )


def daily_sales_trend(t: Tables, year: int = 2023, days: int = 30) -> DataFrame:
    in_year = t["gold_daily_sales_summary"].filter(F.col("d_year") == year).select(
        "d_date", "d_day_name", "total_sales", "transaction_count", "unique_customers", "avg_sale_price")
    return top(in_year, days, *descending("d_date"), *ascending("d_day_name"))


def top_customers_by_ltv(t: Tables, n: int = 10) -> DataFrame:
    best = top(t["gold_customer_lifetime_value"], n, *descending("lifetime_value"), *ascending("c_customer_sk"))
    return best.select("c_customer_id", "full_name", "customer_segment", "lifetime_value",
                       "total_transactions", "avg_transaction_value")


def segment_distribution(t: Tables) -> DataFrame:
    return t["gold_customer_lifetime_value"].groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"),
        F.sum("lifetime_value").alias("total_value"),
        mean("lifetime_value").alias("avg_value"),
        mean("total_transactions").alias("avg_transactions"),
    ).orderBy(*descending("total_value"), *ascending("customer_segment"))


def top_products_by_category(t: Tables, year: int = 2023, ranks: int = 5) -> DataFrame:
    """Ranks 1 … ``ranks``; tied products share a rank and are all listed."""
    best = t["gold_product_performance"].filter((F.col("d_year") == year) & (F.col("category_rank") <= ranks))
    return best.select("i_category", "i_brand", "i_item_desc", "total_revenue", "units_sold", "category_rank") \
        .orderBy(*ascending("i_category", "category_rank"))


def monthly_revenue_growth(t: Tables, from_year: int = 2022) -> DataFrame:
    return t["gold_monthly_trends"].filter(F.col("d_year") >= from_year).select(
        "d_year", "d_month", "monthly_revenue", "monthly_transactions", "unique_customers",
        rounded("revenue_growth_pct").alias("revenue_growth_pct"),
    ).orderBy(*ascending("d_year", "d_month"))


def yoy_comparison(t: Tables, before: int = 2022, after: int = 2023) -> DataFrame:
    months = t["gold_monthly_trends"].filter(F.col("d_year").isin(before, after))
    revenue_of = lambda year: F.sum(
        F.when(F.col("d_year") == year, F.col("monthly_revenue")).otherwise(0))
    columns = (f"revenue_{before}", f"revenue_{after}")
    old, new = map(F.col, columns)
    return (
        months.groupBy("d_month")
        .agg(*[revenue_of(year).cast("decimal(32,2)").alias(name) for name, year in zip(columns, (before, after))])
        .withColumn("yoy_growth_pct", rounded(ratio(new - old, old) * 100))
        .orderBy(*ascending("d_month"))
    )


def ltv_cohorts(t: Tables) -> DataFrame:
    """Customers by the month of their first purchase, with their lifetime value."""
    first = t["gold_customer_lifetime_value"].join(
        t["silver_date_dim"], F.col("first_purchase_date") == F.col("d_date_sk"))
    return first.groupBy(month_start("d_date").alias("cohort_month")).agg(
        F.count("*").alias("cohort_size"),
        mean("lifetime_value").alias("avg_ltv"),
        F.sum("lifetime_value").alias("total_ltv"),
    ).orderBy(*ascending("cohort_month"))


def category_performance(t: Tables, year: int = 2023) -> DataFrame:
    return t["gold_product_performance"].filter(F.col("d_year") == year).groupBy("i_category").agg(
        F.sum("total_revenue").alias("category_revenue"),
        F.sum("units_sold").alias("category_units"),
        F.countDistinct("i_item_sk").alias("product_count"),
        # Six exact decimals, so that the sum does not depend on the order of rows.
        mean(F.col("avg_price").cast("decimal(28,6)")).alias("avg_product_price"),
    ).orderBy(*descending("category_revenue"), *ascending("i_category"))


def yearly_sales(t: Tables) -> DataFrame:
    return t["gold_daily_sales_summary"].groupBy("d_year").agg(F.sum("total_sales").alias("yearly_sales")) \
        .orderBy(*ascending("d_year"))


def daily_sales_for_month(t: Tables, year: int = 2023, month: int = 12) -> DataFrame:
    """One month of the daily mart; on the stored table only its directory is read."""
    return t["gold_daily_sales_summary"].filter((F.col("d_year") == year) & (F.col("d_month") == month))
