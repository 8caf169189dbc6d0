"""Marts and reports on a hand-made lake."""

import datetime as dt
from decimal import Decimal

import pytest

from tidewell.plans import business, challenges, gold, layer_queries, log_queries, silver
from tidewell.sources.tables import DeclaredTables

DAYS = [(20000131, dt.date(2000, 1, 31)), (20000229, dt.date(2000, 2, 29)), (20000301, dt.date(2000, 3, 1)),
        (20000401, dt.date(2000, 4, 1))]


def lake(spark, sales, items=((1, "I1", "cup", "A", "B"), (2, "I2", "cup", "A", "B"), (3, "I3", "pot", None, "B")),
         customers=((1, "C1", "Ada", "B"), (2, "C2", None, "D"), (3, "C3", "Eve", "F"))):
    """Sales rows: date key, item, customer, ticket, quantity, price; the line number makes them distinct."""
    frames = {
        "bronze_store_sales": spark.createDataFrame(
            [(d, i, c, 1, t, n, q, Decimal(p)) for n, (d, i, c, t, q, p) in enumerate(sales)],
            "ss_sold_date_sk int, ss_item_sk bigint, ss_customer_sk bigint, ss_store_sk bigint, "
            "ss_ticket_number bigint, ss_line_number int, ss_quantity int, ss_sales_price decimal(12,2)"),
        "bronze_date_dim": spark.createDataFrame(
            [(k, d, d.year, d.month, d.strftime("%A")) for k, d in DAYS],
            "d_date_sk int, d_date date, d_year int, d_moy int, d_day_name string"),
        "bronze_customer": spark.createDataFrame(
            [(k, n, f, last, "e", "X", 1950) for k, n, f, last in customers],
            "c_customer_sk bigint, c_customer_id string, c_first_name string, c_last_name string, "
            "c_email_address string, c_birth_country string, c_birth_year int"),
        "bronze_item": spark.createDataFrame(
            list(items), "i_item_sk bigint, i_item_id string, i_item_desc string, i_category string, i_brand string"),
        "bronze_store": spark.createDataFrame([(1, "S")], "s_store_sk bigint, s_store_name string"),
    }
    tables = DeclaredTables({name: (lambda _, df=df: df) for name, df in frames.items()})
    return tables.extended(silver.builders()).extended(gold.builders())


def test_ties_share_a_rank_and_a_missing_category_ranks_on_its_own(spark):
    sold = [(20000131, 1, 1, 1, 1, "5.00"), (20000131, 2, 1, 2, 1, "5.00"), (20000131, 3, 1, 3, 1, "9.00")]
    more = [(20000131, 4, 1, 4, 1, "1.00")]
    items = [(1, "I1", "cup", "A", "B"), (2, "I2", "cup", "A", "B"), (3, "I3", "pot", None, "B"),
             (4, "I4", "mug", "A", "B")]
    t = lake(spark, sold + more, items)
    ranks = {r.i_item_sk: r.category_rank for r in gold.product_performance(t).collect()}
    assert ranks == {1: 1, 2: 1, 3: 1, 4: 3}
    assert ranks == {r.i_item_sk: r.category_rank for r in gold.product_performance_view(t).collect()}


def test_item_rows_with_one_key_multiply_sales_as_a_join_does(spark):
    items = [(1, "I1", "cup", "A", "B"), (1, "I1", "cup", "A", "C")]
    t = lake(spark, [(20000131, 1, 1, 1, 2, "5.00")], items)
    rows = gold.product_sales(t).collect()
    assert sorted((r.i_brand, r.total_revenue, r.units_sold) for r in rows) == [
        ("B", Decimal("5.00"), 2), ("C", Decimal("5.00"), 2)]
    life = business.product_lifecycle(t, dt.date(2000, 4, 1)).first()
    assert (life.total_transactions, life.total_units_sold, life.total_revenue) == (1, 4, Decimal("10.00"))


def test_growth_is_null_without_or_after_an_empty_month(spark):
    t = lake(spark, [(20000131, 1, 1, 1, 1, "4.00"), (20000229, 1, 1, 2, 1, "0.00"), (20000301, 1, 1, 3, 1, "5.00"),
                     (20000401, 1, 1, 4, 1, "10.00")])
    months = gold.monthly_trends(t).orderBy("d_month").collect()
    assert [m.revenue_growth_pct for m in months] == [None, -100.0, None, 100.0]


def test_a_sale_without_a_customer_counts_for_the_day_only(spark):
    t = lake(spark, [(20000131, 1, None, 1, 1, "4.00"), (20000131, 1, 1, 2, 1, "6.00")])
    day = gold.daily_sales_summary(t).first()
    assert (day.transaction_count, day.unique_customers, day.avg_sale_price) == (2, 1, 5.0)
    assert [r.c_customer_sk for r in gold.customer_lifetime_value(t).collect()] == [1]


@pytest.mark.parametrize("spent, expected", [
    ("10000.00", "Gold"), ("10000.01", "Premium"), ("5000.00", "Silver"), ("1000.00", "Bronze"), ("1000.01", "Silver")])
def test_segment_bounds_are_exclusive(spark, spent, expected):
    t = lake(spark, [(20000131, 1, 1, 1, 1, spent)])
    assert gold.customer_lifetime_value(t).first().customer_segment == expected


def test_top_products_by_store_keeps_n_rows_on_ties(spark):
    t = lake(spark, [(20000131, i, 1, i, 1, "5.00") for i in (1, 2, 3)])
    best = gold.top_products_by_store(t, 2).orderBy("store_rank").collect()
    assert [(r.i_item_sk, r.store_rank) for r in best] == [(1, 1), (2, 2)]


def test_retention_needs_the_very_next_month(spark):
    t = lake(spark, [(20000131, 1, 1, 1, 1, "1.00"), (20000229, 1, 1, 2, 1, "1.00"), (20000401, 1, 1, 3, 1, "1.00"),
                     (20000229, 1, 2, 4, 1, "1.00"), (20000229, 1, 77, 5, 1, "1.00")])
    rows = business.customer_retention(t).collect()
    assert [(r.purchase_month.month, r.active_customers, r.retained_customers, r.retention_rate) for r in rows] == [
        (1, 1, 0, 0.0), (2, 2, 1, 50.0), (4, 1, 0, 0.0)]


def test_a_missing_name_part_makes_the_joined_name_unknown(spark):
    t = lake(spark, [(20000131, 1, 2, 1, 1, "1.00")])
    row = challenges.customer_segments_vip(t).collect()
    assert [(r.customer_name, r.customer_segment) for r in row] == [("Unknown", "Occasional")]


def test_one_day_of_life_predicts_the_mean_order(spark):
    t = lake(spark, [(20000131, 1, 1, 1, 1, "4.00"), (20000131, 1, 1, 2, 1, "6.00"), (20000131, 1, 2, 3, 1, "6.00")])
    rows = business.clv_prediction(t).collect()
    assert [(r.ss_customer_sk, r.customer_lifespan_days, r.predicted_annual_value) for r in rows] == [(1, 0, 5.0)]


def test_lifecycle_boundaries(spark):
    t = lake(spark, [(20000131, 1, 1, 1, 1, "4.00")])
    stage = lambda day: business.product_lifecycle(t, day).first().lifecycle_stage
    sold = dt.date(2000, 1, 31)
    assert [stage(sold + dt.timedelta(days=n)) for n in (29, 30, 89, 90)] == [
        "Active", "Declining", "Declining", "Discontinued"]


def test_moving_average_starts_with_what_there_is(spark):
    t = lake(spark, [(day, 1, 1, n, 1, f"{n}.00") for n, (day, _) in enumerate(DAYS, 1)])
    rows = business.moving_average_sales(t).collect()
    assert [r.ma_7day for r in rows] == [2.5, 2.0, 1.5, 1.0]


def test_yoy_against_an_empty_year_is_null(spark):
    t = lake(spark, [(20000131, 1, 1, 1, 1, "4.00")])
    row = layer_queries.yoy_comparison(t, 1999, 2000).first()
    assert (row.revenue_1999, row.revenue_2000, row.yoy_growth_pct) == (Decimal("0.00"), Decimal("4.00"), None)


def test_recent_rfm_leaves_old_sales_out(spark):
    t = lake(spark, [(20000131, 1, 1, 1, 1, "4.00"), (20000401, 1, 1, 2, 1, "6.00"), (20000131, 1, 3, 3, 1, "9.00")])
    rows = challenges.rfm_advanced(t, dt.date(2001, 2, 1)).collect()
    assert [(r.c_customer_id, r.frequency, r.monetary_value, r.rfm_score) for r in rows] == [
        ("C1", 1, Decimal("6.00"), "111")]


def test_hours_without_connections_count_zero(spark):
    hours = "year int, month int, day int, hour int"
    queries = spark.createDataFrame(
        [("q1", 2026, 1, 5, 1), ("q1", 2026, 1, 5, 1), ("q2", 2026, 1, 5, 2), ("q3", 2026, 1, 6, 3)],
        f"query_id string, {hours}")
    connections = spark.createDataFrame(
        [("c1", 2026, 1, 5, 1), ("c2", 2026, 1, 5, 1), ("c3", 2026, 1, 5, 9)], f"connection_id string, {hours}")
    rows = log_queries.activity_correlation({"database_logs": queries, "network_logs": connections})
    assert [tuple(r) for r in rows.collect()] == [(1, 1, 2), (2, 1, 0)]
