import datetime as dt
from decimal import Decimal

from tests.conftest import plan_of
from tidewell.operators.dedup import one_row_per_key
from tidewell.plans import silver

SALES = ("ss_sold_date_sk int, ss_item_sk bigint, ss_ticket_number bigint, ss_quantity int, "
         "ss_sales_price decimal(12,2)")


def calendar(spark, *days):
    """Keys that are day numbers, as in the public retail layout, or anything else."""
    return spark.createDataFrame(days or [(20000101, 2000, 1), (20000102, 2000, 1), (20000103, 2000, 1)],
                                 "d_date_sk int, d_year int, d_moy int")


def sales(spark, *rows):
    return spark.createDataFrame([(d, i, t, q, p if p is None else Decimal(p)) for d, i, t, q, p in rows], SALES)


def test_sales_rules_at_their_edges(spark):
    bronze = sales(
        spark,
        (20000101, 1, 1, 1, "0.00"),      # smallest allowed
        (20000101, 1, 1, 1, "0.00"),      # repeated row
        (20000101, 1, 1, 2, "0.00"),      # same keys, other values: a row of its own
        (None, 2, 1, 1, "5.00"), (20000101, 3, 1, None, "5.00"), (20000101, 4, 1, 0, "5.00"),
        (20000101, 5, 1, -1, "5.00"), (20000101, 6, 1, 1, None), (20000101, 7, 1, 1, "-0.01"),
    )
    kept = silver.store_sales(bronze, calendar(spark)).collect()
    assert sorted((r.ss_item_sk, r.ss_quantity, r.year, r.month) for r in kept) == [(1, 1, 2000, 1), (1, 2, 2000, 1)]


def test_a_key_the_calendar_lacks_has_no_partition(spark):
    row = silver.store_sales(sales(spark, (20001399, 1, 1, 1, "1.00")), calendar(spark)).first()
    assert (row.year, row.month) == (None, None)


def test_day_numbers_find_their_month(spark):
    bronze = sales(spark, (2451545, 1, 1, 1, "1.00"), (2451576, 2, 1, 1, "1.00"))
    days = calendar(spark, (2451545, 2000, 1), (2451576, 2000, 2), (None, 1999, 1), (2451545, 2000, 1))
    kept = silver.store_sales(bronze, days).collect()
    assert sorted((r.ss_item_sk, r.year, r.month) for r in kept) == [(1, 2000, 1), (2, 2000, 2)]


def test_sales_are_idempotent(spark):
    bronze = sales(spark, (20000101, 1, 1, 1, "1.00"), (20000101, 1, 1, 1, "1.00"))
    once = silver.store_sales(bronze, calendar(spark))
    again = silver.store_sales(once.drop("year", "month"), calendar(spark))
    assert once.collect() == again.collect()


def test_keyed_sales_keep_one_dated_row_per_ticket_and_item(spark):
    bronze = sales(
        spark, (None, 1, 1, 9, "9.00"), (20000102, 1, 1, 1, "1.00"), (20000102, 1, 1, 1, "2.00"),
        (None, 2, 1, 1, "1.00"), (20000103, 1, 2, 0, "-1.00"),
    )
    kept = silver.store_sales_keyed(bronze, calendar(spark)).collect()
    assert sorted((r.ss_ticket_number, r.ss_item_sk, r.ss_sales_price) for r in kept) == [
        (1, 1, Decimal("2.00")), (2, 1, Decimal("-1.00"))]


def test_customer_name_skips_missing_parts(spark):
    bronze = spark.createDataFrame(
        [(1, "Ada", "B"), (2, None, "C"), (3, None, None), (None, "X", "Y"), (1, "Ada", None)],
        "c_customer_sk bigint, c_first_name string, c_last_name string")
    assert {r.c_customer_sk: r.full_name for r in silver.customer(bronze).collect()} == {1: "Ada B", 2: "C", 3: ""}


def test_weekend_is_false_for_an_unknown_day(spark):
    bronze = spark.createDataFrame(
        [(1, dt.date(2000, 1, 1), 1, "Saturday"), (2, dt.date(2000, 1, 2), 1, "Sunday"),
         (3, dt.date(2000, 1, 3), 1, "Monday"), (4, dt.date(2000, 1, 4), 1, None), (None, None, 1, "Sunday")],
        "d_date_sk int, d_date date, d_moy int, d_day_name string")
    days = {r.d_date_sk: (r.is_weekend, r.d_month) for r in silver.date_dim(bronze).collect()}
    assert days == {1: (True, 1), 2: (True, 1), 3: (False, 1), 4: (False, 1)}


def test_survivor_of_a_key_does_not_depend_on_row_order(spark):
    rows = [(1, "a", 5), (1, "b", 1), (1, "b", None), (2, None, None)]
    for order in (rows, rows[::-1]):
        kept = one_row_per_key(spark.createDataFrame(order, "k int, x string, y int").repartition(3), ["k"])
        assert sorted(tuple(r) for r in kept.collect()) == [(1, "b", 1), (2, None, None)]


def test_generic_tables_lose_repeated_rows_only(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k int, x string")
    assert silver.build("item", {"bronze_item": rows}).count() == 2


def test_sales_do_not_travel_to_the_calendar(spark, setting):
    """Whatever the calendar's size is thought to be, sales are not dealt out by day to meet it."""
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    bronze = sales(spark, (20000101, 1, 1, 1, "2.00"), (20000104, 1, 2, 1, "3.00"))
    for build in (silver.store_sales, silver.store_sales_repeated, silver.store_sales_keyed):
        dated = build(bronze, calendar(spark))
        assert "hashpartitioning(ss_sold_date_sk" not in plan_of(dated)
        assert sorted((r.ss_ticket_number, r.month) for r in dated.collect()) == [(1, 1), (2, None)]
