import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewell.functions import mean, month_gap, month_start, percent, ratio, rounded, weekday_number
from tidewell.functions.masking import masked_email, masked_ip, pseudonym


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("number, digits, expected", [
    (1.005, 2, 1.01), (2.675, 2, 2.68), (-1.005, 2, -1.01), (1234.56499999999, 2, 1234.57), (0.00005, 4, 0.0001),
    (None, 2, None), (1e35, 2, 1e35),
])
def test_rounding_is_half_up_as_written(spark, number, digits, expected):
    assert value(spark, rounded(F.lit(number).cast("double"), digits)) == expected


def test_division_by_nothing_is_null(spark):
    assert value(spark, ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, ratio(F.lit(1), F.lit(None).cast("int"))) is None
    assert value(spark, percent(F.lit(1), F.lit(8))) == 12.5


def test_mean_skips_nulls(spark):
    rows = spark.createDataFrame([(1,), (None,), (4,)], "x int")
    assert rows.agg(mean("x")).first()[0] == 2.5
    assert rows.filter("x > 9").agg(mean("x")).first()[0] is None


def test_calendar(spark):
    day = F.lit(dt.date(2000, 1, 2))  # a Sunday
    assert value(spark, weekday_number(day)) == 0
    assert value(spark, month_start(day)) == dt.date(2000, 1, 1)
    assert value(spark, month_gap(F.lit(dt.date(1999, 11, 1)), day)) == 2


def test_masking(spark):
    assert value(spark, masked_email(F.lit("ada.b@example.com"))) == "a***@example.com"
    assert value(spark, masked_ip(F.lit("10.2.33.4"))) == "10.2.x.x"
    assert value(spark, pseudonym(F.lit("a"), "s")) != value(spark, pseudonym(F.lit("a"), "t"))


@pytest.mark.parametrize("address, hidden", [
    ("2001:db8::1", "x"), ("10.0.0.1:443", "x"), ("", "x"), ("host", "x"), (None, None), ("1.2.3.4", "1.2.x.x")])
def test_addresses_are_hidden_unless_their_form_is_known(spark, address, hidden):
    assert value(spark, masked_ip(F.lit(address).cast("string"))) == hidden


def test_mail_without_an_at_is_hidden_and_a_pseudonym_needs_a_salt(spark):
    assert value(spark, masked_email(F.lit("nobody"))) == "***"
    with pytest.raises(ValueError):
        pseudonym("c", "")
