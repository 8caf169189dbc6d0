"""Masking of personal columns with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pseudonym(value: Column | str, salt: str) -> Column:
    """A stable token: equal inputs stay joinable; without the salt the input cannot be found by trying values."""
    if not salt:
        raise ValueError("a pseudonym needs a salt")
    value = F.col(value) if isinstance(value, str) else value
    return F.sha2(F.concat(F.lit(salt), value), 256)


def masked_email(value: Column | str) -> Column:
    """First letter and domain; text without an @ is hidden as a whole."""
    value = F.col(value) if isinstance(value, str) else value
    hidden = F.regexp_replace(value, r"^(.)[^@]*", "$1***")
    return F.when(value.isNull(), F.lit(None)).when(value.rlike("^[^@]+@"), hidden).otherwise("***")


def masked_ip(value: Column | str) -> Column:
    """An IPv4 address without its last two parts; anything else is hidden as a whole."""
    value = F.col(value) if isinstance(value, str) else value
    plain = F.regexp_extract(value, r"^(\d+\.\d+)\.\d+\.\d+$", 1)
    return F.when(value.isNull(), F.lit(None)).when(plain != "", F.concat(plain, F.lit(".x.x"))).otherwise("x")


def masked_customers(customer: DataFrame, salt: str) -> DataFrame:
    return customer.select(
        "c_customer_sk", pseudonym("c_customer_id", salt).alias("c_customer_id"),
        masked_email("c_email_address").alias("c_email_address"), "c_birth_country", "c_birth_year",
    )


def masked_connections(network_logs: DataFrame) -> DataFrame:
    return network_logs.withColumns({
        "source_ip": masked_ip("source_ip"), "destination_ip": masked_ip("destination_ip"),
    })


def masked_queries(database_logs: DataFrame, salt: str) -> DataFrame:
    return database_logs.withColumns({"client_ip": masked_ip("client_ip"), "user": pseudonym("user", salt)})
