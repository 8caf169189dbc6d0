"""Data-quality checks and quarantine, as aggregates and anti-joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import pin


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows failing each rule, in one pass. A rule that yields NULL counts as failed."""
    failed = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    counts = df.agg(F.count("*").alias("_all"), *failed)
    entries = F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").alias("failed_rows"), F.col("_all").alias("all_rows"))
        for name in rules
    ])
    return counts.select(F.explode(entries).alias("entry")).select("entry.*")


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return per_key.agg(
        F.lit(f"unique: {', '.join(keys)}").alias("check_name"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("failed_rows"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("all_rows"),
    )


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose (non-NULL) key has no parent."""
    parents = parent.select(F.col(parent_key).alias("_parent"))
    return df.filter(F.col(key).isNotNull()).join(parents, F.col(key) == F.col("_parent"), "left_anti")


def orphan_report(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Orphan rows per check. Keys are counted first, so the join sees each key once."""
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    parents = parent.select(F.col(parent_key).alias("_parent")).distinct()
    matched = per_key.join(parents, F.col("_key") == F.col("_parent"), "left")
    lost = F.col("_key").isNotNull() & F.col("_parent").isNull()
    return matched.agg(
        F.lit(f"{key} in {parent_key}").alias("check_name"),
        F.coalesce(F.sum(F.when(lost, F.col("_rows")).otherwise(0)), F.lit(0)).alias("failed_rows"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("all_rows"),
    )


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows passing every rule, and the others with the names of the rules they fail."""
    failed = F.filter(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]),
        lambda name: name.isNotNull(),
    )
    passes = reduce(lambda a, b: a & b, [F.coalesce(rule, F.lit(False)) for rule in rules.values()])
    return df.filter(passes), df.filter(~passes).withColumn("failed_checks", failed)


def sales_rules() -> dict[str, Column]:
    """What silver asks of a sale."""
    return {
        "ss_sold_date_sk is set": F.col("ss_sold_date_sk").isNotNull(),
        "ss_quantity above 0": F.col("ss_quantity") > 0,
        "ss_sales_price at least 0": F.col("ss_sales_price") >= 0,
    }


def sales_quality(sales: DataFrame, date_dim: DataFrame, customer: DataFrame, item: DataFrame) -> DataFrame:
    """Quality report of a sales table: rules, repeated rows and references.

    The columns looked at are stored once; five reports then read them, and not the joins behind the table.
    """
    sales = pin(sales.select(
        "ss_sold_date_sk", "ss_customer_sk", "ss_item_sk", "ss_ticket_number", "ss_line_number", "ss_quantity",
        "ss_sales_price"))
    parts = [
        rule_report(sales, sales_rules()),
        duplicate_report(sales, ["ss_ticket_number", "ss_item_sk", "ss_line_number"]),
        orphan_report(sales, "ss_sold_date_sk", date_dim, "d_date_sk"),
        orphan_report(sales, "ss_customer_sk", customer, "c_customer_sk"),
        orphan_report(sales, "ss_item_sk", item, "i_item_sk"),
    ]
    return reduce(DataFrame.unionByName, parts)
