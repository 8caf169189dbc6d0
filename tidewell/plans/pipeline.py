"""Bronze to silver to gold on stored tables."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewell.plans import gold, silver
from tidewell.plans.incremental import FITS, STAMPS
from tidewell.schemas import SOURCE_TABLES
from tidewell.sources.lake import (
    first_line, overwrite_touched, path_exists, remove_folder, stamped, write_table,
)
from tidewell.sources.tables import DeclaredTables

RUN_LOG = ("job_id string, layer string, table_name string, status string, `rows` long, seconds double, "
           "error string")


def stored_tables(spark: SparkSession, root: str, layers: Sequence[str] = ("bronze", "silver", "gold")) -> Callable:
    """A mapping that reads ``<root>/<layer>/<table>`` for the name ``<layer>_<table>``, for any of the source tables."""
    names = {"bronze": SOURCE_TABLES, "silver": SOURCE_TABLES, "gold": tuple(gold.MARTS)}
    return DeclaredTables({
        f"{layer}_{name}": (lambda _, path=f"{root}/{layer}/{name}": spark.read.parquet(path))
        for layer in layers for name in names[layer]
    })


def _write_all(spark: SparkSession, frames: Mapping[str, Callable[[], DataFrame]], root: str, layer: str,
               partitions: Mapping[str, Sequence[str]], job_id: str) -> list[tuple]:
    log = []
    for name, make in frames.items():
        counted, start = Observation(name), time.monotonic()
        try:
            write_table(make().observe(counted, F.count(F.lit(1)).alias("rows")), f"{root}/{layer}/{name}",
                        partitions.get(name, ()), job_id=job_id)
            log.append((job_id, layer, name, "ok", counted.get["rows"], time.monotonic() - start, None))
        except Exception as problem:  # recorded; the remaining tables are still built
            log.append((job_id, layer, name, "failed", None, time.monotonic() - start, first_line(problem)))
    return log


def _without_stamps(df: DataFrame) -> DataFrame:
    """The columns of the source; of incremental loads, the lines that fitted."""
    rows = df.filter(F.col(FITS) == 1) if FITS in df.columns else df
    return rows.drop(*STAMPS)


def build_silver(spark: SparkSession, bronze: Mapping[str, DataFrame], root: str,
                 tables: Sequence[str] = ("store_sales", "customer", "date_dim", "item", "store"),
                 job_id: str | None = None) -> DataFrame:
    """Write the silver tables under ``root``; returns and appends the run log."""
    plain = DeclaredTables({name: (lambda _, name=name: _without_stamps(bronze[name])) for name in bronze})
    frames = {name: (lambda name=name: silver.build(name, plain)) for name in tables}
    return _logged(spark, root, _write_all(
        spark, frames, root, "silver", silver.PARTITIONS, job_id or uuid.uuid4().hex))


def silver_inputs(spark: SparkSession, root: str) -> DeclaredTables:
    stored = stored_tables(spark, root, ("silver",))
    return DeclaredTables({name: (lambda _, name=name: _without_stamps(stored[name])) for name in stored})


def build_gold(spark: SparkSession, root: str, cuts: gold.SegmentCuts = gold.SegmentCuts(),
               job_id: str | None = None) -> DataFrame:
    """Write the gold marts from the stored silver tables; returns and appends the run log."""
    inputs = silver_inputs(spark, root)
    marts = dict(gold.MARTS, customer_lifetime_value=lambda t: gold.customer_lifetime_value(t, cuts))
    frames = {name: (lambda make=make: make(inputs)) for name, make in marts.items()}
    return _logged(spark, root, _write_all(spark, frames, root, "gold", gold.PARTITIONS, job_id or uuid.uuid4().hex))


def _logged(spark: SparkSession, root: str, entries: list[tuple]) -> DataFrame:
    log = spark.createDataFrame(entries, RUN_LOG)
    stamped(log).coalesce(1).write.mode("append").parquet(f"{root}/run_log")
    return log


def _months(first: dt.date, until: dt.date) -> list[tuple[int, int]]:
    found, year, month = [], first.year, first.month
    while (year, month) <= (until.year, until.month):
        found.append((year, month))
        year, month = (year, month + 1) if month < 12 else (year + 1, 1)
    return found


def refresh_recent_days(spark: SparkSession, root: str, until: dt.date, days: int, job_id: str = "refresh") -> None:
    """Recompute the daily mart for the months that the last ``days`` days fall in.

    Late sales only change those months, and a month is what one directory
    holds, so whole months are recomputed and their directories replaced. A
    month that has no sales any more loses its directory. Months are those of
    the date dimension, whatever the keys look like.
    """
    inputs = silver_inputs(spark, root)
    months = _months((until - dt.timedelta(days=days)).replace(day=1), until)
    # Stated on the partition columns, so older sales are not read at all.
    in_reach = F.lit(False)
    for year, month in months:
        in_reach = in_reach | ((F.col("year") == year) & (F.col("month") == month))
    recent = inputs.extended({"silver_store_sales": lambda _: inputs["silver_store_sales"].filter(in_reach)})
    mart, target = gold.daily_sales_summary(recent), f"{root}/gold/daily_sales_summary"
    kept = {(row.d_year, row.d_month) for row in mart.select("d_year", "d_month").distinct().collect()}
    overwrite_touched(mart, target, gold.PARTITIONS["daily_sales_summary"], job_id=job_id)
    for year, month in months:
        directory = f"{target}/d_year={year}/d_month={month}"
        if (year, month) not in kept and path_exists(spark, directory):
            remove_folder(spark, directory)
