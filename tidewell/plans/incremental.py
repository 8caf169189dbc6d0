"""Incremental loads: new files only, through bronze and silver into the rows and directories of the marts they reach.

A batch is planned before it is run: the files it takes (path, size, time) are written to the ledger, and a batch is
committed when all its steps are through. A planned batch that is not committed, because its job died, is run again
first, with the same files. Each step is first written to the batch's work folder and published from there, so a step
that died half-way through publishing is published again from the same rows, and a step that is done is not redone from
what it has itself changed. A step that was published to its end is marked and left alone. Silver tables are closed under repetition (whole rows or one row per key), so merging a
batch into them twice changes nothing.

One load at a time may run on a lake. A file that is replaced under its name counts as a new file; rows of its old form
stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.plans import gold, silver
from tidewell.schemas import RAW_SCHEMAS, SOURCE_TABLES
from tidewell.sources.delimited import CORRUPT, read_delimited
from tidewell.sources.lake import (
    make_folder, overwrite_touched, partition_folder, path_exists, remove_folder, stamped, subfolders, write_table,
)
from tidewell.sources.tables import DeclaredTables

LINEAGE = "job_id string, output string, input string, `rows` long, rejected long"
LOADED = "batch long, table_name string, files long, `rows` long, rejected long, status string"
STAMPS = ("load_timestamp", "job_id", "source", "batch", "fits", CORRUPT)
FITS = "fits"


class Lake:
    """The folders of one lake."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def ledger(self, state: str, batch: int | str = "*") -> str:
        return f"{self.root}/_ledger/{state}/batch={batch}"

    def work(self, batch: int) -> str:
        return f"{self.root}/_work/batch={batch}"

    def has(self, layer: str, table: str) -> bool:
        return path_exists(self.spark, self.path(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        found = self.spark.read.parquet(self.path(layer, table))
        return found.drop(*STAMPS)

    def batches(self, state: str) -> set[int]:
        folder = f"{self.root}/_ledger/{state}"
        names = subfolders(self.spark, folder) if path_exists(self.spark, folder) else []
        return {int(name.partition("=")[2]) for name in names if path_exists(self.spark, f"{folder}/{name}/_SUCCESS")}


def _files(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The files below a folder; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/{table}")
    return found.select(F.lit(table).alias("table_name"), "path", F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"))


def plan_batch(spark: SparkSession, source: str, root: str, tables: Sequence[str] = SOURCE_TABLES) -> int | None:
    """The number of the batch to run: one that was not finished, else a new one of all new files, else None."""
    lake = Lake(spark, root)
    planned = lake.batches("planned")
    unfinished = planned - lake.batches("committed")
    if unfinished:
        return min(unfinished)
    there = [table for table in tables if path_exists(spark, f"{source}/{table}")]
    if not there:
        return None
    files = reduce(DataFrame.unionByName, [_files(spark, source, table) for table in there]).filter("size > 0")
    if planned:
        known = spark.read.parquet(f"{root}/_ledger/committed").select("table_name", "path", "size", "modified")
        files = files.join(known, ["table_name", "path", "size", "modified"], "left_anti")
    number = max(planned, default=0) + 1
    if files.isEmpty():
        return None
    files.coalesce(1).write.mode("overwrite").parquet(lake.ledger("planned", number))
    return number


def _ingest(batch: _Batch, table: str, paths: Sequence[str], schema: T.StructType | None,
            **read_options) -> list[tuple]:
    """One pass: lines that fit and, beside them, those that do not, with their text.

    The job that stored them, each file, and how many of both it had.
    """
    lake, path = batch.lake, f"{batch.lake.path('bronze', table)}/batch={batch.number}"
    raw = read_delimited(lake.spark, list(paths), schema, capture_malformed=schema is not None, **read_options)
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    rows = raw.withColumns({FITS: F.col(CORRUPT).isNull().cast("int"), "source": F.col("_metadata.file_path")})
    job_id = batch.published(f"bronze_{table}", lambda: write_table(rows, path, [FITS], job_id=batch.job_id))
    if not subfolders(lake.spark, path):
        return []
    fits = F.col(FITS).cast("long")
    found = lake.spark.read.parquet(path).groupBy("source").agg(F.sum(fits).alias("good"), F.sum(1 - fits).alias("bad"))
    return [(job_id, *row) for row in found.orderBy("source").collect()]  # the files of one batch


def rejected_lines(spark: SparkSession, root: str, table: str) -> DataFrame:
    """batch, source and text of the lines of a table that did not fit its schema."""
    return spark.read.parquet(f"{root}/bronze/{table}").filter(F.col(FITS) == 0).select(
        "batch", "source", F.col(CORRUPT).alias("line"))


def lineage(spark: SparkSession, root: str) -> DataFrame:
    """What each load wrote from what: batch, job_id, output, input, rows, rejected; one row per output and input.

    The inputs of a bronze table are files, named as its column ``source`` names them, with the lines of each that
    fitted and that did not. Those of other tables are tables, and ``rows`` is what was written. A load that died and
    was run again counts once, as it was run last.
    """
    written = Lake(spark, root).batches("committed")
    return spark.read.schema(f"{LINEAGE}, batch long").parquet(f"{root}/_ledger/lineage").filter(
        F.col("batch").isin(sorted(written))).select("batch", "job_id", "output", "input", "rows", "rejected")


def built_from(spark: SparkSession, root: str, source: str) -> DataFrame:
    """batch and output of every table that the load of a file wrote from it, through whichever tables between."""
    edges = lineage(spark, root)
    tables = edges.filter("rejected IS NULL").select("batch", F.col("input").alias("from"), "output")
    newest = edges.filter(F.col("input") == source).select("batch", "output").distinct()
    found = newest
    for _ in range(3):  # silver, sales dated by the silver calendar, gold
        newest = tables.join(newest.withColumnRenamed("output", "from"), ["batch", "from"]).select(
            "batch", "output").distinct()
        found = found.union(newest)
    return found.distinct()


def _any(columns: Sequence[str], values: Sequence[Sequence]) -> Column:
    """Rows whose directory columns have one of the listed values; literals, so other directories are not read."""
    return reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, row)]) for row in values
    ], F.lit(False))


class _Batch:
    """The steps of one batch; ``seen`` is told of each before it is published."""

    def __init__(self, lake: Lake, number: int, job_id: str, seen: Callable[[str], None]):
        self.lake, self.number, self.job_id, self.seen = lake, number, job_id, seen
        self.reads: set[str] = set()
        self.edges: list[tuple] = []

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.lake.work(self.number)}/{name}"
        if not path_exists(self.lake.spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").parquet(path)
        return self.lake.spark.read.parquet(path)

    def noted(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A step that is published: which tables it was made from is kept beside it, for when it is run again."""
        def run() -> DataFrame:
            self.reads.clear()
            rows = make()
            self.lake.spark.createDataFrame(
                [(read,) for read in sorted(self.reads)], "input string").coalesce(1).write.mode("overwrite").parquet(
                f"{self.lake.work(self.number)}/{name}.reads")
            return rows
        return self.step(name, run)

    def published(self, name: str, publish: Callable[[], None]) -> str:
        """Publish a step unless that was done before the load died; the job that did it, whose id the rows bear."""
        spark, mark = self.lake.spark, f"{self.lake.work(self.number)}/{name}.published"
        done = subfolders(spark, mark) if path_exists(spark, mark) else []
        if not done:
            publish()
            make_folder(spark, f"{mark}/{self.job_id}")
        return done[0] if done else self.job_id

    def _recorded(self, name: str, make: Callable[[], DataFrame], publish: Callable[[DataFrame], None]) -> None:
        rows = self.noted(name, make)
        written = rows.count()
        inputs = self.lake.spark.read.parquet(f"{self.lake.work(self.number)}/{name}.reads").collect()
        self.seen(name)
        job_id = self.published(name, lambda: publish(rows))
        self.edges += [(job_id, name, row.input, written, None) for row in inputs]

    def replace(self, layer: str, table: str, make: Callable[[], DataFrame]) -> None:
        path = self.lake.path(layer, table)
        self._recorded(f"{layer}_{table}", make, lambda rows: write_table(rows, path, job_id=self.job_id))

    def replace_parts(self, layer: str, table: str, columns: Sequence[str], touched: Sequence[Sequence],
                      make: Callable[[], DataFrame]) -> None:
        """Replace the directories in ``touched``; those without rows any more go."""
        path = self.lake.path(layer, table)

        def publish(rows: DataFrame) -> None:
            kept = {tuple(row) for row in rows.select(*columns).distinct().collect()}
            if kept or not path_exists(self.lake.spark, path):
                overwrite_touched(rows, path, columns, job_id=self.job_id)
            for row in touched:
                if tuple(row) not in kept:
                    remove_folder(self.lake.spark, partition_folder(self.lake.spark, path, columns, row))
        self._recorded(f"{layer}_{table}", make, publish)


class _Watched(Mapping):
    """Tables that tell the batch which of them are read."""

    def __init__(self, tables: Mapping[str, DataFrame], batch: _Batch):
        self.tables, self.batch = tables, batch

    def __getitem__(self, name: str) -> DataFrame:
        self.batch.reads.add(name)
        return self.tables[name]

    def __iter__(self):
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)


def _merged(batch: _Batch, table: str, fresh: DataFrame) -> DataFrame:
    """A silver table with the rows of a batch: its rule on what is stored and what is new."""
    lake, bronze = batch.lake, fresh
    batch.reads.add(f"bronze_{table}")
    if lake.has("silver", table):
        bronze = lake.read("silver", table).select(*fresh.columns).unionByName(fresh)
    return silver.build(table, {f"bronze_{table}": bronze})


def _nothing(df: DataFrame, lake: Lake, layer: str, table: str) -> DataFrame:
    return lake.read(layer, table) if lake.has(layer, table) else df.limit(0)


def _sales(batch: _Batch, fresh: DataFrame | None, days: DataFrame | None) -> tuple[DataFrame, list[tuple]]:
    """Merge new sales, and date again the stored ones whose day changed; the keys reached and the months rewritten."""
    lake, columns = batch.lake, list(silver.PARTITIONS["store_sales"])
    calendar = lake.read("silver", "date_dim")
    parts = []
    if fresh is not None:
        parts.append(silver.store_sales_repeated(fresh, calendar))
    if days is not None and lake.has("silver", "store_sales"):
        old = lake.read("silver", "store_sales").join(days, F.col("ss_sold_date_sk") == F.col("day"), "left_semi")
        moved = old.drop(*columns)
        parts += [old, silver.store_sales_repeated(moved, calendar)]
    if not parts:
        return None, []
    keys = columns + ["ss_customer_sk", "ss_item_sk", "ss_store_sk"]
    # With repeats: those who ask for some of the keys take them distinct, which is far less than all of them are.
    changed = batch.step("changed", lambda: reduce(DataFrame.unionByName, [part.select(*keys) for part in parts]))
    months = [tuple(row) for row in changed.select(*columns).distinct().collect()]  # no more than the calendar has

    def rebuilt() -> DataFrame:
        rows = [] if fresh is None else [fresh]
        batch.reads |= {"silver_date_dim", *(() if fresh is None else ("bronze_store_sales",))}
        if lake.has("silver", "store_sales"):
            rows.insert(0, lake.read("silver", "store_sales").filter(_any(columns, months)).drop(*columns))
        return silver.store_sales(reduce(DataFrame.unionByName, rows), calendar)
    batch.replace_parts("silver", "store_sales", columns, months, rebuilt)
    return changed, months


def _keys(changed: DataFrame | None, column: str, dimension: DataFrame | None, key: str) -> DataFrame | None:
    """The keys of a dimension that changed sales or changed dimension rows have."""
    found = []
    if changed is not None:
        found.append(changed.select(F.col(column).alias("key")))
    if dimension is not None:
        found.append(dimension.select(F.col(key).alias("key")))
    return reduce(DataFrame.unionByName, found).filter("key IS NOT NULL").distinct() if found else None


def _refresh_marts(batch: _Batch, changed: DataFrame | None, months: list[tuple], fresh: Mapping[str, DataFrame],
                   cuts: gold.SegmentCuts) -> None:
    """Each mart is told what it must redo: months, categories of a year, customers, stores."""
    lake = batch.lake
    tables = DeclaredTables({
        f"silver_{name}": (lambda _, name=name: lake.read("silver", name))
        for name in ("store_sales", "customer", "date_dim", "item", "store")})
    sales = tables["silver_store_sales"]

    def with_sales(rows: DataFrame, **others: DataFrame) -> _Watched:
        frames = {"silver_store_sales": rows, **{f"silver_{name}": frame for name, frame in others.items()}}
        return _Watched(tables.extended({name: (lambda _, frame=frame: frame) for name, frame in frames.items()}), batch)

    dated = [month for month in months if month[0] is not None]
    if dated:
        recent = with_sales(sales.filter(_any(("year", "month"), dated)))
        batch.replace_parts("gold", "daily_sales_summary", gold.PARTITIONS["daily_sales_summary"], dated,
                            lambda: gold.daily_sales_summary(recent))
        first = min(year for year, _ in dated)

        def months_since() -> DataFrame:
            totals = gold.monthly_totals(recent)
            stored = _nothing(totals, lake, "gold", "monthly_trends").select(*totals.columns)
            kept = stored.filter(~_any(("d_year", "d_month"), dated))
            return gold.with_growth(kept.unionByName(totals)).filter(F.col("d_year") >= first)
        years = {row.d_year for row in _nothing(
            tables["silver_date_dim"], lake, "gold", "monthly_trends").select("d_year").distinct().collect()}
        later = [(year,) for year in sorted(years | {year for year, _ in dated}) if year >= first]
        batch.replace_parts("gold", "monthly_trends", gold.PARTITIONS["monthly_trends"], later, months_since)

    items = _keys(changed, "ss_item_sk", fresh.get("item"), "i_item_sk")
    if items is not None:
        columns = list(gold.PARTITIONS["product_performance"])

        def reached() -> DataFrame:
            sold = [changed.select("year", "ss_item_sk")] if changed is not None else []
            parts = []
            if "item" in fresh:
                own = fresh["item"].select(F.col("i_item_sk").alias("key")).distinct()
                sold.append(sales.join(own, F.col("ss_item_sk") == F.col("key"), "left_semi").select("year", "ss_item_sk"))
                if lake.has("gold", "product_performance"):
                    parts.append(lake.read("gold", "product_performance").join(
                        own, F.col("i_item_sk") == F.col("key"), "left_semi").select(*columns))
            named = reduce(DataFrame.unionByName, sold).distinct().join(
                tables["silver_item"], F.col("ss_item_sk") == F.col("i_item_sk"))
            parts.append(named.select(F.col("year").alias("d_year"), "i_category"))
            return reduce(DataFrame.unionByName, parts).filter("d_year IS NOT NULL").distinct()
        # A row per directory that the mart has or gets.
        touched = batch.step("touched_products", reached)
        parts = [tuple(row) for row in touched.select(*columns).collect()]
        if parts:
            every = touched.select(F.col("i_category").alias("c")).distinct()
            stock = tables["silver_item"].join(every, F.col("i_category").eqNullSafe(F.col("c")), "left_semi")
            # Every item of a category is ranked, so all its sales of the year count.
            years = sales.filter(F.col("year").isin(sorted({year for year, _ in parts}))).join(
                stock.select(F.col("i_item_sk").alias("key")).distinct(), F.col("ss_item_sk") == F.col("key"), "left_semi")
            batch.replace_parts(
                "gold", "product_performance", columns, parts,
                lambda: gold.product_performance(with_sales(years, item=stock)).filter(_any(columns, parts)))

    def merged(mart: str, key: str, wanted: DataFrame, column: str, make: Callable) -> None:
        """An unpartitioned mart: rows of the keys in question are made again, the others stay."""
        def rows() -> DataFrame:
            made = make(with_sales(sales.join(wanted, F.col(column) == F.col("key"), "left_semi")))
            if not lake.has("gold", mart):
                return made
            kept = lake.read("gold", mart).join(wanted, F.col(key) == F.col("key"), "left_anti")
            return kept.select(*made.columns).unionByName(made)
        batch.replace("gold", mart, rows)

    customers = _keys(changed, "ss_customer_sk", fresh.get("customer"), "c_customer_sk")
    if customers is not None:
        merged("customer_lifetime_value", "c_customer_sk", batch.step("touched_customers", lambda: customers),
               "ss_customer_sk", lambda t: gold.customer_lifetime_value(t, cuts))
    stores = [_keys(changed, "ss_store_sk", fresh.get("store"), "s_store_sk")]
    if "item" in fresh:
        own = fresh["item"].select(F.col("i_item_sk").alias("item")).distinct()
        stores.append(sales.join(own, F.col("ss_item_sk") == F.col("item"), "left_semi").select(
            F.col("ss_store_sk").alias("key")).filter("key IS NOT NULL").distinct())
    stores = [part for part in stores if part is not None]
    if stores:
        merged("top_products_by_store", "s_store_sk", batch.step(
            "touched_stores", lambda: reduce(DataFrame.unionByName, stores).distinct()),
            "ss_store_sk", gold.top_products_by_store)


def load_new_files(spark: SparkSession, source: str, root: str, tables: Sequence[str] = SOURCE_TABLES,
                   schemas: Mapping[str, T.StructType] = RAW_SCHEMAS, cuts: gold.SegmentCuts = gold.SegmentCuts(),
                   seen: Callable[[str], None] = lambda step: None, **read_options) -> DataFrame:
    """Bring the files that came since the last load through all layers; one status row per table of the batch.

    The result equals a build from all files. Only directories and rows that the new rows reach are made again: months
    of the daily mart, months from the first changed one on of the monthly, categories of a year of the product mart,
    customers and stores of the others. Without new files nothing is written.
    """
    lake, number = Lake(spark, root), plan_batch(spark, source, root, tables)
    if number is None:
        return spark.createDataFrame([], LOADED)
    job_id = f"batch-{number}-{uuid.uuid4().hex[:8]}"
    planned = spark.read.parquet(lake.ledger("planned", number))
    paths: dict[str, list[str]] = {}
    for row in planned.select("table_name", "path").collect():  # the files of one batch
        paths.setdefault(row.table_name, []).append(row.path)
    batch, loaded, fresh = _Batch(lake, number, job_id, seen), [], {}
    for table in sorted(paths):
        lines = _ingest(batch, table, paths[table], schemas.get(table), **read_options)
        rows, rejected = sum(good for *_, good, _ in lines), sum(bad for *_, bad in lines)
        batch.edges += [(job, f"bronze_{table}", *line) for job, *line in lines]
        loaded.append((number, table, len(paths[table]), rows, rejected, "ok"))
        if rows:
            stored = spark.read.parquet(f"{lake.path('bronze', table)}/batch={number}")
            fresh[table] = stored.filter(F.col(FITS) == 1).drop(*STAMPS)
        seen(f"bronze_{table}")
    days = None
    if "date_dim" in fresh:
        after = batch.noted("silver_date_dim", lambda: _merged(batch, "date_dim", fresh["date_dim"]))
        days = batch.step("days", lambda: after.subtract(
            _nothing(after, lake, "silver", "date_dim").select(*after.columns)).select(F.col("d_date_sk").alias("day")))
    for table in sorted(set(fresh) - {"store_sales"}):
        batch.replace("silver", table, lambda: _merged(batch, table, fresh[table]))
    changed, months = None, []
    if lake.has("silver", "date_dim"):
        changed, months = _sales(batch, fresh.get("store_sales"), days)
    if all(lake.has("silver", name) for name in ("store_sales", "customer", "date_dim", "item", "store")):
        _refresh_marts(batch, changed, months, fresh, cuts)
    seen("commit")
    spark.createDataFrame(batch.edges, LINEAGE).coalesce(1).write.mode("overwrite").parquet(lake.ledger("lineage", number))
    stamped(planned.drop("batch"), job_id=job_id).coalesce(1).write.mode("overwrite").parquet(
        lake.ledger("committed", number))
    remove_folder(spark, lake.work(number))
    return spark.createDataFrame(loaded, LOADED)
