import datetime as dt
import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import final_plan_of, plan_of
from tests.test_gold import DAYS, lake
from tidewell.plans import business, gold, layer_queries, pipeline
from tidewell.registry import sample_lake
from tidewell.schemas import RAW_SCHEMAS, SOURCE_TABLES
from tidewell.sources import lake as store
from tidewell.sources.delimited import ingest_tables, read_delimited, split_malformed
from tidewell.sources.tables import CatalogTables

SALES = [(20000131, 1, 1, 1, 1, "4.00"), (20000229, 2, 2, 2, 3, "6.00"), (20000301, 1, 1, 3, 1, "9.00")]


def write_text(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as file:
        file.write(text)


def test_ingest_reports_each_table_and_goes_on(spark, tmp_path):
    line = "|".join(["20000131", "1", "7", *["1"] * 7, "3", *["1.50"] * 12])
    write_text(tmp_path / "in" / "store_sales", "a.dat", f"{line}\n{line}\n")
    write_text(tmp_path / "in" / "reason", "a.dat", "1|AAA|why\n2|BBB|\n")
    status = ingest_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["store_sales", "customer", "reason"])
    assert [(r.table_name, r.status, r.rows) for r in status.collect()] == [
        ("store_sales", "ok", 2), ("customer", "failed", None), ("reason", "ok", 2)]
    assert "PATH_NOT_FOUND" in status.filter("status = 'failed'").first().error
    sales = spark.read.parquet(str(tmp_path / "out" / "store_sales"))
    assert sales.drop("source", "job_id", "load_timestamp").schema == RAW_SCHEMAS["store_sales"]
    assert sales.first().ss_sales_price == Decimal("1.50")
    assert spark.read.parquet(str(tmp_path / "out" / "reason")).dtypes[0] == (
        "r_reason_sk", "bigint")
    again = ingest_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"), "store_sales")
    assert again.first().rows == 2 and spark.read.parquet(str(tmp_path / "out" / "store_sales")).count() == 2


def test_all_means_the_24_source_tables(spark, tmp_path):
    status = ingest_tables(spark, str(tmp_path), str(tmp_path / "out"))
    assert status.count() == 24 == len(SOURCE_TABLES)


def test_malformed_lines_are_kept_apart_whole(spark, tmp_path):
    write_text(tmp_path, "a.dat", "1|x|\n2|y|\nthree|z|\n4\n5|a|b|c|\n")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    read = read_delimited(spark, str(tmp_path / "a.dat"), schema, ends_with_separator=True, capture_malformed=True)
    good, bad = split_malformed(read)
    assert sorted(map(tuple, good.collect())) == [(1, "x"), (2, "y")]
    assert sorted(r._corrupt_record for r in bad.collect()) == ["4", "5|a|b|c|", "three|z|"]
    good.write.parquet(str(tmp_path / "good"))
    assert spark.read.parquet(str(tmp_path / "good")).select("v").count() == 2


def test_pipeline_round_trip(spark, tmp_path):
    root = str(tmp_path)
    bronze = lake(spark, SALES)
    assert pipeline.build_silver(spark, bronze, root, job_id="j1").filter("status = 'ok'").count() == 5
    assert pipeline.build_gold(spark, root, job_id="j1").filter("status = 'ok'").count() == 5
    assert spark.read.parquet(f"{root}/run_log").filter("job_id = 'j1'").count() == 10
    assert os.path.isdir(f"{root}/silver/store_sales/year=2000/month=2")
    assert os.path.isdir(f"{root}/gold/product_performance/d_year=2000/i_category=A")
    stored = pipeline.stored_tables(spark, root)
    daily = stored["gold_daily_sales_summary"]
    assert {"load_timestamp", "job_id"} <= set(daily.columns)
    expected = gold.daily_sales_summary(bronze)
    assert sorted(map(str, daily.select(expected.columns).collect())) == sorted(map(str, expected.collect()))
    ranked = layer_queries.top_products_by_category(stored, 2000)
    assert ranked.count() == 2


def test_a_failing_mart_is_logged_and_the_rest_is_built(spark, tmp_path):
    bronze = lake(spark, SALES)
    log = pipeline.build_silver(spark, {k: bronze[k] for k in bronze if k != "bronze_item"}, str(tmp_path))
    assert {r.table_name for r in log.filter("status = 'failed'").collect()} == {"item"}
    assert log.filter("status = 'ok'").count() == 4


def test_refresh_replaces_touched_months_only(spark, tmp_path):
    root = str(tmp_path)
    pipeline.build_silver(spark, lake(spark, SALES), root, job_id="first")
    pipeline.build_gold(spark, root, job_id="first")
    late = lake(spark, SALES + [(20000229, 3, 3, 9, 1, "1.00"), (20000131, 3, 3, 8, 1, "1.00")])
    pipeline.build_silver(spark, late, root, job_id="second")
    pipeline.refresh_recent_days(spark, root, dt.date(2000, 3, 1), 10, job_id="late")
    rows = {(r.d_month, r.job_id): r.total_sales
            for r in spark.read.parquet(f"{root}/gold/daily_sales_summary").collect()}
    assert rows == {(1, "first"): Decimal("4.00"), (2, "late"): Decimal("7.00"), (3, "late"): Decimal("9.00")}


def test_append_adds_each_key_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, None, "a"), (2, 2, "b")], "k int, p int, v string")
    store.write_table(rows, path, ["p"])
    more = rows.union(spark.createDataFrame([(3, 2, "c"), (3, 2, "c")], rows.schema))
    for _ in range(2):
        store.append_new(more, path, ["k", "p"], ["p"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]


@pytest.mark.parametrize("nulls", [False, True])
def test_append_leaves_rows_that_lie_by_a_part_of_the_key(spark, setting, tmp_path, monkeypatch, nulls):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "t")
    lines = spark.range(400).selectExpr("id div 4 AS ticket", "nullif(id % 4, 9) AS item")
    if nulls:
        lines = lines.selectExpr("ticket", "nullif(item, 3) AS item")
    sales = lines.join(spark.range(100).withColumnRenamed("id", "ticket"), "ticket")
    store.append_new(sales.filter("ticket % 3 = 0"), path, ["ticket", "item"])
    write, plans = store.write_table, []

    def written(df, *args, **options):
        plans.append(plan_of(df))
        write(df, *args, **options)

    monkeypatch.setattr(store, "write_table", written)
    for _ in range(2):
        store.append_new(sales, path, ["ticket", "item"])
    rows = [(r.ticket, r.item) for r in spark.read.parquet(path).collect()]
    assert len(rows) == 400 and set(rows) == {(r.ticket, r.item) for r in sales.collect()}
    if not nulls:  # lines, tickets and stored keys; not the joined rows once more
        assert plans[0].count("Exchange hashpartitioning") == 3


def test_registered_layer(spark, tmp_path):
    root = str(tmp_path)
    pipeline.build_silver(spark, lake(spark, SALES), root)
    assert {r.table for r in store.register_layer(spark, f"{root}/silver", "silver_", "lake_db")} == {
        f"silver_{name}" for name in ("store_sales", "customer", "date_dim", "item", "store")}
    tables = CatalogTables(spark, "lake_db")
    assert gold.daily_sales_summary(tables).count() == 3
    with pytest.raises(KeyError):
        tables["silver_nothing"]
    assert spark.sql("DESCRIBE lake_db.silver_store_sales").filter("col_name = 'ss_item_sk'").count() == 1
    # A column added later shows up on the next call; a table whose files are elsewhere is reported.
    store.write_table(spark.createDataFrame([(9, "x")], "s_store_sk bigint, s_city string"),
                      f"{root}/silver/store", mode="append")
    empty = tmp_path / "empty"
    empty.mkdir()
    store.register_layer(spark, f"{root}/silver", "silver_", "lake_db")
    assert "s_city" in spark.table("lake_db.silver_store").columns
    assert {r.status for r in store.register_layer(spark, str(empty), "silver_", "lake_db")} == {"missing"}
    store.register_layer(spark, f"{root}/silver", "view_")
    assert spark.table("view_store_sales").count() == 3
    store.create_table_as(gold.daily_sales_summary(tables).groupBy("d_year").count(), "lake_db.yearly")
    assert spark.table("lake_db.yearly").first()["count"] == 3
    spark.sql("DROP DATABASE lake_db CASCADE")


def test_compaction_keeps_rows_and_other_directories(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(4):
        store.write_table(spark.range(10).withColumn("p", F.col("id") % 2), path, ["p"], mode="append")
    files = lambda p: {f for f in os.listdir(f"{path}/p={p}") if f.endswith(".parquet")}
    untouched = files(1)
    assert len(files(0)) >= 4
    store.compact(spark, path, ["p"], {"p": 0})
    assert len(files(0)) == 1 and files(1) == untouched
    assert spark.read.parquet(path).count() == 40


def test_a_hot_directory_is_written_by_several_tasks(spark, setting, tmp_path):
    setting(spark__sql__adaptive__advisoryPartitionSizeInBytes="100000",
            spark__sql__adaptive__coalescePartitions__minPartitionSize="1000")
    rows = spark.range(90_000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("p"), F.col("id"), F.hash("id").alias("h"))
    store.write_table(rows, str(tmp_path / "t"), ["p"])
    files = {p: len([f for f in os.listdir(tmp_path / "t" / f"p={p}") if f.endswith(".parquet")]) for p in range(20)}
    assert files[0] > 2 and sum(files.values()) < 8 * 20
    assert spark.read.parquet(str(tmp_path / "t")).count() == 90_000


def test_raw_schemas_have_the_full_column_lists():
    assert {table: len(schema) for table, schema in RAW_SCHEMAS.items()} == {
        "call_center": 31, "catalog_page": 9, "catalog_returns": 27, "catalog_sales": 34, "customer": 18,
        "customer_address": 13, "customer_demographics": 9, "date_dim": 28, "household_demographics": 5,
        "income_band": 3, "inventory": 4, "item": 22, "promotion": 19, "reason": 3, "ship_mode": 6, "store": 29,
        "store_returns": 20, "store_sales": 23, "time_dim": 10, "warehouse": 14, "web_page": 14, "web_returns": 24,
        "web_sales": 34, "web_site": 26}
    types = {f.name: f.dataType.simpleString() for schema in RAW_SCHEMAS.values() for f in schema}
    assert {name: types[name] for name in (
        "ss_sold_date_sk", "ss_ticket_number", "ss_quantity", "ss_net_paid_inc_tax", "d_date", "d_date_id",
        "d_current_year", "i_item_desc", "i_rec_end_date", "c_birth_year", "s_zip")} == {
        "ss_sold_date_sk": "bigint", "ss_ticket_number": "bigint", "ss_quantity": "int",
        "ss_net_paid_inc_tax": "decimal(12,2)", "d_date": "date", "d_date_id": "string", "d_current_year": "string",
        "i_item_desc": "string", "i_rec_end_date": "date", "c_birth_year": "int", "s_zip": "string"}


def test_delimited_files_to_gold(spark, tmp_path):
    """The whole path on files: text, bronze, silver, gold, catalog, query."""
    root = str(tmp_path)
    sample = sample_lake(spark, "/root/testdata/sf0.001")
    names = ("store_sales", "customer", "date_dim", "item", "store")
    for name in names:
        sample[f"bronze_{name}"].write.option("sep", "|").csv(f"{root}/raw/{name}")
    schemas = {name: sample[f"bronze_{name}"].schema for name in names}
    status = ingest_tables(spark, f"{root}/raw", f"{root}/bronze", names, schemas)
    assert status.filter("status = 'ok'").count() == 5
    pipeline.build_silver(spark, pipeline.stored_tables(spark, root), root)
    pipeline.build_gold(spark, root)
    for layer in ("silver", "gold"):
        store.register_layer(spark, f"{root}/{layer}", f"{layer}_", "path_db")
    lake_tables = CatalogTables(spark, "path_db")
    for query in (lambda t: layer_queries.yearly_sales(t), lambda t: layer_queries.daily_sales_trend(t, 2000),
                  lambda t: business.customer_retention(t)):
        assert query(lake_tables).collect() == query(sample).collect()
    spark.sql("DROP DATABASE path_db CASCADE")


def test_append_searches_touched_directories_only(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_table(spark.range(6).withColumn("p", F.col("id").cast("int")), path, ["p"])
    rows = spark.createDataFrame([(4, 4), (9, 5)], "id bigint, p int")
    plan = final_plan_of(store._near(spark.read.parquet(path), rows, ["p"]))
    assert re.search(r"PartitionFilters: \[.*subquery", plan)
    store.append_new(rows, path, ["id", "p"], ["p"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4, 5, 9]


def test_days_are_dates():
    assert all(int(day.strftime("%Y%m%d")) == key for key, day in DAYS)


def test_compaction_refuses_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_table(spark.range(10).withColumn("p", F.lit(1)), path, ["p"])
    for where in ({"id": 1}, {"p": 1, "id": 1}, {}):
        with pytest.raises(ValueError):
            store.compact(spark, path, ["p"], where)
    assert spark.read.parquet(path).count() == 10


def test_append_starts_a_table(spark, tmp_path):
    path = str(tmp_path / "new")
    rows = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "k int, p int")
    for _ in range(2):
        store.append_new(rows, path, ["k"], ["p"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]


def test_a_managed_table_is_left_alone(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept_db")
    spark.range(5).write.saveAsTable("kept_db.silver_store")
    store.write_table(spark.range(3), str(tmp_path / "silver" / "store"))
    status = store.register_layer(spark, str(tmp_path / "silver"), "silver_", "kept_db")
    assert [r.status for r in status] == ["managed, left alone"]
    assert spark.table("kept_db.silver_store").count() == 5
    spark.sql("DROP DATABASE kept_db CASCADE")


def test_a_problem_without_a_message_has_its_kind():
    assert store.first_line(KeyError()) == "KeyError" and store.first_line(ValueError("a\nb")) == "a"


def test_any_source_table_becomes_silver(spark, tmp_path):
    root = str(tmp_path)
    store.write_table(spark.createDataFrame([(1, "p"), (1, "p"), (2, "q")], "p_promo_sk bigint, p_promo_name string"),
                      f"{root}/bronze/promotion", source="here", job_id="b1")
    log = pipeline.build_silver(spark, pipeline.stored_tables(spark, root), root, tables=["promotion", "reason"])
    rows = {r.table_name: r for r in log.collect()}
    assert (rows["promotion"].status, rows["promotion"].rows) == ("ok", 2) and rows["promotion"].seconds > 0
    assert rows["reason"].status == "failed" and rows["reason"].error
    assert set(spark.read.parquet(f"{root}/silver/promotion").columns) == {
        "p_promo_sk", "p_promo_name", "load_timestamp", "job_id"}


def test_all_24_tables_are_read_with_their_schemas(spark, tmp_path):
    from tidewell.schemas import RAW_SCHEMAS
    for name, schema in RAW_SCHEMAS.items():
        write_text(tmp_path / "in" / name, "a.dat", "|" * len(schema) + "\n")
    status = ingest_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"), ends_with_separator=True, job_id="j")
    assert {(r.status, r.rows) for r in status.collect()} == {("ok", 1)} and status.count() == 24
    for name, schema in RAW_SCHEMAS.items():
        stored = spark.read.parquet(str(tmp_path / "out" / name))
        assert stored.drop("source", "job_id", "load_timestamp").dtypes == [
            (f.name, f.dataType.simpleString()) for f in schema]
        assert stored.first().job_id == "j" and stored.first().source.endswith(name)


def test_refresh_drops_months_without_sales_and_follows_the_calendar(spark, tmp_path):
    root = str(tmp_path)
    pipeline.build_silver(spark, lake(spark, SALES), root)
    pipeline.build_gold(spark, root)
    assert os.path.isdir(f"{root}/gold/daily_sales_summary/d_year=2000/d_month=3")
    without_march = lake(spark, [sale for sale in SALES if sale[0] // 100 != 200003])
    pipeline.build_silver(spark, without_march, root)
    pipeline.refresh_recent_days(spark, root, dt.date(2000, 3, 31), 40)
    months = {r.d_month for r in spark.read.parquet(f"{root}/gold/daily_sales_summary").collect()}
    assert months == {1, 2} and not os.path.isdir(f"{root}/gold/daily_sales_summary/d_year=2000/d_month=3")


def test_partitions_whose_directories_went_leave_the_catalog(spark, tmp_path):
    path = str(tmp_path / "layer" / "t")
    rows = spark.createDataFrame([(1, 1, "a"), (2, 2, "b c")], "x int, m int, n string")
    store.write_table(rows, path, ["m", "n"], stamp=False)
    layer = str(tmp_path / "layer")
    assert store.register_layer(spark, layer, "s_", "sync_db") == [("s_t", "registered")]
    store.remove_folder(spark, f"{path}/m=2")
    store.write_table(spark.createDataFrame([(3, 3, "d")], rows.schema), path, ["m", "n"], mode="append", stamp=False)
    assert store.register_layer(spark, layer, "s_", "sync_db") == [
        ("s_t", "registered"), ("s_t", "dropped m=2/n=b c")]
    assert {r.partition for r in spark.sql("SHOW PARTITIONS sync_db.s_t").collect()} == {"m=1/n=a", "m=3/n=d"}
    assert sorted(r.x for r in spark.table("sync_db.s_t").collect()) == [1, 3]
    spark.sql("DROP DATABASE sync_db CASCADE")


def test_widened_columns_are_read_and_others_refused(spark, tmp_path):
    layer, path = str(tmp_path / "layer"), str(tmp_path / "layer" / "t")

    def add(values, schema):
        store.write_table(spark.createDataFrame(values, schema), path, ["p"], mode="append", stamp=False)
    add([(1, Decimal("1.50"), 1.5, 1)], "x int, d decimal(5,2), f float, p int")
    assert store.register_layer(spark, layer, "w_", "wide_db") == [("w_t", "registered")]
    add([(2 ** 40, Decimal("123456789.125"), 2.5, 2, "new")], "x bigint, d decimal(15,3), f double, p int, c string")
    assert store.register_layer(spark, layer, "w_", "wide_db") == [("w_t", "registered")]
    assert {name: kind for name, kind in spark.table("wide_db.w_t").dtypes} == {
        "x": "bigint", "d": "decimal(15,3)", "f": "double", "c": "string", "p": "int"}
    for found in (spark.table("wide_db.w_t"), store.read_evolving(spark, path)):
        assert sorted((r.x, r.d, r.f, r.c) for r in found.collect()) == [
            (1, Decimal("1.500"), 1.5, None), (2 ** 40, Decimal("123456789.125"), 2.5, "new")]
    # Narrower files are fine in a wide table; text in place of a number is not, and the table stays as it was.
    add([(3, 3)], "x int, p int")
    assert store.register_layer(spark, layer, "w_", "wide_db") == [("w_t", "registered")]
    assert spark.table("wide_db.w_t").count() == 3
    add([("four", 4)], "x string, p int")
    status = store.register_layer(spark, layer, "w_", "wide_db")
    assert [r.status.partition(",")[0] for r in status] == ["refused"] and "column x" in status[0].status
    assert dict(spark.table("wide_db.w_t").dtypes)["x"] == "bigint"
    with pytest.raises(store.SchemaConflict):
        store.read_evolving(spark, path)
    spark.sql("DROP DATABASE wide_db CASCADE")


@pytest.mark.parametrize("a, b, want", [
    ("tinyint", "int", "int"), ("int", "double", "double"), ("decimal(9,2)", "decimal(8,4)", "decimal(11,4)"),
    ("int", "decimal(5,1)", "decimal(11,1)"), ("date", "timestamp_ntz", "timestamp_ntz"), ("string", "string", "string"),
    ("bigint", "double", None), ("decimal(38,0)", "decimal(10,9)", None), ("string", "int", None)])
def test_wider_types(a, b, want):
    from pyspark.sql.types import _parse_datatype_string
    first, second = (_parse_datatype_string(f"x {kind}") for kind in (a, b))
    for left, right in ((first, second), (second, first)):
        if want is None:
            with pytest.raises(store.SchemaConflict):
                store.widened(left, right)
        else:
            assert store.widened(left, right)["x"].dataType.simpleString() == want
