"""Incremental loads equal one build, whatever dies on the way, and leave alone what they do not reach."""

import os

import pytest

from tidewell import registry
from tidewell.operators import ranking
from tidewell.plans import gold, silver
from tidewell.plans.incremental import Lake, built_from, lineage, load_new_files, plan_batch, rejected_lines
from tidewell.registry import LTV_CUTS, sample_lake

FOLDER = "/root/testdata/sf0.001"
NAMES = ("store_sales", "customer", "date_dim", "item", "store")


def files(path) -> dict[str, float]:
    return {os.path.join(at, name): os.path.getmtime(os.path.join(at, name))
            for at, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def put(df, folder):
    df.write.mode("append").option("sep", "|").csv(folder)


def test_loads_that_die_equal_one_build(spark, tmp_path):
    sample, raw, root = sample_lake(spark, FOLDER), str(tmp_path / "raw"), str(tmp_path / "lake")
    bronze = {name: sample[f"bronze_{name}"] for name in NAMES}
    schemas = {name: frame.schema for name, frame in bronze.items()}
    steps: list[str] = []

    def load(die_at=None):
        def seen(step):
            steps.append(step)
            if step == die_at:
                raise KeyboardInterrupt(step)
        return load_new_files(spark, raw, root, NAMES, schemas, LTV_CUTS, seen)

    # March 2000 is not in the calendar yet, and some customers, items and sales come later.
    late = {"store_sales": "ss_sold_date_sk >= 20010101 AND ss_ticket_number % 4 = 0",
            "customer": "c_customer_sk % 5 = 0", "item": "i_item_sk % 40 = 0",
            "date_dim": "d_date_sk DIV 100 = 200003", "store": "false"}
    for name in NAMES:
        put(bronze[name].filter(f"NOT ({late[name]})"), f"{raw}/{name}")
    assert {(r.table_name, r.rejected) for r in load().collect()} == {(name, 0) for name in NAMES}
    before = files(f"{root}/gold/daily_sales_summary")
    for name in NAMES[:-1]:
        put(bronze[name].filter(late[name]), f"{raw}/{name}")
    for step in ("bronze_store_sales", "silver_date_dim", "silver_store_sales", "gold_daily_sales_summary",
                 "gold_customer_lifetime_value", "commit"):
        with pytest.raises(KeyboardInterrupt):
            load(step)
        assert plan_batch(spark, raw, root, NAMES) == 2
    assert load().count() == 4
    lake = Lake(spark, root)
    for name in NAMES:
        want = silver.build(name, {f"bronze_{n}": frame for n, frame in bronze.items()})
        assert rows(lake.read("silver", name).select(*want.columns)) == rows(want)
    for mart in gold.MARTS:
        want = sample[f"gold_{mart}"] if mart != "product_performance" else gold.product_performance(sample)
        assert rows(lake.read("gold", mart).select(*want.columns)) == rows(want)
    # Months that no late sale or day falls in keep their files.
    after = files(f"{root}/gold/daily_sales_summary")
    assert any("d_year=1999" in path for path in before)
    for path, time in before.items():
        year = int(path.partition("d_year=")[2][:4])
        assert after.get(path) == time if year < 2000 else True
    assert any("d_year=2000/d_month=3" in path for path in set(after) - set(before))
    # Nothing new: nothing is written.
    everything = files(root)
    assert load().count() == 0 and files(root) == everything and not os.path.exists(f"{root}/_work/batch=2")


def test_lines_that_do_not_fit_are_kept_with_their_file(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    (raw / "store").mkdir(parents=True)
    (raw / "store" / "a.dat").write_text("1|one\n2|two\nx|three\n4|four|4\n")
    schema = spark.createDataFrame([], "s_store_sk bigint, s_store_name string").schema
    status = load_new_files(spark, str(raw), root, ["store"], {"store": schema}).first()
    assert (status.files, status.rows, status.rejected) == (1, 2, 2)
    assert rows(Lake(spark, root).read("silver", "store")) == ["(1, 'one')", "(2, 'two')"]
    found = {(r.batch, r.line, os.path.basename(r.source)) for r in rejected_lines(spark, root, "store").collect()}
    assert found == {(1, "x|three", "a.dat"), (1, "4|four|4", "a.dat")}
    # A file of nothing but blank lines, and one that was there before.
    (raw / "store" / "b.dat").write_text("\n\n")
    status = load_new_files(spark, str(raw), root, ["store"], {"store": schema}).first()
    assert (status.files, status.rows, status.rejected) == (1, 0, 0)
    assert Lake(spark, root).read("silver", "store").count() == 2


def test_lineage_tells_what_a_file_reached_and_counts_a_repeated_load_once(spark, tmp_path):
    sample, raw, root = sample_lake(spark, FOLDER), str(tmp_path / "raw"), str(tmp_path / "lake")
    bronze = {name: sample[f"bronze_{name}"] for name in NAMES}
    schemas = {name: frame.schema for name, frame in bronze.items()}

    def load(die_at=None):
        def seen(step):
            if step == die_at:
                raise KeyboardInterrupt(step)
        return load_new_files(spark, raw, root, NAMES, schemas, LTV_CUTS, seen)

    for name in NAMES:
        put(bronze[name].coalesce(1), f"{raw}/{name}")
    load()
    before = lineage(spark, root)
    assert before.filter("rejected IS NOT NULL").count() == len(NAMES)
    assert {r.rows for r in before.filter("output = 'bronze_customer'").collect()} == {bronze["customer"].count()}
    assert {r.input for r in before.filter("output = 'gold_top_products_by_store'").collect()} == {
        "silver_store_sales", "silver_item", "silver_store"}
    with open(f"{raw}/customer/late.csv", "w") as file:
        file.write("900001|C900001|Ada|Byron|a@b.example|GB|1815\nno number|C900002|Bad|Line|c@d.example|GB|1816\n")
    for step in ("silver_customer", "gold_customer_lifetime_value", "commit"):
        with pytest.raises(KeyboardInterrupt):
            load(step)
        assert rows(lineage(spark, root)) == rows(before)
    load()
    late = lineage(spark, root).filter("batch = 2")
    source = rejected_lines(spark, root, "customer").first().source
    assert source.endswith("/customer/late.csv")
    assert [(r.input, r.rows, r.rejected) for r in late.filter("output = 'bronze_customer'").collect()] == [(source, 1, 1)]
    assert {(r.output, r.input) for r in late.filter("rejected IS NULL").collect()} == {
        ("silver_customer", "bronze_customer"), ("gold_customer_lifetime_value", "silver_customer"),
        ("gold_customer_lifetime_value", "silver_store_sales")}
    assert sorted(r.output for r in built_from(spark, root, source).collect()) == [
        "bronze_customer", "gold_customer_lifetime_value", "silver_customer"]


def test_what_was_published_before_a_load_died_is_not_written_again(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    (raw / "store").mkdir(parents=True)
    (raw / "store" / "a.dat").write_text("1|one\n2|two\nx|three\n")
    schema = spark.createDataFrame([], "s_store_sk bigint, s_store_name string").schema

    def load(die_at=None):
        def seen(step):
            if step == die_at:
                raise KeyboardInterrupt(step)
        return load_new_files(spark, str(raw), root, ["store"], {"store": schema}, seen=seen)

    with pytest.raises(KeyboardInterrupt):
        load("silver_store")
    bronze = files(f"{root}/bronze")
    assert bronze and not os.path.exists(f"{root}/silver")
    with pytest.raises(KeyboardInterrupt):
        load("commit")
    silver_files = files(f"{root}/silver")
    status = load().first()
    assert (status.rows, status.rejected) == (2, 1)
    assert files(f"{root}/bronze") == bronze and files(f"{root}/silver") == silver_files
    # Each table is told under the job whose id its rows bear.
    jobs = {r.output: r.job_id for r in lineage(spark, root).collect()}
    for layer in ("bronze", "silver"):
        stored = spark.read.parquet(f"{root}/{layer}/store").select("job_id").distinct().collect()
        assert [r.job_id for r in stored] == [jobs[f"{layer}_store"]]


def test_reading_a_loaded_mart_does_not_rank_all_sales_again(spark, tmp_path, monkeypatch):
    sample, root = sample_lake(spark, FOLDER), str(tmp_path / "lake")
    for mart in gold.MARTS:
        schema = sample[f"gold_{mart}"].schema
        spark.createDataFrame([], schema).write.parquet(f"{root}/gold/{mart}")

    def pinned(df):
        raise AssertionError("a mart is built")
    monkeypatch.setattr(ranking, "pin", pinned)
    monkeypatch.setitem(registry._LOADED, (spark.sparkContext.applicationId, FOLDER), root)
    for mart in gold.MARTS:
        assert registry.REGISTRY[f"incremental_{mart}"](spark, FOLDER).columns == sample[f"gold_{mart}"].columns
