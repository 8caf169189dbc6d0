"""Distributed ranks and tiles equal Spark's own window functions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.operators.ranking import rank_within, tiles, with_position

LIGHT = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@LIGHT
@given(st.lists(st.integers(0, 3) | st.none(), min_size=1, max_size=40), st.integers(2, 7))
def test_tiles_equal_ntile(spark, values, n):
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v int").repartition(3)
    got = tiles(df, "id", {"up": F.col("v"), "down": -F.col("v")}, n)
    want = df.withColumns({
        "up": F.ntile(n).over(W.orderBy(F.col("v").asc_nulls_last(), "id")),
        "down": F.ntile(n).over(W.orderBy(F.col("v").desc_nulls_last(), "id")),
    })
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_seven_rows_in_five_tiles(spark):
    df = spark.range(7).withColumn("v", F.lit(1))
    counts = tiles(df, "id", {"tile": F.col("v")}, 5).groupBy("tile").count().orderBy("tile").collect()
    assert [tuple(r) for r in counts] == [(1, 2), (2, 2), (3, 1), (4, 1), (5, 1)]


def test_tiles_of_nothing(spark):
    assert tiles(spark.range(0), "id", {"tile": F.col("id")}, 5).count() == 0


@LIGHT
@given(st.lists(st.tuples(st.sampled_from("ab") | st.none(), st.integers(0, 3) | st.none()), min_size=1, max_size=40))
def test_rank_equals_window_rank(spark, rows):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id bigint, g string, v int")
    got = rank_within(df, ["g"], "v", ["id"], "rank")
    want = df.withColumn("rank", F.rank().over(W.partitionBy("g").orderBy(F.col("v").desc_nulls_last())))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_group_and_one_value_spread_over_tasks(spark):
    """A third of the rows share a value; all are in one group."""
    df = spark.range(30_000).select("id", F.lit("all").alias("g"), (F.col("id") % 3 * (F.col("id") % 1000)).alias("v"))
    placed = with_position(df, [F.col("v").desc(), F.col("id")])
    assert placed.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first()[:] == (1, 30000, 30000)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 12_000
    got = rank_within(df, ["g"], "v", ["id"], "rank")
    want = df.withColumn("rank", F.rank().over(W.partitionBy("g").orderBy(F.col("v").desc())))
    assert got.exceptAll(want).count() == 0 and got.count() == 30_000


def test_tiles_of_doubles_closer_than_a_millionth_and_beyond_decimals(spark):
    df = spark.range(40).withColumn("v", F.col("id") % 7 * F.lit(1e-9)).withColumn("w", (F.col("id") % 3) * F.lit(1e40))
    got = tiles(df, "id", {"a": F.col("v"), "b": -F.col("w"), "c": F.col("id")}, 5)
    want = df.select("id", *[F.ntile(5).over(W.orderBy(value, "id")).alias(name) for name, value in (
        ("a", F.col("v")), ("b", -F.col("w")), ("c", F.col("id")))])
    assert sorted(got.select("id", "a", "b", "c").collect()) == sorted(want.collect())
