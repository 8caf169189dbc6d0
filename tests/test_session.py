"""Shuffles are cut by the size of the input, whatever the session's fixed number is."""

from pyspark.sql import functions as F

from tidewell.operators.ranking import with_position
from tidewell.session import ADVISORY, INITIAL_PARTITIONS, PARTITION_INPUT, configure, shuffle_partitions, size_shuffles
from tidewell.sources.samples import sample_tables


def test_shuffles_follow_the_size_of_the_input(spark, tmp_path, setting, monkeypatch):
    setting(**{INITIAL_PARTITIONS.replace(".", "__"): "1"})
    folder = str(tmp_path)
    spark.range(20_000).select(F.col("id").alias("event_id"), F.randn(1).alias("value")).write.parquet(
        f"{folder}/events.parquet")
    sample_tables(spark, folder)
    assert shuffle_partitions(spark) == 4  # small input: the session's own number
    monkeypatch.setattr("tidewell.session.PARTITION_INPUT", 10_000)
    sample_tables(spark, folder)
    cut = shuffle_partitions(spark)
    assert 10 < cut < 40 and PARTITION_INPUT > 10_000
    assert with_position(spark.range(1000), [F.col("id")]).filter("position <> id + 1").count() == 0
    # Later, smaller input takes nothing back, as earlier plans may not have run yet; absent files count nothing.
    size_shuffles(spark, [f"{folder}/no.parquet"])
    assert shuffle_partitions(spark) == cut


def test_partitions_are_merged_up_to_a_bounded_size(spark, setting):
    setting(**{ADVISORY.replace(".", "__"): "64m"})
    configure(spark)
    assert int(spark.conf.get(ADVISORY)) == 16 << 20
    setting(**{ADVISORY.replace(".", "__"): "8m"})
    configure(spark)
    assert spark.conf.get(ADVISORY) == "8m"
