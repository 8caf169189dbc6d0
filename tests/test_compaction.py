"""Merging small files by size: what is rewritten, what is left alone, and a step that dies on its way."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidewell.sources import compaction


def table(spark, path, appends=4, rows=400):
    for part in range(appends):
        spark.range(part * rows, (part + 1) * rows, numPartitions=2).select(
            "id", F.concat(F.lit("a b="), F.col("id") % 3).alias("p")).write.mode("append").partitionBy("p").parquet(path)


def files(path):
    return {name: os.stat(name).st_mtime_ns for name in glob.glob(f"{path}/**/*.parquet", recursive=True)
            if f"/{compaction.WORK}/" not in name}


def ids(spark, path):
    return sorted((r.id, r.p) for r in spark.read.parquet(path).collect())


def test_small_files_become_one_per_directory_and_a_second_run_rewrites_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path)
    before = ids(spark, path)
    assert len(files(path)) == 24
    done = compaction.pack_small_files(spark, path)
    assert [(d.files_before, d.files_after) for d in done] == [(8, 1)] * 3 and len({d.directory for d in done}) == 3
    after = files(path)
    assert len(after) == 3 and ids(spark, path) == before and not os.path.exists(f"{path}/{compaction.WORK}")
    assert compaction.pack_small_files(spark, path) == [] and files(path) == after


def test_large_files_and_directories_not_worth_it_are_left_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000, numPartitions=1).write.parquet(f"{path}/d=1")
    spark.range(10, numPartitions=5).write.mode("append").parquet(f"{path}/d=1")
    spark.range(10, numPartitions=1).write.parquet(f"{path}/d=2")
    old = files(path)
    large = max(old, key=os.path.getsize)
    target = int(os.path.getsize(large) * 1.5)
    done = compaction.pack_small_files(spark, path, target_bytes=target)
    left = files(path)
    assert len(done) == 1 and done[0].files_before == 5 and left[large] == old[large] and len(left) == 3
    assert all(left.get(name) == time for name, time in old.items() if "/d=2/" in name)
    assert spark.read.parquet(path).count() == 100_020


def test_bins_follow_the_sizes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4000, numPartitions=40).write.parquet(path)
    total = sum(map(os.path.getsize, files(path)))
    done = compaction.pack_small_files(spark, path, target_bytes=total // 4, files_per_job=10)
    assert done[0].files_before == 40 and 4 <= done[0].files_after <= 5 and len(files(path)) == done[0].files_after
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(4000))


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_step_that_died_is_finished(spark, tmp_path, moved):
    path = str(tmp_path / "t")
    table(spark, path)
    before = ids(spark, path)

    def dies(step):
        raise InterruptedError(step)

    with pytest.raises(InterruptedError):
        compaction.pack_small_files(spark, path, seen=dies)
    assert ids(spark, path) == before and len(files(path)) == 24
    work = glob.glob(f"{path}/{compaction.WORK}/*")[0]
    # As if it had died after the first files were moved, before any was removed.
    for staged in sorted(glob.glob(f"{work}/files/_bin=*/*.parquet"))[:moved]:
        number = staged.split("_bin=")[1].split("/")[0]
        row = spark.read.json(f"{work}/plan").filter(F.col("bin") == int(number)).first()
        target = f"{row.directory.removeprefix('file:')}/packed-{os.path.basename(work)}-{number}-0.snappy.parquet"
        os.rename(staged, target)
    assert compaction.finish_compaction(spark, path) == 1
    assert ids(spark, path) == before and len(files(path)) == 3


def test_a_step_that_died_before_its_plan_is_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, appends=1)
    before = ids(spark, path)
    spark.range(5).write.parquet(f"{path}/{compaction.WORK}/x/files/_bin=0")
    assert compaction.finish_compaction(spark, path) == 0
    assert ids(spark, path) == before and not os.path.exists(f"{path}/{compaction.WORK}")


def test_widened_columns_and_files_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,), (2,)], "x int").coalesce(1).write.parquet(path)
    spark.createDataFrame([(1 << 40, "new")], "x bigint, y string").coalesce(1).write.mode("append").parquet(path)
    compaction.pack_small_files(spark, path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, None), (2, None), (1 << 40, "new")]
    assert len(files(path)) == 1
    empty = str(tmp_path / "empty")
    for _ in range(2):
        spark.createDataFrame([], "x int").write.mode("append").parquet(empty)
    compaction.pack_small_files(spark, empty)
    assert spark.read.parquet(empty).columns == ["x"] and spark.read.parquet(empty).count() == 0
