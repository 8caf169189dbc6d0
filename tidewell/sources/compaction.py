"""Compaction by size: the small files of a directory become few files of about a target size.

Only names and sizes of files pass the driver, as they do whenever Spark lists a table; rows go from the small files
straight to the new ones, and files that are large enough are not touched. A plan of the step is stored before the
first file moves, so a step that died on its way is finished by the next call instead of being begun again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.sources.lake import (
    evolving_schema,
    file_system,
    partition_columns,
    path_exists,
    remove_folder,
    subfolders,
)

TARGET_BYTES = 128 << 20
# Files rewritten by one job; more are several jobs, each published before the next begins.
FILES_PER_JOB = 20_000
WORK = "_compacting"


class Packed(NamedTuple):
    directory: str
    files_before: int
    files_after: int


def small_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """The files to be rewritten: directory, path, file_path, size, bin (from 0 in each directory), bins.

    A file under half the target is small. Small files of a directory are put side by side by name and cut into bins
    where their running size passes a multiple of the target, so a bin holds at most one and a half targets. A
    directory is left alone unless rewriting at least halves its small files, so repeated calls come to an end.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        .load(path).select("path", "_metadata.file_path", F.col("length").alias("size"))
    )
    small = listed.filter(F.col("size") < target_bytes / 2).withColumn(
        "directory", F.regexp_replace("path", "/[^/]*$", ""))
    whole = W.partitionBy("directory")
    before = F.sum("size").over(whole.orderBy("path").rowsBetween(W.unboundedPreceding, -1))
    binned = small.withColumn("bin", F.floor(F.coalesce(before, F.lit(0)) / target_bytes))
    counted = binned.withColumns({"bins": F.max("bin").over(whole) + 1, "files": F.count("*").over(whole)})
    return counted.filter(F.col("files") >= 2 * F.col("bins")).drop("files")


def _jobs(files: Sequence[Row], limit: int) -> Iterator[list[Row]]:
    """Files in the order of their bins, cut so that a bin stays whole."""
    job: list[Row] = []
    for place, file in enumerate(files):
        fresh = place == 0 or (file.directory, file.bin) != (files[place - 1].directory, files[place - 1].bin)
        if fresh and len(job) >= limit:
            yield job
            job = []
        job.append(file)
    if job:
        yield job


def _rewrite(spark: SparkSession, root: str, schema: T.StructType, files: Sequence[Row]) -> str:
    """Write one file per bin into a work folder, and then the plan of what replaces what."""
    bins: dict[tuple[str, int], int] = {}
    rows = [(file.file_path, bins.setdefault((file.directory, file.bin), len(bins))) for file in files]
    work = f"{root}/{WORK}/{uuid.uuid4().hex}"
    numbers = spark.createDataFrame(rows, "_file string, _bin long")
    # At most FILES_PER_JOB names, so small enough to be sent to every task.
    dealt = (
        spark.read.schema(schema).parquet(*[file.path for file in files])
        .withColumn("_file", F.col("_metadata.file_path")).join(F.broadcast(numbers), "_file").drop("_file")
    )
    (
        dealt.repartition(min(len(bins), FILES_PER_JOB), "_bin").write.option("compression", "snappy")
        .partitionBy("_bin").parquet(f"{work}/files")
    )
    plan = [(file.directory, file.path, number) for file, (_, number) in zip(files, rows)]
    spark.createDataFrame(plan, "directory string, path string, bin long").coalesce(1).write.json(f"{work}/plan")
    return work


def _publish(spark: SparkSession, work: str) -> None:
    """Move each bin into its directory and remove the files it was made of; any part of it may have been done before.

    A new file is there before the old ones go, so no row is ever missing; a reader in between may meet a bin twice.
    """
    system, _ = file_system(spark, work)
    name = spark._jvm.org.apache.hadoop.fs.Path
    plan = spark.read.schema("directory string, path string, bin long").json(f"{work}/plan").orderBy("bin", "path").collect()  # names only
    for (directory, number), old in groupby(plan, key=lambda file: (file.directory, file.bin)):
        folder = name(f"{work}/files/_bin={number}")
        if not system.exists(folder):
            continue  # Files without rows stay: they may be all that tells a table's columns.
        written = [entry.getPath() for entry in system.listStatus(folder)]
        for place, file in enumerate(path for path in written if path.getName().endswith(".parquet")):
            target = f"{directory}/packed-{work.rsplit('/', 1)[1]}-{number}-{place}.snappy.parquet"
            if not system.rename(file, name(target)):
                raise RuntimeError(f"could not move {file} to {target}")
        for file in old:
            system.delete(name(file.path), False)
    remove_folder(spark, work)


def finish_compaction(spark: SparkSession, path: str) -> int:
    """Publish the steps that died after their plan was stored and drop those that died before; how many were published."""
    published = 0
    if path_exists(spark, f"{path}/{WORK}"):
        for name in subfolders(spark, f"{path}/{WORK}"):
            work = f"{path}/{WORK}/{name}"
            if path_exists(spark, f"{work}/plan/_SUCCESS"):
                _publish(spark, work)
                published += 1
            else:
                remove_folder(spark, work)
        remove_folder(spark, f"{path}/{WORK}")
    return published


def pack_small_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES,
                     files_per_job: int = FILES_PER_JOB, seen: Callable[[str], None] = lambda step: None) -> list[Packed]:
    """Merge the small files of a Parquet table, directory by directory; the directories changed, with their small files.

    Finishes an earlier call that died first. Columns that were added or widened between files are written in the
    table's type. Files that are added while it runs are left alone; only one such call may run at a time, and
    nothing else may remove files meanwhile. Needs a file system that can rename. ``seen`` hears of each step.
    """
    finish_compaction(spark, path)
    files = small_files(spark, path, target_bytes).orderBy("directory", "bin", "path").collect()  # names only
    if not files:
        return []
    parts = partition_columns(spark, path)
    schema = T.StructType([field for field in evolving_schema(spark, path).fields if field.name not in parts])
    for job in _jobs(files, files_per_job):
        work = _rewrite(spark, path, schema, job)
        seen("planned")
        _publish(spark, work)
    remove_folder(spark, f"{path}/{WORK}")
    return [Packed(directory, len(rows), rows[0].bins) for directory, rows in
            ((directory, list(rows)) for directory, rows in groupby(files, key=lambda file: file.directory))]
