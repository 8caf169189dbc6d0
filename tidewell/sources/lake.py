"""The stored lake: writing, refreshing, registering and compacting tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.dedup import one_row_per_key
from tidewell.session import JOIN_ON_ALL_KEYS, fresh_folder, setting


def stamped(df: DataFrame, **lineage: str) -> DataFrame:
    """Add ``load_timestamp`` and any lineage columns, such as ``source`` and ``job_id``."""
    return df.withColumns({
        **{name: F.lit(value) for name, value in lineage.items()}, "load_timestamp": F.current_timestamp(),
    })


def laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a directory together, so that it gets few files.

    A rebalance, unlike a repartition by the same columns, lets AQE split a
    directory that holds a large share of all rows over several tasks.
    """
    return df.hint("rebalance", *[F.col(name) for name in partition_by]) if partition_by else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                stamp: bool = True, **lineage: str) -> None:
    """Write Parquet with Snappy; overwriting makes a re-run harmless."""
    rows = stamped(df, **lineage) if stamp else df
    writer = laid_out(rows, partition_by).write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_touched(df: DataFrame, path: str, partition_by: Sequence[str], **lineage: str) -> None:
    """Replace only the directories that ``df`` has rows for."""
    (
        laid_out(stamped(df, **lineage), partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        .partitionBy(*partition_by).parquet(path)
    )


def _near(stored: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored rows within the span of ``df`` on each directory column, found before the scan starts."""
    for name in columns:
        low, high = df.agg(F.min(name)).scalar(), df.agg(F.max(name)).scalar()
        stored = stored.filter(F.col(name).isNull() | F.col(name).between(low, high))
    return stored


def _not_stored(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key ``stored`` lacks; a NULL in a key equals a NULL.

    Whole keys are compared by plain equality, which can use rows where they lie, if they lie by some of the keys; a
    null-safe one brings all rows together anew. It is only asked of stored keys with a NULL, if there are any.
    """
    taken = stored.select(*[F.col(key).alias(f"_{key}") for key in keys])
    whole = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in taken.columns])
    equal = reduce(lambda a, b: a & b, [F.col(key) == F.col(f"_{key}") for key in keys])
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    fresh, partial = df.join(taken.filter(whole), equal, "left_anti"), taken.filter(~whole)
    return fresh if partial.isEmpty() else fresh.join(partial, same, "left_anti")


def append_new(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), **lineage) -> None:
    """Append the rows whose key is not stored yet; running it twice adds nothing, and a first load starts the table.

    Directory columns that belong to the key narrow the search to the span of
    directories that ``df`` falls in. Rows that a join or grouping has dealt out
    by some of the keys stay there, and the stored keys are dealt out to them.
    """
    if not path_exists(df.sparkSession, path):
        write_table(one_row_per_key(df, keys), path, partition_by, **lineage)
        return
    stored = df.sparkSession.read.parquet(path)
    nearby = _near(stored, df, [name for name in partition_by if name in keys])
    fresh = _not_stored(one_row_per_key(df, keys), nearby, keys)
    with setting(df.sparkSession, JOIN_ON_ALL_KEYS, "false"):
        write_table(fresh, path, partition_by, mode="append", **lineage)


class SchemaConflict(ValueError):
    """Two types of one column that have no common wider type."""


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _wider(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds all values of both, among those that Parquet files can be read as."""
    if a == b:
        return a
    kinds = {a.simpleString(), b.simpleString()}
    if kinds <= set(_WHOLE):
        return max((a, b), key=lambda kind: _WHOLE.index(kind.simpleString()))
    if kinds == {"float", "double"} or "double" in kinds and kinds <= {"double", *_WHOLE[:3]}:
        return T.DoubleType()
    if kinds == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    decimals = [kind for kind in (a, b) if isinstance(kind, T.DecimalType)]
    if decimals and (len(decimals) == 2 or kinds & set(_WHOLE)):
        digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
        whole = max(k.precision - k.scale if isinstance(k, T.DecimalType) else digits[k.simpleString()] for k in (a, b))
        scale = max(k.scale for k in decimals)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    raise SchemaConflict(f"column {name}: {a.simpleString()} and {b.simpleString()}")


def widened(first: T.StructType, second: T.StructType) -> T.StructType:
    """The columns of both, in order of appearance, each with the wider of its types."""
    found = {field.name: field for field in first.fields}
    for field in second.fields:
        known = found.get(field.name)
        kind = field.dataType if known is None else _wider(field.name, known.dataType, field.dataType)
        found[field.name] = T.StructField(field.name, kind)
    return T.StructType([T.StructField(name, field.dataType) for name, field in found.items()])


def _schema_of(spark: SparkSession, root: str, files: Sequence[str]) -> T.StructType:
    """Merged by Spark; files that disagree are halved until each part agrees, and the parts are widened.

    Files come in order of their times, so a type that changed once costs a logarithm of their number.
    """
    try:
        return spark.read.option("mergeSchema", "true").option("basePath", root).parquet(*files).schema
    except Exception as problem:
        if len(files) == 1 or "CANNOT_MERGE" not in str(problem):
            raise
    middle = len(files) // 2
    return widened(_schema_of(spark, root, files[:middle]), _schema_of(spark, root, files[middle:]))


def evolving_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema that all files below a folder can be read with, directory columns included."""
    plain = spark.read.option("mergeSchema", "true")
    try:
        return plain.parquet(path).schema
    except Exception as problem:
        if "CANNOT_MERGE" not in str(problem):
            raise
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(path).orderBy("modificationTime", "path").select("path")
    return _schema_of(spark, path, [row.path for row in files.collect()])  # names only


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read files written before and after columns were added or widened; missing ones are NULL.

    Raises ``SchemaConflict`` where a column changed to a type that the old one does not fit into, or the other way.
    """
    return spark.read.schema(evolving_schema(spark, path)).parquet(path)


def _matches(values: Mapping[str, object]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.lit(value)) for name, value in values.items()])


def compact(spark: SparkSession, path: str, partition_by: Sequence[str], where: Mapping[str, object],
            rows_per_file: int = 5_000_000) -> None:
    """Rewrite the directories with the given partition values into fewer, larger files.

    Only partition columns may be named, so a directory is rewritten as a whole or not at all. The rows go through a
    folder of their own first: a directory cannot be replaced while it is being read, and a copy is there should the
    job die; the copy is removed when the directories are replaced.
    """
    if not where or set(where) - set(partition_by):
        raise ValueError(f"where names partition columns only ({', '.join(partition_by)})")
    staging = fresh_folder(spark, "compact")
    spark.read.parquet(path).filter(_matches(where)).write.parquet(staging)
    (
        laid_out(spark.read.parquet(staging), partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
        .option("compression", "snappy").partitionBy(*partition_by).parquet(path)
    )
    remove_folder(spark, staging)


class Registered(NamedTuple):
    table: str
    status: str


def file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    system, folder = file_system(spark, path)
    return system.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    system, folder = file_system(spark, path)
    system.delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, folder = file_system(spark, path)
    system.mkdirs(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    system, folder = file_system(spark, path)
    return sorted(entry.getPath().getName() for entry in system.listStatus(folder) if entry.isDirectory())


def partition_folder(spark: SparkSession, path: str, columns: Sequence[str], values: Sequence) -> str:
    """The directory of a partition, its values escaped as Spark writes them."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([path, *(names.getPartitionPathString(column, None if value is None else str(value))
                             for column, value in zip(columns, values))])


def _directories(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    system, folder = file_system(spark, root)
    found = [entry.getPath() for entry in system.listStatus(folder) if entry.isDirectory()]
    return sorted((p.getName(), p.toString()) for p in found if not p.getName().startswith(("_", ".")))


def _kind_of_table(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(name).tableType if spark.catalog.tableExists(name) else None


def _columns(schema: T.StructType, names: Sequence[str]) -> str:
    return ", ".join(f"`{name}` {schema[name].dataType.simpleString()}" for name in names)


def _create_external(spark: SparkSession, full: str, path: str, schema: T.StructType, parts: Sequence[str]) -> None:
    plain = [name for name in schema.names if name not in parts]
    by = f"PARTITIONED BY ({', '.join(f'`{name}`' for name in parts)})" if parts else ""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {full} ({_columns(schema, plain + list(parts))}) USING parquet {by} LOCATION '{location}'")


def _partitions(spark: SparkSession, full: str) -> set[str]:
    return {row.partition for row in spark.sql(f"SHOW PARTITIONS {full}").collect()}


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The directory columns below a path, from its first directories."""
    found, here = [], path
    while folders := [name for name in subfolders(spark, here) if "=" in name]:
        found.append(folders[0].partition("=")[0])
        here = f"{here}/{folders[0]}"
    return found


def _register_external(spark: SparkSession, table: str, full: str, path: str) -> list[Registered]:
    """Create the table or bring it up to date: columns are added and widened, partitions added and dropped.

    A type that changed to one that does not hold the old values leaves the table as it was. As a catalog table cannot
    change a type, a widened one is made anew over its files, which stay where they are.
    """
    kind = _kind_of_table(spark, full)
    if kind == "MANAGED":
        return [Registered(table, "managed, left alone")]
    try:
        schema = evolving_schema(spark, path)
        if kind is not None:
            schema = widened(spark.table(full).schema, schema)
    except SchemaConflict as problem:
        return [Registered(table, f"refused, {problem}")]
    parts, gone = partition_columns(spark, path), set()
    if kind is None:
        _create_external(spark, full, path, schema, parts)
    else:
        known = spark.table(full).schema
        gone = _partitions(spark, full) if parts else set()
        added = [name for name in schema.names if name not in known.names]
        if any(schema[name].dataType != known[name].dataType for name in known.names):
            spark.sql(f"DROP TABLE {full}")
            _create_external(spark, full, path, schema, parts)
        elif added:
            spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({_columns(schema, added)})")
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
        gone -= _partitions(spark, full)
    spark.catalog.refreshTable(full)
    return [Registered(table, "registered"), *[Registered(table, f"dropped {name}") for name in sorted(gone)]]


def register_layer(spark: SparkSession, root: str, prefix: str, database: str | None = None) -> list[Registered]:
    """Make each directory under ``root`` queryable as ``prefix`` + its name.

    Schema and partitions are discovered from the files and refreshed in place
    on every call. With a database the tables are external and outlast the
    session; otherwise they are temporary views. A managed table of the same
    name is left alone, a table whose directory has gone is reported, and so is
    each partition that was dropped because its directory has gone.
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    present = []
    for name, path in _directories(spark, root):
        table = prefix + name
        if database:
            present += _register_external(spark, table, f"{database}.{table}", path)
        else:
            read_evolving(spark, path).createOrReplaceTempView(table)
            present.append(Registered(table, "registered"))
    known = {t.name for t in spark.catalog.listTables(database) if t.name.startswith(prefix)}
    return present + [Registered(name, "missing") for name in sorted(known - {r.table for r in present})]


def create_table_as(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def first_line(problem: Exception) -> str:
    """What to log of an error; its kind where it has no message."""
    lines = str(problem).strip().splitlines()
    return lines[0] if lines else type(problem).__name__
