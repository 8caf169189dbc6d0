"""Bronze ingestion of delimited files without a header."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.schemas import RAW_SCHEMAS, SOURCE_TABLES
from tidewell.sources.lake import first_line, write_table

CORRUPT = "_corrupt_record"
_LINE_END = "_line_end"
STATUS = "table_name string, status string, `rows` bigint, error string"


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, separator: str = "|",
                   ends_with_separator: bool = False, capture_malformed: bool = False) -> DataFrame:
    """Delimited text as a DataFrame.

    With a schema the files are read once; without one Spark needs a pass of its
    own to infer it. ``ends_with_separator`` is for files whose lines end in the
    separator. ``capture_malformed`` keeps the text of lines that do not fit the
    schema in ``_corrupt_record``; see ``split_malformed``.
    """
    reader = spark.read.option("sep", separator).option("header", "false").option("mode", "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    fields = list(schema.fields)
    if ends_with_separator:
        fields.append(T.StructField(_LINE_END, T.StringType()))
    if capture_malformed:
        fields.append(T.StructField(CORRUPT, T.StringType()))
        # A line is judged by all of its fields, whichever columns a later step reads.
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false")
    return reader.schema(T.StructType(fields)).csv(path).drop(_LINE_END)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines that fit the schema; and the others with their text and the fields that could be read.

    Spark does not judge lines by that column alone while reading raw files, so
    store both parts before counting or selecting from them.
    """
    fits = F.col(CORRUPT).isNull()
    return df.filter(fits).drop(CORRUPT), df.filter(~fits)


def ingest_tables(spark: SparkSession, source: str, target: str, tables: str | Iterable[str] = "ALL",
                  schemas: Mapping[str, T.StructType] = RAW_SCHEMAS, job_id: str | None = None,
                  **read_options) -> DataFrame:
    """Copy raw tables to Parquet, one directory each; a failing table does not stop the others.

    Each row gets its source folder, job and load time. Returns one status row per table. The row count is observed by the write
    itself, so no table is read twice.
    """
    job_id = job_id or uuid.uuid4().hex
    names = SOURCE_TABLES if tables == "ALL" else [tables] if isinstance(tables, str) else list(tables)
    outcome = []
    for name in names:
        counted = Observation(name)
        try:
            raw = read_delimited(spark, f"{source}/{name}", schemas.get(name), **read_options)
            write_table(raw.observe(counted, F.count(F.lit(1)).alias("rows")), f"{target}/{name}",
                        source=f"{source}/{name}", job_id=job_id)
            outcome.append((name, "ok", counted.get["rows"], None))
        except Exception as problem:  # reported to the caller, who decides
            outcome.append((name, "failed", None, first_line(problem)))
    return spark.createDataFrame(outcome, STATUS)
