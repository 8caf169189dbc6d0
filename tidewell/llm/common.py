"""Small helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import fresh_folder

# The six ASCII characters that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
# bytes.split() without an argument splits on exactly these.
BREAKS = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Text handled at once inside a task; a single longer text is handled alone.
SLICE_BYTES = 8 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, label: str, parts: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files, which outlive any executor.

    Rows of one value of ``parts`` lie in a folder of their own.
    """
    folder = fresh_folder(df.sparkSession, label)
    (df.write.partitionBy(*parts) if parts else df.write).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null reads as empty."""
    return [value or b"" for value in pc.cast(batch.column(column), pa.large_binary()).to_pylist()]


def sliced(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``limit`` bytes of text, whole rows, at least one."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, size in enumerate(sizes.tolist()):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def digest(*columns: Column) -> tuple[Column, Column]:
    """128 bits that stand for the values, as two longs. Nulls are told apart from values."""
    marked = [part for column in columns for part in (column.isNull(), column)]
    return F.xxhash64(F.lit(1), *marked), F.xxhash64(F.lit(2), *reversed(marked))


def crc_share(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0).cast("long"))


def one_of_each(rows: DataFrame, keys: list[str], *columns: Column) -> DataFrame:
    """One ``row`` per key, the one whose ``columns`` have the least digest, so that reruns agree on which."""
    marked = rows.withColumn("tie", F.struct(*digest(*columns)))
    return marked.groupBy(*keys).agg(F.min_by("row", "tie").alias("row"))
