"""Sharding by extendible hashing, in DataFrame operations only.

A directory is indexed by the leading bits of a document's hash. It starts with one bucket; a bucket over the byte
limit splits on its next bit, the others stay as they are, until every bucket fits. Directory sizes come from a
histogram over the next 16 bits at a time (65,536 rows at most per bucket still too large), rolled up to every
shorter prefix, so all splits of 16 levels take one aggregation over the documents and no loop over bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import stored

STRIDE = 16
# Bits of the hash proper; further ones come from a row's place and only ever part rows that are alike.
HASH_BITS = 64
SALT_BITS = 32


def _bits(hex_digits, count: int):
    """The value of 4 hex digits as a string of ``count`` binary digits."""
    return F.lpad(F.conv(hex_digits, 16, 2), count, "0")


def _directory(over: DataFrame, first: int, limit: int) -> DataFrame:
    """Where each 16-bit step below each open bucket leads: head, step, bits, shard_bytes, shard_docs.

    ``over`` has head (the bits that led to a bucket still too large, '' at the start), step (the next 16 bits) and
    size. ``first`` is the fewest bits of a step that can be a bucket.
    """
    leaves = over.groupBy("head", "step").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
    levels = leaves.withColumn("level", F.explode(F.sequence(F.lit(first), F.lit(STRIDE)))).withColumn(
        "bits", F.expr("left(step, level)"))
    sizes = levels.groupBy("head", "level", "bits").agg(
        F.sum("size").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    # Sizes shrink along a path, so the bucket of a path is its shortest prefix that fits, or all of its bits.
    bucket = F.struct("level", "bits", "shard_bytes", "shard_docs")
    settled = (F.col("shard_bytes") <= limit) | (F.col("level") == STRIDE)
    return (
        levels.select("head", "step", "level", "bits").join(sizes.filter(settled), ["head", "level", "bits"])
        .groupBy("head", "step").agg(F.min(bucket).alias("bucket")).select(
            "head", "step", "bucket.bits", "bucket.shard_bytes", "bucket.shard_docs")
    )


def shard_documents(docs: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """The shard of each row: doc_id, size, shard, depth, shard_bytes, shard_docs, fits.

    ``size`` is the UTF-8 length of the text (null: 0); ``shard`` the bits of its bucket, '' if all fit in one;
    ``depth`` their number. The hash is md5 over doc_id and the text's md5 (nulls marked), so the same documents
    always fall into the same shards. Rows alike in both share all 64 bits; if together they exceed the limit they
    are parted further by a hash of their place, which can only swap rows that are alike. ``fits`` is false for a
    document larger than the limit itself, which no split can help, and then for rows left beside it after all bits.
    An empty table gives an empty result; other columns are ignored.
    """
    marked = F.concat(
        F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("n")), F.lit(":"),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("n")))
    rows = docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
        F.substring(F.md5(marked.cast("binary")), 1, HASH_BITS // 4).alias("hash"))
    salt = F.lower(F.lpad(F.hex(F.xxhash64(F.col("hash"), F.monotonically_increasing_id())), 16, "0"))
    rows = stored(rows.select(
        "doc_id", "size", F.concat("hash", F.substring(salt, 1, SALT_BITS // 4)).alias("hash")), "shard")
    strides = (HASH_BITS + SALT_BITS) // STRIDE
    parts, open_rows = [], rows.withColumn("head", F.lit(""))
    for stride in range(strides):
        stepped = open_rows.withColumn("step", _bits(F.substring("hash", stride * STRIDE // 4 + 1, 4), STRIDE))
        directory = stored(_directory(stepped, 1 if stride else 0, limit), "directory")
        found = stepped.join(directory, ["head", "step"]).select(
            "doc_id", "size", "hash", F.concat("head", "bits").alias("head"), "shard_bytes", "shard_docs")
        if stride == strides - 1 or not directory.filter(F.col("shard_bytes") > limit).head(1):
            parts.append(found)
            break
        parts.append(found.filter(F.col("shard_bytes") <= limit))
        open_rows = found.filter(F.col("shard_bytes") > limit).select("doc_id", "size", "hash", "head")
    placed = reduce(DataFrame.unionByName, parts)
    return placed.select(
        "doc_id", "size", F.col("head").alias("shard"), F.length("head").alias("depth"), "shard_bytes", "shard_docs",
        (F.col("shard_bytes") <= limit).alias("fits"))
