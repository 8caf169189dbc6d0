"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets the exponential key -ln(u) / w, with u a hash of its id and text and w its quality weight; rising
keys are a weighted sample without replacement, the same on every run. Documents are sorted by key within their
source and their sizes summed up in that order. A source whose target exceeds its size is taken whole as often as it
fits; what is left of the target takes the documents first in key order.

The order is laid out by range partitions, so a source of any size spreads over tasks: sums run inside a partition,
and one row per (partition, source) carries the sums of earlier partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.llm.common import WORD, digest, one_of_each, stored


def quality_weight(size: Column, chars: Column) -> Column:
    """1 for prose-like mean word lengths (3 to 10 code points, breaks included), else 0.25."""
    return F.when((chars >= 4 * size) & (chars <= 11 * size), F.lit(1.0)).otherwise(F.lit(0.25))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float = 1.0, most: float = 3.0) -> DataFrame:
    """source, source_size and target of each source; ``sizes`` has source and size.

    Sources in code-point order, null last, weigh ``weights``, repeating. Together they share ``share`` of all sizes;
    a target stops at ``most`` times its source's size and the excess goes to the others by weight. One row per
    source is sorted in one task; documents are not.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = totals.withColumns({
        "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")),
        "cap": F.col("source_size") * F.lit(float(most)),
    })
    everything = W.partitionBy()
    # Water level: sources fill in the order of cap / weight; one is full if the level without it reaches its cap.
    before = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1)
    level = (
        (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    )
    full = weighted.withColumn("all", F.sum("source_size").over(everything) * F.lit(float(share))).withColumn(
        "full", level * F.col("weight") >= F.col("cap"))
    rest = F.col("all") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("weight") * rest / F.when(open_weight > 0, open_weight)))
    return full.select("source", "source_size", target.alias("target"))


def _running(batches):
    """Sum sizes up within each source of a sorted partition, streaming."""
    source, total = None, 0
    for batch in batches:
        names = batch.column("source").to_pylist()
        sizes = batch.column("size").to_numpy(zero_copy_only=False)
        sums = np.cumsum(sizes, dtype=np.int64)
        starts = [row for row in range(len(names)) if row == 0 or names[row] != names[row - 1]]
        running = np.empty(len(names), np.int64)
        for start, end in zip(starts, [*starts[1:], len(names)]):
            if source is None or names[start] != source[0]:
                source, total = (names[start],), 0
            running[start:end] = sums[start:end] - (sums[start - 1] if start else 0) + total
            total = int(running[end - 1])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(name) for name in batch.schema.names], pa.array(running)],
            [*batch.schema.names, "running"])


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, most: float = 3.0,
                weight: Column | None = None, seed: int = 17) -> DataFrame:
    """What a mix takes of each row: doc_id, source, d1, d2, size, source_size, target, copies, taken.

    d1 and d2 stand for doc_id, source and text. Size is the number of words (null text: 0). ``weight`` is a positive
    quality weight over doc_id, text, source and size; by default ``quality_weight``. A document is taken whole or
    not, ``copies`` times; the last one of the fractional epoch is taken if that brings its source nearer to the
    target, so a source misses it by half a document at most. Rows alike in doc_id, source and text tie in the order,
    which cannot change what the mix holds. Null sources are one source, the last. Documents without words take a
    place in the order and take nothing. If no document has a word, every target is 0.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    d1, d2 = digest(F.col("doc_id"), F.col("source"), F.col("text"))
    measured = docs.select("doc_id", "text", "source").withColumns({
        "size": size, "chars": F.coalesce(F.length("text"), F.lit(0)), "d1": d1, "d2": d2})
    weight = quality_weight(F.col("size"), F.col("chars")) if weight is None else weight
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "d1", "d2"), 11).cast("double") + 0.5) / float(1 << 53)
    keyed = measured.select(
        "doc_id", "source", "d1", "d2", "size", (-F.log(uniform) / weight).alias("key"))
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("d1"), F.col("d2")]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    summed = keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn(
        "part", F.spark_partition_id())
    # Stored: range bounds come from a sample, so laying the rows out twice could cut them differently.
    laid_out = stored(summed.mapInArrow(
        _running, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in summed.schema)}, running long"), "mix")
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = laid_out.groupBy("source", "part").agg(F.sum("size").alias("held")).select(
        F.col("source").alias("o_source"), F.col("part").alias("o_part"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    targets = source_targets(laid_out, weights, share, most).withColumnRenamed("source", "t_source")
    placed = (
        laid_out.join(offsets, (F.col("part") == F.col("o_part")) & F.col("source").eqNullSafe(F.col("o_source")))
        .join(targets, F.col("source").eqNullSafe(F.col("t_source")))
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.col("target") - F.col("epochs") * F.col("source_size")
    middle = F.col("before") + F.col("running") - F.col("size") / 2
    return (
        placed.withColumn("epochs", epochs.cast("long"))
        .withColumn("copies", F.col("epochs") + F.when(middle < left, 1).otherwise(0).cast("long"))
        .select("doc_id", "source", "d1", "d2", "size", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, with the columns of ``docs``.

    Rows alike in doc_id, source and text are taken as often as all of them together, as the one of them with the
    least digest over its other columns, so reruns agree.
    """
    plan = mix_sources(docs, **options).groupBy("d1", "d2").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    d1, d2 = digest(docs["doc_id"], docs["source"], docs["text"])
    whole = F.struct(*[docs[c] for c in docs.columns])
    others = [F.col("row").getField(c) for c in docs.columns if c not in ("doc_id", "source", "text")]
    packed = docs.select(d1.alias("d1"), d2.alias("d2"), whole.alias("row"))
    # Rows alike in id, source and text are one entry of the plan, whose copies are already summed.
    return (
        one_of_each(packed, ["d1", "d2"], *others).join(plan, ["d1", "d2"])
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth")).select("row.*")
    )
