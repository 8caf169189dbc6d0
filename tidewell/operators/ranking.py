"""Exact ranks and tiles over groups of any size.

``Window.orderBy`` without (or with a coarse) PARTITION BY pulls a whole group
through one task. Here the rows are range-partitioned on the full sort order
instead, each row gets its place inside its partition, and the row counts of the
earlier partitions give the offset. A group, or one repeated value, may span any
number of tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import pin, shuffle_partitions

# monotonically_increasing_id() holds the partition in the upper bits and the
# row's place in that partition in the lower 33.
_PLACE_BITS = 33


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add the 1-based place of each row in the total order (which must be unique).

    The layout is stored before it is counted: range bounds come from a sample,
    so laying the rows out twice could cut them differently.
    """
    partitions = shuffle_partitions(df.sparkSession)
    laid_out = pin(
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _PLACE_BITS).alias("_part")
    # One row per range partition, so this window and broadcast are bounded by their number.
    offsets = (
        laid_out.groupBy(part).agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)))
        .select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    return (
        laid_out.withColumn("_part", F.shiftright("_at", _PLACE_BITS))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + place + 1)
        .drop("_at", "_part", "_before")
    )


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def rank_within(df: DataFrame, groups: Sequence[str], best: str, unique: Sequence[str], name: str) -> DataFrame:
    """RANK() OVER (PARTITION BY groups ORDER BY best DESC), exact, ties sharing a rank.

    ``unique`` completes the order to a unique one. The rank of a value is the
    first position it occurs at, counted from the first position of its group;
    both are map-side-combined minima.
    """
    order = [F.col(g).asc_nulls_first() for g in groups]
    order += [F.col(best).desc_nulls_last(), *[F.col(u).asc_nulls_first() for u in unique]]
    placed = with_position(df, order, "_position")
    renamed = {g: f"_{g}" for g in groups}
    keys = [F.col(g).alias(renamed[g]) for g in groups]
    # One row per group; and one per value that ties, usually few: any other row is the first of its value itself.
    starts = placed.groupBy(*keys).agg(F.min("_position").alias("_start"))
    ties = placed.groupBy(*keys, F.col(best).alias("_value")).agg(
        F.min("_position").alias("_first"), F.count("*").alias("_rows")).filter("_rows > 1").drop("_rows")
    ties = ties.withColumnsRenamed({r: f"_{r}" for r in renamed.values()})
    tied = _null_safe(placed, ties, [*[(g, f"_{r}") for g, r in renamed.items()], (best, "_value")])
    ranked = placed.join(ties, tied, "left")
    ranked = ranked.join(starts, _null_safe(ranked, starts, list(renamed.items())))
    rank = F.coalesce("_first", "_position") - F.col("_start") + 1
    return ranked.select(*[placed[name] for name in df.columns], rank.cast("int").alias(name))


def _exact(kind: T.DataType) -> bool:
    """Whether a number of this type fits DECIMAL(38,6) as it is."""
    if isinstance(kind, T.DecimalType):
        return kind.scale <= 6 and kind.precision - kind.scale <= 32
    return isinstance(kind, T.IntegralType)


def tiles(df: DataFrame, key: str, measures: Mapping[str, Column], n: int) -> DataFrame:
    """NTILE(n) OVER (ORDER BY measure, key) for several measures at once.

    ``measures`` maps the new column to a numeric expression, ascending (negate
    it for a descending order). Only the n-1 rows that end a tile are looked up
    in the sorted order; every row is then placed by comparing with those, so
    nothing is joined back row by row.
    """
    base = pin(df)
    kinds = base.select(*[expr.alias(name) for name, expr in measures.items()]).schema
    # Measures of one comparable form share a layout; doubles, say, keep a layout of their own type.
    forms: dict[str, dict[str, Column]] = {}
    for field in kinds:
        form = "decimal(38,6)" if _exact(field.dataType) else field.dataType.simpleString()
        forms.setdefault(form, {})[field.name] = measures[field.name].cast(form)
    result = base
    for number, same in enumerate(forms.values()):
        result = _tiled(result, base, key, same, n, f"_cuts{number}_")
    return result.select(*df.columns, *measures)


def _tiled(result: DataFrame, base: DataFrame, key: str, measures: Mapping[str, Column], n: int,
           prefix: str) -> DataFrame:
    """Add the tiles of measures that have one type."""
    entries = F.array(*[
        F.struct(F.lit(i).alias("_measure"), expr.alias("_value")) for i, expr in enumerate(measures.values())
    ])
    long = base.select(F.explode(entries).alias("_entry"), F.col(key).alias("_key")).select("_entry.*", "_key")
    # All measures hold the same rows, so measure i occupies positions i*rows+1 … (i+1)*rows.
    placed = with_position(
        long.withColumn("_null", F.col("_value").isNull()),
        [F.col("_measure"), F.col("_null"), F.col("_value"), F.col("_key")],
    )
    rows = base.agg(F.count("*").alias("_rows"))
    place = F.col("position") - F.col("_measure") * F.col("_rows")
    size, extra = F.expr(f"_rows div {n}"), F.col("_rows") % n
    ends = F.array(*[j * size + F.least(F.lit(j), extra) for j in range(1, n)])
    cuts = (
        placed.crossJoin(F.broadcast(rows))
        .filter(F.array_contains(ends, place))
        # When there are fewer rows than tiles, one row may end several of them.
        .withColumn("_ends", F.size(F.filter(ends, lambda e: e == place)))
        .agg(*[
            F.collect_list(F.when(
                F.col("_measure") == i,
                F.struct("_null", "_value", "_key", "_ends"),
            )).alias(f"{prefix}{i}")
            for i in range(len(measures))
        ])
    )
    result = result.crossJoin(F.broadcast(cuts))
    for i, (name, value) in enumerate(measures.items()):
        mine = F.struct(value.isNull().alias("_null"), value.alias("_value"), F.col(key).alias("_key"))
        passed = F.aggregate(
            f"{prefix}{i}", F.lit(0),
            lambda total, cut: total + F.when(
                F.struct(cut["_null"].alias("_null"), cut["_value"].alias("_value"), cut["_key"].alias("_key")) < mine,
                cut["_ends"],
            ).otherwise(0),
        )
        result = result.withColumn(name, passed + 1)
    return result
