"""The strongest pairs of things that occur in the same basket, exactly and at any basket size.

The textbook plan joins the sale lines with themselves on the ticket. Its output
is quadratic in the basket, and one huge basket lands in one task. Here

* repeated lines are folded first: one row per basket and item with its line
  count; a pair then counts the product of the two line counts;
* items that cannot reach the k-th best count are dropped before any pair is
  formed. With ``lines(t, x)`` the lines of node x in basket t, a pair (x, y)
  counts at most ``reach(x) = sum over t of lines(t, x) * (largest line count of
  a node in t)``, and the pairs among the few nodes of largest reach give a
  count, the floor, that k pairs do attain;
* pairs are formed in blocks of items: a basket of b blocks is dealt to one cell
  per pair of blocks, so no join key holds more than two blocks of rows. A small
  basket is the case b = 1 of the same plan.

The result is the one of the plain self-join; nothing is capped or sampled.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import pin

# Items of a block.
BLOCK = 200


class PairQuery(NamedTuple):
    """Which pairs are wanted: at least ``min_count`` occurrences, the best ``k``."""

    min_count: int
    k: int


def in_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Attach each row's block and the largest line count of a node in its basket.

    One-item baskets form no pair and fall out.
    """
    nodes = rows.groupBy("basket", "node").agg(F.sum("lines").alias("_lines"), F.count("*").alias("_rows"))
    baskets = nodes.groupBy(F.col("basket").alias("_basket")).agg(
        F.sum("_rows").alias("_items"), F.max("_lines").alias("_most")).filter(F.col("_items") > 1)
    blocks = F.ceil(F.col("_items") / block).cast("int")
    return rows.join(baskets, F.col("basket") == F.col("_basket")).select(
        "basket", "item", "node", "lines", "_most", blocks.alias("_blocks"),
        F.pmod(F.xxhash64("item"), blocks).cast("int").alias("_block"),
    )


def _side(rows: DataFrame, name: str, **extra: Column) -> DataFrame:
    return rows.select(
        *[F.col(column).alias(f"{name}_{column}") for column in ("basket", "item", "node", "lines")],
        *[column.alias(f"{name}_{label}") for label, column in extra.items()],
    )


def count_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (node_a, node_b) with item_a < item_b among rows that went through ``in_blocks``."""
    block, last = F.col("_block"), F.col("_blocks") - 1
    one = _side(rows, "l", row=block, column=F.explode(F.sequence(block, last)))
    other = _side(rows, "r", row=F.explode(F.sequence(F.lit(0), block)), column=block)
    same_cell = (
        (F.col("l_basket") == F.col("r_basket"))
        & (F.col("l_row") == F.col("r_row")) & (F.col("l_column") == F.col("r_column"))
    )
    in_order = F.col("l_item") < F.col("r_item")
    # On the diagonal both sides hold the same block and each pair must be taken once.
    once = (F.col("l_row") < F.col("l_column")) | in_order
    return one.join(other, same_cell & once).groupBy(
        F.when(in_order, F.col("l_node")).otherwise(F.col("r_node")).alias("node_a"),
        F.when(in_order, F.col("r_node")).otherwise(F.col("l_node")).alias("node_b"),
    ).agg(F.sum(F.col("l_lines") * F.col("r_lines")).alias("pairs"))


def _reach(rows: DataFrame) -> DataFrame:
    return rows.groupBy("node").agg(F.sum(F.col("lines").cast("decimal(19,0)") * F.col("_most")).alias("reach"))


def _only(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    return rows.join(nodes.select(F.col("node").alias("_node")), F.col("node") == F.col("_node"), "left_semi")


def strongest_pairs(rows: DataFrame, wanted: PairQuery, block: int = BLOCK) -> DataFrame:
    """Every pair that may be among the best ``k`` of those reaching ``min_count``, with its exact count.

    ``rows`` has basket, item, node (what is counted) and lines. The caller
    orders and limits; pairs tied with the k-th are all included.
    """
    blocked = pin(in_blocks(rows, block))
    reach = _reach(blocked)
    # About 2k pairs among the leaders: a fixed number of nodes, whatever the data.
    leaders = reach.orderBy(F.col("reach").desc(), "node").limit(2 * math.isqrt(wanted.k) + 2)
    leading = count_pairs(_only(blocked, leaders)).orderBy(F.col("pairs").desc()).limit(wanted.k)
    # One row: the k-th best count among the leaders' pairs, if there are k.
    floor = leading.agg(F.greatest(
        F.lit(wanted.min_count), F.when(F.count("*") == wanted.k, F.min("pairs"))).alias("_floor"))
    able = reach.crossJoin(floor).filter(F.col("reach") >= F.col("_floor"))
    return count_pairs(_only(blocked, able)).crossJoin(floor).filter(F.col("pairs") >= F.col("_floor")).drop("_floor")
