"""Pair counting against the literal self-join."""

import itertools
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.operators.baskets import PairQuery, count_pairs, in_blocks, strongest_pairs

SCHEMA = "basket bigint, item bigint, node bigint, lines bigint"


def literal(rows):
    counts = Counter()
    for one, two in itertools.permutations(rows, 2):
        if one[0] == two[0] and one[1] < two[1]:
            counts[one[2], two[2]] += one[3] * two[3]
    return dict(counts)


def counted(df):
    return {(r.node_a, r.node_b): r.pairs for r in df.collect()}


def rows_of(lines, node_of=lambda item: item):
    return [(basket, item, node_of(item), n) for (basket, item), n in sorted(Counter(lines).items())]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 7)), min_size=2, max_size=60),
       st.sampled_from([1, 2, 3, 1000]))
def test_blocks_do_not_change_the_counts(spark, lines, large):
    rows = rows_of(lines, lambda item: item % 3)
    assert counted(count_pairs(in_blocks(spark.createDataFrame(rows, SCHEMA), large))) == literal(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 40).map(lambda x: min(x, 9))), min_size=2, max_size=80),
       st.integers(1, 3), st.sampled_from([1, 5]), st.sampled_from([2, 3, 1000]), st.sampled_from([3, 100]))
def test_strongest_pairs_hold_the_best_k(spark, lines, min_count, k, large, nodes):
    rows = rows_of(lines, lambda item: item % nodes)
    got = counted(strongest_pairs(spark.createDataFrame(rows, SCHEMA), PairQuery(min_count, k), large))
    want = {pair: n for pair, n in literal(rows).items() if n >= min_count}
    assert got.items() <= want.items()
    best = sorted(want.values(), reverse=True)
    if best:
        kth = best[min(k, len(best)) - 1]
        assert {p for p, n in want.items() if n >= kth} <= set(got)


def test_one_basket_with_a_third_of_all_lines(spark):
    """A basket of 600 items among small ones: all its pairs count, no join key gets large."""
    hot = [(0, item) for item in range(600)]
    small = [(1 + item % 200, item * 7 % 600) for item in range(1200)]
    rows = rows_of(hot + small)
    df = spark.createDataFrame(rows, SCHEMA)
    assert counted(count_pairs(in_blocks(df, 50))) == literal(rows)
    got = counted(strongest_pairs(df, PairQuery(1, 10), 50))
    want = literal(rows)
    tenth = sorted(want.values(), reverse=True)[9]
    assert {p: n for p, n in got.items() if n >= tenth} == {p: n for p, n in want.items() if n >= tenth}


def test_pruning_leaves_rare_items_of_a_hot_basket_out(spark):
    """Items seen only in the hot basket cannot reach the best count and form no pairs."""
    hot = [(0, item) for item in range(100, 400)]
    popular = [(basket, item) for basket in range(1, 60) for item in range(12)]
    df = spark.createDataFrame(rows_of(hot + popular), SCHEMA)
    got = strongest_pairs(df, PairQuery(1, 50))
    assert got.agg(F.min("pairs"), F.max("node_b")).first()[:] == (59, 11)


def test_large_baskets_lift_pairs_known_from_small_ones(spark):
    """Two large baskets add to the pairs of small ones, and one pair lives in large baskets only."""
    small = [(basket, item) for basket in range(10, 40) for item in range(8)]
    large = [(basket, item) for basket in (1, 2) for item in range(1, 60)]
    alone = [(basket, item) for basket in (1, 2) for item in (70, 71) for _ in range(5)]
    rows = rows_of(small + large + alone)
    want = literal(rows)
    assert want[1, 2] == 32 and want[0, 1] == 30 and want[70, 71] == 50
    for k in (1, 5, 22, 25):
        got = counted(strongest_pairs(spark.createDataFrame(rows, SCHEMA), PairQuery(1, k), 20))
        kth = sorted(want.values(), reverse=True)[k - 1]
        assert {p: n for p, n in got.items() if n >= kth} == {p: n for p, n in want.items() if n >= kth}


@pytest.mark.parametrize("rows", [[], [(1, 1, 1, 5)]])
def test_no_pairs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert counted(count_pairs(in_blocks(df))) == {} == counted(strongest_pairs(df, PairQuery(1, 5)))


def test_descriptions_count_by_description(spark):
    """One key with two descriptions counts for both, and text is what is counted, not keys."""
    from tidewell.plans import business
    sales = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2)], "ss_ticket_number bigint, ss_item_sk bigint")
    items = spark.createDataFrame([(1, "A"), (1, "B"), (2, "C"), (3, None)], "i_item_sk bigint, i_item_desc string")
    found = business.product_affinity({"silver_store_sales": sales, "silver_item": items}, more_than=0, k=5).collect()
    assert sorted((r.item_a_desc, r.item_b_desc, r.co_occurrence_count) for r in found) == [("A", "C", 2), ("B", "C", 2)]


def test_a_basket_above_a_block_takes_the_same_plan(spark):
    rows = rows_of([(basket, item) for basket in range(3) for item in range(450)])
    got = counted(strongest_pairs(spark.createDataFrame(rows, SCHEMA), PairQuery(3, 10)))
    assert got == literal(rows)
