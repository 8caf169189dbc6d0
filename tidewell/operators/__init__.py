from tidewell.operators.baskets import PairQuery, strongest_pairs
from tidewell.operators.dedup import one_row_per_key, whole_rows
from tidewell.operators.ranking import rank_within, tiles

__all__ = ["PairQuery", "one_row_per_key", "rank_within", "strongest_pairs", "tiles", "whole_rows"]
