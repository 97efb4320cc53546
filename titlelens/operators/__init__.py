"""DataFrame-level building blocks shared by the questions."""

from titlelens.operators.asof import asof_join
from titlelens.operators.band import band_join
from titlelens.operators.multisets import compare_by_key, multiset_counts
from titlelens.operators.ranks import global_ranks
from titlelens.operators.sketches import merge_sketches, quantile_sketches, rank_error, sketch_quantiles
from titlelens.operators.summaries import subtotals, to_wide, trailing_sums
from titlelens.operators.topk import top_n, top_per_group
from titlelens.operators.trend import lag_change
from titlelens.operators.lookup import lookup_bounded

__all__ = ["asof_join", "band_join", "compare_by_key", "global_ranks", "merge_sketches", "multiset_counts", "quantile_sketches", "rank_error", "sketch_quantiles", "subtotals", "to_wide", "trailing_sums", "top_n", "top_per_group", "lag_change", "lookup_bounded"]
