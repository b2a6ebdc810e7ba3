"""Keyed counting and point geometry on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from tallyspan.functions.keys import SEED, partition_key, random_order
from tallyspan.functions.text import split_tokens
from tallyspan.functions.vectors import distance, squared_distance
from tallyspan.operators.blocks import farthest_pairs, pairwise_distance_sum
from tallyspan.operators.centers import k_center, min_distance
from tallyspan.operators.classes import (
    class_count,
    count_per_part,
    group_values,
    max_partition_size,
    most_frequent,
    partition_sizes,
    with_partition_key,
    with_physical_part,
)
from tallyspan.operators.coresets import coreset, coreset_tree, with_parts
from tallyspan.operators.diameter import exact_mpd, k_center_mpd, two_approx_mpd
from tallyspan.operators.distances import point_distances
from tallyspan.operators.matching import (
    avg_pairwise_distance,
    greedy_matching,
    remaining_candidates,
)
from tallyspan.operators.sampling import dense_positions, sample_points
from tallyspan.operators.words import (
    avg_word_length,
    distinct_words,
    doc_token_counts,
    row_counts,
    tokens,
    word_count,
)
from tallyspan.plans.counting import class_summary, word_summary
from tallyspan.plans.diversity import diversity_max, diversity_report, mpd_compare
from tallyspan.sources import (
    decode_pairs,
    decode_points,
    encode_pairs,
    encode_points,
    numbered_lines,
    points_from_table,
    read_lines,
    spread_over_cores,
    write_lines,
)

# Task functions travel with their jobs: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("sys", "cloudpickle")]
