"""Readers and writers: text lines, encoded pairs, encoded points, tables."""

from tallyspan.sources.lines import numbered_lines, read_lines, write_lines
from tallyspan.sources.pairs import decode_pairs, encode_pairs
from tallyspan.sources.points import decode_points, dimension_of, encode_points, points_from_table
from tallyspan.sources.tables import spread_over_cores

__all__ = [
    "decode_pairs",
    "decode_points",
    "dimension_of",
    "encode_pairs",
    "encode_points",
    "numbered_lines",
    "points_from_table",
    "read_lines",
    "spread_over_cores",
    "write_lines",
]
