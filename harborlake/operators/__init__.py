from harborlake.operators.dedupe import dedupe, dedupe_by_digest
from harborlake.operators.filters import lines_matching, recent, recent_by_difference
from harborlake.operators.joins import (
    conform_join,
    known_keys_only,
    lookup_join,
    unmatched,
    unmatched_counts,
)
from harborlake.operators.labels import label_pairs
from harborlake.operators.pivot import pivot_max, pivot_max_map, pivot_values
from harborlake.operators.positions import numbered, side_by_side

__all__ = [
    "conform_join",
    "dedupe",
    "dedupe_by_digest",
    "known_keys_only",
    "label_pairs",
    "lines_matching",
    "lookup_join",
    "numbered",
    "pivot_max",
    "pivot_max_map",
    "pivot_values",
    "recent",
    "recent_by_difference",
    "side_by_side",
    "unmatched",
    "unmatched_counts",
]
