"""DataFrame operators. All take column names and return lazy DataFrames."""

from .backlog import only_pending, pending
from .days import calendar_gaps, frontier, select_days, select_rows
from .dedup import latest_version
from .merge import (
    AmbiguousMergeError,
    ambiguous_matches,
    merge_into_table,
    upsert,
)
from .nested import explode_children, flatten_leaderboards, flatten_maps
from .stats import entity_stats, side_counts

__all__ = [
    "AmbiguousMergeError",
    "ambiguous_matches",
    "calendar_gaps",
    "entity_stats",
    "explode_children",
    "flatten_leaderboards",
    "flatten_maps",
    "frontier",
    "latest_version",
    "merge_into_table",
    "only_pending",
    "pending",
    "select_days",
    "select_rows",
    "side_counts",
    "upsert",
]
