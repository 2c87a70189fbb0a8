"""crease: ball-by-ball cricket analytics on PySpark.

Nested match documents are flattened into a match table and a one-row-per-
delivery fact table, team / batting / bowling / season / venue statistics are
aggregated from them, ranked reports sit on top, and a feed of live match
snapshots is folded into a current-state table with the same DataFrame code in
batch and Structured Streaming.

Everything is DataFrame / SQL with built-in functions: no Python UDFs, no
custom optimizer rules, no driver-side loops over data.
"""

from crease.operators.careers import career_batting, compare_batters
from crease.operators.flatten import balls_by_ball, flatten_match_documents, matches_table
from crease.operators.live import cache_entries, current_state, live_rows, snapshot_rows, validate_snapshots
from crease.operators.stats import (
    player_batting_stats,
    player_bowling_stats,
    production_stats,
    season_trends,
    team_stats,
    venue_stats,
)
from crease.plans.incremental import load_new, read_statistics
from crease.plans.pipeline import display_insights, run_pipeline
from crease.sources.commits import read_set, save_set
from crease.sources.documents import read_match_documents, separate_repeats, split_corrupt
from crease.sources.drift import drift_table, read_variants

__all__ = [
    "balls_by_ball",
    "cache_entries",
    "career_batting",
    "compare_batters",
    "current_state",
    "display_insights",
    "drift_table",
    "flatten_match_documents",
    "live_rows",
    "load_new",
    "matches_table",
    "player_batting_stats",
    "player_bowling_stats",
    "production_stats",
    "read_match_documents",
    "read_set",
    "read_statistics",
    "read_variants",
    "run_pipeline",
    "save_set",
    "season_trends",
    "separate_repeats",
    "snapshot_rows",
    "split_corrupt",
    "team_stats",
    "validate_snapshots",
    "venue_stats",
]
