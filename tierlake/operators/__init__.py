from tierlake.operators.clean import cast_doubles, default_location, tidy, trim_strings
from tierlake.operators.dedup import latest_per_key
from tierlake.operators.explore import (
    count_by,
    sample_rows,
    top_countries,
    top_counts,
    top_regions,
    top_states,
)

__all__ = [
    "cast_doubles", "count_by", "default_location", "latest_per_key", "sample_rows", "tidy",
    "top_countries", "top_counts", "top_regions", "top_states", "trim_strings",
]
