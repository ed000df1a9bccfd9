"""The clean table to counts per location and type."""

from tierlake.operators.explore import count_by
from tierlake.schemas import COUNT_COLUMN, LOCATION_COLUMNS, TYPE_COLUMN
from tierlake.sinks.layers import write_gold
from tierlake.sources.layers import read_silver


def aggregate(silver):
    return count_by(silver, *LOCATION_COLUMNS, TYPE_COLUMN, name=COUNT_COLUMN)


def build(spark, layout, date, fmt="parquet"):
    """Rebuild the gold snapshot of ``date`` from its silver snapshot."""
    write_gold(aggregate(read_silver(spark, layout, date)), layout, date, fmt)
