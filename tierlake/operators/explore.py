"""Counts, top-k reports and samples over the layers."""

from pyspark.sql import functions as F

from tierlake.functions.labels import region_label
from tierlake.schemas import COUNT_COLUMN, LOCATION_COLUMNS, TYPE_COLUMN


def count_by(df, *keys, name="count"):
    """Rows per combination of ``keys``; null is a group of its own."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def top_counts(counts, k, keys, name="count"):
    """The ``k`` largest counts; equal counts in the order of their keys."""
    return counts.orderBy(F.desc(name), *[F.asc_nulls_first(c) for c in keys]).limit(k)


def top_countries(silver, k=10):
    return top_counts(count_by(silver, "country"), k, ["country"])


def top_states(silver, country, k=10):
    """The ``k`` states of ``country`` with most rows (case-sensitive match)."""
    return top_counts(
        count_by(silver.where(F.col("country") == country), "state"), k, ["state"]
    )


def top_regions(gold, k=15):
    """The ``k`` largest gold rows with their label; a label can repeat, one per type."""
    top = top_counts(gold, k, [*LOCATION_COLUMNS, TYPE_COLUMN], COUNT_COLUMN)
    return top.withColumn("label", region_label())


def sample_rows(df, n=5):
    """Any ``n`` rows, for display."""
    return df.limit(n)
