"""Landing raw pages and metadata."""

import json
import logging

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tierlake.functions.pages import record_count
from tierlake.layout import snapshot_path
from tierlake.schemas import BRONZE_PAGE, DATE_COLUMN, META
from tierlake.sinks.layers import write_snapshot
from tierlake.sinks.publish import Folders, publish, staged
from tierlake.sources.bronze import read_pages

log = logging.getLogger(__name__)

# Payloads are large values, and Parquet is decoded in batches of up to 4096 rows that
# never cross a row group. Row groups of few pages bound the memory of a reading task;
# a limit in bytes does not, since it counts bytes after compression.
PAYLOAD_OPTIONS = {"parquet.block.row.count.limit": 256, "compression": "zstd"}


def land_pages(pages, layout, date):
    """Replace the page table's snapshot ``date`` by ``pages``, up to the first empty page.

    ``pages`` has ``page`` and ``payload``. Payloads are stored as they are, with
    their number of records, which is null for an unreadable page.

    The pages are fetched and written once, and the write itself reports the
    first empty page. Only if pages with data came after it (a gap), the write is
    repeated with the pages before it; a paged source fetches no others for that. Returns ``pages``, ``unreadable_pages`` and
    ``rows`` as the write counted them.
    """
    if "n_rows" not in pages.columns:
        pages = pages.withColumn("n_rows", record_count("payload"))
    pages = pages.select(*BRONZE_PAGE.names)
    is_empty = F.coalesce(F.col("n_rows") == 0, F.lit(False))
    while True:
        seen = Observation()
        observed = pages.observe(
            seen,
            F.min(F.when(is_empty, F.col("page"))).alias("first_empty"),
            F.max(F.when(~is_empty, F.col("page"))).alias("last"),
            F.count_if(~is_empty).alias("pages"),
            F.count_if(F.col("n_rows").isNull()).alias("unreadable_pages"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows"),
        )
        write_snapshot(observed.where(~is_empty), layout.bronze, date, **PAYLOAD_OPTIONS)
        stats = dict(seen.get)
        first_empty, last = stats.pop("first_empty"), stats.pop("last")
        if first_empty is None or last is None or last < first_empty:
            log.info("%s: landed %s", date, stats)
            return stats
        pages = pages.where(F.col("page") < first_empty)


def land_dated_pages(pages, layout):
    """Replace the snapshots of all dates in ``pages``, each up to its own first empty page.

    ``pages`` has ``ingestion_date``, ``page`` and ``payload``, as for loading a history again.
    A date whose first page is empty gets a snapshot without rows. Returns the dates.

    The pages are read once, into a staged folder. Dates without an empty page are published
    from there as they are; what comes before an empty page is written again.
    """
    if "n_rows" not in pages.columns:
        pages = pages.withColumn("n_rows", record_count("payload"))
    pages = pages.select(F.col(DATE_COLUMN).cast("string").alias(DATE_COLUMN), *BRONZE_PAGE.names)
    return publish_dates(pages, layout.bronze, until_empty=True, **PAYLOAD_OPTIONS)


def publish_dates(rows, root, until_empty=False, **options):
    """Replace the snapshots of all dates in ``rows``, each as a whole; returns them.

    ``rows`` have ``ingestion_date`` as text. They are read once. With ``until_empty`` a date's
    pages count up to its first empty one.
    """
    spark = rows.sparkSession

    def write(rows, folder):
        rows.hint("rebalance", DATE_COLUMN).write.options(**options).partitionBy(DATE_COLUMN).parquet(folder)
        return spark.read.schema(rows.schema).parquet(folder)

    with staged(spark, root) as first, staged(spark, root) as second:
        stored = write(rows, first)
        end = F.min(F.when(F.col("n_rows") == 0, F.col("page")) if until_empty else F.lit(None).cast("int"))
        # One row per date: a number, whatever the number of pages.
        ends = {row[DATE_COLUMN]: row["end"] for row in stored.groupBy(DATE_COLUMN).agg(end.alias("end")).collect()}
        for date in ends:
            snapshot_path(root, date)  # an error before anything is published
        shorter = [date for date, end in ends.items() if end is not None]
        if shorter:
            last = spark.createDataFrame([(d, ends[d]) for d in shorter], f"{DATE_COLUMN} string, _end int")
            kept = stored.where(F.col(DATE_COLUMN).isin(shorter)).join(F.broadcast(last), DATE_COLUMN)
            write(kept.where("page < _end").drop("_end"), second)
        folders = Folders(spark, root)
        for date in sorted(ends):
            folder = f"{second if date in shorter else first}/{DATE_COLUMN}={date}"
            if folders.exists(folder):
                publish(spark, folder, root, date)
            else:  # nothing is left of it
                write_snapshot(stored.drop(DATE_COLUMN).limit(0), root, date)
    return sorted(ends)


def land_meta(spark, metadata, layout, date):
    """Replace the metadata document of a date; an empty one leaves an empty snapshot."""
    rows = [(json.dumps(metadata, ensure_ascii=False),)] if metadata else []
    write_snapshot(spark.createDataFrame(rows, META), layout.meta, date)


def load_stats(spark, layout, date=None):
    """``(ingestion_date, pages, unreadable_pages, rows)`` per snapshot, from the page counts.

    No payload is read; over many terabytes run its action in ``skimming_scans``.
    """
    return read_pages(spark, layout, date).groupBy(DATE_COLUMN).agg(
        F.count("*").alias("pages"),
        F.count_if(F.col("n_rows").isNull()).alias("unreadable_pages"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows"),
    )
