"""Landing a paged collection in waves, so that a run that ends early loses little of it."""

import json
import logging
import uuid

from pyspark.sql import functions as F

from tierlake.layout import as_date
from tierlake.schemas import BRONZE_PAGE
from tierlake.sinks.bronze import PAYLOAD_OPTIONS, land_pages
from tierlake.sinks.publish import Folders
from tierlake.sources.paged import page_ranges, scan_pages

log = logging.getLogger(__name__)

LEDGER = "wave string, first int, last int, first_empty int"


def progress_folder(layout, date):
    """Where the pages of an unfinished landing lie; readers of the layer do not see it."""
    return f"{layout.bronze}/_landing-{as_date(date).isoformat()}"


def read_ledger(spark, layout, date):
    """``(wave, first, last, first_empty)``: the page ranges of a date that have been fetched."""
    folder = f"{progress_folder(layout, date)}/ledger"
    if not Folders(spark, layout.bronze).exists(folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(folder)


def uncovered(planned, covered):
    """The parts of the ``planned`` ranges that no ``covered`` range has; both ``(first, last)``."""
    left, covered = [], sorted(r for r in covered if r[0] <= r[1])
    for first, last in planned:
        for begin, end in covered:
            if end < first or begin > last:
                continue
            if begin > first:
                left.append((first, begin - 1))
            first = max(first, end + 1)
        if first <= last:
            left.append((first, last))
    return left


def land_collection(spark, layout, date, fetch, ranges_at_once=None, restart=False,
                    max_retries=3, backoff_sec=20, **options):
    """Land all pages of a collection as snapshot ``date``; returns what :func:`land_pages` does.

    Like ``land_pages(scan_pages(...))``, but in waves of ``ranges_at_once`` page ranges (4 for
    each core, or one with ``max_rate``). A wave is stored, then entered in a ledger beside the snapshots;
    a wave that failed leaves no entry. The next call for the date plans the ranges again,
    takes off those of the ledger, and fetches only the rest; pages are then as they were
    when first fetched. ``restart=True`` begins anew. The snapshot is published when the last
    wave is in, and the ledger deleted. ``options`` are those of the scan.

    The ledger has a row per range, at most ``max_tasks`` for a whole run.
    """
    files, folder = Folders(spark, layout.bronze), progress_folder(layout, date)
    if restart:
        files.delete(folder)
    done = [tuple(row) for row in read_ledger(spark, layout, date).collect()]
    for name in set(files.names(folder)) - {"ledger"} - {wave for wave, *_ in done}:
        files.delete(f"{folder}/{name}")  # not entered: a run ended before
    covered = [(first, last if empty is None else empty - 1) for _, first, last, empty in done]
    planned = page_ranges(spark, fetch, max_retries, backoff_sec, **options)
    left = uncovered(planned, covered)
    if done:
        log.info("%s: %d page ranges landed before, %d to go", date, len(done), len(left))
    if ranges_at_once is None:
        ranges_at_once = (1 if "max_rate" in options else 4) * spark.sparkContext.defaultParallelism
    for at in range(0, len(left), ranges_at_once):
        ranges = left[at:at + ranges_at_once]
        entries = _land_wave(spark, f"{folder}/wave-{uuid.uuid4().hex}", fetch, ranges, max_retries, backoff_sec, options)
        spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("append").parquet(f"{folder}/ledger")
        done += entries
        if any(first_empty is not None for *_, first_empty in entries):
            break  # what comes later is behind the end
    stats = land_pages(_landed(spark, folder, done, max([last for _, last in planned], default=0)), layout, date)
    files.delete(folder)
    return stats


def _land_wave(spark, folder, fetch, ranges, max_retries, backoff_sec, options):
    """Store the pages of some ranges; their entries for the ledger."""
    pages = scan_pages(
        spark, fetch, max_retries=max_retries, backoff_sec=backoff_sec, ranges=json.dumps(ranges), **options)
    pages.write.options(**PAYLOAD_OPTIONS).parquet(folder)
    # A range ends at its first empty page, so there are no more of them than ranges.
    empty = [row["page"] for row in spark.read.schema(BRONZE_PAGE).parquet(folder).where("n_rows = 0").select("page").collect()]
    wave = folder.rpartition("/")[2]
    return [(wave, first, last, min((e for e in empty if first <= e <= last), default=None)) for first, last in ranges]


def _landed(spark, folder, ledger, last):
    """The pages with rows of all waves, up to the end of the collection.

    An empty page may have rows by now, if it was asked for again: then it is no end.
    """
    if not ledger:
        return spark.createDataFrame([], BRONZE_PAGE)
    waves = sorted({wave for wave, *_ in ledger})
    pages = spark.read.schema(BRONZE_PAGE).parquet(*[f"{folder}/{wave}" for wave in waves])
    pages = pages.where("n_rows IS NULL OR n_rows > 0")
    empty = {first_empty for *_, first_empty in ledger if first_empty is not None}
    filled = {row["page"] for row in pages.where(F.col("page").isin(sorted(empty))).select("page").collect()}
    end = min([*(empty - filled), last + 1])
    return pages.where(F.col("page") < end)
