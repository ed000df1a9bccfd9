"""Loose page files of other loaders, compacted into the page table."""

import logging

from pyspark.sql import functions as F

from tierlake.schemas import BRONZE_PAGE, DATE_COLUMN, META
from tierlake.sinks.bronze import PAYLOAD_OPTIONS, land_meta, publish_dates
from tierlake.sinks.publish import Folders
from tierlake.sources.bronze import LOOSE_GLOB, read_pages
from tierlake.sources.layers import snapshot_dates
from tierlake.sources.meta import read_meta

log = logging.getLogger(__name__)


def import_pages(spark, source, target, dates=None, glob=LOOSE_GLOB, dates_at_once=100, replace=False):
    """Store the loose pages of ``source`` (a layout) as the page table of ``target``.

    One small file per page makes each query list and open all of them; the page table holds
    the same rows ``(page, payload, n_rows)`` in few files, listed once, by this import. All
    pages are taken, unreadable ones too, with their metadata documents.

    ``dates`` are all that ``source`` has, newest first. Those that ``target`` already has are left alone
    unless ``replace`` is true, so an import that ended early goes on where it was. Files
    are listed for ``dates_at_once`` dates at a time, which Spark lists in parallel, and the
    driver holds the file list of no more than these. Each date is published as a whole.
    Returns the dates that were imported; a date without page files is none.
    """
    if source.bronze == target.bronze:
        raise ValueError("the page table needs a folder other than that of the loose files")
    found = [d.isoformat() for d in snapshot_dates(spark, source.bronze)]
    wanted = found if dates is None else [d for d in map(str, dates) if d in set(found)]
    if not replace:
        there = set(Folders(spark, target.bronze).names(target.bronze))
        wanted = [d for d in wanted if f"{DATE_COLUMN}={d}" not in there]
    former = {name.partition("=")[2] for name in Folders(spark, target.meta).names(target.meta)}
    imported = []
    for at in range(0, len(wanted), dates_at_once):
        some = wanted[at:at + dates_at_once]
        pages = read_pages(spark, source, some, loose=True, glob=glob)
        meta = read_meta(spark, source, some, loose=True)
        text = F.col(DATE_COLUMN).cast("string").alias(DATE_COLUMN)
        with_meta = publish_dates(meta.select(text, *META.names), target.meta)
        for date in set(some) & former - set(with_meta):
            land_meta(spark, None, target, date)
        imported += publish_dates(pages.select(text, *BRONZE_PAGE.names), target.bronze, **PAYLOAD_OPTIONS)
        log.info("imported %d of %d dates", len(imported), len(wanted))
    return imported
