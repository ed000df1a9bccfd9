"""One run over all layers."""

from tierlake.layout import today_utc
from tierlake.plans import gold, silver
from tierlake.session import configure
from tierlake.sinks.bronze import land_meta, land_pages
from tierlake.sinks.resumable import land_collection
from tierlake.sources.meta import fetch_metadata, total_pages
from tierlake.sources.paged import retrying


def run(spark, layout, pages, date=None, metadata=None, fmt="parquet", **options):
    """Land ``pages`` as snapshot ``date`` (today, UTC) and build silver and gold from it.

    Every layer is read back from storage by the next one, so a failed run can be
    taken up at any layer. Returns the date. A failure is an exception. ``options`` go to
    :func:`silver.transform`.
    """
    configure(spark)
    date = date or today_utc()
    stats = land_pages(pages, layout, date)
    return _finish(spark, layout, date, stats, metadata, fmt, options)


def run_collection(spark, layout, fetch, fetch_meta=None, date=None, per_page=200, total_field="total",
                   fmt="parquet", max_retries=3, backoff_sec=20, scan=None, **options):
    """:func:`run` over a paged collection that is landed in waves.

    Called again for the same date after a failure, it fetches only the pages that are not
    landed yet (see :func:`land_collection`). ``scan`` are options of the scan.
    """
    configure(spark)
    date = date or today_utc()
    metadata = {}
    if fetch_meta is not None:
        metadata = fetch_metadata(retrying(fetch_meta, max_retries, backoff_sec))
    known = {"total_pages": total_pages(metadata, per_page, total_field), **(scan or {})}
    stats = land_collection(
        spark, layout, date, fetch, max_retries=max_retries, backoff_sec=backoff_sec, **known)
    return _finish(spark, layout, date, stats, metadata, fmt, options)


def _finish(spark, layout, date, stats, metadata, fmt, options):
    land_meta(spark, metadata, layout, date)
    silver.build(spark, layout, date, stats=stats, **options)
    gold.build(spark, layout, date, fmt)
    return date
