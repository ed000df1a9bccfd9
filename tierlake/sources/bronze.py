"""Reading raw pages and the records in them."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.pages import page_records, record_count
from tierlake.layout import snapshot_path
from tierlake.schemas import BRONZE_PAGE, DATE_COLUMN, RAW
from tierlake.session import skimming_scans
from tierlake.sources.layers import load, read_layer
from tierlake.sources.loose import loose_texts

LOOSE_GLOB = "page=*.json"
PAGE_IN_PATH = r"page=(\d+)[^/]*(?:/[^/]*)?$"


def read_pages(spark, layout, date=None, loose=False, glob=LOOSE_GLOB):
    """``(page, payload, n_rows, ingestion_date)`` of one snapshot, or of all.

    ``loose=True`` reads one JSON file per page, as other loaders land them,
    instead of the page table. Files that ``glob`` does not match, such as the
    metadata next to the pages, are left out of the listing. A file may be in UTF-8, UTF-16 or
    UTF-32, with or without a byte order mark; one with bytes that are no text is unreadable,
    and its payload has U+FFFD for them.
    """
    if not loose:
        return read_layer(spark, layout.bronze, BRONZE_PAGE, date)
    pages = _loose_pages(spark, layout, date, glob)
    counted = pages.withColumn("n_rows", F.when(F.col("sound"), record_count("payload")))
    return counted.select(*BRONZE_PAGE.names, DATE_COLUMN)


def read_bronze(
    spark, layout, date=None, schema=RAW, loose=False, glob=LOOSE_GLOB, columns=None
):
    """The records of all readable pages: ``page``, the columns of ``schema``, the date.

    Only ``columns`` are parsed, if given: Spark does not narrow the parsing by itself.
    """
    if columns is not None:
        schema = T.StructType([schema[name] for name in columns])
    if loose:
        pages = _loose_pages(spark, layout, date, glob).where("sound")
    else:
        pages = read_pages(spark, layout, date).where("n_rows > 0")
    return parse(pages, schema)


def parse(pages, schema=RAW):
    """Records of ``pages``; an unreadable page has none."""
    return pages.select("page", F.inline(page_records("payload", schema)), DATE_COLUMN)


def read_quarantine(spark, layout, date=None, loose=False, glob=LOOSE_GLOB):
    """The pages that are not readable JSON: ``(page, payload, ingestion_date)``.

    In the page table they are marked since landing, so nothing is parsed again.
    """
    pages = read_pages(spark, layout, date, loose, glob)
    return pages.where("n_rows IS NULL").select("page", "payload", DATE_COLUMN)


def loose_size(spark, layout, date, glob=LOOSE_GLOB):
    """Number and bytes of a snapshot's loose page files, from the file listing."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    files = load(spark, reader, snapshot_path(layout.bronze, date))
    size = F.coalesce(F.sum("length"), F.lit(0))
    with skimming_scans(spark):
        return files.agg(F.count("*").alias("pages"), size.alias("bytes")).first()


def _loose_pages(spark, layout, date, glob):
    page = F.regexp_extract("path", PAGE_IN_PATH, 1).try_cast("int").alias("page")
    return loose_texts(spark, layout, date, glob).select(page, "payload", "sound", DATE_COLUMN)
