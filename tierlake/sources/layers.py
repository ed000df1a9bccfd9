"""Reading snapshots of a layer, and finding the newest one."""

import logging
import re

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.layout import as_date, snapshot_path
from tierlake.schemas import DATE_COLUMN, GOLD, SILVER
from tierlake.session import bounded_listings, skimming_scans

log = logging.getLogger(__name__)

ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def load(spark, reader, path):
    """``reader.load(path)``, with a missing path as ``FileNotFoundError``; it lists the files."""
    try:
        with bounded_listings(spark):
            return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE", "DELTA_TABLE_NOT_FOUND"):
            raise FileNotFoundError(f"no snapshot at {path}") from error
        raise


def with_date_text(schema):
    """``schema`` plus the snapshot date as text, as the folders spell it.

    Text, since a single folder with another name would otherwise fail the read.
    """
    return T.StructType([*schema.fields, T.StructField(DATE_COLUMN, T.StringType())])


def dated(df, date=None):
    """Keep the dated snapshots (or just ``date``) and type the date.

    The filters are on a partition column: other folders are not opened. A folder that only
    looks like a date (``2025-13-45``) is none.
    """
    folder = F.col(DATE_COLUMN)
    if date is None:
        wanted = folder.rlike(ISO_DATE) & folder.try_cast("date").isNotNull()
    else:
        wanted = folder == as_date(date).isoformat()
    return df.where(wanted).withColumn(DATE_COLUMN, folder.try_cast("date"))


def read_layer(spark, root, schema, date=None, fmt="parquet"):
    """``schema`` plus ``ingestion_date`` of one snapshot, or of all for ``date=None``.

    With a date only that snapshot's folders are listed. The declared schema
    keeps partition values as text (``01`` stays ``01``). A Delta layer holds one
    table per date and is therefore read by date.
    """
    columns = [*schema.names, DATE_COLUMN]
    if fmt == "delta":
        if date is None:
            raise ValueError("a delta layer is read one date at a time")
        table = load(spark, spark.read.format(fmt), snapshot_path(root, date))
        return table.withColumn(DATE_COLUMN, F.lit(as_date(date))).select(*columns)
    reader = spark.read.format(fmt).schema(with_date_text(schema)).option("basePath", root)
    path = root if date is None else snapshot_path(root, date)
    return dated(load(spark, reader, path), date).select(*columns)


def read_silver(spark, layout, date=None):
    return read_layer(spark, layout.silver, SILVER, date)


def read_gold(spark, layout, date=None, fmt="parquet"):
    return read_layer(spark, layout.gold, GOLD, date, fmt)


def snapshot_dates(spark, root):
    """The dates of a layer's folders, newest first, from one listing of one level."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        raise FileNotFoundError(f"no snapshots at {root}")
    found = set()
    for status in files.listStatus(path):
        name, _, date = status.getPath().getName().partition("=")
        if name == DATE_COLUMN and re.fullmatch(ISO_DATE, date):
            try:
                found.add(as_date(date))
            except ValueError:
                log.warning("%s is no date", date)
    return sorted(found, reverse=True)


def latest_date(spark, root, fmt="parquet"):
    """The newest date whose snapshot holds rows, as text; ``FileNotFoundError`` if there is none.

    The dates are tried from the newest one back, so older snapshots are not even listed.
    """

    def has_rows(date):
        reader = spark.read.format(fmt)
        if fmt != "delta":
            reader = reader.schema(T.StructType([]))
        return not load(spark, reader, snapshot_path(root, date)).isEmpty()

    return _newest(spark, root, has_rows)


def latest_date_frame(spark, root, fmt="parquet"):
    """One row: the newest ``ingestion_date`` that holds rows, null if there is none."""
    try:
        newest = as_date(latest_date(spark, root, fmt))
    except FileNotFoundError:
        newest = None
    return spark.createDataFrame([(newest,)], f"{DATE_COLUMN} date")


def latest_loose_date(spark, root, glob="page=*.json"):
    """Newest date of loose page files that are not empty, from file listings; none is opened."""

    def has_pages(date):
        reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
        files = load(spark, reader, snapshot_path(root, date)).where("length > 0")
        return not files.select("length").isEmpty()

    return _newest(spark, root, has_pages)


def _newest(spark, root, holds):
    with skimming_scans(spark):
        for date in snapshot_dates(spark, root):
            if holds(date):
                return date.isoformat()
    raise FileNotFoundError(f"no {DATE_COLUMN} snapshot with rows in {root}")
