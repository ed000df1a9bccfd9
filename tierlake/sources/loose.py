"""Loose files of a dated snapshot, read whole."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.charsets import with_text
from tierlake.layout import snapshot_path
from tierlake.schemas import DATE_COLUMN
from tierlake.sources.layers import dated, load, with_date_text

# The columns of Spark's binary file source.
FILE = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])


def loose_texts(spark, layout, date, glob):
    """``(path, payload, sound, ingestion_date)`` of the files that ``glob`` matches.

    ``date`` is one snapshot, several as a list, or None for all. Empty files are left out.
    ``sound`` is false where bytes are no text (see :func:`with_text`).
    """
    reader = (
        spark.read.format("binaryFile")
        .schema(with_date_text(FILE))
        .option("pathGlobFilter", glob)
        .option("basePath", layout.bronze)
    )
    if date is None or isinstance(date, (list, tuple)):
        paths = layout.bronze if date is None else [snapshot_path(layout.bronze, d) for d in date]
        files = dated(load(spark, reader, paths))
    else:
        files = dated(load(spark, reader, snapshot_path(layout.bronze, date)), date)
    texts = with_text(files.where("length > 0").select("path", "content", DATE_COLUMN))
    return texts.select("path", "payload", "sound", DATE_COLUMN)
