"""JSON pages: one text per page, holding an array of records."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def page_records(payload, schema=T.StructType([])):
    """Array of the records of a page; null where the page is not readable JSON.

    A truncated page is unreadable as a whole. A literal ``null`` between the
    records is not a record, so it never turns into a row of nulls.
    """
    return F.array_compact(F.from_json(payload, T.ArrayType(schema)))


def record_count(payload):
    """Number of records of a page; null where the page is not readable."""
    return F.array_size(page_records(payload))


def to_pages(df, page, columns, order_by, by=()):
    """One row ``(*by, page, payload)`` per group of the column ``page``.

    ``page`` has to be derived from the rows with a bounded number of rows each,
    as in ``id div page_size``, since each page becomes one text.
    """
    row = F.struct(*[F.col(c) for c in order_by], F.struct(*columns).alias("record"))
    in_order = F.transform(F.sort_array(F.collect_list(row)), lambda r: r["record"])
    payload = F.to_json(in_order, {"ignoreNullFields": "false"})
    return df.groupBy(*by, page.cast("int").alias("page")).agg(payload.alias("payload"))
