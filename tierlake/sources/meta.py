"""Metadata of a paged collection: how many rows, hence how many pages."""

import json
import logging
import math

from pyspark.sql import functions as F

from tierlake.schemas import DATE_COLUMN, META
from tierlake.sources.layers import read_layer
from tierlake.sources.loose import loose_texts

log = logging.getLogger(__name__)


def fetch_metadata(fetch):
    """``fetch()`` as a dict; ``{}`` if it fails or is none, since a run can do without it."""
    try:
        body = fetch()
        found = json.loads(body) if isinstance(body, (str, bytes)) else body
    except Exception as error:
        log.warning("no metadata: %s", error)
        return {}
    if not isinstance(found, dict):
        log.warning("metadata is no object: %.80r", found)
        return {}
    return found


def total_pages(metadata, per_page, total_field="total"):
    """Number of pages by a metadata dict, or ``None`` if it does not tell."""
    total = metadata.get(total_field)
    if total is None:
        return None
    try:
        return max(0, math.ceil(int(total) / per_page))
    except (TypeError, ValueError, OverflowError):
        log.warning("metadata has no usable %s: %.80r", total_field, total)
        return None


def read_meta(spark, layout, date=None, loose=False):
    """``(payload, ingestion_date)``, from the metadata table or ``meta.json`` files."""
    if not loose:
        return read_layer(spark, layout.meta, META, date)
    return loose_texts(spark, layout, date, "meta.json").select("payload", DATE_COLUMN)


def page_count(meta, per_page, total_field="total"):
    """``(ingestion_date, total_rows, pages)`` per landed metadata document."""
    total = F.get_json_object("payload", f"$.{total_field}").try_cast("bigint")
    return meta.select(DATE_COLUMN, total.alias("total_rows")).withColumn(
        "pages", F.ceil(F.col("total_rows") / F.lit(per_page))
    )
