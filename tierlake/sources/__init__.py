from tierlake.sources.bronze import parse, read_bronze, read_pages, read_quarantine
from tierlake.sources.layers import (
    latest_date,
    latest_date_frame,
    latest_loose_date,
    read_gold,
    read_layer,
    read_silver,
)
from tierlake.sources.meta import fetch_metadata, page_count, read_meta, total_pages
from tierlake.sources.paged import (
    json_text,
    open_collection,
    page_ranges,
    paged_source,
    retrying,
    scan_pages,
    stop_at_empty,
    url_fetch,
)

__all__ = [
    "fetch_metadata", "json_text", "latest_date", "latest_date_frame", "latest_loose_date", "open_collection",
    "page_count", "page_ranges", "paged_source", "parse", "read_bronze", "read_gold", "read_layer", "read_meta",
    "read_pages", "read_quarantine", "read_silver", "retrying", "scan_pages", "stop_at_empty",
    "total_pages", "url_fetch",
]
