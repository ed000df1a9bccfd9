from tierlake.functions.labels import region_label
from tierlake.functions.pages import page_records, record_count, to_pages

__all__ = ["page_records", "record_count", "region_label", "to_pages"]
