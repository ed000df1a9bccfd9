from tierlake.sinks.bronze import land_dated_pages, land_meta, land_pages, load_stats
from tierlake.sinks.imports import import_pages
from tierlake.sinks.layers import write_gold, write_silver, write_snapshot
from tierlake.sinks.publish import discard_staged, publish, recover, staged
from tierlake.sinks.resumable import land_collection, read_ledger

__all__ = [
    "discard_staged", "import_pages", "land_collection", "land_dated_pages", "land_meta", "land_pages", "load_stats", "publish", "read_ledger",
    "recover", "staged", "write_gold", "write_silver", "write_snapshot",
]
