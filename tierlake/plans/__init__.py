from tierlake.plans import gold, silver
from tierlake.plans.daily import run, run_collection
from tierlake.plans.profile import file_columns, layer_counts, layer_schemas, record_columns

__all__ = [
    "file_columns", "gold", "layer_counts", "layer_schemas", "record_columns", "run", "run_collection", "silver",
]
