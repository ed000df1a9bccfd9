"""Bronze records to the clean table."""

from pyspark.sql import types as T

from tierlake.operators.clean import cast_doubles, default_location, tidy, trim_strings
from tierlake.operators.dedup import latest_per_key
from tierlake.schemas import KEY_COLUMN, NAME_COLUMN, RAW, SILVER_COLUMNS, VERSION_COLUMN
from tierlake.session import shuffles_sized_for, skimming_scans
from tierlake.sinks.bronze import load_stats
from tierlake.sinks.layers import write_silver
from tierlake.sources.bronze import loose_size, read_bronze

LOOSE_RECORD_BYTES = 300
NEEDED = [*SILVER_COLUMNS, VERSION_COLUMN]


def transform(raw, blank_is_null=True, null_key="collapse", version_type=None):
    """Trim, cast, default and de-duplicate raw records.

    ``version_type`` is the type of the version column, such as ``bigint``, ``double`` or
    ``timestamp``, by which the newest version is told; by default it goes by its text.
    Columns that silver does not keep are dropped first, so they are not shuffled.
    """
    order = [c for c in [VERSION_COLUMN] if c in raw.columns] + [NAME_COLUMN]
    df = tidy(raw, NEEDED)
    df = default_location(cast_doubles(trim_strings(df)), blank_is_null=blank_is_null)
    types = {VERSION_COLUMN: version_type} if version_type and VERSION_COLUMN in raw.columns else {}
    return tidy(latest_per_key(df, KEY_COLUMN, order, null_key, types), SILVER_COLUMNS)


def build(spark, layout, date, loose=False, stats=None, **options):
    """Rebuild the silver snapshot of ``date``; ``options`` go to :func:`transform`.

    ``stats`` are those that landing the pages returned, else they are looked up.
    """
    if stats is None:
        stats = loose_stats(spark, layout, date) if loose else landed_stats(spark, layout, date)
    if not stats["pages"]:
        raise FileNotFoundError(f"no bronze pages for {date} in {layout.bronze}")
    needed = T.StructType([field for field in RAW if field.name in NEEDED])
    raw = read_bronze(spark, layout, date, needed, loose)
    with shuffles_sized_for(spark, stats["rows"]):
        write_silver(transform(raw, **options), layout, date)


def landed_stats(spark, layout, date):
    with skimming_scans(spark):
        return load_stats(spark, layout, date).first() or {"pages": 0}


def loose_stats(spark, layout, date):
    """The rows are estimated from the size: they only decide on the shuffle width."""
    size = loose_size(spark, layout, date)
    return {"pages": size["pages"], "rows": size["bytes"] // LOOSE_RECORD_BYTES}
