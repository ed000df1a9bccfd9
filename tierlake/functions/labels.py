from pyspark.sql import functions as F

from tierlake.schemas import LOCATION_COLUMNS, UNKNOWN


def region_label(columns=tuple(LOCATION_COLUMNS), missing=UNKNOWN):
    """``<country> - <state>``, with ``missing`` in place of a null part."""
    return F.concat_ws(" - ", *[F.coalesce(F.col(c), F.lit(missing)) for c in columns])
