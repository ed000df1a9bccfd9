"""Row-wise cleaning. Each step is one projection, so Spark folds them together."""

from pyspark.sql import functions as F

from tierlake.schemas import COORDINATE_COLUMNS, LOCATION_COLUMNS, TEXT_COLUMNS, UNKNOWN


def trim_strings(df, columns=tuple(TEXT_COLUMNS)):
    """Cast to text and strip spaces, for those of ``columns`` that ``df`` has."""
    return df.withColumns(
        {c: F.trim(F.col(c).cast("string")) for c in columns if c in df.columns}
    )


def cast_doubles(df, columns=tuple(COORDINATE_COLUMNS)):
    """Cast to double; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def default_location(df, columns=tuple(LOCATION_COLUMNS), default=UNKNOWN, blank_is_null=True):
    """Fill in ``default`` where a location is missing.

    Blank text counts as missing: as a partition value it would be stored under
    the folder for nulls and come back as null.
    """

    def present(c):
        return F.nullif(F.trim(F.col(c)), F.lit("")) if blank_is_null else F.col(c)

    return df.withColumns({c: F.coalesce(present(c), F.lit(default)) for c in columns})


def tidy(df, wanted):
    """Those of ``wanted`` that ``df`` has, in that order."""
    return df.select(*[c for c in wanted if c in df.columns])
