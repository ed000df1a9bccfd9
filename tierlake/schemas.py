"""Declared schemas of the layers; nothing is inferred from the data."""

from pyspark.sql import types as T

# Column names and their order in the stored layers.
TEXT_COLUMNS = [
    "id", "name", "brewery_type", "street", "address_1", "address_2", "address_3",
    "city", "state", "state_province", "postal_code", "country", "phone", "website_url",
]
COORDINATE_COLUMNS = ["latitude", "longitude"]
VERSION_COLUMN = "updated_at"
KEY_COLUMN = "id"
NAME_COLUMN = "name"
TYPE_COLUMN = "brewery_type"
LOCATION_COLUMNS = ["country", "state"]
SILVER_COLUMNS = [
    "id", "name", "brewery_type", "street", "city", "state", "postal_code", "country",
    "longitude", "latitude", "phone", "website_url",
]
COUNT_COLUMN = "breweries_count"
DATE_COLUMN = "ingestion_date"
UNKNOWN = "Unknown"


def _columns(names, data_type):
    return [T.StructField(name, data_type) for name in names]


# A raw record: every attribute as text, typed in silver.
RAW = T.StructType(_columns(TEXT_COLUMNS + COORDINATE_COLUMNS + [VERSION_COLUMN], T.StringType()))

BRONZE_PAGE = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("payload", T.StringType()),
        T.StructField("n_rows", T.IntegerType()),
    ]
)

META = T.StructType([T.StructField("payload", T.StringType())])

SILVER = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name in COORDINATE_COLUMNS else T.StringType())
        for name in SILVER_COLUMNS
    ]
)

GOLD = T.StructType(
    _columns(LOCATION_COLUMNS + [TYPE_COLUMN], T.StringType())
    + [T.StructField(COUNT_COLUMN, T.LongType())]
)
