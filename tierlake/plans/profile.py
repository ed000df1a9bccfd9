"""What each layer holds: rows and columns."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.layout import as_date, snapshot_path
from tierlake.schemas import DATE_COLUMN
from tierlake.sources.bronze import read_pages
from tierlake.sources.layers import dated, load, read_gold, read_silver, snapshot_dates, with_date_text
from tierlake.sources.loose import FILE

COLUMNS = "position int, column string, type string, nullable boolean"
# Type of a JSON value -> what a reader makes of a column of such values.
JSON_TYPES = {
    r"DECIMAL\(\d+,\d+\)": "double", "FLOAT": "double", "DOUBLE": "double", "BIGINT": "bigint",
    "BOOLEAN": "boolean", "STRING": "string", "VOID": "string", "VARIANT": "string",
}


def layer_counts(spark, layout, date=None, fmt="parquet"):
    """``(layer, ingestion_date, rows)``, from the page counts and the file footers.

    Over many terabytes run its action in ``skimming_scans``.
    """
    bronze = read_pages(spark, layout, date).select(DATE_COLUMN, F.col("n_rows").alias("n"))
    silver = read_silver(spark, layout, date).select(DATE_COLUMN, F.lit(1).alias("n"))
    gold = read_gold(spark, layout, date, fmt).select(DATE_COLUMN, F.lit(1).alias("n"))
    layers = {"bronze": bronze, "silver": silver, "gold": gold}
    counts = [
        rows.groupBy(DATE_COLUMN)
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        .select(F.lit(layer).alias("layer"), DATE_COLUMN, "rows")
        for layer, rows in layers.items()
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


def record_columns(pages):
    """``(ingestion_date, position, column, type, nullable, found)`` of the records in JSON pages.

    As a reader that infers the schema of a date sees it: columns by name, whole numbers as
    ``bigint``, others as ``double``, types that disagree, and columns that are null
    throughout, as ``string``. ``found`` counts the records that have a value.
    """
    records = pages.where("n_rows > 0").select(
        DATE_COLUMN, F.explode(F.from_json("payload", "array<map<string,variant>>")).alias("record"))
    values = records.select(DATE_COLUMN, F.explode("record").alias("column", "value"))
    seen = values.groupBy(DATE_COLUMN, "column").agg(
        F.schema_of_variant_agg("value").alias("json"),
        F.count_if(F.schema_of_variant("value") != "VOID").alias("found"))
    kind = F.col("json")
    for variant, name in JSON_TYPES.items():  # as types, not as names of fields within objects
        kind = F.regexp_replace(kind, f"(^|<|: ){variant}(?=[,>]|$)", f"$1{name}")
    for variant, name in {"OBJECT<": "struct<", "ARRAY<": "array<"}.items():
        kind = F.regexp_replace(kind, f"(^|<|: ){variant}", f"$1{name}")
    kind = F.regexp_replace(F.regexp_replace(kind, ": ", ":"), ", ", ",")
    by_date = seen.groupBy(DATE_COLUMN).agg(
        F.sort_array(F.collect_list(F.struct("column", kind.alias("type"), "found"))).alias("columns"))
    return by_date.select(DATE_COLUMN, F.posexplode("columns").alias("at", "c")).select(
        DATE_COLUMN, (F.col("at") + 1).alias("position"), "c.column", "c.type", F.lit(True).alias("nullable"), "c.found")


def _footers(batches):
    """``(ingestion_date, position, column, type, nullable)`` of each Parquet file, from its footer."""
    import pyarrow as pa
    from pyarrow import fs, parquet
    from pyspark.sql.pandas.types import from_arrow_schema

    for batch in batches:
        found = []
        for path, date in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            address = path.replace("s3a://", "s3://", 1)
            if address.startswith("file:/") and not address.startswith("file:///"):
                address = "file:///" + address[len("file:/"):]
            scheme, _, rest = address.partition("://")
            if scheme == "file":  # the rest is a path and no URI: it may hold any character
                store, name = fs.LocalFileSystem(), rest
            else:
                store, name = fs.FileSystem.from_uri(address)
            schema = parquet.read_schema(name, filesystem=store)
            own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            fields = T.StructType.fromJson(json.loads(own)) if own else from_arrow_schema(schema)
            columns = [(f.name, f.dataType.simpleString(), f.nullable) for f in fields]
            folders = [part.partition("=")[0] for part in path.split("/")[:-1] if "=" in part]
            columns += [(name, "string", True) for name in folders if name != DATE_COLUMN]
            found += [(date, n, *column) for n, column in enumerate(columns, start=1)]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_()]
        columns = list(zip(*found)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=[DATE_COLUMN, "position", "column", "type", "nullable"])


def file_columns(spark, root, date=None, fmt="parquet"):
    """``(ingestion_date, position, column, type, nullable, found)`` of a layer's files.

    ``found`` counts the files that have a column in this place, with this type; where the files
    of a date disagree, there are several rows for it. Folder columns follow those of the
    files, as text. Footers of Parquet are read by the tasks, which have to know the file
    system (a mounted path, HDFS, S3, GCS); other formats tell one schema per date. Over many
    terabytes run the action in ``skimming_scans``: files are listed and not opened by Spark.
    """
    if fmt != "parquet":
        dates = [as_date(date)] if date is not None else sorted(snapshot_dates(spark, root))
        rows = [
            (d, n, f.name, f.dataType.simpleString(), f.nullable, None)
            for d in dates
            for n, f in enumerate(load(spark, spark.read.format(fmt), snapshot_path(root, d)).schema, start=1)]
        return spark.createDataFrame(rows, f"{DATE_COLUMN} date, {COLUMNS}, found long")
    reader = spark.read.format("binaryFile").schema(with_date_text(FILE)).option("basePath", root)
    reader = reader.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", False)
    path = root if date is None else snapshot_path(root, date)
    files = dated(load(spark, reader, path), date).select("path", F.col(DATE_COLUMN).cast("string").alias(DATE_COLUMN))
    return (
        files.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_footers, f"{DATE_COLUMN} string, {COLUMNS}")
        .groupBy(F.col(DATE_COLUMN).cast("date").alias(DATE_COLUMN), "position", "column", "type", "nullable")
        .agg(F.count("*").alias("found")))


def layer_schemas(spark, layout, date=None, fmt="parquet"):
    """``(layer, ingestion_date, position, column, type, nullable, found)`` of all layers.

    Bronze shows the columns of the records as a schema-inferring reader would, silver and
    gold those of the stored files.
    """
    layers = {
        "bronze": record_columns(read_pages(spark, layout, date)),
        "silver": file_columns(spark, layout.silver, date),
        "gold": file_columns(spark, layout.gold, date, fmt),
    }
    frames = [
        df.select(F.lit(layer).alias("layer"), DATE_COLUMN, "position", "column", "type", "nullable",
                  F.col("found").cast("long").alias("found"))
        for layer, df in layers.items()]
    return frames[0].unionAll(frames[1]).unionAll(frames[2])
