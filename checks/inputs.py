"""Input frames that Spark derives from the given tables, and the same as SQL.

The given tables are clean, so ``entity`` turns customers into padded, blank,
missing, malformed and repeated records. ``events`` become pages of 200.
"""

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions import to_pages
from tierlake.layout import Layout, snapshot_path
from tierlake.session import scratch_dir
from tierlake.sinks import land_dated_pages

PAGE_SIZE = 200
DATE = "2024-01-30"
EARLIER_DATE = "2024-01-29"

ENTITY_COLUMNS = [
    "id", "name", "brewery_type", "country", "state", "latitude", "longitude", "updated_at",
]

ENTITY_SQL = """
base AS (
  SELECT c.c_custkey AS k, c.c_name, c.c_mktsegment, c.c_acctbal, c.c_nationkey, n.n_name, r.r_name
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
versions AS (
  SELECT *, '2024-01-01' AS updated_at, '' AS suffix FROM base
  UNION ALL
  SELECT *, '2024-02-01' AS updated_at, ' v2' AS suffix FROM base WHERE k % 3 = 0),
entity AS (
  SELECT concat('  ', CAST(k AS VARCHAR(20)), ' ') AS id,
         concat(' ', c_name, suffix, '  ') AS name,
         CASE WHEN k % 11 = 0 THEN NULL ELSE c_mktsegment END AS brewery_type,
         CASE WHEN k % 7 = 0 THEN NULL WHEN k % 17 = 0 THEN '  ' ELSE concat(' ', r_name, ' ') END AS country,
         CASE WHEN k % 5 = 0 THEN NULL ELSE concat(n_name, '  ') END AS state,
         CASE WHEN k % 13 = 0 THEN 'bad' ELSE CAST(c_acctbal AS VARCHAR(40)) END AS latitude,
         CAST(c_nationkey AS VARCHAR(10)) AS longitude, updated_at
  FROM versions)"""


def silver_sql(source="entity", name="silver"):
    """CTEs of the clean table over ``source``."""
    return f"""
{name}_clean AS (
  SELECT trim(id) AS id, trim(name) AS name, trim(brewery_type) AS brewery_type,
         coalesce(nullif(trim(state), ''), 'Unknown') AS state,
         coalesce(nullif(trim(country), ''), 'Unknown') AS country,
         try_cast(longitude AS DOUBLE) AS longitude, try_cast(latitude AS DOUBLE) AS latitude,
         updated_at
  FROM {source}),
{name}_ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY id ORDER BY updated_at DESC NULLS LAST, name DESC NULLS LAST) AS rn
  FROM {name}_clean),
{name} AS (
  SELECT id, name, brewery_type, state, country, longitude, latitude FROM {name}_ranked WHERE rn = 1)"""


GOLD_SQL = """
gold AS (
  SELECT country, state, brewery_type, count(*) AS breweries_count
  FROM silver GROUP BY country, state, brewery_type)"""

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

EVENT_COLUMNS_SQL = "event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props"
PAGE_SQL = f"CAST(event_id // {PAGE_SIZE} + 1 AS INTEGER)"


TABLE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING",
}


def table(spark, sf_dir, name):
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def entity(spark, sf_dir):
    """The records of ``ENTITY_SQL``, in one pass over the customers."""
    base = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    versions = """inline(CASE
        WHEN c_custkey % 3 = 0 THEN array(struct('2024-01-01' AS updated_at, '' AS suffix),
                                          struct('2024-02-01' AS updated_at, ' v2' AS suffix))
        ELSE array(struct('2024-01-01' AS updated_at, '' AS suffix)) END)"""
    return base.selectExpr("*", versions).selectExpr(
        "concat('  ', c_custkey, ' ') AS id",
        "concat(' ', c_name, suffix, '  ') AS name",
        "CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS brewery_type",
        """CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '  '
                ELSE concat(' ', r_name, ' ') END AS country""",
        "CASE WHEN c_custkey % 5 <> 0 THEN concat(n_name, '  ') END AS state",
        "CASE WHEN c_custkey % 13 = 0 THEN 'bad' ELSE string(c_acctbal) END AS latitude",
        "string(c_nationkey) AS longitude",
        "updated_at",
    )


def entity_pages(records):
    """Records of ``entity`` as JSON pages; both versions of a key share a page."""
    page = F.expr(f"CAST(trim(id) AS BIGINT) DIV {PAGE_SIZE} + 1")
    return to_pages(records, page, records.columns, ["id", "updated_at"])


def events(spark, sf_dir):
    """Events as raw records: the time as text, to the microsecond."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))


def event_pages(spark, sf_dir, by_date=False):
    """Events as JSON pages in the order of ``event_id``, per snapshot date if asked."""
    rows = events(spark, sf_dir)
    if by_date:
        rows = rows.withColumn("ingestion_date", F.col("ts").cast("date").cast("string"))
    page = F.expr(f"event_id DIV {PAGE_SIZE} + 1")
    by = ["ingestion_date"] if by_date else []
    return to_pages(rows, page, EVENT_SCHEMA.names, ["event_id"], by)


def event_rows(records, *extra):
    """Event records as the SQL shows them."""
    micros = F.unix_micros(F.col("ts").try_cast("timestamp")).alias("ts_us")
    return records.select(*extra, "event_id", micros, "user_id", "event_type", "value", "props")


def with_broken_pages(pages):
    """Every third page loses its closing brackets."""
    cut = F.expr("substr(payload, 1, length(payload) - 2)")
    return pages.withColumn("payload", F.when(F.col("page") % 3 == 0, cut).otherwise(F.col("payload")))


def new_layout(spark, dataset):
    return Layout(scratch_dir(spark), dataset)


def page_table_by_date(spark, pages):
    """Land pages that carry their snapshot date."""
    layout = new_layout(spark, "events")
    land_dated_pages(pages, layout)
    return layout


def loose_pages(spark, sf_dir):
    """Events as loose text files, one per date and page; returns the layout and the glob."""
    layout = new_layout(spark, "events")
    pages = event_pages(spark, sf_dir, by_date=True)
    pages.write.partitionBy("ingestion_date", "page").text(layout.bronze)
    return layout, "part-*"


ENCODINGS = ["UTF-8", "UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE"]
BYTE_ORDER_MARKS = {
    "UTF-8": b"\xef\xbb\xbf", "UTF-16LE": b"\xff\xfe", "UTF-16BE": b"\xfe\xff",
    "UTF-32LE": b"\xff\xfe\0\0", "UTF-32BE": b"\0\0\xfe\xff",
}


def encoded_pages(spark, sf_dir):
    """Events as loose files ``page=N.json`` in all character sets, with and without a mark.

    Page n has the character set n modulo 5, and a byte order mark if n div 5 is even; of every
    eleventh page the last byte is missing in the middle of a character. The tasks write the
    files themselves, so the shared folder has to be one that pyarrow knows.
    """
    layout = new_layout(spark, "events")
    address = snapshot_path(layout.bronze, DATE).replace("s3a://", "s3://", 1)

    def write(batches):
        from pyarrow import RecordBatch, fs

        store, root = fs.FileSystem.from_uri(address)
        store.create_dir(root)
        for batch in batches:
            for page, payload in zip(batch["page"].to_pylist(), batch["payload"].to_pylist()):
                name = ENCODINGS[page % 5]
                content = (BYTE_ORDER_MARKS[name] if page // 5 % 2 == 0 else b"") + payload.encode(name)
                if page % 11 == 0:
                    content = content[:-1] + (b"" if name != "UTF-8" else b"\xe2")
                with store.open_output_stream(f"{root}/page={page}.json") as file:
                    file.write(content)
            yield RecordBatch.from_arrays([batch["page"]], names=["page"])

    event_pages(spark, sf_dir).mapInArrow(write, "page int").write.format("noop").mode("overwrite").save()
    return layout


def paged_folder(spark, pages, total_pages, cut_first=0):
    """Store pages in shelves; returns the fetch that reads one page.

    It stands in for a remote collection. A page that is not there is empty. There are at
    most about 10,000 shelves, and neighbouring pages share one, so it is read once and held
    until the next one. Of every ``cut_first``-th page the first reply to a task is cut off.

    The tasks open the shared folder themselves, so it has to be one that pyarrow knows.
    """
    folder = scratch_dir(spark, "pages")
    size = max(25, math.ceil(total_pages / 10_000))
    shelf = F.expr(f"(page - 1) DIV {size}").alias("shelf")
    shelved = pages.select("page", "payload", shelf).hint("rebalance", "shelf")
    shelved.write.partitionBy("shelf").parquet(folder)
    address = folder.replace("s3a://", "s3://", 1)
    held, cut = {}, set()

    def read_shelf(number):
        from pyarrow import fs, parquet

        store, root = fs.FileSystem.from_uri(address)
        path = fs.FileSelector(f"{root}/shelf={number}", allow_not_found=True)
        texts = {}
        for file in store.get_file_info(path):
            if file.base_name.startswith("part-"):
                rows = parquet.read_table(file.path, filesystem=store, partitioning=None)
                texts.update(zip(rows["page"].to_pylist(), rows["payload"].to_pylist()))
        return texts

    def fetch(page):
        number = (page - 1) // size
        if number not in held:
            held.clear()
            held[number] = read_shelf(number)
        text = held[number].get(page, "[]")
        if cut_first and page % cut_first == 0 and page not in cut:
            cut.add(page)
            return text[: len(text) // 2]
        return text

    return fetch
