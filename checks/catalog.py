"""Query name -> (Spark query, SQL for the same rows)."""

import math

from pyspark.errors import PySparkException, PythonException
from pyspark.sql import functions as F

from checks.inputs import (
    DATE,
    EARLIER_DATE,
    ENTITY_COLUMNS,
    ENTITY_SQL,
    EVENT_COLUMNS_SQL,
    EVENT_SCHEMA,
    GOLD_SQL,
    PAGE_SIZE,
    PAGE_SQL,
    entity,
    encoded_pages,
    entity_pages,
    event_pages,
    event_rows,
    loose_pages,
    new_layout,
    page_table_by_date,
    paged_folder,
    silver_sql,
    table,
    with_broken_pages,
)
from tierlake import operators as ops
from tierlake.functions import page_records, region_label
from tierlake.layout import snapshot_path
from tierlake.plans import gold, layer_counts, layer_schemas, run, silver
from tierlake.schemas import COORDINATE_COLUMNS, COUNT_COLUMN, DATE_COLUMN, LOCATION_COLUMNS, SILVER_COLUMNS
from tierlake.session import configure, use_local_scratch
from tierlake.sinks import (
    import_pages,
    land_collection,
    land_dated_pages,
    land_meta,
    land_pages,
    load_stats,
    write_gold,
    write_silver,
)
from tierlake.sources import (
    latest_date,
    latest_date_frame,
    latest_loose_date,
    open_collection,
    page_count,
    read_bronze,
    read_gold,
    read_meta,
    read_quarantine,
    read_silver,
    stop_at_empty,
)

QUERIES = {}
SQL = {}

SILVER_SQL = ENTITY_SQL + "," + silver_sql()
LAYERS_SQL = SILVER_SQL + "," + GOLD_SQL
SILVER_FRAME = ["id", "name", "brewery_type", "state", "country", "longitude", "latitude"]
SILVER_LIST = ", ".join(SILVER_FRAME)
GOLD_FRAME = ["country", "state", "brewery_type", "breweries_count"]
GOLD_LIST = ", ".join(GOLD_FRAME)
COUNTRY = "ASIA"


def query(name, sql):
    """Register the decorated ``f(spark, sf_dir)`` and its SQL."""

    def register(function):
        def configured(spark, sf_dir):
            return function(use_local_scratch(configure(spark)), sf_dir)

        QUERIES[name] = configured
        SQL[name] = sql.strip()
        return function

    return register


def silver_frame(spark, sf_dir):
    return silver.transform(entity(spark, sf_dir))


def stored_silver(spark, sf_dir):
    """The clean table as written and read back."""
    layout = new_layout(spark, "entity")
    write_silver(silver_frame(spark, sf_dir), layout, DATE)
    return read_silver(spark, layout, DATE)


def with_date_text(df, *columns):
    """Select with the date as text, which compares alike in every engine."""
    return df.select(F.col(DATE_COLUMN).cast("string").alias(DATE_COLUMN), *columns)


# --- cleaning ----------------------------------------------------------------


@query("trim_strings", f"""
WITH {ENTITY_SQL}
SELECT trim(id) AS id, trim(name) AS name, trim(brewery_type) AS brewery_type,
       trim(country) AS country, trim(state) AS state, updated_at
FROM entity""")
def _(spark, sf_dir):
    kept = ["id", "name", "brewery_type", "country", "state", "updated_at"]
    return ops.trim_strings(entity(spark, sf_dir)).select(*kept)


@query("cast_coordinates", f"""
WITH {ENTITY_SQL}
SELECT id, updated_at, try_cast(latitude AS DOUBLE) AS latitude,
       try_cast(longitude AS DOUBLE) AS longitude
FROM entity""")
def _(spark, sf_dir):
    kept = ["id", "updated_at", "latitude", "longitude"]
    return ops.cast_doubles(entity(spark, sf_dir)).select(*kept)


@query("default_location", f"""
WITH {ENTITY_SQL}
SELECT id, updated_at, coalesce(nullif(trim(country), ''), 'Unknown') AS country,
       coalesce(nullif(trim(state), ''), 'Unknown') AS state
FROM entity""")
def _(spark, sf_dir):
    kept = ["id", "updated_at", "country", "state"]
    return ops.default_location(entity(spark, sf_dir)).select(*kept)


@query("tidy_projection", f"""
WITH {ENTITY_SQL}
SELECT id, name, brewery_type, state, country, longitude, latitude FROM entity""")
def _(spark, sf_dir):
    return ops.tidy(entity(spark, sf_dir), SILVER_COLUMNS)


# --- one row per key ---------------------------------------------------------


def latest_sql(source, key, order, columns):
    return f"""
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source})
WHERE rn = 1"""


@query("dedup_latest", f"WITH {ENTITY_SQL}" + latest_sql(
    "entity", "id", "updated_at DESC NULLS LAST, name DESC NULLS LAST", ", ".join(ENTITY_COLUMNS)))
def _(spark, sf_dir):
    return ops.latest_per_key(entity(spark, sf_dir), "id", ["updated_at", "name"])


@query("dedup_by_name", f"WITH {ENTITY_SQL}" + latest_sql(
    "entity", "id", "name DESC NULLS LAST", ", ".join(ENTITY_COLUMNS[:-1])))
def _(spark, sf_dir):
    return ops.latest_per_key(entity(spark, sf_dir).drop("updated_at"), "id", ["name"])


@query("dedup_events", latest_sql("events", "user_id", "ts DESC", EVENT_COLUMNS_SQL))
def _(spark, sf_dir):
    latest = ops.latest_per_key(table(spark, sf_dir, "events"), "user_id", ["ts"])
    return event_rows(latest)


@query("dedup_null_keys", f"WITH {ENTITY_SQL}" + latest_sql(
    "entity WHERE state IS NOT NULL", "state", "updated_at DESC, name DESC",
    "id, name, state, updated_at") + """
UNION ALL
SELECT id, name, state, updated_at FROM entity WHERE state IS NULL""")
def _(spark, sf_dir):
    records = entity(spark, sf_dir).select("id", "name", "state", "updated_at")
    return ops.latest_per_key(records, "state", ["updated_at", "name"], null_key="keep")


# Versions as numbers and as times with a zone, kept as text: their order is not that of the text.
TYPED_VERSIONS = """
versions_of_nation AS (
  SELECT c_nationkey AS id, c_name AS name,
         CASE WHEN c_custkey % 19 = 0 THEN 'none' ELSE CAST(c_custkey AS VARCHAR(20)) END AS version,
         concat('2024-01-0', CAST(c_custkey % 9 + 1 AS VARCHAR(1)), ' 00:00:00',
                CASE WHEN c_custkey % 2 = 0 THEN '+09:00' ELSE '-09:00' END) AS stamp
  FROM customer)"""


def versions_of_nation(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_nationkey AS id", "c_name AS name",
        "CASE WHEN c_custkey % 19 = 0 THEN 'none' ELSE string(c_custkey) END AS version",
        "concat('2024-01-0', c_custkey % 9 + 1, ' 00:00:00', if(c_custkey % 2 = 0, '+09:00', '-09:00')) AS stamp")


@query("dedup_numeric_versions", f"WITH {TYPED_VERSIONS}" + latest_sql(
    "versions_of_nation", "id", "try_cast(version AS BIGINT) DESC NULLS LAST, version DESC, name DESC",
    "id, name, version"))
def _(spark, sf_dir):
    rows = versions_of_nation(spark, sf_dir).drop("stamp")
    return ops.latest_per_key(rows, "id", ["version", "name"], types={"version": "bigint"})


@query("dedup_timed_versions", f"WITH {TYPED_VERSIONS}" + latest_sql(
    "versions_of_nation", "id", "try_cast(stamp AS TIMESTAMPTZ) DESC NULLS LAST, stamp DESC, name DESC",
    "id, name, stamp"))
def _(spark, sf_dir):
    rows = versions_of_nation(spark, sf_dir).drop("version")
    return ops.latest_per_key(rows, "id", ["stamp", "name"], types={"stamp": "timestamp"})


@query("silver_numeric_versions", f"""
WITH {ENTITY_SQL},
numbered AS (
  SELECT * REPLACE (CASE WHEN updated_at = '2024-01-01' THEN '10' ELSE '9' END AS updated_at) FROM entity),""" + silver_sql(
    "numbered", "text_order") + """,
numeric AS (
  SELECT *, row_number() OVER (
      PARTITION BY id ORDER BY CAST(updated_at AS BIGINT) DESC NULLS LAST, name DESC NULLS LAST) AS turn
  FROM text_order_clean)""" + f"""
SELECT {SILVER_LIST} FROM numeric WHERE turn = 1""")
def _(spark, sf_dir):
    """The first version of an entity has number 10, the second one 9; landed and built."""
    layout = new_layout(spark, "entity")
    number = F.when(F.col("updated_at") == "2024-01-01", "10").otherwise("9")
    land_pages(entity_pages(entity(spark, sf_dir).withColumn("updated_at", number)), layout, DATE)
    silver.build(spark, layout, DATE, version_type="bigint")
    return read_silver(spark, layout, DATE).select(*SILVER_FRAME)


# --- silver and gold as frames -----------------------------------------------


@query("silver_build", f"WITH {SILVER_SQL} SELECT {SILVER_LIST} FROM silver")
def _(spark, sf_dir):
    return silver_frame(spark, sf_dir)


@query("gold_counts", f"WITH {LAYERS_SQL} SELECT {GOLD_LIST} FROM gold")
def _(spark, sf_dir):
    return gold.aggregate(silver_frame(spark, sf_dir))


@query("count_by_country", f"""
WITH {SILVER_SQL} SELECT country, count(*) AS "count" FROM silver GROUP BY country""")
def _(spark, sf_dir):
    return ops.count_by(stored_silver(spark, sf_dir), "country")


@query("filter_country", f"""
WITH {SILVER_SQL}
SELECT state, count(*) AS "count" FROM silver WHERE country = '{COUNTRY}' GROUP BY state""")
def _(spark, sf_dir):
    in_country = stored_silver(spark, sf_dir).where(F.col("country") == COUNTRY)
    return ops.count_by(in_country, "state")


@query("top_countries", f"""
WITH {SILVER_SQL}
SELECT country, count(*) AS "count" FROM silver GROUP BY country
ORDER BY count(*) DESC, country LIMIT 10""")
def _(spark, sf_dir):
    return ops.top_countries(stored_silver(spark, sf_dir))


@query("top_states", f"""
WITH {SILVER_SQL}
SELECT state, count(*) AS "count" FROM silver WHERE country = '{COUNTRY}' GROUP BY state
ORDER BY count(*) DESC, state LIMIT 10""")
def _(spark, sf_dir):
    return ops.top_states(stored_silver(spark, sf_dir), COUNTRY)


@query("top_regions", f"""
WITH {LAYERS_SQL}
SELECT {GOLD_LIST}, concat_ws(' - ', country, state) AS label FROM gold
ORDER BY breweries_count DESC, country, state, brewery_type NULLS FIRST LIMIT 15""")
def _(spark, sf_dir):
    layout = new_layout(spark, "entity")
    write_gold(gold.aggregate(silver_frame(spark, sf_dir)), layout, DATE)
    return ops.top_regions(read_gold(spark, layout, DATE)).drop(DATE_COLUMN)


@query("sample_rows", f"""
WITH {SILVER_SQL}
SELECT least(5, count(*)) AS sampled, least(5, count(*)) AS found FROM silver""")
def _(spark, sf_dir):
    """Any rows will do: how many there are, and how many of them the table has."""
    stored = stored_silver(spark, sf_dir)
    some = ops.sample_rows(stored, 5).select("id")
    known = stored.select("id", F.lit(1).alias("known"))
    return some.join(known, "id", "left").agg(F.count("*").alias("sampled"), F.count("known").alias("found"))


@query("region_labels", f"""
WITH {ENTITY_SQL}
SELECT id, updated_at,
       concat_ws(' - ', coalesce(country, 'Unknown'), coalesce(state, 'Unknown')) AS label
FROM entity""")
def _(spark, sf_dir):
    return entity(spark, sf_dir).select("id", "updated_at", region_label().alias("label"))


# --- paged source ------------------------------------------------------------


def event_total(spark, sf_dir):
    return table(spark, sf_dir, "events").count()


def scan_events(spark, pages, total, cut_first=0, **options):
    """Pages of a stand-in for a remote collection that announces ``total`` rows."""
    fetch = paged_folder(spark, pages, math.ceil(total / PAGE_SIZE), cut_first)
    scanned, _ = open_collection(
        spark, fetch, lambda: {"total": total}, PAGE_SIZE, pause_sec=0, backoff_sec=0, **options
    )
    return scanned


def page_records_of(pages):
    rows = pages.select("page", F.inline(page_records("payload", EVENT_SCHEMA)))
    return event_rows(rows, "page")


PAGES_SQL = f"""
WITH total AS (
  SELECT CAST(ceil(count(*) / {PAGE_SIZE}.0) AS BIGINT) AS pages FROM events)
SELECT {PAGE_SQL} AS page, {EVENT_COLUMNS_SQL} FROM events"""


@query("paged_scan", PAGES_SQL)
def _(spark, sf_dir):
    total = event_total(spark, sf_dir)
    return page_records_of(scan_events(spark, event_pages(spark, sf_dir), total))


@query("page_cap", PAGES_SQL + f"""
WHERE {PAGE_SQL} <= (SELECT pages // 2 FROM total)""")
def _(spark, sf_dir):
    total = event_total(spark, sf_dir)
    half = math.ceil(total / PAGE_SIZE) // 2
    return page_records_of(scan_events(spark, event_pages(spark, sf_dir), total, max_pages=half))


@query("paged_retry", PAGES_SQL)
def _(spark, sf_dir):
    """Every seventh page is cut off in its first reply to a task."""
    total = event_total(spark, sf_dir)
    return page_records_of(scan_events(spark, event_pages(spark, sf_dir), total, cut_first=7))


UNTIL_EMPTY_SQL = PAGES_SQL + f"""
WHERE {PAGE_SQL} < (SELECT pages // 2 FROM total)"""


def with_a_gap(spark, sf_dir):
    """The pages of the events, with an empty one in the middle."""
    total = event_total(spark, sf_dir)
    middle = math.ceil(total / PAGE_SIZE) // 2
    emptied = F.when(F.col("page") == middle, "[]").otherwise(F.col("payload"))
    return scan_events(spark, event_pages(spark, sf_dir).withColumn("payload", emptied), total)


@query("stop_at_empty", UNTIL_EMPTY_SQL)
def _(spark, sf_dir):
    layout = new_layout(spark, "events")
    land_pages(with_a_gap(spark, sf_dir), layout, DATE)
    return event_rows(read_bronze(spark, layout, DATE, EVENT_SCHEMA), "page")


@query("stop_at_empty_scan", UNTIL_EMPTY_SQL)
def _(spark, sf_dir):
    return page_records_of(stop_at_empty(with_a_gap(spark, sf_dir)))


@query("resumed_landing", PAGES_SQL)
def _(spark, sf_dir):
    """A landing that fails half-way; the next one may not ask for the first quarter again."""
    total = event_total(spark, sf_dir)
    pages = math.ceil(total / PAGE_SIZE)
    fetch = paged_folder(spark, event_pages(spark, sf_dir), pages)

    def until_half(page):
        if pages // 2 < page <= pages:
            raise OSError(f"page {page} is not to be had yet")
        return fetch(page)

    def from_a_quarter(page):
        if page <= pages // 4:
            raise OSError(f"page {page} was landed before")
        return fetch(page)

    layout = new_layout(spark, "events")
    options = {
        "total_pages": pages, "pages_per_task": max(1, pages // 40), "ranges_at_once": 4 if pages > 40 else 1,
        "pause_sec": 0, "backoff_sec": 0, "max_retries": 1}
    try:
        land_collection(spark, layout, DATE, until_half, **options)
    except PythonException:
        land_collection(spark, layout, DATE, from_a_quarter, **options)
    return event_rows(read_bronze(spark, layout, DATE, EVENT_SCHEMA), "page")


# --- bronze ------------------------------------------------------------------


@query("bronze_land_roundtrip", f"""
SELECT '{DATE}' AS ingestion_date, {PAGE_SQL} AS page, {EVENT_COLUMNS_SQL} FROM events""")
def _(spark, sf_dir):
    layout = new_layout(spark, "events")
    land_pages(event_pages(spark, sf_dir), layout, DATE)
    records = read_bronze(spark, layout, DATE, EVENT_SCHEMA)
    date = F.col(DATE_COLUMN).cast("string").alias(DATE_COLUMN)
    return event_rows(records, date, "page")


@query("bronze_parse", f"""
SELECT {PAGE_SQL} AS page, {EVENT_COLUMNS_SQL} FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def _(spark, sf_dir):
    layout, glob = loose_pages(spark, sf_dir)
    date = latest_loose_date(spark, layout.bronze, glob)
    records = read_bronze(spark, layout, date, EVENT_SCHEMA, loose=True, glob=glob)
    return event_rows(records, "page")


@query("bronze_encodings", f"""
SELECT {PAGE_SQL} AS page, {EVENT_COLUMNS_SQL}, FALSE AS unreadable FROM events WHERE {PAGE_SQL} % 11 <> 0
UNION ALL
SELECT DISTINCT {PAGE_SQL}, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::VARCHAR, NULL::DOUBLE, NULL::VARCHAR, TRUE
FROM events WHERE {PAGE_SQL} % 11 = 0""")
def _(spark, sf_dir):
    """Pages in five character sets; every eleventh has bytes that are no text."""
    layout = encoded_pages(spark, sf_dir)
    records = event_rows(read_bronze(spark, layout, DATE, EVENT_SCHEMA, loose=True), "page")
    readable = records.withColumn("unreadable", F.lit(False))
    unreadable = read_quarantine(spark, layout, DATE, loose=True).select("page", F.lit(True).alias("unreadable"))
    return readable.unionByName(unreadable, allowMissingColumns=True)


@query("bronze_all_dates", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date, count(*) AS "rows",
       sum(event_id)::BIGINT AS event_id_sum
FROM events GROUP BY 1""")
def _(spark, sf_dir):
    layout, glob = loose_pages(spark, sf_dir)
    records = read_bronze(
        spark, layout, schema=EVENT_SCHEMA, loose=True, glob=glob, columns=["event_id"])
    counts = records.groupBy(DATE_COLUMN).agg(
        F.count("*").alias("rows"), F.sum("event_id").alias("event_id_sum")
    )
    return with_date_text(counts, "rows", "event_id_sum")


@query("bronze_latest_rows", f"""
SELECT {EVENT_COLUMNS_SQL} FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def _(spark, sf_dir):
    layout = page_table_by_date(spark, event_pages(spark, sf_dir, by_date=True))
    newest = latest_date(spark, layout.bronze)
    return event_rows(read_bronze(spark, layout, newest, EVENT_SCHEMA))


@query("latest_date", """
SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS ingestion_date FROM events""")
def _(spark, sf_dir):
    layout = page_table_by_date(spark, event_pages(spark, sf_dir, by_date=True))
    return with_date_text(latest_date_frame(spark, layout.bronze))


DATED_PAGES_SQL = f"""
WITH dated AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date, {PAGE_SQL} AS page,
         count(*) AS n, ({PAGE_SQL} % 3 = 0) AS broken
  FROM events GROUP BY ALL)"""


@query("load_stats", DATED_PAGES_SQL + """
SELECT ingestion_date, count(*) AS pages, count(*) FILTER (WHERE broken) AS unreadable_pages,
       coalesce(sum(n) FILTER (WHERE NOT broken), 0)::BIGINT AS "rows"
FROM dated GROUP BY ingestion_date""")
def _(spark, sf_dir):
    pages = with_broken_pages(event_pages(spark, sf_dir, by_date=True))
    stats = load_stats(spark, page_table_by_date(spark, pages))
    return with_date_text(stats, "pages", "unreadable_pages", "rows")


@query("quarantined_pages", DATED_PAGES_SQL + """
SELECT ingestion_date, page FROM dated WHERE broken""")
def _(spark, sf_dir):
    pages = with_broken_pages(event_pages(spark, sf_dir, by_date=True))
    unreadable = read_quarantine(spark, page_table_by_date(spark, pages))
    return with_date_text(unreadable, "page")


@query("meta_page_count", f"""
SELECT '{DATE}' AS ingestion_date, count(*) AS total_rows,
       CAST(ceil(count(*) / {PAGE_SIZE}.0) AS BIGINT) AS pages
FROM events""")
def _(spark, sf_dir):
    layout = new_layout(spark, "events")
    land_meta(spark, {"total": event_total(spark, sf_dir)}, layout, DATE)
    counted = page_count(read_meta(spark, layout, DATE), PAGE_SIZE)
    return with_date_text(counted, "total_rows", "pages")


@query("dated_replacement", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date, count(*) AS "rows", sum(event_id)::BIGINT AS event_id_sum
FROM events WHERE day(ts) % 3 <> 0 GROUP BY 1""")
def _(spark, sf_dir):
    """A history loaded again: on every third day the collection is empty by now, and nothing of it stays."""
    layout = new_layout(spark, "events")
    pages = event_pages(spark, sf_dir, by_date=True)
    land_dated_pages(pages, layout)
    gone = F.day(F.col(DATE_COLUMN).cast("date")) % 3 == 0
    land_dated_pages(pages.withColumn("payload", F.when(gone, "[]").otherwise(F.col("payload"))).where(
        gone | (F.day(F.col(DATE_COLUMN).cast("date")) % 3 == 1)), layout)
    records = read_bronze(spark, layout, schema=EVENT_SCHEMA, columns=["event_id"])
    counts = records.groupBy(DATE_COLUMN).agg(
        F.count("*").alias("rows"), F.sum("event_id").alias("event_id_sum"))
    return with_date_text(counts, "rows", "event_id_sum")


# --- stored silver and gold --------------------------------------------------


@query("silver_roundtrip", f"WITH {SILVER_SQL} SELECT {SILVER_LIST} FROM silver")
def _(spark, sf_dir):
    layout = new_layout(spark, "entity")
    write_silver(silver_frame(spark, sf_dir), layout, DATE)
    return read_silver(spark, layout, DATE).select(*SILVER_FRAME)


@query("silver_scan_date", f"""
WITH {SILVER_SQL}
SELECT '{DATE}' AS ingestion_date, {SILVER_LIST} FROM silver WHERE country = '{COUNTRY}'""")
def _(spark, sf_dir):
    layout = new_layout(spark, "entity")
    records = entity(spark, sf_dir)
    older = records.where(F.col("updated_at") == "2024-01-01")
    write_silver(silver.transform(older), layout, EARLIER_DATE)
    write_silver(silver.transform(records), layout, DATE)
    stored = read_silver(spark, layout).where(F.col(DATE_COLUMN) == F.lit(DATE).cast("date"))
    return with_date_text(stored.where(F.col("country") == COUNTRY), *SILVER_FRAME)


@query("failed_rebuild", f"WITH {SILVER_SQL} SELECT {SILVER_LIST} FROM silver")
def _(spark, sf_dir):
    """A rebuild that fails in the middle of its write leaves the snapshot there was."""
    layout = new_layout(spark, "entity")
    clean = silver_frame(spark, sf_dir)
    write_silver(clean, layout, DATE)
    broken = F.when(F.xxhash64("id") % 50 == 0, F.raise_error(F.lit("a task fails"))).otherwise(F.col("name"))
    try:
        write_silver(clean.withColumn("name", broken), layout, DATE)
    except PySparkException:
        return read_silver(spark, layout, DATE).select(*SILVER_FRAME)
    raise AssertionError("the rebuild did not fail")


@query("gold_roundtrip", f"WITH {LAYERS_SQL} SELECT {GOLD_LIST} FROM gold")
def _(spark, sf_dir):
    layout = new_layout(spark, "entity")
    write_gold(gold.aggregate(silver_frame(spark, sf_dir)), layout, DATE)
    return read_gold(spark, layout, DATE).select(*GOLD_FRAME)


@query("gold_scan_date", f"""
WITH {LAYERS_SQL}
SELECT '{DATE}' AS ingestion_date, {GOLD_LIST} FROM gold""")
def _(spark, sf_dir):
    layout = new_layout(spark, "entity")
    counts = gold.aggregate(silver_frame(spark, sf_dir))
    write_gold(counts.where(F.col("country") == COUNTRY), layout, EARLIER_DATE)
    write_gold(counts, layout, DATE)
    return with_date_text(read_gold(spark, layout, DATE), *GOLD_FRAME)


# --- runs over all layers ----------------------------------------------------


@query("medallion_end_to_end", f"WITH {LAYERS_SQL} SELECT {GOLD_LIST} FROM gold")
def _(spark, sf_dir):
    layout = new_layout(spark, "entity")
    date = run(spark, layout, entity_pages(entity(spark, sf_dir)), DATE)
    return read_gold(spark, layout, date).select(*GOLD_FRAME)


@query("layer_counts", f"""
WITH {LAYERS_SQL}
SELECT 'bronze' AS layer, '{DATE}' AS ingestion_date, count(*) AS "rows" FROM entity
UNION ALL SELECT 'silver', '{DATE}', count(*) FROM silver
UNION ALL SELECT 'gold', '{DATE}', count(*) FROM gold""")
def _(spark, sf_dir):
    layout = new_layout(spark, "entity")
    run(spark, layout, entity_pages(entity(spark, sf_dir)), DATE)
    return with_date_text(layer_counts(spark, layout), "layer", "rows")


def schema_rows(layer, date, columns):
    """Rows of (column, type) pairs; counts are the only columns without nulls."""
    return [f"('{layer}', '{date}', {n}, '{c}', '{t}', {c != COUNT_COLUMN})" for n, (c, t) in enumerate(columns, start=1)]


def stored_columns(names):
    """Folder columns follow those of the files."""
    names = [*[n for n in names if n not in LOCATION_COLUMNS], *LOCATION_COLUMNS]
    return [(n, "double" if n in COORDINATE_COLUMNS else "string") for n in names]


SCHEMA_ROWS = [
    *schema_rows("bronze", DATE, [
        ("brewery_type", "string"), ("country", "string"), ("id", "string"), ("latitude", "string"),
        ("longitude", "bigint"), ("name", "string"), ("parts", "struct<flag:boolean,share:double>"),
        ("state", "string"), ("updated_at", "string")]),
    *schema_rows("silver", DATE, stored_columns(SILVER_COLUMNS)),
    *schema_rows("silver", EARLIER_DATE, stored_columns(SILVER_FRAME)),
    f"('silver', '{EARLIER_DATE}', 5, 'latitude', 'string', TRUE)",
    *schema_rows("gold", DATE, [
        ("brewery_type", "string"), ("breweries_count", "bigint"), ("country", "string"), ("state", "string")]),
]


@query("layer_schemas", f"""
SELECT layer, ingestion_date, position, "column", "type", nullable
FROM (VALUES {", ".join(SCHEMA_ROWS)}) AS s(layer, ingestion_date, position, "column", "type", nullable)
WHERE EXISTS (SELECT 1 FROM customer)""")
def _(spark, sf_dir):
    """Records with numbers and an object; on the earlier date, files of silver that disagree."""
    layout = new_layout(spark, "entity")
    number = F.col("longitude").cast("int")
    parts = F.expr("struct(longitude % 2 = 0 AS flag, longitude / 8 AS share)")
    records = entity(spark, sf_dir).withColumns({"parts": parts, "longitude": number})
    run(spark, layout, entity_pages(records), DATE)
    clean = silver_frame(spark, sf_dir)
    write_silver(clean, layout, EARLIER_DATE)
    as_text = clean.withColumn("latitude", F.col("latitude").cast("string"))
    as_text.write.mode("append").partitionBy("country", "state").parquet(snapshot_path(layout.silver, EARLIER_DATE))
    return with_date_text(layer_schemas(spark, layout), "layer", "position", "column", "type", "nullable")


@query("imported_pages", f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date, {PAGE_SQL} AS page, {EVENT_COLUMNS_SQL} FROM events""")
def _(spark, sf_dir):
    """Loose files of all dates, compacted into the page table and read from there."""
    source, glob = loose_pages(spark, sf_dir)
    target = new_layout(spark, "events")
    import_pages(spark, source, target, glob=glob)
    records = read_bronze(spark, target, schema=EVENT_SCHEMA)
    return event_rows(records, F.col(DATE_COLUMN).cast("string").alias(DATE_COLUMN), "page")


@query("rerun_idempotent", f"WITH {SILVER_SQL}," + """
corrected AS (
  SELECT * FROM entity
  WHERE updated_at = '2024-01-01' AND coalesce(trim(country), '') <> 'ASIA'),""" + silver_sql(
    "corrected", "second") + f"""
SELECT '{EARLIER_DATE}' AS ingestion_date, {SILVER_LIST} FROM silver
UNION ALL
SELECT '{DATE}' AS ingestion_date, {SILVER_LIST} FROM second""")
def _(spark, sf_dir):
    """The second run of a date has older names and no country ASIA; only it remains."""
    layout = new_layout(spark, "entity")
    records = entity(spark, sf_dir)
    in_asia = F.coalesce(F.trim("country"), F.lit("")) == COUNTRY
    corrected = records.where((F.col("updated_at") == "2024-01-01") & ~in_asia)
    for date, given in [(EARLIER_DATE, records), (DATE, records), (DATE, corrected)]:
        land_pages(entity_pages(given), layout, date)
        silver.build(spark, layout, date)
    return with_date_text(read_silver(spark, layout), *SILVER_FRAME)
