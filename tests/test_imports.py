"""Loose pages compacted into the page table, and the schema profile."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.compare import spark_rows
from tests.pages import DATE, page_frame, record, write_loose
from tierlake.layout import Layout, snapshot_path
from tierlake.plans import file_columns, layer_schemas, record_columns, run
from tierlake.sinks import import_pages, land_pages, write_silver
from tierlake.sources import read_bronze, read_meta, read_pages, read_quarantine

DATES = ["2025-01-01", "2025-01-02", "2025-01-03"]


@pytest.fixture
def layouts(tmp_path):
    source, target = Layout(str(tmp_path / "loose"), "items"), Layout(str(tmp_path / "table"), "items")
    for n, date in enumerate(DATES):
        pages = [[record(f"{date}-{p}-{r}", name="Ä☃") for r in range(3)] for p in range(20)] + [[], '[{"id": ', [record("z")]]
        write_loose(source, date, pages, meta={"total": n} if n else None)
    write_loose(source, "latest", [[record("no date")]])
    folder = tmp_path / "loose" / "bronze" / "items" / "ingestion_date=2025-01-03"
    (folder / "page=50.json").write_bytes('[{"id":"50"}]'.encode("utf-16"))
    return source, target


def test_import_equals_the_loose_pages(spark, layouts):
    source, target = layouts
    assert import_pages(spark, source, target, dates_at_once=2) == ["2025-01-02", "2025-01-03", "2025-01-01"]
    for read in (read_pages, read_bronze, read_quarantine, read_meta):
        assert spark_rows(read(spark, target)) == spark_rows(read(spark, source, loose=True))
    assert read_quarantine(spark, target).count() == 3
    stored = read_pages(spark, target)
    assert len(stored.inputFiles()) < 10 < len(read_pages(spark, source, loose=True).inputFiles())
    plan = stored.where(F.col("ingestion_date") == F.lit("2025-01-02").cast("date")).select("page")._jdf.queryExecution().toString()
    assert "binaryFile" not in plan and "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_import_goes_on_where_it_was(spark, layouts):
    source, target = layouts
    assert import_pages(spark, source, target, dates=["2025-01-02", "1999-01-01"]) == ["2025-01-02"]
    land_pages(page_frame(spark, [[record("own")]]), target, "2025-01-01")
    assert import_pages(spark, source, target) == ["2025-01-03"]
    assert read_pages(spark, target, "2025-01-01").count() == 1
    assert import_pages(spark, source, target) == []
    assert sorted(import_pages(spark, source, target, replace=True)) == DATES
    assert spark_rows(read_pages(spark, target)) == spark_rows(read_pages(spark, source, loose=True))


def test_import_replaces_metadata(spark, layouts, tmp_path):
    source, target = layouts
    import_pages(spark, source, target)
    (tmp_path / "loose" / "bronze" / "items" / "ingestion_date=2025-01-02" / "meta.json").unlink()
    import_pages(spark, source, target, replace=True)
    assert [r["payload"] for r in read_meta(spark, target).collect()] == ['{"total": 2}']


def test_import_into_its_own_folder_is_refused(spark, layouts):
    with pytest.raises(ValueError, match="other than"):
        import_pages(spark, layouts[0], layouts[0])


def test_listing_many_folders_takes_few_tasks(spark, tmp_path):
    """Each task that lists sends some 3 kB to the driver, whatever it finds."""
    source, target = Layout(str(tmp_path / "loose"), "items"), Layout(str(tmp_path / "table"), "items")
    for n in range(1, 301):
        folder = tmp_path / "loose" / "bronze" / "items" / "ingestion_date=2025-01-01" / f"page={n}"
        folder.mkdir(parents=True)
        (folder / "part-0.txt").write_text(json.dumps([record(n)]))
    context, key = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    context.setJobGroup("listings", "listings")
    try:
        pages = read_pages(spark, source, "2025-01-01", loose=True, glob="part-*")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup("listings")]
    tasks = [context.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    assert tasks and sum(tasks) <= 100
    assert spark.conf.get(key) == before
    assert import_pages(spark, source, target, glob="part-*") == ["2025-01-01"]
    stored = read_pages(spark, target)
    assert sorted(r["page"] for r in stored.collect()) == list(range(1, 301))
    assert spark_rows(stored) == spark_rows(pages)


def columns(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("ingestion_date", "position", "type").collect()]


def test_record_columns(spark, tmp_path):
    records = [
        {"id": 1, "b": 1.5, "c": None, "o": {"z": 1, "VOID": None, "d": [0.5]}, "Mixed": 1, "n": 1},
        {"id": 2, "b": 3, "t": True, "l": [1, 2], "Mixed": "x", "n": 2.5}, None,
    ]
    layout = Layout(str(tmp_path), "items")
    land_pages(page_frame(spark, [[records[0]], records[1:], "[{"]), layout, DATE)
    land_pages(page_frame(spark, [[{"id": "1"}]]), layout, "2025-01-01")
    got = columns(record_columns(read_pages(spark, layout)), "ingestion_date", "column", "type", "found")
    day = dt.date.fromisoformat(DATE)
    assert got == [(dt.date(2025, 1, 1), "id", "string", 1)] + [(day, *row) for row in [
        ("Mixed", "string", 2), ("b", "double", 2), ("c", "string", 0), ("id", "bigint", 2), ("l", "array<bigint>", 1),
        ("n", "double", 2), ("o", "struct<VOID:string,d:array<double>,z:bigint>", 1), ("t", "boolean", 1)]]
    inferred = spark.read.json(spark.createDataFrame([(json.dumps(r),) for r in records[:2]], "value string").rdd.map(lambda r: r[0]))
    mine = {(c, t) for _, c, t, _ in got[1:]}
    assert {(f.name, f.dataType.simpleString()) for f in inferred.schema} == mine


def test_files_that_disagree(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    rows = spark.createDataFrame([("1", "n", 1.0, "Chile", "a=b/c d%é")], "id string, name string, latitude double, country string, state string")
    write_silver(rows, layout, DATE)
    folder = snapshot_path(layout.silver, DATE)
    rows.withColumn("latitude", F.lit("x")).drop("name").write.mode("append").partitionBy("country", "state").parquet(folder)
    got = columns(file_columns(spark, layout.silver), "position", "column", "type", "found")
    assert sorted(got) == [
        (1, "id", "string", 2), (2, "latitude", "string", 1), (2, "name", "string", 1), (3, "country", "string", 1),
        (3, "latitude", "double", 1), (4, "country", "string", 1), (4, "state", "string", 1), (5, "state", "string", 1)]
    assert columns(file_columns(spark, layout.silver, DATE), "position", "column", "type", "found") == got


def test_schemas_of_all_layers(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    run(spark, layout, page_frame(spark, [[record("1"), record("2", country="Peru")]]), DATE, fmt="orc")
    rows = layer_schemas(spark, layout, DATE, fmt="orc").collect()
    assert {r["layer"] for r in rows} == {"bronze", "silver", "gold"}
    gold = sorted((r["position"], r["column"], r["type"]) for r in rows if r["layer"] == "gold")
    assert gold == [(1, "brewery_type", "string"), (2, "breweries_count", "bigint"), (3, "country", "string"), (4, "state", "string")]
    silver = {r["column"]: (r["type"], r["nullable"]) for r in rows if r["layer"] == "silver"}
    assert silver["latitude"] == ("double", True) and silver["state"] == ("string", True) and len(silver) == 12
