"""Storage: round trips, reruns, runs over all layers, invariants."""

import datetime as dt
import random
import tempfile
from types import SimpleNamespace

import pytest
from pyarrow import parquet

from tests.compare import spark_rows
from tests.pages import DATE, page_frame, record, stored
from tierlake.layout import Layout, snapshot_path, today_utc
from tierlake.operators import sample_rows
from tierlake.plans import gold, layer_counts, run, silver
from tierlake.schemas import GOLD, SILVER
from tierlake.session import (
    INITIAL_PARTITIONS,
    scratch_dir,
    shuffles_sized_for,
    skimming_scans,
    use_local_scratch,
)
from tierlake.sinks import (
    land_dated_pages,
    land_meta,
    land_pages,
    load_stats,
    write_silver,
    write_snapshot,
)
from tierlake.sources import (
    page_count,
    read_gold,
    read_layer,
    read_meta,
    read_pages,
    read_quarantine,
    read_silver,
)


def random_pages(seed, pages=6, size=30):
    """Records with repeated and missing keys, blanks and bad numbers, and a broken page."""
    pick = random.Random(seed).choice
    made = [
        [
            record(
                pick([None, *map(str, range(60))]),
                name=pick(["a", " b ", None]),
                brewery_type=pick(["micro", "large", None]),
                country=pick(["Chile", " Peru ", "", None]),
                state=pick(["01", "Maule", "  ", None]),
                latitude=pick(["1.5", "bad", None, 2]),
                updated_at=pick(["2024-01-01", "2024-06-01", None]),
            )
            for _ in range(size)
        ]
        for _ in range(pages)
    ]
    return [*made, '[{"id": ']


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_invariants(spark, tmp_path, seed):
    pages = random_pages(seed)
    layout = Layout(str(tmp_path), "items")
    assert run(spark, layout, page_frame(spark, pages), DATE) == DATE
    stats = load_stats(spark, layout, DATE).first()
    assert (stats["pages"], stats["unreadable_pages"], stats["rows"]) == (7, 1, 180)
    clean = read_silver(spark, layout, DATE).toPandas()
    ids = {r["id"] for page in pages[:-1] for r in page}
    assert len(clean) == len(ids) and set(clean["id"].dropna()) == ids - {None}
    assert not clean[["country", "state"]].isna().any().any()
    assert not (clean["country"] == "").any()
    counts = read_gold(spark, layout, DATE).toPandas()
    assert counts["breweries_count"].sum() == len(clean)
    assert not counts.duplicated(["country", "state", "brewery_type"]).any()
    layers = {r["layer"]: r["rows"] for r in layer_counts(spark, layout, DATE).collect()}
    assert layers == {"bronze": 180, "silver": len(clean), "gold": len(counts)}


def test_written_layers_read_back_equal(spark, tmp_path):
    layout = stored(spark, tmp_path, random_pages(5), False)
    silver.build(spark, layout, DATE)
    clean = read_silver(spark, layout, DATE)
    assert clean.columns == [*SILVER.names, "ingestion_date"]
    assert dict(clean.dtypes)["latitude"] == "double" and dict(clean.dtypes)["state"] == "string"
    assert {r["ingestion_date"] for r in clean.collect()} == {dt.date.fromisoformat(DATE)}
    gold.build(spark, layout, DATE)
    stored_counts = read_gold(spark, layout, DATE).drop("ingestion_date")
    assert stored_counts.dtypes == [(f.name, f.dataType.simpleString()) for f in GOLD]
    assert spark_rows(stored_counts) == spark_rows(gold.aggregate(clean))


def test_rerun_replaces_its_date_only(spark, tmp_path):
    layout = Layout(str(tmp_path), "items", "summary")
    first = [[record("1", country="Peru")], [record("2")], [record("3")]]
    run(spark, layout, page_frame(spark, first), "2025-02-28")
    run(spark, layout, page_frame(spark, first), DATE)
    other = [spark_rows(read(spark, layout, "2025-02-28")) for read in (read_pages, read_silver, read_gold)]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        run(spark, layout, page_frame(spark, [[record("4", name="only")]]), DATE)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["page"] for r in read_pages(spark, layout, DATE).collect()] == [1]
    assert [r["id"] for r in read_silver(spark, layout, DATE).collect()] == ["4"]
    assert [r["country"] for r in read_gold(spark, layout, DATE).collect()] == ["Chile"]
    assert other == [
        spark_rows(read(spark, layout, "2025-02-28")) for read in (read_pages, read_silver, read_gold)
    ]
    assert read_silver(spark, layout).count() == 4


def test_hot_partition_is_split_over_tasks(spark, tmp_path):
    """A third of the rows has one location; its size decides on the number of files."""
    rows = spark.range(60_000).selectExpr(
        "string(id) AS id", "sha2(string(id), 256) AS name",
        "if(id % 3 = 0, 'Hot', concat('C', id % 40)) AS country", "'S' AS state",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        write_silver(rows, Layout(str(tmp_path), "items"), DATE)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    folder = tmp_path / "silver" / "items" / f"ingestion_date={DATE}"
    assert len(list(folder.glob("country=Hot/state=S/*.parquet"))) > 3
    assert len(list(folder.glob("country=C1/state=S/*.parquet"))) <= 3
    assert read_silver(spark, Layout(str(tmp_path), "items"), DATE).count() == 60_000


def test_gold_in_another_format(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    run(spark, layout, page_frame(spark, [[record("1")]]), DATE, fmt="orc")
    assert [r["breweries_count"] for r in read_gold(spark, layout, DATE, "orc").collect()] == [1]
    with pytest.raises(ValueError, match="one date"):
        read_gold(spark, layout, fmt="delta")


def test_any_text_can_name_a_folder(spark, tmp_path):
    names = ["a/b", "x=y", "100%", "Ünï côdé", "2025-01-01", "007", "null", "it's", "a:b*c?", "__x"]
    layout = Layout(str(tmp_path), "items")
    page = [record(str(n), country=name, state=name) for n, name in enumerate(names)]
    run(spark, layout, page_frame(spark, [page]), DATE)
    rows = {int(r["id"]): (r["country"], r["state"]) for r in read_silver(spark, layout, DATE).collect()}
    assert rows == {n: (name, name) for n, name in enumerate(names)}
    assert {r["country"] for r in read_gold(spark, layout, DATE).collect()} == set(names)


def test_run_with_nothing_readable(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    run(spark, layout, page_frame(spark, ["[{", "oops"]), DATE)
    assert read_quarantine(spark, layout, DATE).count() == 2
    assert read_silver(spark, layout, DATE).count() == 0
    assert read_gold(spark, layout, DATE).count() == 0


def test_empty_snapshot_reads_as_no_rows(spark, tmp_path):
    nothing = spark.createDataFrame([], SILVER)
    write_snapshot(nothing, str(tmp_path), DATE, ["country", "state"])
    assert read_layer(spark, str(tmp_path), SILVER, DATE).count() == 0


def test_metadata(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    land_meta(spark, {"total": "900"}, layout, DATE)
    land_meta(spark, {}, layout, DATE)
    assert read_meta(spark, layout, DATE).count() == 0
    land_meta(spark, {"total": "401", "by": "Ä"}, layout, DATE)
    assert read_meta(spark, layout, DATE).first()["payload"] == '{"total": "401", "by": "Ä"}'
    row = page_count(read_meta(spark, layout, DATE), 200).first()
    assert (row["total_rows"], row["pages"]) == (401, 3)


def test_run_without_a_date_is_today(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    before = today_utc()
    date = run(spark, layout, page_frame(spark, [[record("1")]]), metadata={"total": 1})
    assert date in (before, today_utc())
    assert read_silver(spark, layout, date).count() == 1
    assert read_meta(spark, layout, date).count() == 1
    assert len(sample_rows(read_gold(spark, layout, date), 5).collect()) == 1


def test_layout():
    layout = Layout("s3a://", "items")
    assert layout.bronze == "s3a://bronze/items"
    assert layout.meta == "s3a://bronze/items_meta"
    assert layout.silver == "s3a://silver/items"
    assert layout.gold == "s3a://gold/items_agg"
    assert Layout("/data", "items", "summary", gold_bucket="g").gold == "/data/g/summary"
    assert snapshot_path(layout.gold, DATE) == f"s3a://gold/items_agg/ingestion_date={DATE}"
    with pytest.raises(ValueError):
        snapshot_path(layout.gold, "latest")


def test_scratch_folder_is_in_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    made = scratch_dir(spark)
    assert made != scratch_dir(spark) and made.startswith(shared.rstrip("/") + "/")


def session_with(**settings):
    """Only the settings of a session, by their last part."""
    values = {f"spark.{key.replace('_', '.')}": value for key, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=values.get, set=values.__setitem__))


def test_scratch_folder_without_a_setting():
    for master in ["local[2]", "yarn", "local-cluster[1,1,1024]"]:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_dir(session_with(master=master))
    assert scratch_dir(use_local_scratch(session_with(master="local[2]"))).startswith(tempfile.gettempdir())
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(use_local_scratch(session_with(master="yarn")))
    given = session_with(master="local", checkpoint_dir="/shared/")
    assert scratch_dir(use_local_scratch(given), "x").startswith("/shared/x-")


def test_rerun_without_metadata_leaves_none(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    run(spark, layout, page_frame(spark, [[record("1")]]), DATE, metadata={"total": 900})
    run(spark, layout, page_frame(spark, [[record("1")]]), DATE)
    assert read_meta(spark, layout, DATE).count() == 0


def test_history_is_landed_per_date(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    rows = [("2025-01-01", 1, '[{"id":"1"}]'), ("2025-01-01", 2, "[]"), ("2025-01-01", 3, '[{"id":"3"}]'),
            ("2025-01-02", 1, "[{"), ("2025-01-02", 2, '[{"id":"2"}]')]
    land_dated_pages(spark.createDataFrame(rows, "ingestion_date string, page int, payload string"), layout)
    stats = {str(r["ingestion_date"]): tuple(r)[1:] for r in load_stats(spark, layout).collect()}
    assert stats == {"2025-01-01": (1, 0, 1), "2025-01-02": (2, 1, 1)}
    again = spark.createDataFrame([("2025-01-02", 1, '[{"id":"9"}]')], "ingestion_date string, page int, payload string")
    land_dated_pages(again, layout)
    stats = {str(r["ingestion_date"]): tuple(r)[1:] for r in load_stats(spark, layout).collect()}
    assert stats == {"2025-01-01": (1, 0, 1), "2025-01-02": (1, 0, 1)}


def test_shuffle_width_follows_the_rows(spark):
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    with shuffles_sized_for(spark, 50_500_000):
        assert spark.conf.get(INITIAL_PARTITIONS) == "51"
    with shuffles_sized_for(spark, 10):
        assert spark.conf.get(INITIAL_PARTITIONS) == "8"
    with shuffles_sized_for(spark, 10**15):
        assert spark.conf.get(INITIAL_PARTITIONS) == "100000"
    assert spark.conf.get(INITIAL_PARTITIONS, None) == before


def test_skimming_scans_end_with_the_block(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), skimming_scans(spark):
        assert spark.conf.get(key) == str(16 << 30)
        raise ZeroDivisionError
    assert spark.conf.get(key) == before


def test_row_groups_hold_few_pages(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    pages = spark.range(1, 1001, 1, 1).selectExpr("int(id) AS page", "'[{\"id\":\"1\"}]' AS payload")
    land_pages(pages, layout, DATE)
    (file,) = (tmp_path / "bronze" / "items" / f"ingestion_date={DATE}").glob("*.parquet")
    footer = parquet.ParquetFile(file).metadata
    sizes = [footer.row_group(n).num_rows for n in range(footer.num_row_groups)]
    assert sum(sizes) == 1000 and max(sizes) <= 256


def test_landing_returns_what_the_write_counted(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    pages = [[record("1"), record("2")], "[{", [record("3")], [], [record("4")]]
    stats = land_pages(page_frame(spark, pages), layout, DATE)
    assert stats == {"pages": 3, "unreadable_pages": 1, "rows": 3}
    stored_stats = load_stats(spark, layout, DATE).drop("ingestion_date").first()
    assert stored_stats.asDict() == stats
