"""Edge semantics on hand-written pages, for both bronze layouts."""

import shutil

import pytest
from pyspark.sql import functions as F

from tests.pages import DATE, record, stored, write_loose
from tierlake.layout import Layout
from tierlake.operators import latest_per_key, trim_strings
from tierlake.plans import gold, silver
from tierlake.sources import (
    fetch_metadata,
    latest_date,
    latest_loose_date,
    read_bronze,
    read_gold,
    read_meta,
    read_pages,
    read_quarantine,
    read_silver,
    total_pages,
)


@pytest.fixture(params=[False, True], ids=["table", "loose"])
def loose(request):
    return request.param


def clean(spark, folder, pages, loose, **options):
    layout = stored(spark, folder, pages, loose)
    silver.build(spark, layout, DATE, loose=loose, **options)
    return layout, {row["id"]: row for row in read_silver(spark, layout, DATE).collect()}


def test_bad_numbers_become_null(spark, tmp_path, loose):
    texts = {"a": "bad", "b": " 3 ", "c": "", "d": None, "e": -70.25}
    page = [record(i, latitude=t, longitude=t) for i, t in texts.items()]
    _, rows = clean(spark, tmp_path, [page], loose)
    assert {i: r["latitude"] for i, r in rows.items()} == {
        "a": None, "b": 3.0, "c": None, "d": None, "e": -70.25,
    }
    assert all(r["latitude"] == r["longitude"] for r in rows.values())


def test_newest_version_wins(spark, tmp_path, loose):
    versions = [("2024-01-05", "old"), (None, "undated"), ("2024-02-01", "new")]
    pages = [[record("1", updated_at=at, street=street)] for at, street in versions]
    _, rows = clean(spark, tmp_path, pages, loose)
    assert [r["street"] for r in rows.values()] == ["new"]


def test_order_is_by_name_without_versions(spark, tmp_path, loose):
    page = [record("1", name=name) for name in ["b", "c", None, "a"]]
    _, rows = clean(spark, tmp_path, [page], loose)
    assert rows["1"]["name"] == "c"


def test_ties_give_the_same_row_however_they_are_stored(spark, tmp_path):
    page = [record("1", street=s, city=c) for s in "xyz" for c in "pqr"]
    kept = set()
    for n, order in enumerate([page, page[::-1], page[4:] + page[:4]]):
        _, rows = clean(spark, tmp_path / str(n), [[row] for row in order], False)
        kept.add((rows["1"]["street"], rows["1"]["city"]))
    assert kept == {("z", "r")}


@pytest.mark.parametrize("broken", ['[{"id": broken', '[{"id":"5"},{"id":"6","na', "<html>", "[1, 2]"])
def test_unreadable_page_is_set_aside_whole(spark, tmp_path, loose, broken):
    pages = [[record("1")], broken, [record("2"), record("3")]]
    layout, rows = clean(spark, tmp_path, pages, loose)
    assert sorted(rows) == ["1", "2", "3"]
    bad = read_quarantine(spark, layout, DATE, loose=loose).collect()
    assert [(r["page"], r["payload"]) for r in bad] == [(2, broken)]


def test_records_that_are_null_are_no_rows(spark, tmp_path, loose):
    layout = stored(spark, tmp_path, ["[null]" if loose else [record("0")], [record("1"), None]], loose)
    rows = read_bronze(spark, layout, DATE, loose=loose).where("page = 2").collect()
    assert [r["id"] for r in rows] == ["1"]
    counts = {r["page"]: r["n_rows"] for r in read_pages(spark, layout, DATE, loose=loose).collect()}
    assert counts[2] == 1


def test_pages_after_an_empty_one_are_ignored(spark, tmp_path):
    layout = stored(spark, tmp_path, [[record("1")], [], [record("3")], [], [record("5")]], False)
    assert [r["page"] for r in read_pages(spark, layout, DATE).collect()] == [1]
    assert read_quarantine(spark, layout, DATE).count() == 0


def test_empty_last_page_is_not_stored(spark, tmp_path):
    layout = stored(spark, tmp_path, [[record("1")], [record("2")], []], False)
    assert sorted(r["page"] for r in read_pages(spark, layout, DATE).collect()) == [1, 2]


def test_null_ids(spark, tmp_path):
    page = [record(None, name=name) for name in "abc"] + [record("1")]
    _, rows = clean(spark, tmp_path / "collapse", [page], False)
    assert sorted((r["id"] or "-", r["name"]) for r in rows.values()) == [("-", "c"), ("1", "n1")]
    layout, _ = clean(spark, tmp_path / "keep", [page], False, null_key="keep")
    names = [r["name"] for r in read_silver(spark, layout, DATE).collect()]
    assert sorted(names) == ["a", "b", "c", "n1"]


def test_unknown_null_key_rule(spark):
    with pytest.raises(ValueError, match="null_key"):
        latest_per_key(spark.range(1), "id", [], null_key="drop")


def test_missing_locations_survive_storage(spark, tmp_path, loose):
    page = [record(str(n), country=c, state=c) for n, c in enumerate(["", "  ", None, " Peru "])]
    layout, rows = clean(spark, tmp_path, [page], loose)
    assert {i: (r["country"], r["state"]) for i, r in rows.items()} == {
        "0": ("Unknown",) * 2, "1": ("Unknown",) * 2, "2": ("Unknown",) * 2, "3": ("Peru", "Peru"),
    }
    gold.build(spark, layout, DATE)
    counts = {r["country"]: r["breweries_count"] for r in read_gold(spark, layout, DATE).collect()}
    assert counts == {"Unknown": 3, "Peru": 1}


def test_blank_location_can_be_kept(spark):
    df = spark.createDataFrame([("", None)], "country string, state string")
    raw = df.select("*", *[F.lit("1").alias(c) for c in ("id", "name", "latitude", "longitude")])
    row = silver.transform(raw, blank_is_null=False).first()
    assert (row["country"], row["state"]) == ("", "Unknown")


def test_numeric_states_stay_text(spark, tmp_path):
    page = [record("a", state="01"), record("b", state="02")]
    _, rows = clean(spark, tmp_path, [page], False)
    assert (rows["a"]["state"], rows["b"]["state"]) == ("01", "02")


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([("  \tz\t ", " y ", 7)], "name string, city string, phone int")
    row = trim_strings(df).first()
    assert tuple(row) == ("\tz\t", " y", "7")


def test_newest_date_skips_what_holds_no_rows(spark, tmp_path):
    layout = stored(spark, tmp_path, [[record("1")]], False, "2025-02-28")
    stored(spark, tmp_path, [[record("1")]], False, "2025-03-01")
    stored(spark, tmp_path, [[]], False, "2025-03-02")
    for name in ["2025-03-09", "latest", "2025-13-45"]:
        (tmp_path / "bronze" / "items" / f"ingestion_date={name}").mkdir()
    assert latest_date(spark, layout.bronze) == "2025-03-01"
    assert {r[0] for r in read_pages(spark, layout).select("page").collect()} == {1}


def test_newest_date_does_not_open_older_ones(spark, tmp_path):
    layout = stored(spark, tmp_path, [[record("1")]], False, "2025-03-01")
    older = tmp_path / "bronze" / "items" / "ingestion_date=2025-02-01"
    older.mkdir()
    (older / "part-0.parquet").write_text("no parquet at all")
    assert latest_date(spark, layout.bronze) == "2025-03-01"


def test_impossible_dates_have_no_rows(spark, tmp_path):
    layout = stored(spark, tmp_path, [[record("1")]], False, "2025-03-01")
    base = tmp_path / "bronze" / "items"
    shutil.copytree(base / "ingestion_date=2025-03-01", base / "ingestion_date=2025-13-45")
    assert [str(r["ingestion_date"]) for r in read_pages(spark, layout).collect()] == ["2025-03-01"]


def test_newest_date_ignores_pages_in_other_folders(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    write_loose(layout, "2025-03-01", [[record("1")]])
    write_loose(layout, "latest", [[record("2")]])
    write_loose(layout, "2025-03-02", [], meta={"total": 1})
    assert latest_loose_date(spark, layout.bronze) == "2025-03-01"
    rows = read_bronze(spark, layout, loose=True).collect()
    assert [(r["id"], str(r["ingestion_date"])) for r in rows] == [("1", "2025-03-01")]


def test_no_snapshot_at_all(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    with pytest.raises(FileNotFoundError):
        latest_date(spark, layout.bronze)
    (tmp_path / "bronze" / "items" / "other").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        latest_date(spark, layout.bronze)
    with pytest.raises(FileNotFoundError):
        latest_loose_date(spark, layout.bronze)


def test_missing_snapshot_is_named(spark, tmp_path, loose):
    layout = stored(spark, tmp_path, [[record("1")]], loose)
    with pytest.raises(FileNotFoundError, match="2025-04-01"):
        silver.build(spark, layout, "2025-04-01", loose=loose)
    with pytest.raises(FileNotFoundError, match="2025-04-01"):
        gold.build(spark, layout, "2025-04-01")


def test_snapshot_without_pages_is_named(spark, tmp_path, loose):
    layout = Layout(str(tmp_path), "items")
    if loose:
        write_loose(layout, DATE, [], meta={"total": 0})
    else:
        stored(spark, tmp_path, [[]], False)
    with pytest.raises(FileNotFoundError, match=DATE):
        silver.build(spark, layout, DATE, loose=loose)


def test_metadata_is_not_read_as_a_page(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    write_loose(layout, DATE, [[record("1")], [record("2")]], meta={"total": 2})
    assert sorted(r["id"] for r in read_bronze(spark, layout, DATE, loose=True).collect()) == ["1", "2"]
    assert [r["payload"] for r in read_meta(spark, layout, DATE, loose=True).collect()] == ['{"total": 2}']


def test_types_may_drift_between_pages(spark, tmp_path, loose):
    without = record("3")
    del without["latitude"]
    pages = [[record("1", latitude=1.25)], [record("2", latitude="2.5")], [without]]
    _, rows = clean(spark, tmp_path, pages, loose)
    assert [rows[i]["latitude"] for i in "123"] == [1.25, 2.5, None]


def test_text_of_values_that_are_no_strings(spark, tmp_path, loose):
    page = '[{"id": 7, "name": {"x": 1}, "street": true, "city": 1e3, "phone": 12345678901234567890}]'
    layout = stored(spark, tmp_path, [page], loose)
    row = read_bronze(spark, layout, DATE, loose=loose).first()
    assert (row["id"], row["name"], row["street"]) == ("7", '{"x":1}', "true")
    assert (row["city"], row["phone"]) == ("1000.0", "12345678901234567890")


def test_same_rows_without_ansi_mode(spark, tmp_path, loose):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        pages = [[record("1", latitude="bad"), record("1", latitude="2")], '[{"id": broken', [record("2")]]
        layout, rows = clean(spark, tmp_path, pages, loose)
        counts = {r["page"]: r["n_rows"] for r in read_pages(spark, layout, DATE, loose).collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert {i: r["latitude"] for i, r in rows.items()} == {"1": 2.0, "2": None}
    assert counts == {1: 2, 2: None, 3: 1}


def test_null_type_is_a_group(spark, tmp_path):
    page = [record("1", brewery_type=None), record("2"), record("3", brewery_type="micro")]
    layout, _ = clean(spark, tmp_path, [page], False)
    gold.build(spark, layout, DATE)
    rows = {r["brewery_type"]: r["breweries_count"] for r in read_gold(spark, layout, DATE).collect()}
    assert rows == {None: 2, "micro": 1}


def test_required_columns(spark):
    df = spark.createDataFrame([("1", "a")], "id string, name string")
    with pytest.raises(Exception, match="latitude"):
        silver.transform(df)


def test_metadata_failure_is_not_fatal():
    def fails():
        raise OSError("down")

    assert fetch_metadata(fails) == {}
    assert fetch_metadata(lambda: '{"total": 401}') == {"total": 401}
    assert total_pages({"total": "401"}, 200) == 3
    assert total_pages({}, 200) is None


@pytest.mark.parametrize("body", ["null", "[1]", "7", '"x"', [1], None, "<html>"])
def test_metadata_of_any_shape_is_not_fatal(body):
    assert fetch_metadata(lambda: body) == {}


@pytest.mark.parametrize("total", ["n/a", [], {}, float("inf"), ""])
def test_unusable_total_is_no_total(total):
    assert total_pages({"total": total}, 200) is None
