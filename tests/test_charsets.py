"""Pages in every character set that JSON may be stored in."""

from pathlib import Path

import pytest

from tests.pages import DATE, record, text_of
from tierlake.layout import Layout
from tierlake.plans import silver
from tierlake.sources import (
    json_text, read_bronze, read_meta, read_pages, read_quarantine, read_silver)

MARKS = {
    "utf-8": b"\xef\xbb\xbf", "utf-16-le": b"\xff\xfe", "utf-16-be": b"\xfe\xff",
    "utf-32-le": b"\xff\xfe\0\0", "utf-32-be": b"\0\0\xfe\xff",
}
CASES = [(name, mark) for name in MARKS for mark in (True, False)]


def write(folder, files):
    path = Path(folder, "bronze", "items", f"ingestion_date={DATE}")
    path.mkdir(parents=True)
    for name, content in files.items():
        (path / name).write_bytes(content)
    return Layout(str(folder), "items")


def encoded(text, name, mark):
    return (MARKS[name] if mark else b"") + text.encode(name)


def test_every_character_set(spark, tmp_path):
    texts = [text_of([record(str(n), name="Ärger ☃ 😀 �"), record(f"{n}b")]) for n in range(len(CASES))]
    files = {f"page={n}.json": encoded(text, *case) for n, (text, case) in enumerate(zip(texts, CASES))}
    layout = write(tmp_path, files)
    rows = read_pages(spark, layout, DATE, loose=True).collect()
    assert {r["page"]: (r["payload"], r["n_rows"]) for r in rows} == {n: (t, 2) for n, t in enumerate(texts)}
    names = {r["name"] for r in read_bronze(spark, layout, DATE, loose=True).where("id NOT LIKE '%b'").collect()}
    assert names == {"Ärger ☃ 😀 �"}
    assert read_quarantine(spark, layout, DATE, loose=True).count() == 0
    silver.build(spark, layout, DATE, loose=True)
    assert read_silver(spark, layout, DATE).count() == 2 * len(CASES)


def test_bytes_that_are_no_text_are_set_aside(spark, tmp_path):
    half = '[{"id":"\ud800"}]'.encode("utf-16-le", "surrogatepass")
    files = {
        "page=1.json": b'[{"id":"\xff\xfe"}]', "page=2.json": b"\xff\xfe" + half, "page=3.json": half,
        "page=4.json": '[{"id":"4"}]'.encode("utf-16-le")[:-1], "page=5.json": '[{"id":"5"}]'.encode("utf-32-be")[:-3],
        "page=6.json": '[{"id":"6"}]'.encode("latin-1"), "page=7.json": '[{"id":"é"}]'.encode("latin-1"),
        "page=8.json": b"", "page=9.json": b"\xef\xbb\xbf", "page=10.json": b"\xff\xfe", "page=11.json": b"[",
    }
    layout = write(tmp_path, files)
    assert [r["id"] for r in read_bronze(spark, layout, DATE, loose=True).collect()] == ["6"]
    bad = {r["page"]: r["payload"] for r in read_quarantine(spark, layout, DATE, loose=True).collect()}
    assert sorted(bad) == [1, 2, 3, 4, 5, 7, 9, 10, 11]
    assert bad[7] == '[{"id":"�"}]' and bad[9] == "" and bad[11] == "["


def test_options_of_the_session_stay(spark, tmp_path):
    keys = ["spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction"]
    layout = write(tmp_path, {"page=1.json": '[{"id":"1"}]'.encode("utf-16")})
    before = [spark.conf.get(k) for k in keys]
    pages = read_pages(spark, layout, DATE, loose=True)
    assert [spark.conf.get(k) for k in keys] == before
    assert pages.first()["n_rows"] == 1


def test_metadata_in_another_character_set(spark, tmp_path):
    layout = write(tmp_path, {"meta.json": '{"total": 3}'.encode("utf-16"), "page=1.json": b"[]"})
    assert [r["payload"] for r in read_meta(spark, layout, DATE, loose=True).collect()] == ['{"total": 3}']


@pytest.mark.parametrize("name, mark", CASES)
def test_fetched_bytes(name, mark):
    text = '[{"id":"Ä☃"}]'
    assert json_text(lambda page: encoded(text, name, mark))(1) == text
