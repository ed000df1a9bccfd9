"""Hand-written pages in the loose layout and in the page table."""

import json
from pathlib import Path

from tierlake.layout import Layout
from tierlake.sinks import land_pages

DATE = "2025-03-01"


def text_of(page):
    return page if isinstance(page, str) else json.dumps(page, ensure_ascii=False)


def write_loose(layout, date, pages, meta=None):
    """Files ``page=N.json`` (and ``meta.json``) of one date."""
    folder = Path(layout.bronze, f"ingestion_date={date}")
    folder.mkdir(parents=True, exist_ok=True)
    for number, page in enumerate(pages, start=1):
        (folder / f"page={number}.json").write_text(text_of(page), encoding="utf-8")
    if meta is not None:
        (folder / "meta.json").write_text(json.dumps(meta))


def page_frame(spark, pages):
    rows = [(number, text_of(page)) for number, page in enumerate(pages, start=1)]
    return spark.createDataFrame(rows, "page int, payload string")


def stored(spark, folder, pages, loose, date=DATE):
    """A layout with ``pages`` as its bronze snapshot."""
    layout = Layout(str(folder), "items")
    if loose:
        write_loose(layout, date, pages)
    else:
        land_pages(page_frame(spark, pages), layout, date)
    return layout


def record(id, **fields):
    """A raw record with the columns silver needs."""
    base = {"name": f"n{id}", "country": "Chile", "state": "Maule", "latitude": None, "longitude": None}
    return {"id": id, **base, **fields}
