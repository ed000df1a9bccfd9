"""A landing that ends early, and the total rate of requests."""

import time

import pytest
from pyspark.errors import PythonException

from tests.pages import DATE, record, text_of
from tests.test_paged import asked, collection, pages_of
from tierlake.layout import Layout
from tierlake.plans import run_collection
from tierlake.sinks import land_collection, read_ledger
from tierlake.sinks.resumable import uncovered
from tierlake.sources import latest_date, page_ranges, read_meta, read_pages, read_silver, scan_pages
from tierlake.sources.paged import paced

QUICK = {"pause_sec": 0, "backoff_sec": 0, "max_retries": 1}


def logged(folder, fetch, fails=lambda page: False):
    """``fetch`` that notes each call in a file, and fails for some pages."""

    def noted(page):
        with open(f"{folder}/asked-{page}", "a") as log:
            log.write("x")
        if fails(page):
            raise OSError(f"page {page} is down")
        return fetch(page)

    return noted


def calls(folder, name):
    path = folder / name
    path.mkdir()
    return path


def test_the_next_run_fetches_only_the_rest(spark, tmp_path):
    layout, fetch = Layout(str(tmp_path / "data"), "items"), collection(pages_of(40))
    options = {"total_pages": 40, "pages_per_task": 2, "ranges_at_once": 4, **QUICK}
    first, second = calls(tmp_path, "first"), calls(tmp_path, "second")
    with pytest.raises(PythonException, match="is down"):
        land_collection(spark, layout, DATE, logged(first, fetch, lambda page: page == 21), **options)
    # two waves of eight pages are in, the third is not
    assert sorted((r["first"], r["last"]) for r in read_ledger(spark, layout, DATE).collect()) == [
        (n, n + 1) for n in range(1, 17, 2)]
    with pytest.raises(FileNotFoundError):
        read_pages(spark, layout, DATE)
    stats = land_collection(spark, layout, DATE, logged(second, fetch), **options)
    assert stats == {"pages": 40, "unreadable_pages": 0, "rows": 80}
    fetched = asked(second)
    assert fetched.pop(41) == 1, "the end is looked for"
    assert sorted(fetched) == list(range(17, 41))
    assert {r["page"]: r["payload"] for r in read_pages(spark, layout, DATE).collect()} == {
        n: fetch(n) for n in range(1, 41)}
    assert [p.name for p in (tmp_path / "data" / "bronze" / "items").iterdir()] == [f"ingestion_date={DATE}"]


def test_unfinished_landing_leaves_the_former_snapshot(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    options = {"total_pages": 6, "pages_per_task": 1, "ranges_at_once": 2, **QUICK}
    land_collection(spark, layout, DATE, collection(pages_of(3)), **{**options, "total_pages": 3})
    with pytest.raises(PythonException):
        land_collection(spark, layout, DATE, logged(tmp_path, collection(pages_of(6)), lambda page: page == 5), **options)
    assert read_pages(spark, layout, DATE).count() == 3 and read_pages(spark, layout).count() == 3
    assert latest_date(spark, layout.bronze) == DATE
    again = calls(tmp_path, "again")
    land_collection(spark, layout, DATE, logged(again, collection(pages_of(6))), restart=True, **options)
    assert sorted(asked(again)) == [1, 2, 3, 4, 5, 6, 7] and read_pages(spark, layout, DATE).count() == 6


def test_wave_that_is_not_entered_does_not_count(spark, tmp_path):
    layout = Layout(str(tmp_path), "items")
    orphan = tmp_path / "bronze" / "items" / f"_landing-{DATE}" / "wave-77"
    orphan.mkdir(parents=True)
    (orphan / "part-0.parquet").write_text("half a file")
    assert land_collection(spark, layout, DATE, collection(pages_of(2)), **QUICK)["pages"] == 2


def test_collection_that_grows_between_the_runs(spark, tmp_path):
    """The end found by the first run is asked for again by the second."""
    layout = Layout(str(tmp_path), "items")
    options = {"pages_per_task": 4, "ranges_at_once": 1, **QUICK}
    land_collection(spark, layout, DATE, collection(pages_of(6)), **options)
    ledger = tmp_path / "bronze" / "items"
    first = calls(tmp_path, "first")
    with pytest.raises(PythonException):
        land_collection(spark, layout, DATE, logged(first, collection(pages_of(12)), lambda page: page == 11), **options)
    assert (ledger / f"_landing-{DATE}").exists()
    second = calls(tmp_path, "second")
    stats = land_collection(spark, layout, DATE, logged(second, collection(pages_of(20))), **options)
    assert stats["pages"] == 20 and not any(page in asked(second) for page in (2, 4, 6, 8))


@pytest.mark.parametrize("pages, expected", [
    ([], 0), ([[]], 0), ([[record("1")], [], [record("3")]], 1), (["[{", [record("2")]], 2),
])
def test_ends_and_unreadable_pages(spark, tmp_path, pages, expected):
    layout = Layout(str(tmp_path), "items")
    # Only replies that are JSON arrive, so a broken one is an error here and not a page.
    if any(text_of(p) == "[{" for p in pages):
        with pytest.raises(PythonException):
            land_collection(spark, layout, DATE, collection(pages), total_pages=2, **QUICK)
        return
    options = {"total_pages": len(pages), "pages_per_task": 1, "ranges_at_once": 2, **QUICK}
    assert land_collection(spark, layout, DATE, collection(pages), **options)["pages"] == expected
    assert read_pages(spark, layout, DATE).count() == expected


def test_run_over_all_layers_is_taken_up(spark, tmp_path):
    layout, fetch = Layout(str(tmp_path / "data"), "items"), collection(pages_of(9))
    scan = {"pages_per_task": 1, "ranges_at_once": 3, "pause_sec": 0}
    given = {"date": DATE, "per_page": 2, "scan": scan, "backoff_sec": 0, "max_retries": 1}
    first, second = calls(tmp_path, "first"), calls(tmp_path, "second")
    with pytest.raises(PythonException):
        run_collection(spark, layout, logged(first, fetch, lambda page: page == 8), lambda: {"total": 18}, **given)
    assert run_collection(spark, layout, logged(second, fetch), lambda: {"total": 18}, **given) == DATE
    assert sorted(asked(second)) == [7, 8, 9, 10]
    assert read_silver(spark, layout, DATE).count() == 18 and read_meta(spark, layout, DATE).count() == 1


@pytest.mark.parametrize("planned, covered, left", [
    ([(1, 10)], [], [(1, 10)]), ([(1, 10)], [(1, 10)], []), ([(1, 10)], [(3, 4), (8, 20)], [(1, 2), (5, 7)]),
    ([(1, 5), (6, 9)], [(4, 7)], [(1, 3), (8, 9)]), ([(1, 5)], [(7, 9)], [(1, 5)]), ([], [(1, 2)], []),
    ([(1, 3)], [(2, 1)], [(1, 3)]), ([(1, 9)], [(2, 6), (3, 4)], [(1, 1), (7, 9)]),
])
def test_uncovered(planned, covered, left):
    assert uncovered(planned, covered) == left


def test_slots_of_phases():
    """Three phases with calls of any length: every slot has one call at most."""
    starts = []
    for phase in range(3):
        now = [100.0 + phase * 1.7]

        def sleep(seconds, now=now):
            now[0] += seconds

        def fetch(page, now=now):
            starts.append(now[0])
            now[0] += page % 4 * 0.31

        turn = paced(fetch, phase, 3, 5, 90.0, clock=lambda now=now: now[0], sleep=sleep)
        for page in range(40):
            turn(page)
    slots = [round((at - 90) * 5, 6) for at in starts]
    assert all(abs(s - round(s)) < 1e-3 for s in slots) and len({round(s) for s in slots}) == len(slots) == 120


def test_total_rate_of_eight_tasks(spark, tmp_path):
    fetch = collection(pages_of(48))

    def stamped(page):
        with open(f"{tmp_path}/at-{page}-{time.time()}", "w"):
            return fetch(page)

    pages = scan_pages(spark, stamped, backoff_sec=0, total_pages=48, pages_per_task=1, max_rate=16, max_pages=48)
    assert pages.rdd.getNumPartitions() == 8
    began = time.time()
    assert pages.count() == 48
    at = sorted(float(f.name.split("-")[2]) for f in tmp_path.glob("at-*"))
    assert len(at) == 48 and at[-1] - at[0] > 47 / 16 - 0.2
    for first, later in zip(at, at[16:]):  # seventeen calls never fit a second
        assert later - first > 0.9
    assert time.time() - began < 30


def test_rate_bounds_retries_and_planning(spark, tmp_path):
    tries = []

    def flaky(page):
        tries.append(time.time())
        if len(tries) % 2:
            raise OSError("busy")
        return "[]" if page > 5 else '[{"id": "1"}]'

    ranges = page_ranges(spark, flaky, backoff_sec=0, pages_per_task=2, max_rate=20)
    assert ranges == [(1, 2), (3, 4), (5, 6)]
    assert all(b - a > 0.04 for a, b in zip(tries, tries[1:]))
    with pytest.raises(ValueError, match="max_rate"):
        page_ranges(spark, flaky, max_rate=0)


def test_waves_keep_the_rate(spark, tmp_path):
    """A landing with a rate has as many waves as one without, and is taken up like it."""
    layout, fetch = Layout(str(tmp_path / "data"), "items"), collection(pages_of(40))
    options = {"total_pages": 40, "pages_per_task": 2, "max_rate": 100, "backoff_sec": 0, "max_retries": 1}
    first, second = calls(tmp_path, "first"), calls(tmp_path, "second")
    with pytest.raises(PythonException, match="is down"):
        land_collection(spark, layout, DATE, logged(first, fetch, lambda page: page == 21), **options)
    assert read_ledger(spark, layout, DATE).count() == 8  # one wave of a range for each core
    assert land_collection(spark, layout, DATE, logged(second, fetch), **options)["pages"] == 40
    assert sorted(asked(second)) == list(range(17, 42))
