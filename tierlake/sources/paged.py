"""A paged collection as a Spark data source: every task fetches a range of pages."""

import json
import math
import time
from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, LessThan

from tierlake.functions.pages import record_count
from tierlake.sources.meta import fetch_metadata, total_pages


def url_fetch(url, timeout=10):
    """Fetch of ``url.format(page=n)`` as bytes; any URL the standard library opens."""

    def fetch(page=None):
        from urllib.request import urlopen

        with urlopen(url.format(page=page), timeout=timeout) as response:
            return response.read()

    return fetch


def retrying(fetch, max_retries=3, backoff_sec=20):
    """``fetch`` with up to ``max_retries`` attempts; the last error is raised."""
    if max_retries < 1:
        raise ValueError(f"max_retries must be at least 1, not {max_retries}")

    def attempt(*args):
        for left in reversed(range(max_retries)):
            try:
                return fetch(*args)
            except Exception:
                if not left:
                    raise
                time.sleep(backoff_sec)

    return attempt


def paced(fetch, phase, phases, rate, origin, clock=time.time, sleep=time.sleep):
    """``fetch`` that starts only at moments of its own, so that all phases together keep ``rate``.

    Time from ``origin`` (seconds of the epoch) is cut into slots of 1/rate seconds, and slot
    ``phase``, ``phase + phases``, ... belong to this phase. Each call waits for the next of them
    that has not begun, so no slot sees two calls, whenever the phases begin or fall behind.
    Phases need no contact, only clocks that agree.
    """
    every, first = phases / rate, origin + phase / rate
    turn = -1

    def wait_and_fetch(*args):
        nonlocal turn
        turn = max(turn + 1, math.ceil((clock() - first) / every))
        while (left := first + turn * every - clock()) > 0:
            sleep(left)
        return fetch(*args)

    return wait_and_fetch


def json_text(fetch):
    """``fetch`` whose reply is decoded: its JSON text, ``[]`` if there is nothing in it.

    Text is kept as received; bytes may be UTF-8, UTF-16 or UTF-32. A reply that is not JSON, blank and cut-off ones included, is an
    error, so a retry around this function asks for the page again.
    """

    def fetch_text(page):
        body = fetch(page)
        if isinstance(body, bytes):
            body = body.decode(json.detect_encoding(body))
        elif not isinstance(body, str):
            body = json.dumps(body, ensure_ascii=False)
        return body if json.loads(body) else "[]"

    return fetch_text


def paged_source(fetch, name="paged_json", max_retries=3, backoff_sec=20):
    """A data source class that calls ``fetch(page)`` in the executors.

    ``fetch`` returns the page's JSON array, as text or as Python objects. Rows
    are ``(page, payload)``; text is kept as received. A failed fetch, or a reply that is
    not JSON, is repeated; the last error ends the read. A page without rows is
    delivered as ``[]`` and ends the range it lies in. A filter ``page < n`` reaches the
    source: pages from ``n`` on are not fetched.

    Options:
      start_page      first page (1)
      total_pages     pages known from the metadata (none)
      max_pages       cap on the number of pages (none)
      pages_per_task  pages fetched by one task (50)
      max_tasks       most tasks; with more pages, each task fetches more of them (10,000)
      pause_sec       wait between the pages of a task (0.2; 0 with max_rate)
      max_rate        most requests per second of all tasks together (no limit)
      slots           with max_rate: tasks that run at the same time
      ranges          JSON list of [first, last], instead of planning

    Tasks run side by side. ``max_rate`` plans no more of them than ``slots``, and each asks in
    time slots of its own (see :func:`paced`), retries included. Where fewer tasks get to
    run at once, the rate stays lower; speculative copies of a task would share its slots.

    The end need not be known. Planning looks for an empty page past the known
    total in strides of 1, 2, 4, ... pages, so a collection that has grown, or has no
    metadata, is still laid out over many tasks. A source that has no empty page at any
    number that fits ``page`` is an error.

    The classes are local to this function so that Spark ships them by value.
    """

    def payloads(phase, phases, rate, origin):
        asked = fetch if rate is None else paced(fetch, phase, phases, rate, origin)
        return retrying(json_text(asked), max_retries, backoff_sec)

    payloads(0, 1, None, 0)  # refuses settings that make no sense
    last_page = (1 << 31) - 1

    @dataclass
    class PageRange(InputPartition):
        first: int
        last: int
        phase: int = 0
        phases: int = 1
        origin: float = 0.0

    class PageReader(DataSourceReader):
        def __init__(self, options):
            self.start = int(options.get("start_page", 1))
            self.known = int(options.get("total_pages", 0))
            cap = options.get("max_pages")
            self.end = math.inf if cap is None else self.start + int(cap) - 1
            self.step = int(options.get("pages_per_task", 50))
            self.tasks = int(options.get("max_tasks", 10_000))
            rate = options.get("max_rate")
            self.rate = None if rate is None else float(rate)
            if self.rate is not None:
                if not self.rate > 0:
                    raise ValueError(f"max_rate must be above 0, not {rate}")
                self.tasks = min(self.tasks, int(options.get("slots", 1)))
            self.pause = float(options.get("pause_sec", 0.2 if rate is None else 0))
            self.given = options.get("ranges")
            self.below = math.inf

        def pushFilters(self, filters):
            for filter in filters:
                if isinstance(filter, LessThan) and filter.attribute == ("page",):
                    self.below = min(self.below, filter.value)
                else:
                    yield filter

        def partitions(self):
            ranges = self.given_ranges() if self.given is not None else self.planned_ranges()
            ranges = ranges or [(self.start, self.start - 1)]  # Spark needs one task
            phases = min(len(ranges), self.tasks) if self.rate else 1
            origin = time.time()
            return [PageRange(*r, n % phases, phases, origin) for n, r in enumerate(ranges)]

        def given_ranges(self):
            cut = [(first, min(last, self.below - 1)) for first, last in json.loads(self.given)]
            return [(first, last) for first, last in cut if first <= last]

        def planned_ranges(self):
            known = min(max(self.known, self.start - 1), self.end)
            if self.below < math.inf:
                last = min(max(self.below - 1, self.start - 1), self.end)
            elif self.end - known <= self.step:
                last = self.end
            else:
                last = self.search_end(known)
            step = max(self.step, math.ceil((last - self.start + 1) / self.tasks))
            return [(first, min(first + step - 1, last)) for first in range(self.start, last + 1, step)]

        def search_end(self, known):
            stride, payload = 1, payloads(0, 1, self.rate, time.time())
            while known < self.end:
                probe = min(known + stride, self.end)
                if probe > last_page:
                    raise ValueError(f"no empty page up to {known}: the collection does not end")
                if payload(probe) == "[]":
                    return probe - 1
                known, stride = probe, stride * 2
            return self.end

        def read(self, partition):
            import pyarrow as pa

            schema = pa.schema([("page", pa.int32()), ("payload", pa.string())])
            payload = payloads(partition.phase, partition.phases, self.rate, partition.origin)
            for page in range(partition.first, partition.last + 1):
                if page > partition.first:
                    time.sleep(self.pause)
                text = payload(page)
                yield pa.RecordBatch.from_pydict({"page": [page], "payload": [text]}, schema)
                if text == "[]":
                    return

    class PagedJsonSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "page int, payload string"

        def reader(self, schema):
            return PageReader(self.options)

    return PagedJsonSource


def scan_options(spark, options):
    """Options of :func:`paged_source` as given, and the ``slots`` that a ``max_rate`` needs."""
    given = {key: value for key, value in options.items() if value is not None}
    if "max_rate" in given:
        given.setdefault("slots", spark.sparkContext.defaultParallelism)
    return given


def page_ranges(spark, fetch, max_retries=3, backoff_sec=20, **options):
    """``(first, last)`` of the page ranges of a collection, in order, for scans of some at a time.

    With ``max_rate`` the search for the end keeps it; the ranges are as many as without.
    """
    given = {key: str(value) for key, value in scan_options(spark, options).items()}
    given["slots"] = given.get("max_tasks", "10000")
    source = paged_source(fetch, "planned", max_retries, backoff_sec)(given)
    ranges = [(r.first, r.last) for r in source.reader(None).partitions()]
    return [(first, last) for first, last in ranges if first <= last]


def scan_pages(spark, fetch, name="paged_json", max_retries=3, backoff_sec=20, **options):
    """``(page, payload, n_rows)`` of a paged collection; see :func:`paged_source`.

    The pages are those of all ranges: the empty page that ends one, and pages of later
    ranges, are among them. Landing cuts them at the first empty page; other
    consumers call :func:`stop_at_empty`.
    """
    source = paged_source(fetch, name, max_retries, backoff_sec)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
    given = scan_options(spark, options)
    pages = spark.read.format(name).options(**given).load()
    return pages.withColumn("n_rows", record_count("payload"))


def stop_at_empty(pages):
    """The pages before the first empty one.

    A first pass finds it and brings one number to the driver; reading the result then
    fetches the pages before it, and none behind.
    """
    first = pages.where("n_rows = 0").agg(F.min("page")).first()[0]
    return pages if first is None else pages.where(F.col("page") < first)


def open_collection(
    spark, fetch, fetch_meta=None, per_page=200, total_field="total",
    max_retries=3, backoff_sec=20, **options,
):
    """``(pages, metadata)`` of a collection whose metadata tells its number of rows.

    Missing metadata is no error: the end is then searched for.
    """
    metadata = {}
    if fetch_meta is not None:
        metadata = fetch_metadata(retrying(fetch_meta, max_retries, backoff_sec))
    options.setdefault("total_pages", total_pages(metadata, per_page, total_field))
    return scan_pages(spark, fetch, max_retries=max_retries, backoff_sec=backoff_sec, **options), metadata
