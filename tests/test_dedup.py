"""One row per key against brute force on random rows."""

import random

import pytest

from tests.pages import DATE, page_frame, record, stored
from tierlake.operators import latest_per_key
from tierlake.plans import run, silver
from tierlake.sources import read_silver


def first_by_hand(rows, order):
    """Descending with nulls last by the columns ``order``, per value of column 0."""

    def rank(row):
        return [(row[i] is not None, row[i] if row[i] is not None else "") for i in order]

    best = {}
    for row in rows:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    return best


def random_rows(seed, count=3000):
    """A third of the rows under one key, a tenth without; many ties."""
    rng = random.Random(seed)

    def key():
        share = rng.random()
        return "hot" if share < 0.33 else None if share < 0.43 else str(rng.randrange(400))

    def value():
        return rng.choice([None, "", "a", "b", "B", "é"])

    return [(key(), value(), value(), value()) for _ in range(count)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("order_by", [["version", "name"], ["name"]])
def test_latest_per_key_by_hand(spark, seed, order_by):
    rows = random_rows(seed)
    columns = ["id", "version", "name", "extra"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).repartition(7)
    order = [columns.index(c) for c in order_by]
    order += [i for i in range(1, 4) if i not in order]
    best = first_by_hand(rows, order)
    collapsed = [tuple(r) for r in latest_per_key(df, "id", order_by).collect()]
    assert sorted(collapsed, key=repr) == sorted(best.values(), key=repr)
    kept = [tuple(r) for r in latest_per_key(df, "id", order_by, null_key="keep").collect()]
    expected = [r for k, r in best.items() if k is not None] + [r for r in rows if r[0] is None]
    assert sorted(kept, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("kind, versions, newest", [
    (None, ["9", "10"], "9"), ("bigint", ["9", "10"], "10"), ("bigint", ["9", "10", "x", None], "10"),
    ("bigint", ["x", "y"], "y"), ("double", ["1e3", "999.5"], "1e3"), ("double", ["-1", "-2"], "-1"),
    ("decimal(38,10)", ["0.1", "0.10", "0.09"], "0.10"), ("bigint", ["07", "7"], "7"), ("bigint", ["7", "07"], "7"),
    ("timestamp", ["2024-01-02T00:00:00+09:00", "2024-01-01T23:00:00Z"], "2024-01-01T23:00:00Z"),
    ("date", ["2024-1-2", "2024-01-10"], "2024-01-10"),
])
def test_typed_versions(spark, kind, versions, newest):
    df = spark.createDataFrame([(1, v) for v in versions], "id int, version string")
    types = {"version": kind} if kind else None
    assert [r["version"] for r in latest_per_key(df, "id", ["version"], types=types).collect()] == [newest]


def test_type_of_a_column_that_is_no_order(spark):
    with pytest.raises(ValueError, match="other"):
        latest_per_key(spark.createDataFrame([(1, "a")], "id int, version string"), "id", ["version"], types={"other": "int"})


def test_columns_of_the_input_stay(spark):
    rows = [(1, "a", 5, 6), (1, "b", 7, 8), (None, "c", 9, 10), (None, "d", 11, 12)]
    df = spark.createDataFrame(rows, "id int, name string, _rank int, _OWN int")
    kept = latest_per_key(df, "id", ["name"], null_key="keep")
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[2], rows[3]], key=str)


def test_typed_versions_through_a_build(spark, tmp_path):
    pages = [[record("1", updated_at="9", street="nine")], [record("1", updated_at=10, street="ten")]]
    layout = stored(spark, tmp_path, pages, False)
    for kind, street in [(None, "nine"), ("bigint", "ten"), ("double", "ten")]:
        silver.build(spark, layout, DATE, version_type=kind)
        assert [r["street"] for r in read_silver(spark, layout, DATE).collect()] == [street]
    run(spark, layout, page_frame(spark, pages), DATE, version_type="bigint")
    assert [r["street"] for r in read_silver(spark, layout, DATE).collect()] == ["ten"]
