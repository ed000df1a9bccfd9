"""Physical plans: what is pruned, pushed down and limited before the shuffle."""

import pytest
from pyspark.sql import functions as F

from checks.inputs import entity
from tests.pages import DATE, page_frame, record
from tierlake.layout import Layout
from tierlake.operators import (
    count_by,
    latest_per_key,
    top_countries,
    top_regions,
    top_states,
)
from tierlake.plans import gold, run, silver
from tierlake.sources import (
    read_bronze,
    read_gold,
    read_quarantine,
    read_silver,
)

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("lake")), "items")
    run(spark, layout, page_frame(spark, [[record("1"), record("2", country="Peru")]]), DATE)
    return layout


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def scan_line(plan, name):
    return [line for line in plan.splitlines() if line.startswith(name)]


def test_location_filter_prunes_folders(spark, layout, capsys):
    rows = read_silver(spark, layout).where("country = 'Peru'")
    plan = plan_of(count_by(rows, "state"), capsys)
    assert "country" in scan_line(plan, "PartitionFilters")[0]
    assert scan_line(plan, "ReadSchema") == ["ReadSchema: struct<>"]


def test_date_filter_prunes_folders(spark, layout, capsys):
    plan = plan_of(read_silver(spark, layout).where(F.col("ingestion_date") == F.lit(DATE).cast("date")), capsys)
    assert "ingestion_date" in scan_line(plan, "PartitionFilters")[0]
    one = plan_of(read_silver(spark, layout, DATE), capsys)
    assert f"ingestion_date={DATE}" in scan_line(one, "Location")[0]


def test_gold_reads_only_the_type_column(spark, layout, capsys):
    plan = plan_of(gold.aggregate(read_silver(spark, layout, DATE)), capsys)
    assert scan_line(plan, "ReadSchema") == ["ReadSchema: struct<brewery_type:string>"]
    assert "partial_count" in plan


def test_quarantine_filter_is_pushed_down(spark, layout, capsys):
    plan = plan_of(read_quarantine(spark, layout, DATE), capsys)
    assert "IsNull(n_rows)" in scan_line(plan, "PushedFilters")[0]


def test_pages_are_parsed_once(spark, layout, capsys):
    plan = plan_of(read_bronze(spark, layout, DATE), capsys)
    assert plan.count("Arguments: inline(") == 1
    assert "from_json" not in "".join(scan_line(plan, "Condition"))
    assert "GreaterThan(n_rows,0)" in scan_line(plan, "PushedFilters")[0]


def test_one_row_per_key_leaves_each_task(spark, capsys):
    plan = plan_of(latest_per_key(entity(spark, SF_DIR), "id", ["updated_at", "name"]), capsys)
    tree = plan[: plan.index("\n\n\n")]
    limits = [n for n, line in enumerate(tree.splitlines()) if "WindowGroupLimit" in line]
    shuffle = [n for n, line in enumerate(tree.splitlines()) if "- Exchange" in line]
    assert len(limits) == 2 and limits[0] < shuffle[0] < limits[1]


def test_silver_shuffles_only_what_it_keeps(spark, layout, capsys):
    plan = plan_of(silver.transform(read_bronze(spark, layout, DATE)), capsys)
    exchange = plan[plan.index(") Exchange") :]
    columns = [line for line in exchange.splitlines() if line.startswith("Input")][0]
    assert "updated_at" in columns and "address_1" not in columns and "payload" not in columns


def test_rows_without_a_key_cost_no_second_read(spark, layout, capsys):
    raw = silver.transform(read_bronze(spark, layout, DATE), null_key="keep")
    plan = plan_of(raw, capsys)
    assert len(scan_line(plan, "Location")) == 1 and plan.count("Arguments: inline(") == 1
    tree = plan[: plan.index("\n\n\n")].splitlines()
    limits = [n for n, line in enumerate(tree) if "WindowGroupLimit" in line]
    shuffle = [n for n, line in enumerate(tree) if "- Exchange" in line]
    assert len(limits) == 2 and limits[0] < shuffle[0] < limits[1]


def test_only_wanted_columns_are_parsed(spark, layout, capsys):
    plan = plan_of(read_bronze(spark, layout, DATE, columns=["id"]), capsys)
    (inline,) = [line for line in plan.splitlines() if line.startswith("Arguments: inline(")]
    assert "id" in inline and "name" not in inline


@pytest.mark.parametrize("report", [
    lambda spark, layout: top_countries(read_silver(spark, layout, DATE)),
    lambda spark, layout: top_states(read_silver(spark, layout, DATE), "Peru"),
    lambda spark, layout: top_regions(read_gold(spark, layout, DATE)),
])
def test_reports_take_the_top_rows(spark, layout, capsys, report):
    assert "TakeOrderedAndProject" in plan_of(report(spark, layout), capsys)
