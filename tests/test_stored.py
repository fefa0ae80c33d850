"""Tables that lie together, months that are left out, rejects, and planned ranges."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from shopgrain.operators.settle import new_folder
from shopgrain.plans import reports, stored
from shopgrain.plans.model import RetailModel
from shopgrain.sources import rejects
from shopgrain.sources.tables import JdbcSource, planned_ranges, read_sales, sales_on, write_sales
from shopgrain.sources.together import read_together, write_together

from .test_plans import plan_of


@pytest.fixture(scope="module")
def together(spark, folder):
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in ("orders", "lineitem")}
    keyed = {"orders": (tables["orders"], "o_orderkey"), "lineitem": (tables["lineitem"], "l_orderkey")}
    path = new_folder(spark, "together")
    write_together(keyed, path, 8)
    schemas = {"orders": (tables["orders"].schema, "o_orderkey"), "lineitem": (tables["lineitem"].schema, "l_orderkey")}
    return read_together(spark, path, schemas, 8)


def test_orders_and_lines_join_without_a_shuffle(spark, folder, together):
    plan = plan_of(reports.channel_breakdown(RetailModel.of_driver_tables(spark, folder, together)))
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(Channel" in plan  # per channel only
    assert "SelectedBucketsCount: 8 out of 8" in plan and "SortMergeJoin" in plan


def test_bucketed_tables_hold_the_same_rows(spark, folder, together):
    for name, frame in together.items():
        plain = spark.read.parquet(f"{folder}/{name}.parquet")
        assert frame.exceptAll(plain).count() == 0 and frame.count() == plain.count()


def test_a_hot_order_in_bucketed_tables(spark):
    """An order with a third of all lines stays in one bucket, and its lines all count."""
    orders = spark.range(300).selectExpr("id as o", "id % 5 as kind")
    lines = spark.range(9000).selectExpr("if(id % 3 = 0, 7, id % 300) as l", "id as n")
    found = write_together({"orders": (orders, "o"), "lines": (lines, "l")}, new_folder(spark, "hot"), 4)
    per_order = found["orders"].join(found["lines"].hint("merge"), F.col("o") == F.col("l")).groupBy("o").count()
    assert "Exchange" not in plan_of(per_order)
    assert {r["o"]: r["count"] for r in per_order.collect()} == {r["l"]: r["count"] for r in lines.groupBy("l").count().collect()}


def test_the_months_of_a_quarter_are_known_from_the_calendar(spark, model, tmp_path):
    path = str(tmp_path / "sales")
    write_sales(model.fact_sales, path)
    days = model.dim_date.where("YearQuarter = '1996-Q2'")
    found = sales_on(read_sales(spark, path), days)
    plan = plan_of(found)
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", plan)
    assert found.count() == model.fact_sales.where("DateKey between 19960401 and 19960630").count() > 0
    assert {"YearQuarter", "Channel"} <= set(found.columns) and "_day" not in found.columns


RAW = [
    (1, "c", None, "1990-01-31", "20200105", "7", "150.5", "x", "n/a", " 10.00 "),
    (2, "c", None, "unknown", "2020-01-06", "n/a", None, "", " ", "ten"),
    (3, "c", None, None, "31/31/2020", "12", "1e9", "60", "60.5", None),
    (3, "c", None, None, "31/31/2020", "12", "1e9", "60", "60.5", None),
]
COLUMNS = (
    "ID long, CustomerID string, Mask string, BirthDay string, CreateDate string, DistrictID string, CustomerHeight string, "
    "CustomerWeight string, CustomerWaistSize string, ShipPrice string"
)


def test_ledger_of_rejects(spark, tmp_path):
    table = "gmc.E01OrderHeader"
    entries = rejects.ledger(spark.createDataFrame(RAW, COLUMNS), table)
    rows = sorted((r.RowKey, r.YearMonth, r.Mask, r.Texts) for r in entries.collect() if r.RowKey != "3")
    bit = {c: 1 << i for i, c in enumerate(rejects.TABLES[table].columns)}
    assert rows == [
        ("1", 202001, bit["CustomerWeight"] + bit["CustomerWaistSize"], {"CustomerWeight": "x", "CustomerWaistSize": "n/a"}),
        ("2", 202001, bit["BirthDay"] + bit["DistrictID"] + bit["ShipPrice"], {"BirthDay": "unknown", "DistrictID": "n/a", "ShipPrice": "ten"}),
    ]
    path = str(tmp_path / "rejects")
    for _ in range(2):  # the ledger of a table is replaced, not added to
        rejects.write_ledger(entries, path)
    kept = spark.read.schema(rejects.SCHEMA).parquet(path)
    found = {r.ColumnName: r.Rejects for r in rejects.counts(kept).collect()}
    assert found == {
        "BirthDay": 1, "CreateDate": 2, "DistrictID": 1, "CustomerHeight": 2, "CustomerWeight": 1, "CustomerWaistSize": 1,
        "ShipPrice": 1,
    }
    by_month = rejects.counts(kept, ["YearMonth"]).where("YearMonth is null")
    assert {r.ColumnName for r in by_month.collect()} == {"CreateDate", "CustomerHeight"}
    assert rejects.ledger(spark.createDataFrame([], COLUMNS), table).count() == 0


def test_rejects_are_what_the_products_turn_into_null(spark, model):
    """For every checked column: as many rejects as values that are there and come out null."""
    counted = {(r.Source, r.ColumnName): r.Rejects for r in stored.cast_rejects(model).collect()}
    raw = model.raw("rms.E00ItemMST")
    lost = raw.where("trim(PackageWeight) <> '' and try_cast(PackageWeight as decimal(10,3)) is null").count()
    assert counted.get(("rms.E00ItemMST", "PackageWeight"), 0) == lost > 0


def matches(predicate, key):
    if key is None:
        return "IS NULL" in predicate or predicate == "1 = 1"
    return eval(predicate.replace(" IS NULL", " == None").replace(" AND ", " and ").replace(" OR ", " or ").replace("1 = 1", "True"), {"k": key})  # noqa: S307


def test_ranges_follow_the_rows():
    rng = random.Random(1)
    for _ in range(50):
        histogram = [(first * 10, rng.choice([0, 1, 5, 40, 300])) for first in rng.sample(range(200), rng.randint(1, 60))]
        parts = rng.randint(1, 12)
        predicates = planned_ranges("k", histogram, parts)
        assert 1 <= len(predicates) <= parts
        for key in (None, -5, 2001, *(first + d for first, _ in histogram for d in (0, 3))):
            assert sum(matches(p, key) for p in predicates) == 1
        total, largest = sum(n for _, n in histogram), max(n for _, n in histogram)
        for p in predicates:
            assert sum(n for first, n in histogram if matches(p, first)) <= total / parts + 1.5 * largest + 1
    assert planned_ranges("k", [], 4) == ["1 = 1"]
    source = JdbcSource("jdbc:x", ranges={"rms.E01OrderItems": planned_ranges("ID", [(0, 5), (10, 5)], 2)})
    assert source.ranges["rms.E01OrderItems"] == ["ID < 10 OR ID IS NULL", "ID >= 10"]
    assert source.options("rms.E01OrderItems")["dbtable"] == "rms.E01OrderItems"
