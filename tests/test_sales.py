"""Rules of the five feeds on hand-written rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest

from shopgrain.plans.model import RetailModel
from shopgrain.sources.contract import output_schema

from . import raw_tables


@pytest.fixture(scope="module")
def sales(spark):
    return RetailModel.of_tables(raw_tables.tables(spark)).fact_sales


@pytest.fixture(scope="module")
def lines(sales):
    return [row.asDict() for row in sales.collect()]


def of(lines, channel, order=None):
    found = [r for r in lines if r["Channel"] == channel and order in (None, r["OrderID"])]
    return sorted(found, key=lambda r: (r["OrderID"], r["LineID"], r["Quantity"] or 0))


def test_contract(sales):
    assert [(f.name, f.dataType) for f in sales.schema] == [(f.name, f.dataType) for f in output_schema("fact_sales")]


def test_store_lines_meet_their_order_on_both_keys(lines):
    assert len(of(lines, "RMS")) == 7  # free, exchanged and other-site lines are out, and the order without items
    assert [r["Quantity"] for r in of(lines, "RMS", "1001")] == [1, 2]
    assert {r["LineID"] for r in of(lines, "RMS", "1001")} == {"1001_A1"}  # a SKU twice shares its line id


def test_store_amounts(lines):
    _, two = of(lines, "RMS", "1001")
    assert (two["SalePrice"], two["ListPrice"], two["DiscountAmount"]) == (D("90.00"), D("100.00"), D("20"))
    assert two["GMV"] == two["NetRevenue"] == D("180")
    assert (two["PlatformFee"], two["ShippingFee"]) == (0, D("15000.00"))
    assert (two["DateKey"], two["OrderDate"], two["SuccessDate"]) == (20240105, date(2024, 1, 5), None)
    assert (two["StoreID"], two["EmpID"], two["CustomerID"], two["Platform"]) == ("S1", "E1", "C1", None)
    (unknown_discount,) = of(lines, "RMS", "1002")
    assert unknown_discount["NetRevenue"] is None and unknown_discount["ShippingFee"] is None
    (nothing_sold,) = of(lines, "RMS", "1003")
    assert (nothing_sold["SalePrice"], nothing_sold["NetRevenue"], nothing_sold["ShippingFee"]) == (D("1.01"), 0, None)


@pytest.mark.parametrize(
    ("order", "name", "flags"),
    [
        ("1001", "Done", (True, False, False)),
        ("1002", "Cancelled", (False, True, False)),
        ("1003", "Unknown", (False, False, True)),
        ("1004", None, (False, False, False)),
        ("1005", None, (False, False, False)),
    ],
)
def test_store_status(lines, order, name, flags):
    for row in of(lines, "RMS", order):
        assert row["StatusName"] == name
        assert (row["IsSuccess"], row["IsCancelled"], row["IsUnknown"]) == flags


def test_a_line_without_sku_keeps_a_line_id(lines):
    assert of(lines, "RMS", "1005")[0]["LineID"] == "1005_"


def test_telesales(lines):
    rows = {r["OrderID"]: r for r in of(lines, "GMC")}
    assert set(rows) == {"1001", "2002", "2003", "2005", "2006"}  # the deleted order is out
    first = rows["1001"]
    assert (first["LineID"], first["Platform"], first["CustomerID"], first["Quantity"]) == ("1", "GMC", "7", 2)
    assert (first["SalePrice"], first["ListPrice"], first["DiscountAmount"]) == (D("80.00"), D("100.00"), D("40"))
    assert first["GMV"] == first["NetRevenue"] == D("160")
    assert (first["SuccessDate"], first["ShippingFee"], first["OrderType"]) == (date(2024, 1, 8), D("30000.00"), "K")
    assert (first["StatusRaw"], first["StatusName"], first["IsSuccess"], first["IsUnknown"]) == ("3", "Done", True, False)
    assert (rows["2002"]["Quantity"], rows["2002"]["ShippingFee"], rows["2002"]["IsCancelled"]) == (None, None, True)
    assert rows["2003"]["NetRevenue"] == D("80.01")
    assert [rows[o]["DateKey"] for o in ("1001", "2002", "2003", "2005", "2006")] == [20240105, 20240106, None, 20240105, None]
    assert (rows["2006"]["Quantity"], rows["2006"]["SalePrice"], rows["2006"]["DiscountAmount"]) == (None, None, None)
    assert (rows["2006"]["StatusName"], rows["2006"]["IsSuccess"], rows["2006"]["IsCancelled"]) == (None, False, False)


def test_lazada(lines):
    rows = {r["OrderID"]: r for r in of(lines, "Lazada")}
    assert all(r["Quantity"] == 1 and r["PlatformFee"] == 0 and r["CustomerID"] is None for r in rows.values())
    assert [rows[o]["DiscountAmount"] for o in ("501", "502", "503")] == [D("10"), D("0"), D("0")]
    assert [rows[o]["ShippingFee"] for o in ("501", "502")] == [D("5.00"), D("0.00")]
    assert rows["501"]["NetRevenue"] == D("90") and rows["504"]["NetRevenue"] is None
    assert [rows[o]["IsSuccess"] for o in sorted(rows)] == [True, True, False, False, False]
    assert [rows[o]["IsCancelled"] for o in sorted(rows)] == [False, False, True, True, False]
    assert {r["SourceID"] for r in rows.values()} == {"Lazada"}


def test_shopee(lines):
    rows = {r["OrderID"]: r for r in of(lines, "Shopee")}
    assert [rows[o]["PlatformFee"] for o in sorted(rows)] == [D("18"), D("5"), D("0"), D("1"), D("1")]
    assert [rows[o]["NetRevenue"] for o in sorted(rows)] == [D("162"), D("175"), D("180"), D("179"), None]
    assert [rows[o]["DiscountAmount"] for o in sorted(rows)] == [D("20"), 0, 0, D("20"), D("20")]
    assert [rows[o]["IsSuccess"] for o in sorted(rows)] == [True, True, False, False, False]
    assert [rows[o]["IsCancelled"] for o in sorted(rows)] == [False, False, True, True, False]
    assert (rows["601"]["ShippingFee"], rows["602"]["ShippingFee"]) == (D("7.00"), D("0.00"))
    assert (rows["601"]["CustomerDistrict"], rows["601"]["CustomerWard"]) == ("d", "w")


def test_tiki(lines):
    rows = {r["OrderID"]: r for r in of(lines, "Tiki")}
    assert (rows["701"]["GMV"], rows["701"]["NetRevenue"], rows["701"]["DiscountAmount"]) == (D("200"), D("170"), D("30"))
    assert [rows[o]["PlatformFee"] for o in sorted(rows)] == [D("-30"), 0, 0]  # the sign stays as stored
    assert [rows[o]["DiscountAmount"] for o in sorted(rows)] == [D("30"), 0, 0]
    assert (rows["702"]["GMV"], rows["703"]["GMV"]) == (0, None)
    assert [rows[o]["IsSuccess"] for o in sorted(rows)] == [True, False, False]
    assert [rows[o]["IsCancelled"] for o in sorted(rows)] == [False, True, False]
    assert {r["OrderType"] for r in rows.values()} == {None}


def test_every_line_of_every_feed_is_there(lines):
    per_channel = {c: len(of(lines, c)) for c in ("RMS", "GMC", "Lazada", "Shopee", "Tiki")}
    assert per_channel == {"RMS": 7, "GMC": 5, "Lazada": 5, "Shopee": 5, "Tiki": 3}
