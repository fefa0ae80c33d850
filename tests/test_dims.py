from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest

from shopgrain.operators import dims
from shopgrain.operators.star import duplicate_keys
from shopgrain.plans.model import RetailModel
from shopgrain.sources.contract import output_schema

from . import raw_tables


@pytest.fixture(scope="module")
def raw_model(spark):
    return RetailModel.of_tables(raw_tables.tables(spark))


def by_key(frame, key):
    return {row[key]: row.asDict() for row in frame.collect()}


@pytest.mark.parametrize(
    "product", ["dim_product", "dim_store", "dim_employee", "dim_date", "dim_customer", "fact_target", "customer_rfm"]
)
def test_contract(raw_model, product):
    found = getattr(raw_model, product).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in output_schema(product)]


def test_products(raw_model):
    rows = raw_model.dim_product.collect()
    assert sorted(r["SKUCode"] for r in rows) == ["A1", "B1", "C1", "D1", "D1"]  # D1 twice: two collections
    found = by_key(raw_model.dim_product.filter("SKUCode <> 'D1'"), "SKUCode")
    a, b, c = found["A1"], found["B1"], found["C1"]
    assert (a["ProductName"], a["CategoryName"], a["CategoryID"]) == ("Shirt", "Tops", 1)
    assert (a["CollectionName"], a["CollectionMonth"], a["CollectionYear"]) == ("March", 3, 2024)
    assert (a["CollectionYearMonth"], a["IsOnlineOnly"], a["PackageWeight_kg"]) == (202403, 0, D("0.126"))
    assert (b["ProductName"], b["CategoryName"], b["CollectionName"], b["ItemCode"]) == (None, None, None, "B")
    assert (c["ProductName"], c["ListPrice"], c["IsOnlineOnly"]) == (None, D("10.00"), 0)
    (d, _) = [r for r in rows if r["SKUCode"] == "D1"]
    assert (d["CategoryID"], d["CategoryName"], d["IsOnlineOnly"], d["PackageWeight_kg"]) == (9, None, 1, None)


def test_duplicate_keys_are_found(raw_model):
    assert [tuple(r) for r in duplicate_keys(raw_model.dim_product, "SKUCode").collect()] == [("D1", 2)]
    assert duplicate_keys(raw_model.dim_store, "StoreID").isEmpty()


def test_stores(raw_model):
    found = by_key(raw_model.dim_store, "StoreID")
    assert [found[s]["OwnershipType"] for s in ("S1", "S2", "S3")] == ["Directly Owned", "Franchise", "Franchise"]
    assert (found["S1"]["RegionCode"], found["S1"]["RegionName"], found["S1"]["City"]) == ("R1", "North", "Hue")
    assert (found["S2"]["City"], found["S2"]["IsFranchise"]) == (None, None)  # its master row is deleted


def test_employees(raw_model):
    found = by_key(raw_model.dim_employee, "EmpID")
    assert set(found) == {"E1", "E2", "T1", "T2", "T3"}
    assert (found["E1"]["EmpName"], found["E1"]["Role"], found["E1"]["IsActive"]) == ("Ann", "Manager", True)
    assert (found["E2"]["Role"], found["E2"]["IsActive"], found["E2"]["EndDate"]) == ("Staff", False, None)
    assert found["E1"]["StartDate"] == found["E2"]["StartDate"] == date(2020, 1, 5)
    assert [found[t]["Role"] for t in ("T1", "T2", "T3")] == ["Manager", "Staff", "Staff"]
    assert (found["T2"]["EmpName"], found["T2"]["Channel"], found["T2"]["IsActive"]) == ("Fay", "Online", True)


def test_dates(raw_model):
    found = by_key(raw_model.dim_date, "DateKey")
    assert (found[20240101]["IsWorkingDay"], found[20240101]["IsHoliday"]) == (0, 1)
    assert (found[20240105]["IsWorkingDay"], found[20240105]["IsHoliday"]) == (1, 0)
    assert (found[20241231]["IsWorkingDay"], found[20241231]["IsHoliday"]) == (0, 0)
    assert (found[20240229]["FullDate"], found[20240229]["Year"]) == (date(2024, 2, 29), 2024)


def test_customers(raw_model):
    found = by_key(raw_model.dim_customer, "CustomerID")
    assert set(found) == {"7", "8", "10"}  # without id and deleted are out
    hoa = found["7"]
    assert (hoa["CustomerName"], hoa["Phone"], hoa["Province"], hoa["Email"]) == ("Hoa B", "091", "Hue", "a@x")
    assert (hoa["Gender"], hoa["New_Gender"]) == ("nữ ", "Nữ")
    assert (hoa["DistrictID"], hoa["WardID"]) == ("7", "3")  # largest as text; 1.5 is no number
    assert (hoa["BirthDate"], hoa["IsWholesaler"], hoa["TotalOrders"]) == (date(1990, 1, 2), True, 2)
    assert (hoa["Height_cm"], hoa["Weight_kg"], hoa["WaistSize_cm"]) == (D("161.0"), D("50.0"), None)
    assert (hoa["FirstOrderDate"], hoa["LastOrderDate"]) == (date(2024, 1, 5), date(2024, 1, 6))
    assert (found["8"]["New_Gender"], found["8"]["IsWholesaler"]) == ("Không xác định", False)
    assert found["10"]["FirstOrderDate"] is None


def test_targets(raw_model):
    rows = raw_model.fact_target.collect()
    assert len(rows) == 7
    store = next(r for r in rows if r["StoreID"] == "S1" and r["DateKey"] == 20240101)
    assert (store["StoreName"], store["RegionName"], store["StoreType"], store["AM_Name"]) == ("Store 1", "North", "T", "Ann")
    assert (store["Channel"], store["ChannelGroup"], store["TargetRevenue"]) == ("RMS", "Offline", D("1000.00"))
    online = {r["DateKey"]: r for r in rows if r["Channel"] == "GMC"}
    assert online[20240101]["StoreName"] == "GMC Telesales"
    assert (online[20240101]["TargetAOV"], online[20240101]["TargetOrders"], online[20240101]["TargetItems"]) == (D("80.56"), 10, 20)
    assert (online[20240201]["TargetAOV"], online[20240201]["TargetOrders"], online[20240201]["TargetItems"]) == (None, None, None)
    ecom = [r for r in rows if r["Channel"] == "Ecom"]
    assert sorted((r["Platform"], r["StoreName"]) for r in ecom) == [("Lazada", "Lazada"), ("Shopee", "Shopee")]


def test_built_calendar(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2023-12-25', DATE'2024-03-01')) AS date")
    found = by_key(dims.dim_date(dims.build_calendar(days)), "DateKey")
    assert len(found) == 68
    new_year, leap, sunday = found[20240101], found[20240229], found[20231231]
    assert (new_year["IsHoliday"], new_year["IsWorkingDay"], new_year["DateName"]) == (1, 0, "Thứ 2")
    assert (new_year["WeekOfYear"], new_year["WeekNumber"], new_year["YearQuarter"]) == (1, "W1", "2024-Q1")
    assert (new_year["MonthName"], new_year["QuarterName"], new_year["WeekName"]) == ("Tháng 1", "Quý 1", "01/01/2024 - 07/01/2024")
    assert (sunday["DateName"], sunday["WeekOfYear"], sunday["WeekStartDate"]) == ("Chủ nhật", 52, date(2023, 12, 25))
    assert (leap["DayOfMonth"], leap["IsWorkingDay"], leap["WeekEndDate"]) == (29, 1, date(2024, 3, 3))
