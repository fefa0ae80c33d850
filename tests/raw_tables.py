"""Small hand-written raw tables, one case per rule."""

from __future__ import annotations

import unicodedata
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from shopgrain.sources.contract import RAW, raw_schema

D = Decimal
DECOMPOSED_CANCEL = unicodedata.normalize("NFD", "Đã hủy đơn")


def day(text: str) -> datetime:
    return datetime.fromisoformat(text)


def calendar_row(key: int, working: str = "Y", holiday: str = "N") -> tuple:
    date = datetime.strptime(str(key), "%Y%m%d")
    return (
        key, date, "d", date.day, 1, "W1", "w", key // 100, date.month, "m", f"{date.year}-Q1", "q", 1, str(date.year),
        working, holiday, date.date(), date.date(),
    )


ROWS: dict[str, list[tuple]] = {
    "rms.E00ItemSKUs": [
        ("A1", "A", "red", "S", D("50.00"), D("100.00"), True, "b1", 0),
        ("A2", "A", "red", "M", D("50.00"), D("100.00"), True, "b2", 1),  # deleted
        ("B1", "B", "blue", "S", D("20.00"), D("60.00"), False, "b3", 0),  # item deleted
        ("C1", "C", "tan", "L", None, D("10.00"), True, None, 0),  # item unknown
        ("D1", "D", "tan", "L", D("1.00"), D("10.00"), True, None, 0),  # two collections in its month
        ("E1", "E", "tan", "L", D("1.00"), D("10.00"), True, None, None),  # deletion unknown
    ],
    "rms.E00ItemMST": [
        ("A", "Shirt", "1", "S24", None, "Brand", "0.1255", 3, 2024, 0),
        ("B", "Skirt", "2", "S24", 1, "Brand", "1", 3, 2024, 1),
        ("D", "Dress", "9", None, 1, "Brand", "heavy", 5, 2024, 0),  # category unknown
    ],
    "rms.E00ItemCategory": [(1, "Tops"), (2, "Bottoms")],
    "rms.E00Collection": [(3, 2024, "March"), (5, 2024, "May"), (5, 2024, "Early summer")],
    "rms.E00Store_AM": [
        ("S1", "Store 1", "E1", "Ann", " R1 ", "North ", "  TRỰC THUỘC "),
        ("S2", "Store 2", "E2", "Bob", "R2", " South", "NHƯỢNG QUYỀN"),
        ("S3", "Store 3", "E3", "Cat", None, None, None),
    ],
    "mdm.E00CORStores": [
        ("S1", False, "Hue", "d", "w", "a", "1", 0),
        ("S2", True, "Hoi An", "d", "w", "a", "2", 1),  # deleted
    ],
    "mdm.E00Employee": [
        ("E1", " Ann ", "F", "Sales", "True", "S1", "1", "1", "2020-01-05", None),
        ("E2", "Bob", "M", "Sales", "false", "S2", "False", "true", "20200105", "not known"),
        ("E3", "Cat", "F", "Sales", "1", "S3", "1", "0", None, None),  # not staff
        ("E4", "Dan", "M", "Sales", None, "S3", None, None, None, None),  # not known to be staff
    ],
    "gmc.E00EmployeeOnline": [("T1", " Eve", "Tele", "1"), ("T2", "Fay ", "Tele", "0"), ("T3", "Gus", None, "yes")],
    "mdm.E00Calendar": [
        calendar_row(20240101, "N", "Y"),
        calendar_row(20240105),
        calendar_row(20240106, "N"),
        calendar_row(20240229),
        calendar_row(20241231, None, None),
    ],
    "rms.E01OrderHeader": [
        ("1001", "S1", day("2024-01-05T10:11:12"), "E1", "C1", "Lan", "15000", 4, "POS", "Retail"),
        ("1002", "S1", day("2024-01-06"), "E1", "C2", "Mai", None, 5, "POS", None),
        ("1003", "S2", day("2024-02-29"), "E2", None, None, "junk", 0, "POS", None),
        ("1004", "S2", day("2024-02-29"), "E2", "C1", "Lan", "0", 7, "POS", None),  # no such status
        ("1005", "S2", day("2024-02-29"), "E2", "C1", "Lan", "0", None, "POS", None),  # no status
        ("1006", "S1", day("2024-02-29"), "E2", "C1", "Lan", "0", 4, "POS", None),  # no items
        ("1007", "S1", day("2024-03-15"), "E2", "C9", "Day outside the calendar", "0", 4, "POS", None),
    ],
    "rms.E01OrderItems": [
        ("1001", "S1", "A1", D("2"), "90", "100", "20", 0, 0),
        ("1001", "S1", "A1", D("1"), "100", "100", "0", 0, 0),  # the SKU again: line id is not a key
        ("1001", "S1", "B1", D("1"), "0", "60", "60", 1, 0),  # free
        ("1001", "S1", "C1", D("1"), "0", "60", "0", 0, 1),  # exchange
        ("1001", "S2", "A1", D("1"), "100", "100", "0", 0, 0),  # other site
        ("1002", "S1", "A1", D("1"), "100", "100", None, 0, 0),  # no discount known
        ("1003", "S2", "ZZ", D("0"), "1.005", "100", "0", 0, 0),  # unknown SKU, nothing sold
        ("1004", "S2", "A1", D("1"), "100", "100", "0", 0, 0),
        ("1005", "S2", None, D("1"), "100", "100", "0", 0, 0),
        ("1007", "S1", "A1", D("1"), "100", "100", "0", 0, 0),
    ],
    "rms.E00Status": [(4, "O", "Done"), (4, "P", "Paid"), (5, "O", "Cancelled"), (0, "O", "Unknown")],
    "gmc.E01OrderHeader": [
        (1001, 7, "Hoa", "090", "nữ ", "1990-01-02", "Hue", "12", "1.5", "a@x", "True", "160.25", "50", "", "2024-01-05 10:11:12.000", 0, "T1", "COD", "30000", 3, "FB", "K"),
        (2002, 7, "Hoa B", "091", "Nam", "junk", "Hanoi", "7", "3", None, "0", "161", "x", None, "20240106", 0, "T1", "COD", "1,000", 4, "FB", "K"),
        (2003, 8, "Ivy", None, "", None, None, None, None, None, None, None, None, None, "junk", 0, "T2", None, None, 3, None, None),
        (2004, 9, "Jon", None, "Nam", None, None, None, None, None, "1", None, None, None, "2024-01-05", 1, "T2", None, None, 3, None, None),  # deleted
        (2005, None, "Kim", None, "unknown", None, None, None, None, None, None, None, None, None, "2024-1-5", 0, "T2", None, None, 3, None, None),
        (2006, 10, "Lou", None, None, None, None, None, None, None, None, None, None, None, "05/01/2024", 0, "T2", None, None, 99, None, None),
    ],
    "gmc.E01OrderItemsOnline": [
        (1001, 1, "2024-01-08", "A1", " 2 ", "80", "100", "160"),
        (2002, 2, None, "A1", "12.7", "80", "100", "160"),
        (2003, 3, None, "A1", "1", "80", "100", "80.005"),
        (2004, 4, None, "A1", "1", "80", "100", "80"),
        (2005, 5, "", "A1", "1", "80", "100", "80"),
        (2006, 6, None, "A1", "", "1,000", None, None),
    ],
    "gmc.E00OrderStatus": [(3, "Done"), (4, "Cancelled")],
    "ecom.E01LazadaOrders": [
        (501, 1, "2024-01-05", "2024-01-09", "A1", "Mai", "Hue", "COD", "90", "100", D("-10"), D("5"), "delivered", "N"),
        (502, 2, "2024-01-05", None, "A1", "Mai", "Hue", "COD", "90", "100", None, None, "Delivered ", "N"),
        (503, 3, "2024-01-05", None, "A1", "Mai", "Hue", "COD", "90", "100", D("0"), None, "CANCELED", "N"),
        (504, 4, "2024-01-05", None, "A1", "Mai", "Hue", "COD", "junk", "100", None, None, "returned to seller", "N"),
        (505, 5, "2024-01-05", None, "A1", "Mai", "Hue", "COD", "90", "100", None, None, None, "N"),
    ],
    "ecom.E01ShopeeOrders": [
        ("601", 1, "2024-01-05", "2024-01-10", "A1", "An", "Hue", "d", "w", "COD", "2", "90", "100", "180", "10", "5", "3", "7", "Hoàn thành", "N"),
        ("602", 2, "2024-01-05", None, "A1", "An", "Hue", "d", "w", "COD", "2", "90", "0", "180", None, "5", None, None, "ĐÃ HOÀN TẤT", "N"),
        ("603", 3, "2024-01-05", None, "A1", "An", "Hue", "d", "w", "COD", "2", "90", None, "180", None, None, None, None, DECOMPOSED_CANCEL, "N"),
        ("604", 4, "2024-01-05", None, "A1", "An", "Hue", "d", "w", "COD", "2", "90", "100", "180", "1", None, None, None, "Đã HUỶ", "N"),
        ("605", 5, "2024-01-05", None, "A1", "An", "Hue", "d", "w", "COD", "2", "90", "100", None, "1", None, None, None, "Đang giao", "N"),
    ],
    "ecom.E01TikiOrders": [
        ("701", 1, "2024-01-05", "2024-01-07", "A1", "COD", "2", "100", "170", "-30", "Giao hàng thành công"),
        ("702", 2, "2024-01-05", None, "A1", "COD", "0", "100", "0", None, "Hủy"),
        ("703", 3, "2024-01-05", None, "A1", "COD", None, "100", "0", "junk", None),
    ],
    "rms.E00TargetStores": [
        ("20240101", "S1", " Store 1", "North ", " T", "Ann ", D("1000.00")),
        ("20240201", "S1", "Store 1", "North", "T", "Ann", D("500.00")),
        ("20240101", "S2", "Store 2", "South", "T", "Bob", D("300.00")),
    ],
    "gmc.E00Target": [("20240101", D("200.00"), "80.555", "10", "20"), ("20240201", D("200.00"), "junk", "1.5", None)],
    "ecom.E00Target": [("20240101", "Lazada", D("50.00")), ("20240101", "Shopee", D("60.00"))],
}


def tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame(ROWS[name], raw_schema(name)) for name in RAW}
