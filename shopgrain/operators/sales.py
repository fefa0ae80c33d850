"""Unified sales fact: five order feeds conformed to one line-level schema.

Each feed has one rule: given its raw columns it yields the contract columns it
knows, those of the order and those of the line, and says which rows count. The
rules are used in two ways:

* `union_feeds`  - every feed has its own raw tables; five selects are stacked.
* `conform_tagged` - the orders of all feeds lie in one table with a feed tag,
  and their lines in another. Both are scanned and joined once instead of five
  times; order columns are computed per order, before lines multiply them.

Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocabulary as words
from ..functions.clean import (
    date_key,
    is_code,
    joined_text,
    mentions,
    money,
    or_zero,
    parse_date,
    same_text,
    text,
    whole,
)
from ..sources.contract import as_column, contract_columns, output_schema


class Raw(Mapping[str, Column]):
    """Raw columns of a feed by name; `typed` ones hold dates as dates."""

    def __init__(self, columns: Mapping[str, Column], typed: frozenset[str] = frozenset()):
        self.columns, self.typed = dict(columns), typed

    @classmethod
    def of(cls, frame: DataFrame, alias: str | None = None) -> Raw:
        prefix = f"{alias}." if alias else ""
        dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
        typed = frozenset(f.name for f in frame.schema if isinstance(f.dataType, dates))
        return cls({name: F.col(prefix + name) for name in frame.columns}, typed)

    def __getitem__(self, name: str) -> Column:
        return self.columns[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.columns)

    def __len__(self) -> int:
        return len(self.columns)

    def __or__(self, other: Mapping[str, Column]) -> Raw:
        return Raw(self.columns | dict(other), self.typed | getattr(other, "typed", frozenset()))

    def day(self, name: str) -> Column:
        """The column as a date; only text has to be parsed."""
        return self[name].cast("date") if name in self.typed else parse_date(self[name])


@dataclass(frozen=True)
class FeedRule:
    """How one feed becomes sales lines."""

    name: str
    order: Callable[[Raw], dict]
    line: Callable[[Raw], dict]
    keep_order: Callable[[Raw], Column] | None = None
    keep_line: Callable[[Raw], Column] | None = None

    def order_values(self, raw: Raw) -> dict:
        labels = {
            "Channel": words.CHANNEL[self.name],
            "ChannelGroup": words.CHANNEL_GROUP[self.name],
            "Platform": words.PLATFORM[self.name],
            "IsUnknown": False,
        }
        if words.CHANNEL_GROUP[self.name] == words.TARGET_ECOM_CHANNEL:
            labels["SourceID"] = words.CHANNEL[self.name]
        return labels | self.order(raw)

    def line_values(self, raw: Raw) -> dict:
        return {"PlatformFee": 0, "ShippingFee": 0} | self.line(raw)


def _ordered_on(day: Column) -> dict:
    return {"DateKey": date_key(day), "OrderDate": day}


def _positive(value: Column) -> Column:
    return F.coalesce(value > 0, F.lit(False))


def _store_order(raw: Raw) -> dict:
    status = raw["Status"]
    return {
        "OrderID": raw["OrderCode"],
        **_ordered_on(raw.day("DocDate")),
        "StoreID": raw["SiteID"],
        "EmpID": raw["SalesNo"],
        "CustomerID": raw["CustID"],
        "CustomerName": raw["CustName"],
        "StatusRaw": text(status),
        "StatusName": raw["StatusName"],
        "IsSuccess": is_code(status, words.STORE_SUCCESS),
        "IsCancelled": is_code(status, words.STORE_CANCELLED),
        "IsUnknown": is_code(status, words.STORE_UNKNOWN),
        "SourceID": text(raw["Source"]),
        "OrderType": text(raw["OrderType"]),
    }


def _store_line(raw: Raw) -> dict:
    discount = money(raw["DiscItemValue"])
    after_discount = money(raw["Qty"]) * money(raw["StandardPrice"]) - discount
    return {
        "LineID": joined_text(raw["OrderCode"], raw["SKUCode"], "_"),
        "SKUCode": raw["SKUCode"],
        "Quantity": raw["Qty"].cast("int"),
        "SalePrice": money(raw["UnitPrice"]),
        "ListPrice": money(raw["StandardPrice"]),
        "DiscountAmount": discount,
        "GMV": after_discount,
        "NetRevenue": after_discount,
        "ShippingFee": money(raw["ShipCost"]),
    }


def _neither_free_nor_exchanged(raw: Raw) -> Column:
    return (raw["IsFreeitem"] == 0) & (raw["IsExchange"] == 0)


def _telesales_order(raw: Raw) -> dict:
    status = raw["StatusID"]
    return {
        "OrderID": text(raw["OrderID"]),
        **_ordered_on(raw.day("CreateDate")),
        "EmpID": raw["AssignTo"],
        "CustomerID": text(raw["CustomerID"]),
        "CustomerName": raw["CustomerName"],
        "CustomerProvince": raw["Provinces"],
        "PaymentMethod": text(raw["PaymentMethod"]),
        "StatusRaw": text(status),
        "StatusName": raw["StatusName"],
        "IsSuccess": is_code(status, words.TELESALES_SUCCESS),
        "IsCancelled": is_code(status, words.TELESALES_CANCELLED),
        "SourceID": text(raw["Source"]),
        "OrderType": text(raw["CategoryID"]),
    }


def _telesales_line(raw: Raw) -> dict:
    paid, listed = money(raw["UnitPrice"]), money(raw["OriginalPrice"])
    total = money(raw["Total"])
    return {
        "LineID": text(raw["ItemID"]),
        "SuccessDate": raw.day("SuccessDate"),
        "SKUCode": raw["ProductID"],
        "Quantity": whole(raw["Quantity"]),
        "SalePrice": paid,
        "ListPrice": listed,
        "DiscountAmount": (listed - paid) * money(raw["Quantity"]),
        "GMV": total,
        "NetRevenue": total,
        "ShippingFee": money(raw["ShipPrice"]),
    }


def _not_deleted(raw: Raw) -> Column:
    return raw["IsDelete"] == 0


def _lazada_order(raw: Raw) -> dict:
    status = raw["status"]
    return {
        "OrderID": text(raw["orderNumber"]),
        **_ordered_on(raw.day("createTime")),
        "CustomerName": raw["customerName"],
        "CustomerProvince": raw["shippingCity"],
        "PaymentMethod": raw["payMethod"],
        "StatusRaw": status,
        "StatusName": status,
        "IsSuccess": same_text(status, words.LAZADA_SUCCESS),
        "IsCancelled": mentions(status, words.LAZADA_CANCELLED),
        "OrderType": raw["orderType"],
    }


def _lazada_line(raw: Raw) -> dict:
    paid = money(raw["paidPrice"])
    return {
        "LineID": text(raw["orderItemId"]),
        "SuccessDate": raw.day("deliveredDate"),
        "SKUCode": raw["sellerSku"],
        "Quantity": 1,
        "SalePrice": paid,
        "ListPrice": money(raw["unitPrice"]),
        "DiscountAmount": money(F.abs(or_zero(raw["sellerDiscountTotal"]))),
        "GMV": paid,
        "NetRevenue": paid,
        "ShippingFee": money(or_zero(raw["shippingFee"])),
    }


def _shopee_order(raw: Raw) -> dict:
    status = raw["TrangThaiDonHang"]
    return {
        "OrderID": raw["MaDonHang"],
        **_ordered_on(raw.day("NgayDatHang")),
        "CustomerName": raw["TenNguoiNhan"],
        "CustomerProvince": raw["TinhThanhPho"],
        "CustomerDistrict": raw["QuanHuyen"],
        "CustomerWard": raw["PhuongXa"],
        "PaymentMethod": raw["PhuongThucThanhToan"],
        "StatusRaw": status,
        "StatusName": status,
        "IsSuccess": mentions(status, words.SHOPEE_SUCCESS),
        "IsCancelled": mentions(status, words.VIETNAMESE_CANCELLED),
        "OrderType": raw["LoaiDonHang"],
    }


def _shopee_line(raw: Raw) -> dict:
    paid, listed = money(raw["GiaUuDai"]), money(raw["GiaGoc"])
    gross = money(raw["TongGiaBanSanPham"])
    fees = [or_zero(money(raw[name])) for name in ("PhiCoDinh", "PhiDichVu", "PhiThanhToan")]
    fee = reduce(Column.__add__, fees)
    return {
        "LineID": text(raw["Id"]),
        "SuccessDate": raw.day("ThoiGianHoanThanhDonHang"),
        "SKUCode": raw["SKUSanPham"],
        "Quantity": whole(raw["SoLuong"]),
        "SalePrice": paid,
        "ListPrice": listed,
        "DiscountAmount": F.when(_positive(listed), (listed - paid) * money(raw["SoLuong"])).otherwise(0),
        "GMV": gross,
        "NetRevenue": gross - fee,
        "PlatformFee": fee,
        "ShippingFee": or_zero(money(raw["PhiVanChuyenDuKien"])),
    }


def _tiki_order(raw: Raw) -> dict:
    status = raw["TrangThai"]
    return {
        "OrderID": raw["MaDonHang"],
        **_ordered_on(raw.day("NgayDat")),
        "PaymentMethod": raw["PhuongThucThanhToan"],
        "StatusRaw": status,
        "StatusName": status,
        "IsSuccess": mentions(status, words.TIKI_SUCCESS),
        "IsCancelled": mentions(status, words.VIETNAMESE_CANCELLED),
    }


def _tiki_line(raw: Raw) -> dict:
    price = money(raw["DonGia"])
    revenue = money(raw["DoanhThu"])
    gross = price * money(raw["SLBan"])
    quantity = whole(raw["SLBan"])
    return {
        "LineID": text(raw["Id"]),
        "SuccessDate": raw.day("NgayGiaoHangThanhCong"),
        "SKUCode": raw["SSKU"],
        "Quantity": quantity,
        "SalePrice": price,
        "ListPrice": price,
        "DiscountAmount": F.when(_positive(price) & _positive(quantity), gross - revenue).otherwise(0),
        "GMV": gross,
        "NetRevenue": revenue,
        # The sign is kept as stored; measures take the absolute value.
        "PlatformFee": or_zero(money(raw["PhiPhaiTraTiki"])),
    }


RULES = {
    rule.name: rule
    for rule in (
        FeedRule("store", _store_order, _store_line, keep_line=_neither_free_nor_exchanged),
        FeedRule("telesales", _telesales_order, _telesales_line, keep_order=_not_deleted),
        FeedRule("lazada", _lazada_order, _lazada_line),
        FeedRule("shopee", _shopee_order, _shopee_line),
        FeedRule("tiki", _tiki_order, _tiki_line),
    )
}
FACT = "fact_sales"
LINE_COLUMNS = (
    "LineID", "SuccessDate", "SKUCode", "Quantity", "SalePrice", "ListPrice", "DiscountAmount", "GMV", "NetRevenue",
    "PlatformFee", "ShippingFee",
)


def sales_lines(feed: str, lines: DataFrame, raw: Raw) -> DataFrame:
    """Contract rows of one feed from its raw lines."""
    rule = RULES[feed]
    for keep in (rule.keep_order, rule.keep_line):
        if keep is not None:
            lines = lines.filter(keep(raw))
    return lines.select(*contract_columns(FACT, rule.order_values(raw) | rule.line_values(raw)))


def union_feeds(feeds: Mapping[str, tuple[DataFrame, Raw]]) -> DataFrame:
    """Stack the feeds, each given as its raw lines and raw columns."""
    branches = [sales_lines(name, lines, raw) for name, (lines, raw) in feeds.items()]
    return reduce(DataFrame.unionByName, branches)


@dataclass(frozen=True)
class TaggedColumns:
    """Columns and filters that conform all feeds at once, chosen by a tag.

    Column expressions do not depend on a frame, so they can be built once and
    used for every query.
    """

    order_filters: list[Column]
    order_columns: list[Column]
    line_filters: list[Column]
    line_columns: list[Column]


def tagged_columns(tag: Column, feeds: Sequence[tuple[str, Raw]]) -> TaggedColumns:
    """`feeds` lists the feeds with their raw columns; the tag is the place in it.

    Orders with another tag are dropped.
    """

    def kept(which: str) -> list[Column]:
        keeps = [(at, getattr(RULES[feed], which), raw) for at, (feed, raw) in enumerate(feeds)]
        return [(tag != at) | keep(raw) for at, keep, raw in keeps if keep is not None]

    def chosen(which: str, lines: bool) -> list[Column]:
        per_tag = [getattr(RULES[feed], which)(raw) for feed, raw in feeds]
        return [
            _by_tag(tag, [values.get(f.name) for values in per_tag], f.dataType).alias(f.name)
            for f in output_schema(FACT)
            if (f.name in LINE_COLUMNS) == lines
        ]

    return TaggedColumns(
        [tag.between(0, len(feeds) - 1), *kept("keep_order")],
        chosen("order_values", lines=False),
        kept("keep_line"),
        chosen("line_values", lines=True),
    )


def _by_tag(tag: Column, values: list[object], kind: T.DataType) -> Column:
    """The value whose place is the tag.

    The expression is kept short, as Java compiles only short methods well:
    constants alone are looked up in a list, feeds with the same expression
    share a branch, and the expression most feeds share needs no test.
    """
    if not any(isinstance(value, Column) for value in values):
        return F.get(F.array(*[F.lit(value).cast(kind) for value in values]), tag.cast("int"))
    columns = [as_column(value).cast(kind) for value in values]
    tags_of: dict[str, list[int]] = {}
    for at, column in enumerate(columns):
        tags_of.setdefault(str(column), []).append(at)
    *tested, commonest = sorted(tags_of.values(), key=len)
    choice = F
    for tags in tested:
        choice = choice.when(tag.isin(tags) if len(tags) > 1 else tag == tags[0], columns[tags[0]])
    otherwise = columns[commonest[0]]
    return choice.otherwise(otherwise) if tested else otherwise


def conform_tagged(
    orders: DataFrame,
    items: DataFrame,
    matching: Column,
    columns: TaggedColumns,
    line_basis: Sequence[Column] = (),
    order_key: Column | None = None,
) -> DataFrame:
    """Contract rows of all feeds from tagged orders and their lines.

    `line_basis` are columns that the raw line columns build on. With `order_key`, a
    column of the join, rows also have it as `OrderKey`: by it the lines of an order
    already lie together, so a fold by order needs no further shuffle.

    Both sides grow with the data, so they are joined by sort-merge, never by
    broadcast; adaptive execution splits an order that holds very many lines.
    """
    orders = reduce(DataFrame.filter, columns.order_filters, orders).select("*", *columns.order_columns)
    lines = orders.join(items.hint("merge"), matching).select("*", *line_basis)
    return _conformed_lines(lines, columns, order_key)


def conform_joined(
    joined: DataFrame, columns: TaggedColumns, line_basis: Sequence[Column] = (), order_key: Column | None = None
) -> DataFrame:
    """The same from orders that have met their lines already.

    For rows that are dealt again after that join: the columns they are made from are far
    narrower than contract rows, so those are computed where the rows arrive.
    """
    lines = reduce(DataFrame.filter, columns.order_filters, joined).select("*", *columns.order_columns, *line_basis)
    return _conformed_lines(lines, columns, order_key)


def _conformed_lines(lines: DataFrame, columns: TaggedColumns, order_key: Column | None) -> DataFrame:
    lines = reduce(DataFrame.filter, columns.line_filters, lines)
    order_names = [name for name in output_schema(FACT).names if name not in LINE_COLUMNS]
    key = [] if order_key is None else [order_key.alias("OrderKey")]
    named = [*output_schema(FACT).names, *(["OrderKey"] if key else [])]
    return lines.select(*order_names, *columns.line_columns, *key).select(*named)


def store_feed(headers: DataFrame, items: DataFrame, statuses: DataFrame) -> tuple[DataFrame, Raw]:
    """Store lines: headers and items meet on order and site, then status names."""
    order_status = statuses.filter(F.col("FunctType") == words.ORDER_FUNCTION_TYPE)
    lines = (
        headers.alias("h")
        .join(
            items.alias("i"),
            (F.col("i.OrderCode") == F.col("h.OrderCode")) & (F.col("i.SiteID") == F.col("h.SiteID")),
        )
        .join(order_status.alias("s"), F.col("s.StatusID") == F.col("h.Status"), "left")
    )
    return lines, Raw.of(items, "i") | Raw.of(headers, "h") | {"StatusName": F.col("s.StatusName")}


def telesales_feed(headers: DataFrame, items: DataFrame, statuses: DataFrame) -> tuple[DataFrame, Raw]:
    """Telesales lines: headers and items meet on order, then status names."""
    lines = (
        headers.alias("h")
        .join(items.alias("i"), F.col("i.OrderID") == F.col("h.ID"))
        .join(statuses.alias("s"), F.col("s.ID") == F.col("h.StatusID"), "left")
    )
    renamed = {"ItemID": F.col("i.ID"), "StatusName": F.col("s.Name")}
    return lines, Raw.of(headers, "h") | Raw.of(items, "i") | renamed


def flat_feed(lines: DataFrame) -> tuple[DataFrame, Raw]:
    """A marketplace feed: one table, one row per line."""
    return lines, Raw.of(lines)
