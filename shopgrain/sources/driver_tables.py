"""The given star tables (orders, lineitem, part, ...) seen as retail sources.

Order priority decides the feed of an order; its lines then carry the raw
columns of that feed, derived from the order and line columns. Two shapes:

* `sales` - one scan and one join for all feeds, with a feed tag;
* `raw` - each raw table on its own, as the operational systems would hold them.

All derivations are column expressions, so filters and pruning reach the scans.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocabulary as words
from ..functions.clean import MONEY, date_key
from ..operators.dims import build_calendar
from ..operators.sales import Raw, TaggedColumns, conform_joined, conform_tagged, tagged_columns
from .contract import raw_schema

# Which orders belong to which feed.
PRIORITY_OF_FEED = {
    "store": "1-URGENT",
    "telesales": "2-HIGH",
    "lazada": "3-MEDIUM",
    "shopee": "4-NOT SPECIFIED",
    "tiki": "5-LOW",
}

# Raw status of an order, by feed and by order state.
STATUS_CODES = {"store": {"F": 4, "P": 5, "O": 0}, "telesales": {"F": 3, "P": 4, "O": 1}}
STATUS_NAMES = {
    "store": {4: "Thành công", 5: "Đã hủy", 0: "Chưa rõ"},
    "telesales": {3: "Thành công", 4: "Đã hủy"},
}
# Two spellings per state; the second is for orders above the price limit.
STATUS_TEXTS = {
    "lazada": {"F": ("delivered", "delivered"), "P": ("Canceled by buyer", "returned"), "O": ("In transit", "pending")},
    "shopee": {"F": ("Hoàn thành", "Đã HOÀN TẤT"), "P": ("Đã hủy", "ĐÃ HUỶ"), "O": ("Đang giao", "Chờ lấy hàng")},
    "tiki": {"F": ("Giao hàng thành công", "THÀNH CÔNG"), "P": ("Đã hủy", "HUỶ"), "O": ("Đang xử lý", "Mới")},
}
PRICE_LIMIT = 250_000
DELETED_BELOW = 10_000
CUSTOMERS_PER_STORE = 15
AREAS = 25


def _dec(value: Column) -> Column:
    return value.cast(MONEY)


def _share(amount: Column, rate: str) -> Column:
    return _dec(amount * F.lit(rate).cast("decimal(4,2)"))


def _labelled(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _looked_up(values: list, position: Column) -> Column:
    """The value at a position of a fixed list; null when the position is null."""
    return F.get(F.array(*map(F.lit, values)), position)


@cache
def _order_columns() -> list[Column]:
    """Columns that the raw order columns are taken from, computed once per order."""
    priority, state, customer = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_custkey")
    high = F.col("o_totalprice") > PRICE_LIMIT
    store = F.call_function("div", customer, F.lit(CUSTOMERS_PER_STORE))
    area = F.pmod(customer, F.lit(AREAS))
    feed = F
    for at, name in enumerate(words.FEEDS):
        feed = feed.when(priority == PRIORITY_OF_FEED[name], at)

    # Raw status by feed, state and price: fixed lists with one entry per case.
    states = "FPO"
    place = feed * len(states) + F.when(state == "F", 0).when(state == "P", 1).when(state == "O", 2)
    cases = [(name, at) for name in words.FEEDS for at in states]
    codes = [STATUS_CODES.get(name, {}).get(at) for name, at in cases]
    names = [STATUS_NAMES.get(name, {}).get(code) for (name, _), code in zip(cases, codes)]
    texts = [text for name, at in cases for text in STATUS_TEXTS.get(name, {}).get(at, (None, None))]

    columns = {
        "feed": feed,
        "day": F.col("o_orderdate").cast("date"),
        "order_text": F.col("o_orderkey").cast("string"),
        "customer_text": customer.cast("string"),
        "customer_name": _labelled("Customer ", customer),
        "store": store.cast("string"),
        "seller": _labelled("E", store),
        "agent": _labelled("T", area),
        "province": _labelled("Province ", area),
        "city": _labelled("City ", area),
        "district": _labelled("District ", area),
        "ward": _labelled("Ward ", area),
        "payment": F.when(high, "Bank").otherwise("COD"),
        "kind": F.when(high, "VIP").otherwise("Retail"),
        "ship_cost": _dec(_dec(F.col("o_totalprice")) * F.lit("0.01").cast("decimal(3,2)")),
        "deleted": F.when(F.col("o_totalprice") < DELETED_BELOW, 1).otherwise(0),
        "final": state == "F",
        "status_code": _looked_up(codes, place),
        "status_name": _looked_up(names, place),
        "status_text": _looked_up(texts, place * 2 + high.cast("int")),
    }
    kept = [F.col(name) for name in ("o_orderkey", "o_custkey")]
    return [*kept, *[column.alias(name) for name, column in columns.items()]]


@cache
def _line_columns() -> list[Column]:
    """Columns that the raw line columns are taken from, computed once per line.

    They are added after the join, for the lines that are left by then. Amounts
    of one feed are computed for its lines only.
    """
    of_feed = {name: F.col("feed") == at for at, name in enumerate(words.FEEDS)}
    store, lazada, shopee, tiki = (of_feed[name] for name in ("store", "lazada", "shopee", "tiki"))
    discounted, taxed = F.col("l_discount") > 0, F.col("l_tax") > 0
    quantity = F.col("l_quantity").cast("int")
    price = _dec(F.col("l_extendedprice"))
    tax = F.col("l_tax").cast("decimal(4,2)")
    paid = _dec(price * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")))
    columns = {
        "line_number": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "sku": F.col("l_partkey").cast("string"),
        "done": F.when(F.col("final"), F.col("l_shipdate").cast("date")),
        "quantity": quantity,
        "price": price,
        "paid": paid,
        "quantity_dec": _dec(quantity),
        "total": _dec(paid * quantity),
        "store_discount": F.when(store & discounted, _dec((price - paid) * quantity)),
        "lazada_discount": F.when(lazada & discounted, _dec(paid - price)),
        "shopee_listed": F.when(shopee, F.when(taxed, price).otherwise(F.lit(0).cast(MONEY))),
        "freight": F.when(taxed, _dec(tax * 100)),
        "fixed_fee": F.when(shopee, _share(paid, "0.05")),
        "service_fee": F.when(shopee & taxed, _dec(paid * tax)),
        "payment_fee": F.when(shopee & discounted, _share(paid, "0.02")),
        "negative_fee": F.when(tiki & taxed, -_share(paid, "0.09")),
        "free": F.when(F.col("l_quantity") < 2, 1).otherwise(0),
    }
    return [column.alias(name) for name, column in columns.items()]


def fixed_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as a local relation, which Spark knows the size of."""

    def literal(value: object) -> str:
        if isinstance(value, str):
            return "'" + value.replace("'", "\\'") + "'"
        return "NULL" if value is None else str(value)

    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    fields = T.StructType.fromDDL(schema)
    typed = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields)
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS fixed({', '.join(fields.names)})")


# Raw columns that hold dates, and below the raw columns of each feed.
DATE_COLUMNS = frozenset(
    {
        "DocDate", "CreateDate", "SuccessDate", "createTime", "deliveredDate", "NgayDatHang",
        "ThoiGianHoanThanhDonHang", "NgayDat", "NgayGiaoHangThanhCong",
    }
)


@cache
def _raw_columns() -> dict[str, dict[str, Column]]:
    """Raw columns of every feed, over prepared orders and lines."""
    c = F.col

    return {
        "store": {
            "OrderCode": c("order_text"),
            "SiteID": c("store"),
            "DocDate": c("day"),
            "SalesNo": c("seller"),
            "CustID": c("customer_text"),
            "CustName": c("customer_name"),
            "ShipCost": c("ship_cost"),
            "Status": c("status_code"),
            "Source": F.lit("POS"),
            "OrderType": c("kind"),
            "SKUCode": c("sku"),
            "Qty": c("quantity_dec"),
            "UnitPrice": c("paid"),
            "StandardPrice": c("price"),
            "DiscItemValue": c("store_discount"),
            "IsFreeitem": c("free"),
            "IsExchange": c("exchange"),
        },
        "telesales": {
            "OrderID": c("o_orderkey"),
            "CustomerID": c("o_custkey"),
            "CustomerName": c("customer_name"),
            "Provinces": c("province"),
            "CreateDate": c("day"),
            "IsDelete": c("deleted"),
            "AssignTo": c("agent"),
            "PaymentMethod": c("payment"),
            "ShipPrice": c("ship_cost"),
            "StatusID": c("status_code"),
            "Source": F.lit("Phone"),
            "CategoryID": c("kind"),
            "ItemID": c("line_number"),
            "SuccessDate": c("done"),
            "ProductID": c("sku"),
            "Quantity": c("quantity_dec"),
            "UnitPrice": c("paid"),
            "OriginalPrice": c("price"),
            "Total": c("total"),
        },
        "lazada": {
            "orderNumber": c("o_orderkey"),
            "orderItemId": c("line_number"),
            "createTime": c("day"),
            "deliveredDate": c("done"),
            "sellerSku": c("sku"),
            "customerName": c("customer_name"),
            "shippingCity": c("city"),
            "payMethod": c("payment"),
            "paidPrice": c("paid"),
            "unitPrice": c("price"),
            "sellerDiscountTotal": c("lazada_discount"),
            "shippingFee": c("freight"),
            "status": c("status_text"),
            "orderType": c("kind"),
        },
        "shopee": {
            "MaDonHang": c("order_text"),
            "Id": c("line_number"),
            "NgayDatHang": c("day"),
            "ThoiGianHoanThanhDonHang": c("done"),
            "SKUSanPham": c("sku"),
            "TenNguoiNhan": c("customer_name"),
            "TinhThanhPho": c("city"),
            "QuanHuyen": c("district"),
            "PhuongXa": c("ward"),
            "PhuongThucThanhToan": c("payment"),
            "SoLuong": c("quantity_dec"),
            "GiaUuDai": c("paid"),
            "GiaGoc": c("shopee_listed"),
            "TongGiaBanSanPham": c("total"),
            "PhiCoDinh": c("fixed_fee"),
            "PhiDichVu": c("service_fee"),
            "PhiThanhToan": c("payment_fee"),
            "PhiVanChuyenDuKien": c("freight"),
            "TrangThaiDonHang": c("status_text"),
            "LoaiDonHang": c("kind"),
        },
        "tiki": {
            "MaDonHang": c("order_text"),
            "Id": c("line_number"),
            "NgayDat": c("day"),
            "NgayGiaoHangThanhCong": c("done"),
            "SSKU": c("sku"),
            "PhuongThucThanhToan": c("payment"),
            "SLBan": c("quantity_dec"),
            "DonGia": c("price"),
            "DoanhThu": c("total"),
            "PhiPhaiTraTiki": c("negative_fee"),
            "TrangThai": c("status_text"),
        },
    }


@cache
def _tagged_columns() -> TaggedColumns:
    raws = {feed: Raw(columns, DATE_COLUMNS) for feed, columns in _raw_columns().items()}
    for feed in STATUS_NAMES:
        raws[feed] |= {"StatusName": F.col("status_name")}
    return tagged_columns(F.col("feed"), [(feed, raws[feed]) for feed in words.FEEDS])


def as_text(column: Column, kind: T.DataType) -> Column:
    """A value as a source would write it: dates in three forms, numbers with blanks.

    The form follows from the value, so a row that is made again is the same. Absent
    dates are empty, absent numbers a word.
    """
    form = F.pmod(F.xxhash64(column), F.lit(3))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        forms = [F.date_format(column, f) for f in ("yyyyMMdd", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd")]
        return F.coalesce(F.when(form == 0, forms[0]).when(form == 1, forms[1]).otherwise(forms[2]), F.lit(""))
    plain = F.regexp_replace(column.cast("string"), r"\.0+$", "")  # whole numbers without decimals
    return F.coalesce(F.when(form == 0, F.concat(F.lit(" "), plain, F.lit("  "))).otherwise(plain), F.lit("n/a"))


def as_declared(frame: DataFrame, name: str) -> DataFrame:
    """A raw table in its declared types; what is declared as text and is none becomes dirty text."""
    columns = []
    for field in raw_schema(name):
        kind, column = frame.schema[field.name].dataType, F.col(field.name)
        typed_text = isinstance(field.dataType, T.StringType) and isinstance(
            kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
        )
        columns.append((as_text(column, kind) if typed_text else column.cast(field.dataType)).alias(field.name))
    return frame.select(*columns)


class DriverTables:
    """Retail sources derived from one folder of the given tables."""

    def __init__(self, spark: SparkSession, folder: str, stored: Mapping[str, DataFrame] | None = None):
        """`stored` gives tables that are read from elsewhere, such as a bucketed copy."""
        self.spark, self.folder, self.stored = spark, folder, stored or {}
        self._schemas: dict[str, T.StructType] = {}

    def table(self, name: str) -> DataFrame:
        if name in self.stored:
            return self.stored[name]
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:  # each look at a file is a job of its own
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    @cached_property
    def day_range(self) -> tuple:
        """First and last order day; one small job, asked once."""
        day = F.col("o_orderdate").cast("date")
        return tuple(self.table("orders").agg(F.min(day), F.max(day)).first())

    def _days(self) -> DataFrame:
        """Every day of the years in which orders were made."""
        first, last = (day.year for day in self.day_range)
        start = F.make_date(F.lit(first), F.lit(1), F.lit(1))
        end = F.make_date(F.lit(last), F.lit(12), F.lit(31))
        return self.spark.range(1).select(F.explode(F.sequence(start, end)).alias("date"))

    def _months(self) -> Column:
        """First days of the months from the first to the last order, as an array."""
        first, last = (F.trunc(F.lit(day), "month") for day in self.day_range)
        return F.sequence(first, last, F.expr("interval 1 month"))

    # -- all feeds in one pass ---------------------------------------------------

    def sales(self, *feeds: str) -> DataFrame:
        """The sales fact of feeds (all by default) from one scan of each table and one join."""
        return self._conformed(feeds)

    def keyed_sales(self, *feeds: str) -> DataFrame:
        """The same with `OrderKey`, the number of the order by which the join deals its lines."""
        return self._conformed(feeds, F.col("o_orderkey"))

    def monthly_sales(self) -> DataFrame:
        """All sales, with the lines of a month lying together: dealt as they are read."""
        orders, items = self._wanted_orders(*words.FEEDS), self._items()
        joined = orders.join(items.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
        month = F.trunc(F.col("o_orderdate").cast("date"), "month")
        dealt = joined.withColumn("month", month).hint("rebalance", F.col("month"))
        return conform_joined(dealt.select(*_order_columns(), *items.columns), _tagged_columns(), _line_columns())

    def _conformed(self, feeds: tuple[str, ...], order_key: Column | None = None) -> DataFrame:
        return conform_tagged(
            self._orders_of(*(feeds or words.FEEDS)),
            self._items(),
            F.col("o_orderkey") == F.col("l_orderkey"),
            _tagged_columns(),
            _line_columns(),
            order_key,
        )

    def _items(self) -> DataFrame:
        """Lines as they go into the join: two text flags become one number."""
        exchange = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
        return self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_shipdate", F.when(exchange, 1).otherwise(0).alias("exchange"),
        )

    def _wanted_orders(self, *feeds: str) -> DataFrame:
        return self.table("orders").filter(F.col("o_orderpriority").isin([PRIORITY_OF_FEED[feed] for feed in feeds]))

    def _orders_of(self, *feeds: str) -> DataFrame:
        return self._wanted_orders(*feeds).select(*_order_columns())

    # -- raw tables, one by one ---------------------------------------------------

    def raw(self, name: str) -> DataFrame:
        return as_declared(getattr(self, "_" + name.replace(".", "_"))(), name)

    def _lines_of(self, feed: str) -> DataFrame:
        lines = self._orders_of(feed).join(self._items().hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
        return lines.select("*", *_line_columns())

    @staticmethod
    def _pick(feed: str, *names: str) -> list[Column]:
        raw = _raw_columns()[feed]
        return [raw[name].alias(name) for name in (names or raw)]

    def _rms_E01OrderHeader(self) -> DataFrame:
        return self._orders_of("store").select(
            *self._pick(
                "store", "OrderCode", "SiteID", "DocDate", "SalesNo", "CustID", "CustName", "ShipCost", "Status",
                "Source", "OrderType",
            )
        )

    def _rms_E01OrderItems(self) -> DataFrame:
        return self._lines_of("store").select(
            *self._pick(
                "store", "OrderCode", "SiteID", "SKUCode", "Qty", "UnitPrice", "StandardPrice", "DiscItemValue",
                "IsFreeitem", "IsExchange",
            )
        )

    def _rms_E00Status(self) -> DataFrame:
        rows = [(code, words.ORDER_FUNCTION_TYPE, name) for code, name in STATUS_NAMES["store"].items()]
        rows.append((4, "P", "Paid"))
        return fixed_rows(self.spark, rows, "StatusID int, FunctType string, StatusName string")

    def _gmc_E01OrderHeader(self) -> DataFrame:
        """Telesales orders with the attributes of their customer."""
        customer = F.col("c_custkey")
        gender = F.col("c_mktsegment")
        size = F.pmod(customer, F.lit(30))
        profile = self.table("customer").select(
            customer,
            _labelled("09", F.lpad(customer.cast("string"), 8, "0")).alias("PhoneNumber"),
            F.when(gender == "FURNITURE", "Nữ")
            .when(gender == "BUILDING", "Female")
            .when(gender == "MACHINERY", "Nam")
            .when(gender == "AUTOMOBILE", "male")
            .otherwise("")
            .alias("CustomerGender"),
            F.when(F.col("c_acctbal") < 0, "unknown")
            .otherwise(F.date_add(F.lit("1960-01-01").cast("date"), F.pmod(customer, F.lit(15000)).cast("int")).cast("string"))
            .alias("BirthDay"),
            F.when(F.col("c_acctbal") > 9000, "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("DistrictID"),
            F.col("c_nationkey").cast("string").alias("WardID"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("Email"),
            F.when(F.col("c_acctbal") > 8000, "True").otherwise("0").alias("IsWholesaler"),
            F.concat((size + 150).cast("string"), F.lit(".5")).alias("CustomerHeight"),
            (size + 40).cast("string").alias("CustomerWeight"),
            F.when(size > 3, (size + 60).cast("string")).alias("CustomerWaistSize"),
        )
        header = self._orders_of("telesales").select(
            F.col("o_custkey"),
            F.col("o_orderkey").alias("ID"),
            *self._pick(
                "telesales", "CustomerID", "CustomerName", "Provinces", "CreateDate", "IsDelete", "AssignTo",
                "PaymentMethod", "ShipPrice", "StatusID", "Source", "CategoryID",
            ),
        )
        return header.join(profile, header["o_custkey"] == profile["c_custkey"], "left").drop("o_custkey", "c_custkey")

    def _gmc_E01OrderItemsOnline(self) -> DataFrame:
        picked = self._pick(
            "telesales", "OrderID", "ItemID", "SuccessDate", "ProductID", "Quantity", "UnitPrice", "OriginalPrice",
            "Total",
        )
        return self._lines_of("telesales").select(*picked).withColumnRenamed("ItemID", "ID")

    def _gmc_E00OrderStatus(self) -> DataFrame:
        return fixed_rows(self.spark, list(STATUS_NAMES["telesales"].items()), "ID int, Name string")

    def _ecom_E01LazadaOrders(self) -> DataFrame:
        return self._lines_of("lazada").select(*self._pick("lazada"))

    def _ecom_E01ShopeeOrders(self) -> DataFrame:
        return self._lines_of("shopee").select(*self._pick("shopee"))

    def _ecom_E01TikiOrders(self) -> DataFrame:
        return self._lines_of("tiki").select(*self._pick("tiki"))

    def _rms_E00ItemSKUs(self) -> DataFrame:
        key, price = F.col("p_partkey").cast("string"), _dec(F.col("p_retailprice"))
        return self.table("part").select(
            key.alias("SKUCode"),
            F.concat(F.lit("I"), key).alias("ItemCode"),
            F.substring_index("p_name", " ", 1).alias("sku_attr1"),
            F.col("p_size").cast("string").alias("sku_attr2"),
            _dec(price * F.lit("0.60").cast("decimal(3,2)")).alias("COGS"),
            price.alias("SalesPrice"),
            (F.col("p_size") != 1).alias("IsActive"),
            F.concat(F.lit("893"), F.lpad(key, 10, "0")).alias("BarCode"),
            F.when(F.col("p_size") == 50, 1).otherwise(0).alias("IsDelete"),
        )

    def _rms_E00ItemMST(self) -> DataFrame:
        size = F.col("p_size")
        return self.table("part").select(
            F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("ItemCode"),
            F.col("p_name").alias("ItemName"),
            _category().cast("string").alias("ItemCategory"),
            _labelled("C", size).alias("ItemCollection"),
            F.when(size > 10, F.when(size > 45, 1).otherwise(0)).alias("IsOnlyOnline"),
            F.col("p_brand").alias("ProductBrand"),
            F.when(size == 7, "n/a").otherwise(F.concat(size.cast("string"), F.lit(".25"))).alias("PackageWeight"),
            _collection_month().alias("MonthOfCollection"),
            _collection_year().alias("YearOfCollection"),
            F.when(size == 49, 1).otherwise(0).alias("IsDelete"),
        )

    def _rms_E00ItemCategory(self) -> DataFrame:
        kinds = self.table("part").filter(F.col("p_type") != "PROMO").select("p_type").distinct()
        return kinds.select(_category().alias("CateID"), F.col("p_type").alias("CateName"))

    def _rms_E00Collection(self) -> DataFrame:
        sizes = self.table("part").filter(F.col("p_size") <= 45).select("p_size").distinct()
        return sizes.select(
            _collection_month().alias("collectionMonth"),
            _collection_year().alias("collectionYear"),
            _labelled("Collection ", F.col("p_size")).alias("collectionName"),
        )

    def _places(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )

    def _rms_E00Store_AM(self) -> DataFrame:
        return self._places().select(
            F.col("s_suppkey").cast("string").alias("StoreID"),
            F.col("s_name").alias("StoreName"),
            _labelled("AM", F.col("n_nationkey")).alias("EmpID"),
            F.col("n_name").alias("AmName"),
            F.concat(F.lit(" R"), F.col("r_regionkey").cast("string")).alias("RegionCode"),
            F.concat(F.col("r_name"), F.lit("  ")).alias("RegionName"),
            _store_type().alias("StoreType"),
        )

    def _mdm_E00CORStores(self) -> DataFrame:
        number = F.col("s_suppkey")
        return self.table("supplier").select(
            number.cast("string").alias("No_"),
            (F.col("s_acctbal") < 0).alias("IsFranchise"),
            _labelled("City ", F.col("s_nationkey")).alias("City"),
            _labelled("District ", number).alias("District"),
            _labelled("Ward ", number).alias("Ward"),
            F.concat(F.col("s_name"), F.lit(" street")).alias("Address"),
            _labelled("028", F.lpad(number.cast("string"), 7, "0")).alias("Phone"),
            F.when(F.col("s_acctbal") > 9000, 1).otherwise(0).alias("IsDelete"),
        )

    def _mdm_E00Employee(self) -> DataFrame:
        number, balance = F.col("s_suppkey"), F.col("s_acctbal")
        return self.table("supplier").select(
            _labelled("E", number).alias("emp_id"),
            F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("emp_name"),
            F.when(balance > 2000, "Nữ").alias("Gender"),
            F.lit("Store").alias("Department"),
            F.when(balance > 5000, "True").otherwise("0").alias("BGD"),
            number.cast("string").alias("SiteID"),
            F.when(balance > 0, "1").otherwise("False").alias("IsActive"),
            F.when(balance > -500, "true").otherwise("False").alias("isEmp"),
            F.when(balance > 1000, F.date_add(F.lit("2010-03-01").cast("date"), F.col("s_nationkey")).cast("string"))
            .otherwise("not known")
            .alias("start_date"),
            F.when(balance < 0, "2020-06-30 17:00:00.000").alias("end_date"),
        )

    def _gmc_E00EmployeeOnline(self) -> DataFrame:
        return self.table("nation").select(
            _labelled("T", F.col("n_nationkey")).alias("Code"),
            F.concat(F.lit("  "), F.col("n_name")).alias("Name"),
            F.lit("Telesales").alias("Department"),
            F.col("n_regionkey").cast("string").alias("IsLeader"),
        )

    def _mdm_E00Calendar(self) -> DataFrame:
        return build_calendar(self._days())

    def _rms_E00TargetStores(self) -> DataFrame:
        """A row per store and month. The file of stores is small, so one task may read all of
        them; they are dealt out before each becomes as many rows as there are months."""
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        month = F.explode(self._months()).alias("first_day")
        return self._places().repartition(parts, "s_suppkey").select("*", month).select(
            date_key(F.col("first_day")).cast("string").alias("Datekey"),
            F.col("s_suppkey").cast("string").alias("StoreId"),
            F.concat(F.lit(" "), F.col("s_name")).alias("StoreName"),
            F.concat(F.col("r_name"), F.lit(" ")).alias("Region"),
            _store_type().alias("StoreType"),
            F.col("n_name").alias("AM"),
            (_dec(F.col("s_acctbal")) * 10 + 200_000).cast(MONEY).alias("Target"),
        )

    def _gmc_E00Target(self) -> DataFrame:
        """One target a month; the amounts follow from the number of customers."""
        size = self.table("customer").agg(F.count(F.lit(1)).alias("customers"))
        month = F.explode(self._months()).alias("first_day")
        customers = F.col("customers")
        return size.select("customers", month).select(
            date_key(F.col("first_day")).cast("string").alias("DateKey"),
            (customers * 10_000).cast(MONEY).alias("Target"),
            (F.month("first_day") * 1_000 + 100_000).cast("string").alias("AOV"),
            F.call_function("div", customers, F.lit(20)).cast("string").alias("Orders"),
            F.when(F.month("first_day") == 2, "n/a")
            .otherwise(F.call_function("div", customers, F.lit(4)).cast("string"))
            .alias("Items"),
        )

    def _ecom_E00Target(self) -> DataFrame:
        size = self.table("customer").agg(F.count(F.lit(1)).alias("customers"))
        platforms = F.array(*[F.lit(words.PLATFORM[feed]) for feed in ("lazada", "shopee", "tiki")])
        return (
            size.select("customers", F.explode(self._months()).alias("first_day"))
            .select("*", F.explode(platforms).alias("Platform"))
            .select(
                date_key(F.col("first_day")).cast("string").alias("DateKey"),
                "Platform",
                (F.col("customers") * F.length("Platform") * 1_000).cast(MONEY).alias("TargetGMV"),
            )
        )


def _category() -> Column:
    """A number for a product type."""
    return F.ascii("p_type") * 100 + F.length("p_type")


def _collection_month() -> Column:
    return F.pmod(F.col("p_size"), F.lit(12)) + 1


def _collection_year() -> Column:
    return F.call_function("div", F.col("p_size"), F.lit(12)).cast("int") + 2015


def _store_type() -> Column:
    return F.when(F.col("s_acctbal") < 0, "NHƯỢNG QUYỀN").otherwise(f" {words.DIRECT_STORE_TYPE} ")
