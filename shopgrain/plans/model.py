"""The retail model: eight products over a set of raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as words
from ..functions.clean import key_month
from ..operators import dims, rfm, targets
from ..operators.sales import flat_feed, store_feed, telesales_feed, union_feeds
from ..sources.driver_tables import DriverTables

RawTables = Callable[[str], DataFrame]


class RetailModel:
    """Products as DataFrames, each built when first asked for.

    `raw` gives a raw table by name. `sales` may replace the stacking of feeds
    where their lines already lie together; it takes the names of the feeds. `keyed`
    gives the same with a column `OrderKey`, by which the lines of an order lie together,
    `monthly` all sales with the lines of a month lying together.
    """

    def __init__(
        self,
        raw: RawTables,
        sales: Callable[..., DataFrame] | None = None,
        keyed: Callable[..., DataFrame] | None = None,
        monthly: Callable[[], DataFrame] | None = None,
    ):
        self._raw = raw
        self._sales = sales or self.stacked_sales
        self._keyed = keyed
        self._monthly = monthly

    @classmethod
    def of_tables(cls, tables: Mapping[str, DataFrame]) -> RetailModel:
        return cls(tables.__getitem__)

    @classmethod
    def of_driver_tables(
        cls, spark: SparkSession, folder: str, stored: Mapping[str, DataFrame] | None = None
    ) -> RetailModel:
        source = DriverTables(spark, folder, stored)
        return cls(source.raw, source.sales, source.keyed_sales, source.monthly_sales)

    def raw(self, name: str) -> DataFrame:
        """A raw table."""
        return self._raw(name)

    @cached_property
    def dim_product(self) -> DataFrame:
        names = ("rms.E00ItemSKUs", "rms.E00ItemMST", "rms.E00ItemCategory", "rms.E00Collection")
        return dims.dim_product(*map(self._raw, names))

    @cached_property
    def dim_store(self) -> DataFrame:
        return dims.dim_store(self._raw("rms.E00Store_AM"), self._raw("mdm.E00CORStores"))

    @cached_property
    def dim_employee(self) -> DataFrame:
        return dims.dim_employee(self._raw("mdm.E00Employee"), self._raw("gmc.E00EmployeeOnline"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self._raw("mdm.E00Calendar"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self._raw("gmc.E01OrderHeader"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._sales(*words.FEEDS)

    def keyed_sales(self) -> DataFrame:
        """The sales fact with `OrderKey`: one value per order id, null where that is null."""
        if self._keyed:
            return self._keyed(*words.FEEDS)
        return self.fact_sales.withColumn("OrderKey", F.col("OrderID"))

    def monthly_sales(self) -> DataFrame:
        """The sales fact with the lines of a month lying together, for `write_sales`."""
        if self._monthly:
            return self._monthly()
        return self.fact_sales.hint("rebalance", key_month(F.col("DateKey")))

    def sales_of(self, *feeds: str) -> DataFrame:
        """The sales fact of some feeds; the others are not read."""
        return self._sales(*feeds)

    def stacked_sales(self, *feeds: str) -> DataFrame:
        """Sales from feeds (all by default), each read from its own raw tables."""
        raw = self._raw
        build = {
            "store": lambda: store_feed(*map(raw, ("rms.E01OrderHeader", "rms.E01OrderItems", "rms.E00Status"))),
            "telesales": lambda: telesales_feed(
                *map(raw, ("gmc.E01OrderHeader", "gmc.E01OrderItemsOnline", "gmc.E00OrderStatus"))
            ),
            "lazada": lambda: flat_feed(raw("ecom.E01LazadaOrders")),
            "shopee": lambda: flat_feed(raw("ecom.E01ShopeeOrders")),
            "tiki": lambda: flat_feed(raw("ecom.E01TikiOrders")),
        }
        return union_feeds({feed: build[feed]() for feed in feeds or words.FEEDS})

    @cached_property
    def fact_target(self) -> DataFrame:
        return targets.fact_target(*map(self._raw, ("rms.E00TargetStores", "gmc.E00Target", "ecom.E00Target")))

    @cached_property
    def customer_rfm(self) -> DataFrame:
        return rfm.customer_rfm(self.fact_sales, self.dim_date)

    def publish(self, *products: str) -> None:
        """Register products (all by default) as temporary views for Spark SQL.

        Views are plans, computed when queried; only the customer segments settle
        their base table on the way.
        """
        for product in products or words.VIEW_NAMES:
            getattr(self, product).createOrReplaceTempView(words.VIEW_NAMES[product])
