"""Business questions over the model.

Every report sums the sales lines on their own keys first and joins dimensions
or targets to the sums. What is shuffled and joined is then the number of keys,
not the number of lines, and a key that holds many lines is folded before the
shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions import vocabulary as words
from ..functions.clean import key_month
from ..operators import rank, rfm, timeintel
from ..operators.star import SALES_RELATIONSHIPS, TARGET_RELATIONSHIPS, star_join
from .model import RetailModel

AMOUNT = "decimal(38,4)"
TARGET = "decimal(28,2)"


def _count(condition: Column | None = None) -> Column:
    return F.count(F.lit(1) if condition is None else F.when(condition, 1))


def _amount(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast(AMOUNT)


def _completed(sales: DataFrame) -> DataFrame:
    return sales.filter("IsSuccess")


def _over_all(value: Column) -> Column:
    """An aggregate over all rows; for rows that are already summed."""
    return value.over(Window.partitionBy())


def _share(revenue: str = "Revenue") -> Column:
    return m.percent(F.col(revenue), _over_all(F.sum(revenue)))


# -- audit and channels --------------------------------------------------------


def row_count_audit(model: RetailModel) -> DataFrame:
    """Rows of every dimension and fact."""
    products = [name for name in words.VIEW_NAMES if name != "customer_rfm"]
    counts = [
        getattr(model, name).agg(_count().alias("Rows")).select(F.lit(words.VIEW_NAMES[name]).alias("ViewName"), "Rows")
        for name in products
    ]
    return reduce(DataFrame.unionByName, counts)


def _orders(model: RetailModel, *by: str) -> DataFrame:
    """Lines folded to orders, where the join has brought them together.

    An order counts once, so the number of orders is a plain sum of the folded rows.
    """
    return model.keyed_sales().groupBy("OrderKey", *by).agg(
        F.max(F.when(F.col("OrderID").isNotNull(), 1)).alias("orders"),
        m.units().alias("units"),
        F.sum(F.when(F.col("IsSuccess"), F.col("NetRevenue"))).alias("revenue"),
        _count(F.col("IsSuccess") & F.col("NetRevenue").isNotNull()).alias("priced"),
        m.success_lines().alias("success"),
        m.lines().alias("lines"),
        F.max("IsSuccess").alias("success_order"),
    )


def _whole(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def channel_breakdown(model: RetailModel) -> DataFrame:
    """Orders, units, completed revenue and success rate per channel."""
    per_channel = (
        _orders(model, "Channel", "ChannelGroup")
        .groupBy("Channel", "ChannelGroup")
        .agg(
            _whole("orders").alias("Orders"),
            F.sum("units").alias("Units"),
            _amount(F.sum("revenue")).alias("Revenue_Success"),
            F.sum("priced").alias("_priced"),
            F.sum("success").alias("_success"),
            F.sum("lines").alias("_lines"),
        )
    )
    return per_channel.select(
        "Channel",
        "ChannelGroup",
        "Orders",
        "Units",
        "Revenue_Success",
        m.ratio(F.col("Revenue_Success"), F.col("_priced")).alias("AvgLineRevenue"),
        m.percent(F.col("_success"), F.col("_lines")).alias("SuccessRate_Pct"),
    ).orderBy(F.desc("Revenue_Success"))


def total_revenue(model: RetailModel) -> DataFrame:
    """Completed revenue, distinct orders and average order value, all channels."""
    totals = _orders(model).agg(
        _amount(F.sum("revenue")).alias("Revenue"), _whole("orders").alias("Orders"), _whole("lines").alias("OrderLines")
    )
    return totals.withColumn("RevenuePerOrder", m.ratio(F.col("Revenue"), F.col("Orders")))


def channel_share(model: RetailModel) -> DataFrame:
    """Completed revenue per channel with completed sales, and its share."""
    revenue = _completed(model.fact_sales).groupBy("Channel", "ChannelGroup").agg(m.revenue().alias("Revenue"))
    return revenue.withColumn("Share_Pct", _share())


def channel_group_share(model: RetailModel) -> DataFrame:
    """Completed revenue per group of channels with completed sales, and its share."""
    revenue = _completed(model.fact_sales).groupBy("ChannelGroup").agg(m.revenue().alias("Revenue"))
    return revenue.withColumn("Share_Pct", _share())


def overall_success(model: RetailModel) -> DataFrame:
    """Success rate of all orders, and of all lines."""
    totals = _orders(model).agg(
        _whole("orders").alias("Orders"),
        _count(F.col("success_order") & F.col("orders").isNotNull()).alias("SuccessOrders"),
        _whole("lines").alias("OrderLines"),
        _whole("success").alias("SuccessLines"),
    )
    return totals.withColumns(
        {
            "SuccessRate_Pct": m.percent(F.col("SuccessOrders"), F.col("Orders")),
            "LineSuccessRate_Pct": m.percent(F.col("SuccessLines"), F.col("OrderLines")),
        }
    )


def platform_fee_rate(model: RetailModel) -> DataFrame:
    """Platform fees as a share of gross value."""
    fees = model.fact_sales.groupBy("Channel", "Platform").agg(
        m.platform_fee().cast(AMOUNT).alias("PlatformFee"), m.gross_value().cast(AMOUNT).alias("GMV")
    )
    return fees.withColumn("FeeRate_Pct", m.percent(F.col("PlatformFee"), F.col("GMV")))


def net_after_fee(model: RetailModel) -> DataFrame:
    """What is left of completed sales after platform fees.

    Net revenue is already after fees where the feed reports it so; feeds without
    fee data have a fee of zero.
    """
    return (
        _completed(model.fact_sales)
        .groupBy("Channel", "Platform")
        .agg(
            m.gross_value().cast(AMOUNT).alias("GMV"),
            m.platform_fee().cast(AMOUNT).alias("PlatformFee"),
            m.revenue().alias("NetAfterFee"),
        )
    )


def avg_discount(model: RetailModel) -> DataFrame:
    """Discount as a share of list value, per channel and over all."""
    sums = model.fact_sales.groupBy("Channel").agg(
        m.discount().cast(AMOUNT).alias("Discount"), m.list_value().cast(AMOUNT).alias("ListValue")
    )
    overall = m.percent(_over_all(F.sum("Discount")), _over_all(F.sum("ListValue")))
    return sums.select(
        "Channel",
        "Discount",
        "ListValue",
        m.percent(F.col("Discount"), F.col("ListValue")).alias("Discount_Pct"),
        overall.alias("Overall_Discount_Pct"),
    )


def order_quality(model: RetailModel) -> DataFrame:
    """Success, cancellation and return rates of orders, and of lines.

    Lines are folded to orders first, so one shuffle serves all three distinct
    counts. Lines without an order id count as lines, but as no order.
    """
    orders = model.fact_sales.groupBy("Channel", "Platform", "OrderID").agg(
        F.max("IsSuccess").alias("success"),
        F.max("IsCancelled").alias("cancelled"),
        F.max(m.is_returned()).alias("returned"),
        m.lines().alias("lines"),
        m.success_lines().alias("success_lines"),
    )
    counts = orders.groupBy("Channel", "Platform").agg(
        F.count("OrderID").alias("Orders"),
        *(
            _count(F.col(flag) & F.col("OrderID").isNotNull()).alias(name)
            for flag, name in (("success", "SuccessOrders"), ("cancelled", "CancelledOrders"), ("returned", "ReturnedOrders"))
        ),
        F.sum("lines").alias("OrderLines"),
        F.sum("success_lines").alias("SuccessLines"),
    )
    rates = {
        "SuccessRate_Pct": ("SuccessOrders", "Orders"),
        "CancelRate_Pct": ("CancelledOrders", "Orders"),
        "ReturnRate_Pct": ("ReturnedOrders", "Orders"),
        "LineSuccessRate_Pct": ("SuccessLines", "OrderLines"),
    }
    return counts.withColumns({name: m.percent(F.col(a), F.col(b)) for name, (a, b) in rates.items()})


# -- products --------------------------------------------------------------------


def _by_product(model: RetailModel, *attributes: str) -> DataFrame:
    """Completed units and revenue per SKU, with attributes of the product."""
    per_sku = (
        _completed(model.fact_sales)
        .groupBy("SKUCode")
        .agg(m.units().alias("Units"), F.sum("NetRevenue").alias("Revenue"))
    )
    return per_sku.join(model.dim_product.select("SKUCode", *attributes), "SKUCode", "left")


def top_products(model: RetailModel, size: int = 10) -> DataFrame:
    """Best products by completed revenue; equal revenue falls in order of SKU."""
    keys = ("SKUCode", "ProductName", "CategoryName", "CollectionName")
    return (
        _by_product(model, *keys[1:])
        .groupBy(*keys)
        .agg(F.sum("Units").alias("TotalUnits"), F.sum("Revenue").cast(AMOUNT).alias("TotalRevenue"))
        .orderBy(F.desc("TotalRevenue"), "SKUCode")
        .limit(size)
    )


def _product_mix(model: RetailModel, attribute: str) -> DataFrame:
    named = F.coalesce(attribute, F.lit(words.UNKNOWN_MEMBER)).alias(attribute)
    mix = (
        _by_product(model, attribute)
        .groupBy(named)
        .agg(F.sum("Units").alias("Units"), F.sum("Revenue").cast(AMOUNT).alias("Revenue"))
    )
    return mix.withColumn("Share_Pct", _share())


def category_mix(model: RetailModel) -> DataFrame:
    return _product_mix(model, "CategoryName")


def collection_mix(model: RetailModel) -> DataFrame:
    return _product_mix(model, "CollectionName")


def gross_margin(model: RetailModel) -> DataFrame:
    """Completed revenue less cost of goods, per category."""
    cost = F.sum(F.col("Units") * F.col("CostOfGoods"))
    margin = (
        _by_product(model, "CategoryName", "CostOfGoods")
        .groupBy(F.coalesce("CategoryName", F.lit(words.UNKNOWN_MEMBER)).alias("CategoryName"))
        .agg(_amount(F.sum("Revenue")).alias("Revenue"), _amount(cost).alias("Cost"))
        .withColumn("Margin", (F.col("Revenue") - F.col("Cost")).cast(AMOUNT))
    )
    return margin.withColumn("Margin_Pct", m.percent(F.col("Margin"), F.col("Revenue")))


# -- stores, regions, ownership -----------------------------------------------------


def _store_share(model: RetailModel, attribute: str) -> DataFrame:
    """Completed revenue by a store attribute; sales outside stores are the unknown member."""
    per_store = _completed(model.fact_sales).groupBy("StoreID").agg(m.revenue().alias("Revenue"))
    named = F.coalesce(attribute, F.lit(words.UNKNOWN_MEMBER)).alias(attribute)
    shares = (
        per_store.join(model.dim_store.select("StoreID", attribute), "StoreID", "left")
        .groupBy(named)
        .agg(F.sum("Revenue").cast(AMOUNT).alias("Revenue"))
    )
    return shares.withColumn("Share_Pct", _share())


def region_share(model: RetailModel) -> DataFrame:
    return _store_share(model, "RegionName")


def ownership_share(model: RetailModel) -> DataFrame:
    return _store_share(model, "OwnershipType")


# -- targets -----------------------------------------------------------------------


def _scope() -> Column:
    """What a target is set for: a store, a channel or a platform."""
    return (
        F.when(F.col("ChannelGroup") == words.CHANNEL_GROUP["store"], F.col("StoreID"))
        .when(F.col("ChannelGroup") == words.TARGET_ECOM_CHANNEL, F.col("Platform"))
        .otherwise(F.col("Channel"))
    )


def target_and_actual(model: RetailModel, *attributes: str, sales: DataFrame | None = None) -> DataFrame:
    """Each target with the completed revenue of its scope and month.

    Sales are summed to the grain of the targets before they meet, so no target
    is repeated by the sales that match it. `sales` may hold some feeds only.
    """
    keys = ["YearMonth", "ChannelGroup", "Scope"]
    month = key_month(F.col("DateKey")).alias("YearMonth")
    actual = (
        _completed(model.fact_sales if sales is None else sales)
        .groupBy(month, "ChannelGroup", _scope().alias("Scope"))
        .agg(m.revenue().alias("Actual"))
    )
    target = (
        model.fact_target.groupBy(month, "Channel", "ChannelGroup", _scope().alias("Scope"), *attributes)
        .agg(F.sum("TargetRevenue").alias("Target"))
    )
    return target.join(actual, keys, "left")


def _achievement(rows: DataFrame, *keys: str) -> DataFrame:
    sums = rows.groupBy(*keys).agg(
        F.sum("Target").cast(TARGET).alias("Target"), _amount(F.sum("Actual")).alias("Actual")
    )
    return sums.withColumn("Achievement_Pct", m.percent(F.col("Actual"), F.col("Target")))


def revenue_vs_target(model: RetailModel) -> DataFrame:
    return _achievement(target_and_actual(model), "YearMonth", "Channel", "ChannelGroup").orderBy("YearMonth", "Channel")


def overall_achievement(model: RetailModel) -> DataFrame:
    return _achievement(target_and_actual(model))


def _store_targets(model: RetailModel, *attributes: str) -> DataFrame:
    rows = target_and_actual(model, *attributes, sales=model.sales_of("store"))
    return rows.filter(F.col("ChannelGroup") == words.CHANNEL_GROUP["store"]).withColumnRenamed("Scope", "StoreID")


def region_achievement(model: RetailModel) -> DataFrame:
    return _achievement(_store_targets(model, "RegionName"), "RegionName")


def region_month_achievement(model: RetailModel) -> DataFrame:
    """Store targets and revenue per region and month."""
    return _achievement(_store_targets(model, "RegionName"), "YearMonth", "RegionName")


def manager_vs_target(model: RetailModel) -> DataFrame:
    return _achievement(_store_targets(model, "AM_Name"), "YearMonth", "AM_Name")


def store_vs_target(model: RetailModel) -> DataFrame:
    """Target and revenue per store and month, ranked by revenue within the month."""
    stores = _achievement(_store_targets(model), "YearMonth", "StoreID")
    return rank.add_rank(stores, "Revenue_Rank", ["YearMonth"], "Actual", "StoreID")


def store_ranking(model: RetailModel) -> DataFrame:
    """Target and revenue per store over the whole period, ranked by revenue."""
    return rank.add_rank(_achievement(_store_targets(model), "StoreID"), "Revenue_Rank", [], "Actual", "StoreID")


def target_fanout_demo(model: RetailModel) -> DataFrame:
    """Targets joined to sale lines one by one, summed afterwards.

    This is the comparison as first published, kept to show why it misleads: a
    target counts once per matching line, and marketplace targets match nothing.
    The result of that join is computed here without making it: a target that
    matches n lines contributes n times itself, or once if there are none.
    """
    month = key_month(F.col("DateKey")).alias("YearMonth")
    per_store = model.fact_sales.groupBy(month, "Channel", "StoreID").agg(
        m.lines().alias("lines"), m.revenue().alias("revenue")
    )
    # The sums count for their store, and for targets that name no store.
    everywhere = F.lit(None).cast("string")
    scopes = F.when(F.col("StoreID").isNull(), F.array(everywhere)).otherwise(F.array(everywhere, "StoreID"))
    per_scope = (
        per_store.select("YearMonth", "Channel", "lines", "revenue", F.explode(scopes).alias("Scope"))
        .groupBy("YearMonth", "Channel", "Scope")
        .agg(F.sum("lines").alias("lines"), F.sum("revenue").alias("revenue"))
    )
    targets = model.fact_target.select(month, "Channel", "ChannelGroup", "StoreID", "TargetRevenue").alias("t")
    meets = [F.col(f"t.{key}") == F.col(f"s.{key}") for key in ("YearMonth", "Channel")]
    matched = targets.join(per_scope.alias("s"), [*meets, F.col("t.StoreID").eqNullSafe(F.col("s.Scope"))], "left")
    times = F.coalesce("lines", F.lit(1))
    return matched.groupBy("t.YearMonth", "t.Channel", "ChannelGroup").agg(
        F.sum(F.col("TargetRevenue") * times).cast(AMOUNT).alias("Target"),
        _amount(F.sum("revenue")).alias("Actual"),
    )


def aov_vs_target(model: RetailModel) -> DataFrame:
    """Orders, order value and items per order by month and channel, against targets.

    Only telesales has targets for these; other channels show none. The three targets
    stand apart: one that cannot be read leaves the others. A month with a target and
    no sales shows zeros. Lines without an order id add to items and revenue alone.
    """
    keys = ["YearMonth", "Channel"]
    month = key_month(F.col("DateKey")).alias("YearMonth")
    orders = (
        _completed(model.fact_sales)
        .groupBy(month, "Channel", "OrderID")
        .agg(m.units().alias("items"), m.revenue().alias("revenue"))
    )
    actual = orders.groupBy(*keys).agg(
        F.count("OrderID").alias("Orders"),
        F.sum("items").alias("Items"),
        F.sum("revenue").cast(AMOUNT).alias("Revenue"),
    )
    goals = (
        model.fact_target.groupBy(month, "Channel")
        .agg(
            F.max("TargetAOV").alias("TargetAOV"),
            F.sum("TargetOrders").alias("TargetOrders"),
            F.sum("TargetItems").alias("TargetItems"),
        )
        .filter(F.coalesce("TargetAOV", "TargetOrders", "TargetItems").isNotNull())
    )
    c = F.col
    compared = actual.join(goals, keys, "full").withColumns(
        {
            "Orders": F.coalesce("Orders", F.lit(0)),
            "Items": F.coalesce("Items", F.lit(0)),
            "Revenue": _amount(c("Revenue")),
        }
    )
    return compared.select(
        *keys,
        "Orders",
        "Items",
        "Revenue",
        m.ratio(c("Revenue"), c("Orders")).alias("AOV"),
        m.ratio(c("Items"), c("Orders")).alias("ItemsPerOrder"),
        "TargetAOV",
        "TargetOrders",
        "TargetItems",
        m.percent(F.try_divide(c("Revenue").cast("double"), c("Orders")), c("TargetAOV")).alias("AOV_Pct"),
        m.percent(c("Orders"), c("TargetOrders")).alias("Orders_Pct"),
        m.percent(c("Items"), c("TargetItems")).alias("Items_Pct"),
    )


# -- time --------------------------------------------------------------------------


def mtd_ytd_daily(model: RetailModel) -> DataFrame:
    return timeintel.mtd_ytd(timeintel.daily_revenue(model.fact_sales, model.dim_date))


def yoy_monthly(model: RetailModel) -> DataFrame:
    return timeintel.yoy_monthly(timeintel.daily_revenue(model.fact_sales, model.dim_date))


def workday_split(model: RetailModel) -> DataFrame:
    """Completed revenue on working days, other days and holidays.

    Lines without a date, or with one outside the calendar, are of unknown days.
    """
    per_day = _completed(model.fact_sales).groupBy("DateKey").agg(
        m.lines().alias("lines"), m.revenue().alias("revenue")
    )
    split = (
        per_day.join(model.dim_date.select("DateKey", "IsWorkingDay", "IsHoliday"), "DateKey", "left")
        .groupBy("IsWorkingDay", "IsHoliday")
        .agg(
            F.count("DateKey").alias("SalesDays"),
            F.sum("lines").alias("OrderLines"),
            F.sum("revenue").cast(AMOUNT).alias("Revenue"),
        )
    )
    return split.withColumn("Share_Pct", _share())


# -- customers -----------------------------------------------------------------------


def gender_share(model: RetailModel) -> DataFrame:
    counts = model.dim_customer.groupBy("New_Gender").agg(_count().alias("Customers"))
    return counts.withColumn("Share_Pct", _share("Customers"))


def segment_distribution(model: RetailModel) -> DataFrame:
    return rfm.segment_distribution(model.customer_rfm)


def segment_value_ratio(model: RetailModel) -> DataFrame:
    return rfm.segment_value_ratio(model.customer_rfm)


def at_risk_customers(model: RetailModel) -> DataFrame:
    return rfm.customers_of(model.customer_rfm)


# -- star joins ------------------------------------------------------------------------


def star_sales(model: RetailModel) -> DataFrame:
    """Completed sales by attributes of all five dimensions."""
    keys = [key for key, _ in SALES_RELATIONSHIPS.values()]
    facts = (
        _completed(model.fact_sales)
        .groupBy(*keys)
        .agg(_count().alias("lines"), m.units().alias("units"), F.sum("NetRevenue").alias("revenue"))
    )
    dims = {name: getattr(model, name) for name in SALES_RELATIONSHIPS}
    return (
        star_join(facts, dims, SALES_RELATIONSHIPS, keys)
        .groupBy("YearQuarter", "CategoryName", "RegionName", "EmployeeRole", "CustomerGender")
        .agg(
            F.sum("lines").alias("OrderLines"),
            F.sum("units").alias("Units"),
            F.sum("revenue").cast(AMOUNT).alias("Revenue"),
        )
    )


def star_target(model: RetailModel) -> DataFrame:
    """Targets by attributes of the calendar and the stores."""
    dims = {name: getattr(model, name) for name in TARGET_RELATIONSHIPS}
    facts = model.fact_target.select("DateKey", "StoreID", "StoreName", "TargetRevenue")
    return (
        star_join(facts, dims, TARGET_RELATIONSHIPS, ["StoreName", "DateKey"])
        .groupBy("YearQuarter", "RegionName", "OwnershipType")
        .agg(_count().alias("Targets"), F.sum("TargetRevenue").cast(TARGET).alias("Target"))
    )
