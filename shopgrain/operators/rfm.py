"""Customer segmentation by recency, frequency and monetary value."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.contract import contract_columns
from ..functions.measures import percent, ratio
from .ntile import add_tiles
from .settle import settle

SCORES = {"R": "Recency_Days", "F": "Frequency", "M": "Monetary"}
TILES = 5


def customer_orders(sales: DataFrame) -> DataFrame:
    """Net revenue per customer, completed order and day: what the base is folded from."""
    completed = sales.filter(F.col("IsSuccess") & F.col("CustomerID").isNotNull())
    return completed.groupBy("CustomerID", "OrderID", "DateKey").agg(F.sum("NetRevenue").alias("NetRevenue"))


def base_of_orders(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value of the customers of these orders.

    Sales on days outside the calendar do not count. Recency is measured from
    the last day of the calendar, which may be later than the last sale.
    """
    days = dim_date.select("DateKey", "FullDate")
    last_day = days.agg(F.max("FullDate").alias("day")).select("day").scalar()
    return (
        orders.join(days, "DateKey")
        .groupBy("CustomerID")
        .agg(
            F.max("FullDate").alias("LastDay"),
            F.countDistinct("OrderID").alias("Frequency"),
            F.sum("NetRevenue").cast("decimal(38,4)").alias("Monetary"),
        )
        .select("CustomerID", F.datediff(last_day, F.col("LastDay")).alias("Recency_Days"), "Frequency", "Monetary")
    )


def customer_base(sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value of every customer with a completed order.

    Lines are folded to orders by day before they meet the calendar.
    """
    return base_of_orders(customer_orders(sales), dim_date)


def score(base: DataFrame, buckets: int | None = None) -> DataFrame:
    """Quintile scores by distributed NTILE; ties fall in order of customer id.

    `buckets` overrides the number of buckets that follows from the row count.
    """
    tiled = add_tiles(settle(base), TILES, "CustomerID", {f"_{s}": value for s, value in SCORES.items()}, buckets)
    return _scored(tiled, {s: F.col(f"_{s}") for s in SCORES})


def score_by_window(base: DataFrame) -> DataFrame:
    """The same scores by the built-in window, which sorts in one task.

    A check of `score` on data known to be small.
    """
    return _scored(
        base, {s: F.ntile(TILES).over(Window.orderBy(value, "CustomerID")) for s, value in SCORES.items()}
    )


def _scored(frame: DataFrame, tiles: dict[str, Column]) -> DataFrame:
    # The first recency tile holds the latest customers and scores highest.
    return frame.select(
        "CustomerID",
        *SCORES.values(),
        (F.lit(TILES + 1) - tiles["R"]).alias("R_Score"),
        tiles["F"].alias("F_Score"),
        tiles["M"].alias("M_Score"),
    )


def segment(r: Column, f: Column, m: Column) -> Column:
    """Segment label of three scores: the first rule that holds."""
    # Labels, thresholds and their order.
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champion")
        .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal")
        .when((r >= 4) & (f <= 2), "New Customer")
        .when((r >= 3) & (f >= 2) & (m >= 3), "Potential Loyalist")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
        .when((r == 1) & (f >= 3), "Lost Champion")
        .when((r <= 2) & (f <= 2), "Lost")
        .otherwise("Need Attention")
    )


def label(scored: DataFrame) -> DataFrame:
    return scored.select(*_labelled_columns())


@cache
def _labelled_columns() -> list[Column]:
    """Contract columns over scored customers, built once for all queries."""
    scores = {f"{s}_Score": F.col(f"{s}_Score") for s in SCORES}
    values = {name: F.col(name) for name in ("CustomerID", *SCORES.values())} | scores
    values["RFM_Score"] = F.concat(*[s.cast("string") for s in scores.values()])
    values["RFM_Segment"] = segment(*scores.values())
    return contract_columns("customer_rfm", values)


def customer_rfm(sales: DataFrame, dim_date: DataFrame, buckets: int | None = None) -> DataFrame:
    return label(score(customer_base(sales, dim_date), buckets))


def segment_distribution(rfm: DataFrame) -> DataFrame:
    """Customers and share per segment."""
    counts = rfm.groupBy("RFM_Segment").agg(F.count(F.lit(1)).alias("Customers"))
    return counts.withColumn("Share_Pct", percent(F.col("Customers"), F.sum("Customers").over(Window.partitionBy())))


def segment_value_ratio(rfm: DataFrame, base_segment: str = "Lost") -> DataFrame:
    """Mean monetary value per segment, and as a multiple of the base segment's."""
    per_segment = rfm.groupBy("RFM_Segment").agg(
        F.count(F.lit(1)).alias("Customers"), F.sum("Monetary").alias("Monetary")
    )
    average = per_segment.select("RFM_Segment", "Customers", ratio(F.col("Monetary"), F.col("Customers")).alias("AvgMonetary"))
    base = F.max(F.when(F.col("RFM_Segment") == base_segment, F.col("AvgMonetary"))).over(Window.partitionBy())
    return average.withColumn("RatioToLost", ratio(F.col("AvgMonetary"), base))


def customers_of(rfm: DataFrame, segment_label: str = "At Risk") -> DataFrame:
    """All customers of a segment, most valuable first."""
    return rfm.filter(F.col("RFM_Segment") == segment_label).orderBy(F.desc("Monetary"), "CustomerID")
