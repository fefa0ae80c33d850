"""Running totals and year-on-year comparison on a gap-free calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import percent, revenue


def daily_revenue(sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Completed revenue of every calendar day; zero on days without sales.

    Only completed lines are read, and they are summed per day first, so what is
    joined and windowed afterwards has one row per day. Sales on days outside the
    calendar do not show.
    """
    per_day = sales.filter("IsSuccess").groupBy("OrderDate").agg(revenue().alias("Revenue"))
    days = dim_date.select("FullDate", "YearMonth", "Year")
    joined = days.join(per_day, days["FullDate"] == per_day["OrderDate"], "left")
    zero = F.lit(0).cast(per_day.schema["Revenue"].dataType)
    return joined.select(*days.columns, F.coalesce("Revenue", zero).alias("Revenue"))


def mtd_ytd(daily: DataFrame) -> DataFrame:
    """Revenue since the start of the month and of the year, by day."""

    def since_start(period: str):
        window = Window.partitionBy(period).orderBy("FullDate").rowsBetween(Window.unboundedPreceding, 0)
        return F.sum("Revenue").over(window).cast("decimal(38,4)")

    return daily.select(
        "FullDate", "Revenue", since_start("YearMonth").alias("MTD_Revenue"), since_start("Year").alias("YTD_Revenue")
    )


def yoy_monthly(daily: DataFrame) -> DataFrame:
    """Revenue of each month beside the same month of the year before."""
    months = daily.groupBy("YearMonth").agg(F.sum("Revenue").alias("Revenue"))
    before = months.select((F.col("YearMonth") + 100).alias("YearMonth"), F.col("Revenue").alias("LastYear_Revenue"))
    change = F.col("Revenue") - F.col("LastYear_Revenue")
    return (
        months.join(before, "YearMonth", "left")
        .withColumn("YoY_Pct", percent(change, F.col("LastYear_Revenue")))
        .select("YearMonth", "Revenue", "LastYear_Revenue", "YoY_Pct")
    )
