"""Registered queries over a folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import session
from ..functions import vocabulary as words
from ..operators import rfm
from . import reports, stored
from .model import RetailModel

Query = Callable[[SparkSession, str], DataFrame]

REPORTS = (
    reports.row_count_audit,
    reports.channel_breakdown,
    reports.total_revenue,
    reports.channel_share,
    reports.channel_group_share,
    reports.overall_success,
    reports.platform_fee_rate,
    reports.net_after_fee,
    reports.avg_discount,
    reports.order_quality,
    reports.top_products,
    reports.category_mix,
    reports.collection_mix,
    reports.gross_margin,
    reports.region_share,
    reports.ownership_share,
    reports.revenue_vs_target,
    reports.overall_achievement,
    reports.region_achievement,
    reports.region_month_achievement,
    reports.manager_vs_target,
    reports.store_vs_target,
    reports.store_ranking,
    reports.target_fanout_demo,
    reports.aov_vs_target,
    reports.mtd_ytd_daily,
    reports.yoy_monthly,
    reports.workday_split,
    reports.gender_share,
    reports.segment_distribution,
    reports.segment_value_ratio,
    reports.at_risk_customers,
    reports.star_sales,
    reports.star_target,
)


def _on_model(report: Callable[[RetailModel], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        session.apply(spark)
        return report(RetailModel.of_driver_tables(spark, folder))

    return query


def _on_folder(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        session.apply(spark)
        return query(spark, folder)

    return run


def _rfm_in_buckets(model: RetailModel) -> DataFrame:
    """Customer segments by the steps that large customer counts take."""
    return rfm.customer_rfm(model.fact_sales, model.dim_date, buckets=16)


def queries() -> dict[str, Query]:
    products = {name: _on_model(lambda model, name=name: getattr(model, name)) for name in words.VIEW_NAMES}
    variants = {
        "fact_sales_union": _on_model(RetailModel.stacked_sales),
        "customer_rfm_distributed": _on_model(_rfm_in_buckets),
    }
    on_model = {report.__name__: _on_model(report) for report in (*REPORTS, *stored.ON_MODEL)}
    return products | variants | on_model | {query.__name__: _on_folder(query) for query in stored.ON_FOLDER}
