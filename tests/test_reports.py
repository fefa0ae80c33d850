"""Properties that must hold whatever the data."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shopgrain.functions import vocabulary as words
from shopgrain.operators.star import duplicate_keys
from shopgrain.plans import catalog, reports, stored
from shopgrain.plans.model import RetailModel
from shopgrain.sources.contract import RAW, raw_schema
from shopgrain.sources.driver_tables import DriverTables

from . import raw_tables


@pytest.fixture(scope="module")
def raw_model(spark):
    return RetailModel.of_tables(raw_tables.tables(spark))


def total(frame, column):
    return frame.agg(F.sum(column)).first()[0]


def test_one_pass_equals_stacked_feeds(model):
    one_pass, stacked = model.fact_sales, model.stacked_sales()
    assert one_pass.schema.simpleString() == stacked.schema.simpleString()
    assert one_pass.exceptAll(stacked).isEmpty() and stacked.exceptAll(one_pass).isEmpty()


def test_derived_raw_tables_have_their_declared_types(spark, folder):
    source = DriverTables(spark, folder)
    for name in RAW:
        assert source.raw(name).schema.simpleString() == raw_schema(name).simpleString(), name
    dates = source.raw("ecom.E01TikiOrders").select("NgayDat", "DoanhThu").collect()
    assert {len(r["NgayDat"]) for r in dates} == {8, 10, 23}
    assert any(r["DoanhThu"] != r["DoanhThu"].strip() for r in dates)


@pytest.mark.parametrize(
    ("dim", "key"),
    [
        ("dim_product", "SKUCode"),
        ("dim_store", "StoreID"),
        ("dim_employee", "EmpID"),
        ("dim_date", "DateKey"),
        ("dim_customer", "CustomerID"),
    ],
)
def test_dimensions_keep_their_key_unique(model, dim, key):
    assert duplicate_keys(getattr(model, dim), key).isEmpty()


def test_shares_add_up_to_all_revenue(model):
    revenue = reports.total_revenue(model).first()["Revenue"]
    for report in (reports.channel_share, reports.channel_group_share, reports.region_share, reports.ownership_share):
        frame = report(model)
        assert total(frame, "Revenue") == revenue
        assert total(frame, "Share_Pct") == pytest.approx(100, abs=1e-4)
    completed = model.fact_sales.filter("IsSuccess")
    for report in (reports.category_mix, reports.collection_mix):
        assert total(report(model), "Revenue") == total(completed, "NetRevenue") == revenue


def test_year_to_date_ends_at_the_year(model):
    daily = reports.mtd_ytd_daily(model)
    last_days = daily.filter("month(FullDate) = 12 AND day(FullDate) = 31")
    per_year = daily.groupBy(F.year("FullDate").alias("y")).agg(F.sum("Revenue").alias("r"))
    ends = {r["FullDate"].year: r["YTD_Revenue"] for r in last_days.collect()}
    assert ends == {r["y"]: r["r"] for r in per_year.collect()}
    assert total(daily, "Revenue") == reports.total_revenue(model).first()["Revenue"]


def test_targets_are_not_repeated_by_sales(raw_model):
    found = {(r["YearMonth"], r["Channel"]): r for r in reports.revenue_vs_target(raw_model).collect()}
    assert found[202401, "RMS"]["Target"] == D("1300.00")  # S1 and S2, once each
    assert found[202401, "RMS"]["Actual"] == D("280.0000")
    assert found[202402, "RMS"]["Actual"] == 0  # a month without completed sales
    assert (found[202401, "GMC"]["Target"], found[202401, "GMC"]["Actual"]) == (D("200.00"), D("240.0000"))
    # Marketplace targets meet the sales of their platform.
    assert (found[202401, "Ecom"]["Target"], found[202401, "Ecom"]["Actual"]) == (D("110.00"), D("517.0000"))


def test_the_literal_comparison_repeats_targets(raw_model):
    literal = {(r["YearMonth"], r["Channel"]): r for r in reports.target_fanout_demo(raw_model).collect()}
    # S1 has three lines in January (one order of two, one cancelled), S2 none.
    assert literal[202401, "RMS"]["Target"] == D("3300.0000")
    assert literal[202401, "RMS"]["Actual"] == D("280.0000")
    assert (literal[202401, "Ecom"]["Target"], literal[202401, "Ecom"]["Actual"]) == (D("110.0000"), 0)
    assert literal[202401, "GMC"]["Target"] == D("600.0000")  # three telesales lines


def test_fee_rate_takes_the_sign_away(raw_model):
    rates = {r["Channel"]: r for r in reports.platform_fee_rate(raw_model).collect()}
    assert (rates["Tiki"]["PlatformFee"], rates["Tiki"]["FeeRate_Pct"]) == (D("30"), 15.0)
    assert rates["Lazada"]["FeeRate_Pct"] == 0


def test_order_quality(raw_model):
    rows = {r["Channel"]: r for r in reports.order_quality(raw_model).collect()}
    lazada = rows["Lazada"]
    assert (lazada["Orders"], lazada["SuccessOrders"], lazada["CancelledOrders"], lazada["ReturnedOrders"]) == (5, 2, 2, 1)
    assert (lazada["SuccessRate_Pct"], lazada["ReturnRate_Pct"]) == (40.0, 20.0)
    store = rows["RMS"]
    assert (store["Orders"], store["OrderLines"], store["SuccessLines"]) == (6, 7, 3)


class OwnFacts:
    """A model with facts of its own."""

    def __init__(self, model, **frames):
        self.model, self.frames = model, frames

    def __getattr__(self, name):
        return self.frames.get(name) if name in self.frames else getattr(self.model, name)


def test_lines_without_an_order_id_are_no_order(spark, raw_model):
    blank = F.when(F.col("Channel") != "Lazada", F.col("OrderID"))
    facts = raw_model.fact_sales.withColumn("OrderID", blank)
    own = OwnFacts(raw_model, fact_sales=facts, keyed_sales=lambda: facts.withColumn("OrderKey", F.col("OrderID")))
    quality = {r["Channel"]: r for r in reports.order_quality(own).collect()}
    breakdown = {r["Channel"]: r["Orders"] for r in reports.channel_breakdown(own).collect()}
    assert {c: r["Orders"] for c, r in quality.items()} == breakdown
    assert (breakdown["Lazada"], quality["Lazada"]["SuccessOrders"], quality["Lazada"]["OrderLines"]) == (0, 0, 5)
    values = {(r["YearMonth"], r["Channel"]): r for r in reports.aov_vs_target(own).collect()}
    assert all(r["Orders"] == 0 and r["AOV"] is None and r["Items"] > 0 for (_, c), r in values.items() if c == "Lazada")
    (overall,) = reports.overall_success(own).collect()
    assert overall["Orders"] == reports.total_revenue(own).first()["Orders"]


def test_targets_stand_apart(spark, model):
    unread = model.fact_target.withColumn("TargetAOV", F.lit(None).cast("decimal(18,2)"))
    before = reports.aov_vs_target(model)
    after = reports.aov_vs_target(OwnFacts(model, fact_target=unread))
    for target in ("TargetOrders", "TargetItems"):
        assert total(after, target) == total(before, target) > 0
    assert after.filter("TargetAOV IS NOT NULL").isEmpty()
    no_sales = OwnFacts(model, fact_sales=model.fact_sales.limit(0))
    rows = reports.aov_vs_target(no_sales).collect()
    assert rows and all((r["Orders"], r["Items"], r["Revenue"]) == (0, 0, 0) for r in rows)


def test_days_off_the_calendar_stay(raw_model):
    split = reports.workday_split(raw_model)
    assert total(split, "Revenue") == reports.total_revenue(raw_model).first()["Revenue"]
    assert total(split, "Share_Pct") == pytest.approx(100, abs=1e-4)


def test_year_on_year_is_null_without_a_base(raw_model):
    assert all(r["YoY_Pct"] is None for r in reports.yoy_monthly(raw_model).collect())


def test_every_customer_has_one_segment(model):
    distribution = reports.segment_distribution(model)
    assert total(distribution, "Customers") == model.customer_rfm.count()
    assert total(distribution, "Share_Pct") == pytest.approx(100, abs=1e-4)


def test_published_views_answer_sql(spark, raw_model):
    raw_model.publish()
    for view in words.VIEW_NAMES.values():
        assert spark.table(view).count() > 0
    found = spark.sql(
        """SELECT p.CategoryName, sum(s.NetRevenue) AS revenue FROM v_FactSales s
           JOIN v_DimProduct p ON p.SKUCode = s.SKUCode WHERE s.IsSuccess AND s.Channel = 'RMS' GROUP BY ALL"""
    ).collect()
    assert [tuple(r) for r in found] == [("Tops", D("380.0000"))]


def test_every_report_is_registered():
    made = {name for name in vars(reports) if not name.startswith("_")}
    assert {r.__name__ for r in catalog.REPORTS} <= made
    on_stored = len(stored.ON_MODEL) + len(stored.ON_FOLDER)
    assert len(catalog.queries()) == len(catalog.REPORTS) + len(words.VIEW_NAMES) + on_stored + 2
