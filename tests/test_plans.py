"""Physical plans: what is read, joined and shuffled."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import rfm
from shopgrain.plans import catalog, reports
from shopgrain.plans.model import RetailModel
from shopgrain.sources.driver_tables import DriverTables
from shopgrain.sources.tables import read_sales, write_sales


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet.*/{table}\.parquet", plan))


@pytest.mark.parametrize("report", [
    reports.channel_breakdown, reports.order_quality, reports.revenue_vs_target, reports.target_fanout_demo,
    reports.aov_vs_target, reports.gross_margin, reports.region_share,
])
def test_lines_are_scanned_once(model, report):
    plan = plan_of(report(model))
    assert scans(plan, "lineitem") == 1 and scans(plan, "orders") == 1


def test_only_needed_columns_are_read(model):
    plan = plan_of(model.fact_sales.groupBy("Channel").agg(F.sum("Quantity")))
    (schema,) = re.findall(r"lineitem.*?ReadSchema: struct<(.*?)>", plan)
    assert schema == "l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_linestatus:string"


def test_filters_reach_the_scan_of_orders(model):
    plan = plan_of(model.fact_sales.filter("IsSuccess").groupBy("StoreID").agg(F.sum("NetRevenue")))
    assert re.search(r"orders\.parquet.*PushedFilters: \[In\(o_orderpriority", plan)
    # Success is decided on orders, before they meet their lines.
    before_join = plan[plan.index("SortMergeJoin"):]
    assert "status_code" in before_join or "o_orderstatus" in before_join


@pytest.mark.parametrize("report", [reports.store_vs_target, reports.region_month_achievement, reports.manager_vs_target])
def test_store_reports_read_store_orders_only(model, report):
    plan = plan_of(report(model))
    filters = re.findall(r"/orders\.parquet.*?PushedFilters: \[(.*?)\]", plan)
    assert any("EqualTo(o_orderpriority,1-URGENT)" in f for f in filters) and not any("In(o_orderpriority" in f for f in filters)


def test_orders_and_lines_are_never_broadcast(model):
    plan = plan_of(model.fact_sales)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_no_cartesian_products(spark, folder):
    for name, query in catalog.queries().items():
        plan = plan_of(query(spark, folder))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_customers_never_meet_in_one_task(spark, monkeypatch):
    """The frames that are numbered: each by bucket, none by a window over all rows."""
    seen = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: seen.append(plan_of(self)) or collect(self))
    base = spark.range(4000).selectExpr(
        "string(id) AS CustomerID", "int(id % 90) AS Recency_Days", "id % 7 AS Frequency", "id * 1.0 AS Monetary"
    )
    scored = rfm.score(base)
    windows = [p for p in seen if "Window" in p]
    assert windows
    for plan in windows:
        assert not re.search(r"Window \[row_number\(\) windowspecdefinition\(position", plan)
        assert "SinglePartition" not in plan
    assert "SinglePartition" not in plan_of(scored) and "Exchange" not in plan_of(scored)


@pytest.mark.parametrize("report", [reports.store_vs_target, reports.star_sales, reports.star_target, reports.store_ranking])
def test_reports_are_built_without_a_job_over_the_fact(spark, folder, report):
    """Building a report runs nothing, once the schemas and the days of the calendar are known."""
    source = DriverTables(spark, folder)
    for name in "region nation customer supplier part orders lineitem".split():
        source.table(name)
    assert source.day_range
    model = RetailModel(source.raw, source.sales)
    spark.sparkContext.setJobGroup("build", "build")
    try:
        report(model)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def sides(plan: str) -> list[tuple[str, str]]:
    """What lies under either side of each join of a plan."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    lines = [line for line in plan.splitlines() if line.strip()]
    found = []
    for at, line in enumerate(lines):
        if not re.match(r"[ :+\-*()\d]*(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", line):
            continue
        under = []
        for below in lines[at + 1 :]:
            if depth(below) <= depth(line):
                break
            under.append(below)
        first = depth(under[0])
        starts = [i for i, below in enumerate(under) if depth(below) == first]
        found.append(tuple("\n".join(under[i:j]) for i, j in zip(starts, [*starts[1:], len(under)])))
    return found


def test_reports_join_products_to_sums(model):
    """The fact is summed by SKU below its join with the product dimension."""
    plan = plan_of(reports.category_mix(model))
    meets = [
        (sums, products)
        for sums, products in ((s, p) for pair in sides(plan) if len(pair) == 2 for s, p in (pair, pair[::-1]))
        if "lineitem.parquet" in sums and "lineitem.parquet" not in products and "part.parquet" in products
    ]
    assert meets
    for sums, _ in meets:
        assert "HashAggregate(keys=[SKUCode" in sums


def test_written_sales_prune_months(spark, model, tmp_path):
    path = str(tmp_path / "sales")
    write_sales(model.fact_sales, path)
    stored = read_sales(spark, path)
    assert stored.count() == model.fact_sales.count()
    one_month = stored.filter("YearMonth = 199701")
    assert re.search(r"PartitionFilters: \[.*YearMonth#\d+ = 199701", plan_of(one_month))
    assert one_month.count() == model.fact_sales.filter("DateKey DIV 100 = 199701").count() > 0


def test_an_order_with_a_third_of_all_lines_is_split(spark, folder, tmp_path):
    """A hot order is split among tasks, and its lines all count."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    hot = orders.filter("o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F'").agg(F.min("o_orderkey")).first()[0]
    copies = F.when(F.col("l_linenumber") <= 2, hot).otherwise(F.col("l_orderkey")).alias("l_orderkey")
    many = lines.crossJoin(spark.range(20)).select(copies, *lines.columns[1:])
    many.repartition(16).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        report = reports.channel_breakdown(RetailModel.of_driver_tables(spark, str(tmp_path)))
        found = {r["Channel"]: r for r in report.collect()}
        assert "SortMergeJoin(skew=true)" in plan_of(report)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    expected = many.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).filter("o_orderpriority = '4-NOT SPECIFIED'")
    row = expected.agg(F.countDistinct("o_orderkey").alias("o"), F.sum("l_quantity").cast("bigint").alias("u")).first()
    assert (found["Shopee"]["Orders"], found["Shopee"]["Units"]) == (row["o"], row["u"])
