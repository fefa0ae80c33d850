from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from pyspark.errors import PySparkException

from shopgrain.operators.star import DuplicateKeyError, check_keys, dimension_join, star_join
from shopgrain.plans import reports
from shopgrain.plans.model import RetailModel
from shopgrain.sources.driver_tables import DriverTables


@pytest.fixture(scope="module")
def facts(spark):
    """Facts of which most have no key, and one key holds a third."""
    return spark.range(900).select(
        F.col("id").cast("string").alias("OrderID"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 30 == 1, F.concat(F.lit("k"), F.col("id"))).alias("StoreID"),
        F.col("id").alias("amount"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("hot", "North", 1), ("k1", "South", 2), ("k31", None, 3), (None, "Nowhere", 4)]
    return spark.createDataFrame(rows, "StoreID string, Region string, Size int")


def joined(facts, dim):
    return dimension_join(facts, dim, "StoreID", {"Region": "Region", "Size": "Size"}, ["OrderID"])


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_every_fact_is_kept_once(spark, facts, dim, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        result = joined(facts, dim)
        assert result.columns == ["OrderID", "StoreID", "amount", "Region", "Size"]
        rows = {r["OrderID"]: r for r in result.collect()}
        assert len(rows) == result.count() == 900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert (rows["0"]["Region"], rows["0"]["Size"]) == ("North", 1)
    assert (rows["1"]["Region"], rows["31"]["Region"], rows["31"]["Size"]) == ("South", "(unknown)", 3)
    assert (rows["2"]["StoreID"], rows["2"]["Region"], rows["2"]["Size"]) == (None, "(unknown)", None)


def test_a_repeated_key_is_refused(dim):
    relationship = {"dim": ("StoreID", {"Region": "Region"})}
    check_keys({"dim": dim}, relationship)
    with pytest.raises(DuplicateKeyError):
        check_keys({"dim": dim.union(dim)}, relationship)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_a_repeated_key_stops_the_join(spark, facts, dim, threshold):
    """Whatever the join, and also where the attributes are the same or are not asked for."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for repeated in (dim.union(dim.where("StoreID = 'hot'")), dim.union(spark.createDataFrame([("k1", "x", 9)], dim.schema))):
            for ask in (lambda d: d.collect(), lambda d: d.groupBy("Region").count().collect()):
                with pytest.raises(PySparkException, match="StoreID is not unique"):
                    ask(joined(facts, repeated))
        nulls = dim.union(dim.where("StoreID is null"))  # absent keys match nothing and may repeat
        assert joined(facts, nulls).count() == 900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_star_reports_refuse_a_repeated_employee(spark, folder):
    source = DriverTables(spark, folder)
    employees = source.raw("mdm.E00Employee")
    raw = lambda name: employees.union(employees.limit(1)) if name == "mdm.E00Employee" else source.raw(name)
    with pytest.raises(PySparkException, match="EmpID is not unique"):
        reports.star_sales(RetailModel(raw, source.sales)).collect()


def test_relationships_are_joined_one_after_the_other(facts, dim):
    dims = {"one": dim, "two": dim.withColumnRenamed("Region", "Other")}
    found = star_join(facts, dims, {"one": ("StoreID", {"Region": "R"}), "two": ("StoreID", {"Other": "O"})}, ["OrderID"])
    assert found.columns == ["OrderID", "StoreID", "amount", "R", "O"] and found.where("R = O").count() == 900


def test_large_dimensions_are_not_broadcast(facts, dim, spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined(facts, dim)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert "_bucket" in plan  # absent keys are spread


def test_absent_keys_are_dealt_by_their_bucket(facts, dim, spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined(facts, dim)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert re.search(r"SortMergeJoin \[StoreID#\d+, _bucket#\d+\]", plan)
    assert re.search(r"Exchange hashpartitioning\(StoreID#\d+, _bucket#\d+", plan)
