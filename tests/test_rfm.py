from __future__ import annotations

from collections import Counter
from decimal import Decimal as D
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopgrain.operators import ntile, ordering, rfm
from shopgrain.operators.rank import add_rank
from shopgrain.plans.model import RetailModel

from . import raw_tables


def expected_segment(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champion"
    if r >= 3 and f >= 3 and m >= 3:
        return "Loyal"
    if r >= 4 and f <= 2:
        return "New Customer"
    if r >= 3 and f >= 2 and m >= 3:
        return "Potential Loyalist"
    if r <= 2 and f >= 3 and m >= 3:
        return "At Risk"
    if r == 1 and f >= 3:
        return "Lost Champion"
    if r <= 2 and f <= 2:
        return "Lost"
    return "Need Attention"


def test_all_125_score_triples(spark):
    triples = list(product(range(1, 6), repeat=3))
    frame = spark.createDataFrame(triples, "r int, f int, m int")
    found = frame.select("*", rfm.segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert {tuple(x)[:3]: x["s"] for x in found} == {t: expected_segment(*t) for t in triples}
    assert Counter(x["s"] for x in found) == {
        "Champion": 8,
        "Loyal": 19,
        "New Customer": 20,
        "Potential Loyalist": 3,
        "At Risk": 18,
        "Lost Champion": 6,
        "Lost": 20,
        "Need Attention": 31,
    }


def test_base_on_raw_tables(spark):
    model = RetailModel.of_tables(raw_tables.tables(spark))
    base = {r["CustomerID"]: r for r in rfm.customer_base(model.fact_sales, model.dim_date).collect()}
    # Only completed lines of known customers on calendar days: C1 (store), 7 (telesales).
    # 8 has no readable date, C9 bought on a day outside the calendar, C2 only cancelled.
    assert set(base) == {"C1", "7"}
    assert (base["C1"]["Recency_Days"], base["C1"]["Frequency"], base["C1"]["Monetary"]) == (361, 1, D("280"))
    assert (base["7"]["Recency_Days"], base["7"]["Frequency"], base["7"]["Monetary"]) == (361, 1, D("160"))


def test_an_order_id_of_two_systems_counts_once(spark):
    sales = spark.createDataFrame(
        [("c", "1", 20240105, D("1"), True), ("c", "1", 20240106, D("1"), True)],
        "CustomerID string, OrderID string, DateKey int, NetRevenue decimal(38,4), IsSuccess boolean",
    )
    model = RetailModel.of_tables(raw_tables.tables(spark))
    (row,) = rfm.customer_base(sales, model.dim_date).collect()
    assert (row["Frequency"], row["Monetary"], row["Recency_Days"]) == (1, D("2"), 360)


@given(rows=st.integers(0, 200), tiles=st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_tile_ends_follow_the_definition(rows, tiles):
    size, larger = divmod(rows, tiles)
    sizes = [size + 1] * larger + [size] * (tiles - larger)
    assert ntile.tile_ends(rows, tiles) == [sum(sizes[:n]) for n in range(1, tiles)]


def customers(spark, rows):
    """Customers of whom many share a value, and some have none."""
    return spark.range(rows).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("CustomerID"),
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 37 % 100).cast("int")).alias("Recency_Days"),
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 5).cast("bigint").alias("Frequency"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7919 % 1000).cast("decimal(38,4)")).alias("Monetary"),
    )


@pytest.mark.parametrize("rows", [1, 3, 5, 12, 997])
@pytest.mark.parametrize("buckets", [None, 1, 7, 40])
def test_distributed_scores_equal_the_window(spark, rows, buckets):
    frame = customers(spark, rows)
    assert sorted(rfm.score(frame, buckets).collect()) == sorted(rfm.score_by_window(frame).collect())


def test_scores_beyond_the_sample(spark, monkeypatch):
    """Samples a part of the rows, with bounds in long lists."""
    monkeypatch.setattr(ordering, "SAMPLE_ROWS", 300)
    frame = customers(spark, 5000)
    assert sorted(rfm.score(frame, 30).collect()) == sorted(rfm.score_by_window(frame).collect())


def test_tiles_differ_by_one_row_at_most(spark):
    scored = rfm.score(customers(spark, 1003), 9)
    for score in ("R_Score", "F_Score", "M_Score"):
        sizes = [r["count"] for r in scored.groupBy(score).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_no_customers(spark):
    assert rfm.label(rfm.score(customers(spark, 0))).isEmpty()


def test_ranks_within_groups(spark):
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 5 > 0, (F.col("id") % 7).cast("int")).alias("month"),
        F.col("id").cast("string").alias("store"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 13).cast("decimal(38,4)")).alias("revenue"),
    )
    found = [tuple(r) for r in add_rank(frame, "place", ["month"], "revenue", "store").collect()]
    groups = {}
    for row in frame.collect():
        groups.setdefault(row["month"], []).append(tuple(row))
    expected = [
        (*row, place)
        for rows in groups.values()
        for place, row in enumerate(sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[1])), 1)
    ]
    key = lambda r: (r[0] is None, r[0], r[3])
    assert sorted(found, key=key) == sorted(expected, key=key)
