"""A fact that change sets keep up to date equals one that is built anew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shopgrain.operators import rfm
from shopgrain.operators.settle import settle
from shopgrain.sources import upkeep
from shopgrain.sources.contract import output_schema
from shopgrain.sources.tables import read_sales, write_sales


def lines(spark, orders):
    """Contract rows of orders: (channel, order, day, customer, units of the lines)."""
    rows = [
        (channel, order, day, customer, units, at)
        for (channel, order), (day, customer, lot) in orders.items()
        for at, units in enumerate(lot)
    ]
    df = spark.createDataFrame(rows, "Channel string, OrderID string, DateKey int, CustomerID string, Quantity int, LineID string")
    made = df.withColumns({"NetRevenue": F.col("Quantity") * 10, "IsSuccess": F.col("Quantity") % 5 != 0})
    return made.select(
        *[
            (F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in output_schema("fact_sales")
        ]
    )


def same(left, right):
    left, right = (frame.select(*output_schema("fact_sales").names) for frame in (left, right))
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_any_sequence_of_changes_equals_a_rebuild(spark, tmp_path):
    rng = random.Random(4)
    days = [19970115, 19970220, 19970221, 19970310, 19970412, None]

    def order():
        return rng.choice(days), rng.choice(["c1", "c2", "c3", None]), [rng.randint(1, 9) for _ in range(rng.randint(1, 4))]

    key = lambda: (rng.choice(["A", "B"]), rng.choice([*map(str, range(25)), None]))
    state = {key(): order() for _ in range(25)}
    sales, by_order = str(tmp_path / "sales"), str(tmp_path / "orders")
    write_sales(lines(spark, state), sales)
    upkeep.write_customer_orders(rfm.customer_orders(read_sales(spark, sales)), by_order)
    calendar = spark.createDataFrame([(d,) for d in days if d], "DateKey int").withColumn(
        "FullDate", F.to_date(F.col("DateKey").cast("string"), "yyyyMMdd")
    )
    for turn in range(5):
        named = {key() for _ in range(7)}
        now = {k: order() for k in named if rng.random() < 0.6} if turn < 4 else {}
        named |= {k for k in state if turn == 3 and state[k][0] == 19970412}  # a month is emptied
        now = {k: v for k, v in now.items() if turn != 3 or v[0] != 19970412}
        state = {k: v for k, v in state.items() if k not in named} | now
        orders = spark.createDataFrame([(*k, 1) for k in named] * 2, "Channel string, OrderID string, NetRevenue int")
        for _ in range(2):  # applying it again changes nothing
            months = upkeep.apply_changes(spark, sales, orders, lines(spark, now))
            upkeep.refresh_customer_orders(spark, sales, by_order, months)
        stored, rebuilt = read_sales(spark, sales), lines(spark, state)
        same(stored, rebuilt)
        found = rfm.base_of_orders(upkeep.read_customer_orders(spark, by_order), calendar)
        expected = rfm.customer_base(rebuilt.where("DateKey is not null"), calendar)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_only_the_months_of_changes_are_written(spark, model, tmp_path):
    path = str(tmp_path / "sales")
    write_sales(model.fact_sales, path)
    one = settle(read_sales(spark, path).where("YearMonth = 199701").limit(1))
    files = lambda: {f: len(list(f.iterdir())) for f in (tmp_path / "sales").iterdir() if f.is_dir()}
    stamps = lambda: {p: p.stat().st_mtime_ns for f in files() for p in f.iterdir()}
    before, n = stamps(), read_sales(spark, path).count()
    gone = model.fact_sales.join(one.select("Channel", "OrderID"), ["Channel", "OrderID"], "left_semi").count()
    assert upkeep.apply_changes(spark, path, one, one.limit(0)) == [199701]
    after = stamps()
    changed = {p.parent.name for p in before.keys() ^ after.keys()} | {p.parent.name for p in before if after.get(p) != before[p]}
    assert changed == {"YearMonth=199701"} and read_sales(spark, path).count() == n - gone
    assert upkeep.apply_changes(spark, path, one, one.limit(0)) == []


def test_lines_of_orders_that_are_not_named_are_refused(spark, tmp_path):
    path = str(tmp_path / "sales")
    made = lines(spark, {("A", "1"): (19970115, "c", [1]), ("B", "1"): (19970115, "c", [2])})
    write_sales(made, path)
    with pytest.raises(upkeep.UnnamedOrderError):
        upkeep.apply_changes(spark, path, made.where("Channel = 'A'"), made)
    same(read_sales(spark, path), made)


def test_lines_that_stay_are_not_shuffled(spark, model, tmp_path, monkeypatch):
    """Only lines that are given, or may be of a named order, are dealt by month again."""
    path = str(tmp_path / "sales")
    write_sales(model.fact_sales, path)
    stored = read_sales(spark, path)
    one = settle(stored.where("OrderID is not null").limit(1))
    dealt = []

    def watched(sales, path, gathered=None, **more):
        dealt.append((sales.count(), gathered.count()))
        return write_sales(sales, path, gathered=gathered, **more)

    monkeypatch.setattr(upkeep, "write_sales", watched)
    n = stored.where(F.col("YearMonth") == one.first()["YearMonth"]).count()
    upkeep.apply_changes(spark, path, one, one.drop("YearMonth"))
    ((moved, stay),) = dealt
    assert stay > n / 2 and moved < n / 2


def test_a_month_of_many_small_files_is_gathered(spark, tmp_path):
    path = str(tmp_path / "sales")
    made = lines(spark, {("A", str(i)): (19970115, "c", [1, 2]) for i in range(40)})
    for part in range(12):
        write_sales(made.where(F.col("OrderID").cast("int") % 12 == part), path, mode="append")
    files = lambda: len(list((tmp_path / "sales" / "YearMonth=199701").glob("*.parquet")))
    assert files() == 12
    upkeep.apply_changes(spark, path, made.where("OrderID = 3"), made.where("OrderID = 3"))
    assert files() < 12
    same(read_sales(spark, path), made)


def test_monthly_sales_are_the_sales(model):
    """Dealt by month before the contract columns are made; no month lies in many tasks."""
    monthly = model.monthly_sales()
    same(monthly, model.fact_sales)
    tasks = monthly.select(F.col("DateKey").substr(1, 6).alias("m"), F.spark_partition_id().alias("p")).distinct()
    assert tasks.groupBy("m").count().where("count > 1").isEmpty()


def test_months_are_written_without_a_sort(spark, model, tmp_path):
    """A task that writes few months keeps a file open for each: its rows need no memory."""
    from shopgrain.session import SETTINGS

    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 12 and "spark.sql.maxConcurrentOutputFileWriters" in SETTINGS
    path = str(tmp_path / "sales")
    write_sales(model.monthly_sales(), path, together=True)
    same(read_sales(spark, path), model.fact_sales)
