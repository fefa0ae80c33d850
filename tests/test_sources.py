from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from shopgrain.plans.model import RetailModel
from shopgrain.sources.contract import RAW, contract_columns, raw_schema
from shopgrain.sources.driver_tables import DriverTables
from shopgrain.sources.tables import JdbcSource, JdbcSplit, as_raw, read_files, read_sales, write_sales

from . import raw_tables


def rows(frame):
    return sorted(map(str, frame.collect()))


CSV = {
    "header": "true",
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


@pytest.mark.parametrize("file_format", ["parquet", "orc", "json", "csv"])
def test_raw_files_give_the_same_sales(spark, tmp_path, file_format):
    tables = raw_tables.tables(spark)
    options = CSV if file_format == "csv" else {}
    for name, frame in tables.items():
        frame.write.format(file_format).options(**options).save(f"{tmp_path}/{name}")
    read = read_files(spark, str(tmp_path), file_format, **options)
    assert {name: frame.schema.simpleString() for name, frame in read.items()} == {
        name: raw_schema(name).simpleString() for name in RAW
    }
    expected = RetailModel.of_tables(tables)
    found = RetailModel.of_tables(read)
    for product in ("fact_sales", "fact_target", "dim_product", "dim_store", "dim_employee", "dim_date"):
        assert rows(getattr(expected, product)) == rows(getattr(found, product)), product


def test_as_raw_picks_and_types(spark):
    wide = spark.createDataFrame([(1, "Done", "extra")], "id bigint, name string, other string")
    found = as_raw(wide, "gmc.E00OrderStatus")
    assert found.schema.simpleString() == "struct<ID:int,Name:string>" and tuple(found.first()) == (1, "Done")


def test_jdbc_options_split_large_tables():
    source = JdbcSource("jdbc:x", {"user": "u"}, {"gmc.E01OrderHeader": JdbcSplit("ID", 0, 1000, 16)})
    assert source.options("gmc.E00Target") == {"url": "jdbc:x", "dbtable": "gmc.E00Target", "user": "u"}
    options = source.options("gmc.E01OrderHeader")
    assert (options["partitionColumn"], options["upperBound"], options["numPartitions"]) == ("ID", "1000", "16")


def test_an_order_table_is_never_read_in_one_piece():
    with pytest.raises(ValueError, match="splits"):
        JdbcSource("jdbc:x").options("rms.E01OrderItems")


def test_writing_a_month_leaves_the_others(spark, model, tmp_path):
    path = str(tmp_path / "sales")
    sales = model.fact_sales
    write_sales(sales, path)
    month = sales.filter("DateKey DIV 100 = 199701")
    write_sales(month.limit(1), path)
    stored = read_sales(spark, path)
    assert stored.filter("YearMonth = 199701").count() == 1
    assert stored.count() == sales.count() - month.count() + 1


def test_a_name_outside_the_contract_is_refused(spark):
    with pytest.raises(ValueError, match="Colour"):
        contract_columns("dim_product", {"Colour": "red"})


def test_targets_of_stores_are_made_in_many_tasks(spark, folder):
    """The stores come from one small file; their months are not all made where it is read."""
    source = DriverTables(spark, folder)
    assert source.table("supplier").select(F.spark_partition_id()).distinct().count() == 1
    targets = source.raw("rms.E00TargetStores")
    assert targets.select(F.spark_partition_id()).distinct().count() > 1
    assert targets.groupBy("StoreId").count().where("StoreId is not null").count() == source.table("supplier").count()
