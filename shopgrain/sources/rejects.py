"""What could not be read: a ledger of values that are no date or number.

The products turn such text into null, as the sources' own conversions do. The ledger
says where that happened. Each raw row is read once and gets a mask, one bit per
converted column whose text is there and cannot be converted; rows with a mask go to the
ledger with their key, month and offending texts, so they can be put right at the source
and fed again. Counts per column follow from the bits alone.

Null and blank text is no value and no reject. Conversions are those of the products
(`functions.clean`). Each table names the columns that identify a row, and the column,
if any, whose day puts it in a month.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..functions.clean import date_key, key_month

Convert = Callable[[Column], Column]
MEASURE: Convert = lambda value: clean.decimal(value, 5, 1)
WEIGHT: Convert = lambda value: clean.decimal(value, 10, 3)


SCHEMA = "YearMonth int, RowKey string, Mask bigint, Texts map<string,string>, Source string"


@dataclass(frozen=True)
class Checked:
    """How a raw table is checked: its key, the column of its month and its conversions."""

    key: tuple[str, ...]
    columns: dict[str, Convert]
    month: str | None = None


TABLES = {
    "gmc.E01OrderHeader": Checked(
        ("ID",),
        {
            "BirthDay": clean.parse_date,
            "CreateDate": clean.parse_date,
            "DistrictID": clean.whole,
            "CustomerHeight": MEASURE,
            "CustomerWeight": MEASURE,
            "CustomerWaistSize": MEASURE,
            "ShipPrice": clean.money,
        },
        "CreateDate",
    ),
    "gmc.E01OrderItemsOnline": Checked(
        ("OrderID", "ID"),
        {
            "SuccessDate": clean.parse_date,
            "Quantity": clean.whole,
            "UnitPrice": clean.money,
            "OriginalPrice": clean.money,
            "Total": clean.money,
        },
    ),
    "mdm.E00Employee": Checked(("emp_id",), {"start_date": clean.parse_date, "end_date": clean.parse_date}),
    "rms.E00ItemMST": Checked(("ItemCode",), {"PackageWeight": WEIGHT}),
    "gmc.E00Target": Checked(
        ("DateKey",), {"AOV": clean.money, "Orders": clean.whole, "Items": clean.whole}, "DateKey"
    ),
}


def ledger(frame: DataFrame, table: str, checked: Checked | None = None) -> DataFrame:
    """Rows with a value that cannot be converted: source, month, key, mask and texts."""
    rule = checked or TABLES[table]
    failed = {c: _failed(F.col(c), convert) for c, convert in rule.columns.items()}
    bits = [F.when(test, F.lit(1 << at)).otherwise(F.lit(0)).cast("long") for at, test in enumerate(failed.values())]
    texts = F.map_from_entries(
        F.filter(
            F.array(*[F.when(test, F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))) for c, test in failed.items()]),
            lambda entry: entry.isNotNull(),
        )
    )
    month = key_month(date_key(clean.parse_date(F.col(rule.month)))) if rule.month else F.lit(None).cast("int")
    return frame.select(
        F.lit(table).alias("Source"),
        month.alias("YearMonth"),
        F.concat_ws("/", *[F.col(c).cast("string") for c in rule.key]).alias("RowKey"),
        reduce(Column.bitwiseOR, bits).alias("Mask"),
        texts.alias("Texts"),
    ).where("Mask <> 0")


def counts(entries: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Rejects per source and column, from the masks alone; one row per column that has some."""
    keys = ["Source", *by]
    masks = entries.groupBy(*keys, "Mask").agg(F.count(F.lit(1)).alias("rows"))
    names = F.create_map(*[F.lit(x) for t, rule in TABLES.items() for x in (t, "|".join(rule.columns))])
    column = F.posexplode(F.split(F.try_element_at(names, F.col("Source")), r"\|")).alias("_at", "ColumnName")
    return (
        masks.select(*keys, "Mask", "rows", column)
        .where(F.getbit("Mask", F.col("_at")) == 1)
        .groupBy(*keys, "ColumnName")
        .agg(F.sum("rows").alias("Rejects"))
    )


def write_ledger(entries: DataFrame, path: str) -> None:
    """Store the ledger by source and month; what is written again replaces what was there."""
    entries.write.partitionBy("Source", "YearMonth").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(
        path
    )


def _failed(text: Column, convert: Convert) -> Column:
    plain = text.cast("string")
    return F.coalesce((F.trim(plain) != "") & convert(text).isNull(), F.lit(False))
