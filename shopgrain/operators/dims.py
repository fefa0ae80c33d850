"""The five dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as words
from ..functions.clean import decimal, flag, parse_date, spelled, text, trimmed, whole
from ..sources.contract import contract_columns


def dim_product(skus: DataFrame, items: DataFrame, categories: DataFrame, collections: DataFrame) -> DataFrame:
    """One row per live SKU, with its item, category and collection if known.

    Deleted items are taken out before the join, so their SKUs stay, without
    item attributes. Two collections in one month give a SKU two rows; see
    `star.duplicate_keys`.
    """
    k, m, g, l = (lambda name, a=a: F.col(f"{a}.{name}") for a in "kmgl")
    category_id = m("ItemCategory").cast("int")
    rows = (
        skus.filter(F.col("IsDelete") == 0)
        .alias("k")
        .join(items.filter(F.col("IsDelete") == 0).alias("m"), k("ItemCode") == m("ItemCode"), "left")
        .join(categories.alias("g"), category_id == g("CateID"), "left")
        .join(
            collections.alias("l"),
            (l("collectionMonth") == m("MonthOfCollection")) & (l("collectionYear") == m("YearOfCollection")),
            "left",
        )
    )
    month, year = l("collectionMonth").cast("int"), l("collectionYear").cast("int")
    return rows.select(
        *contract_columns(
            "dim_product",
            {
                "SKUCode": k("SKUCode"),
                "ItemCode": k("ItemCode"),
                "ProductName": m("ItemName"),
                "ColorCode": k("sku_attr1"),
                "SizeCode": k("sku_attr2"),
                "CategoryName": g("CateName"),
                "CategoryID": category_id,
                "CollectionCode": m("ItemCollection"),
                "CollectionName": l("collectionName"),
                "CollectionMonth": month,
                "CollectionYear": year,
                "CollectionYearMonth": year * 100 + month,
                "CostOfGoods": k("COGS"),
                "ListPrice": k("SalesPrice"),
                "IsActive": k("IsActive"),
                "IsOnlineOnly": F.coalesce(m("IsOnlyOnline"), F.lit(0)),
                "Brand": m("ProductBrand"),
                "BarCode": k("BarCode"),
                "PackageWeight_kg": decimal(m("PackageWeight"), 10, 3),
            },
        )
    )


def dim_store(store_managers: DataFrame, stores: DataFrame) -> DataFrame:
    """One row per store, with manager, region, ownership and address.

    Any store type but the direct one, an absent type too, counts as franchise.
    """
    a, s = (lambda name, x=x: F.col(f"{x}.{name}") for x in "as")
    store_type = trimmed(a("StoreType"))
    owned = F.when(spelled(store_type, [words.DIRECT_STORE_TYPE]), words.OWNED_DIRECTLY)
    rows = store_managers.alias("a").join(
        stores.filter(F.col("IsDelete") == 0).alias("s"), a("StoreID") == s("No_"), "left"
    )
    values = {name: s(name) for name in ("IsFranchise", "City", "District", "Ward", "Address", "Phone")}
    values |= {
        "StoreID": a("StoreID"),
        "StoreName": a("StoreName"),
        "AM_EmpID": a("EmpID"),
        "AM_Name": a("AmName"),
        "RegionCode": trimmed(a("RegionCode")),
        "RegionName": trimmed(a("RegionName")),
        "StoreType": store_type,
        "OwnershipType": owned.otherwise(words.OWNED_BY_FRANCHISE),
    }
    return rows.select(*contract_columns("dim_store", values))


def dim_employee(store_staff: DataFrame, online_staff: DataFrame) -> DataFrame:
    """Store staff that count as employees, and all online sales staff."""
    c = F.col
    offline = store_staff.filter(flag(c("isEmp"))).select(
        *contract_columns(
            "dim_employee",
            {
                "EmpID": c("emp_id"),
                "EmpName": trimmed(c("emp_name")),
                "Gender": c("Gender"),
                "Department": text(c("Department")),
                "Role": _role(flag(c("BGD"))),
                "StoreID": c("SiteID"),
                "IsActive": flag(c("IsActive")),
                "Channel": words.STAFF_OFFLINE,
                "StartDate": parse_date(c("start_date")),
                "EndDate": parse_date(c("end_date")),
            },
        )
    )
    online = online_staff.select(
        *contract_columns(
            "dim_employee",
            {
                "EmpID": c("Code"),
                "EmpName": trimmed(c("Name")),
                "Department": text(c("Department")),
                "Role": _role(whole(c("IsLeader")) == 1),
                "IsActive": True,
                "Channel": words.STAFF_ONLINE,
            },
        )
    )
    return offline.unionByName(online)


def _role(leads: Column) -> Column:
    return F.when(leads, words.ROLE_MANAGER).otherwise(words.ROLE_STAFF)


def dim_date(calendar: DataFrame) -> DataFrame:
    """One row per day of the calendar."""
    c = F.col

    def yes(name: str) -> Column:
        return F.when(spelled(c(name), [words.CALENDAR_YES]), 1).otherwise(0)

    return calendar.select(
        *contract_columns(
            "dim_date",
            {
                "DateKey": c("date_key"),
                "FullDate": c("date"),
                "DateName": c("date_name"),
                "DayOfMonth": c("day_of_month"),
                "WeekOfYear": c("week_of_year"),
                "WeekNumber": c("week_number"),
                "WeekName": c("week_name"),
                "YearMonth": c("month"),
                "MonthNum": c("month_of_year"),
                "MonthName": c("month_name"),
                "YearQuarter": c("quarter"),
                "QuarterName": c("quarter_name"),
                "QuarterNum": c("quarter_of_year"),
                "Year": c("year_name"),
                "IsWorkingDay": yes("is_working_day"),
                "IsHoliday": yes("is_holiday"),
                "WeekStartDate": c("week_start_date"),
                "WeekEndDate": c("week_end_date"),
            },
        )
    )


def build_calendar(days: DataFrame) -> DataFrame:
    """A raw calendar for the days of a frame with one date column.

    For callers without a calendar table. Weeks start on Monday (ISO).
    """
    day = F.col("date").cast("date")
    weekday = F.weekday(day)  # Monday is 0
    year, month, quarter = F.year(day), F.month(day), F.quarter(day)
    week = F.weekofyear(day)
    monday = F.date_sub(day, weekday)
    day_name = F.element_at(F.array(*map(F.lit, words.DAY_NAMES)), weekday + 1)
    holiday = F.lit(False)
    for holiday_month, holiday_day in words.HOLIDAYS:
        holiday = holiday | ((month == holiday_month) & (F.day(day) == holiday_day))

    def worded(prefix: str, number: Column) -> Column:
        return F.concat_ws(" ", F.lit(prefix), number.cast("string"))

    def yes_no(test: Column) -> Column:
        return F.when(test, "Y").otherwise("N")

    return days.toDF("date").select(
        (year * 10000 + month * 100 + F.day(day)).alias("date_key"),
        day.cast("timestamp_ntz").alias("date"),
        day_name.alias("date_name"),
        F.day(day).alias("day_of_month"),
        week.alias("week_of_year"),
        F.concat(F.lit("W"), week.cast("string")).alias("week_number"),
        F.concat(F.date_format(monday, "dd/MM/yyyy"), F.lit(" - "), F.date_format(F.date_add(monday, 6), "dd/MM/yyyy")).alias(
            "week_name"
        ),
        (year * 100 + month).alias("month"),
        month.alias("month_of_year"),
        worded(words.MONTH_PREFIX, month).alias("month_name"),
        F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string")).alias("quarter"),
        worded(words.QUARTER_PREFIX, quarter).alias("quarter_name"),
        quarter.alias("quarter_of_year"),
        year.cast("string").alias("year_name"),
        yes_no((weekday < 5) & ~holiday).alias("is_working_day"),
        yes_no(holiday).alias("is_holiday"),
        monday.alias("week_start_date"),
        F.date_add(monday, 6).alias("week_end_date"),
    )


def dim_customer(headers: DataFrame) -> DataFrame:
    """One row per telesales customer, from the orders that were not deleted.

    Each attribute is the largest value seen, which may come from different
    orders. Distinct orders are counted on their own: counted beside the
    attributes, they would have every order shuffled with all its text.
    """
    c = F.col
    created = parse_date(c("CreateDate"))
    id_text = {name: text(whole(c(name))) for name in ("DistrictID", "WardID")}
    seen = {
        "CustomerName": c("CustomerName"),
        "Phone": c("PhoneNumber"),
        "Gender": c("CustomerGender"),
        "BirthDate": parse_date(c("BirthDay")),
        "Province": c("Provinces"),
        **id_text,
        "Email": c("Email"),
        "IsWholesaler": flag(c("IsWholesaler")),
        "Height_cm": decimal(c("CustomerHeight"), 5, 1),
        "Weight_kg": decimal(c("CustomerWeight"), 5, 1),
        "WaistSize_cm": decimal(c("CustomerWaistSize"), 5, 1),
        "LastOrderDate": created,
    }
    kept = headers.filter(c("CustomerID").isNotNull() & (c("IsDelete") == 0))
    customer = text(c("CustomerID")).alias("CustomerID")
    attributes = kept.groupBy(customer).agg(
        *[F.max(value).alias(name) for name, value in seen.items()], F.min(created).alias("FirstOrderDate")
    )
    orders = kept.select(customer, "ID").distinct().groupBy("CustomerID").agg(F.count("ID").alias("TotalOrders"))
    customers = attributes.join(orders, "CustomerID")
    values = {name: c(name) for name in customers.columns} | {"New_Gender": gender_label(c("Gender"))}
    return customers.select(*contract_columns("dim_customer", values))


def gender_label(gender: Column) -> Column:
    return (
        F.when(spelled(gender, words.MALE_TEXT), words.GENDER_MALE)
        .when(spelled(gender, words.FEMALE_TEXT), words.GENDER_FEMALE)
        .otherwise(words.GENDER_UNKNOWN)
    )
