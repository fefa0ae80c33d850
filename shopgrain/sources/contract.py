"""Column names and types of the eight products, and of the raw tables read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output columns and types.
OUTPUT = {
    "dim_product": """
        SKUCode string, ItemCode string, ProductName string, ColorCode string, SizeCode string,
        CategoryName string, CategoryID int, CollectionCode string, CollectionName string,
        CollectionMonth smallint, CollectionYear smallint, CollectionYearMonth int,
        CostOfGoods decimal(18,2), ListPrice decimal(18,2), IsActive boolean, IsOnlineOnly int,
        Brand string, BarCode string, PackageWeight_kg decimal(10,3)""",
    "dim_store": """
        StoreID string, StoreName string, AM_EmpID string, AM_Name string, RegionCode string,
        RegionName string, StoreType string, OwnershipType string, IsFranchise boolean,
        City string, District string, Ward string, Address string, Phone string""",
    "dim_employee": """
        EmpID string, EmpName string, Gender string, Department string, Role string,
        StoreID string, IsActive boolean, Channel string, StartDate date, EndDate date""",
    "dim_date": """
        DateKey int, FullDate date, DateName string, DayOfMonth int, WeekOfYear int,
        WeekNumber string, WeekName string, YearMonth int, MonthNum smallint, MonthName string,
        YearQuarter string, QuarterName string, QuarterNum smallint, Year smallint,
        IsWorkingDay int, IsHoliday int, WeekStartDate date, WeekEndDate date""",
    "dim_customer": """
        CustomerID string, CustomerName string, Phone string, Gender string, New_Gender string,
        BirthDate date, Province string, DistrictID string, WardID string, Email string,
        IsWholesaler boolean, Height_cm decimal(5,1), Weight_kg decimal(5,1),
        WaistSize_cm decimal(5,1), FirstOrderDate date, LastOrderDate date, TotalOrders bigint""",
    "fact_sales": """
        OrderID string, LineID string, Channel string, ChannelGroup string, Platform string,
        DateKey int, OrderDate date, SuccessDate date, StoreID string, EmpID string,
        SKUCode string, CustomerID string, CustomerName string, CustomerProvince string,
        CustomerDistrict string, CustomerWard string, PaymentMethod string, Quantity int,
        SalePrice decimal(18,2), ListPrice decimal(18,2), DiscountAmount decimal(38,4),
        GMV decimal(38,4), NetRevenue decimal(38,4), PlatformFee decimal(20,2),
        ShippingFee decimal(18,2), StatusRaw string, StatusName string, IsSuccess boolean,
        IsCancelled boolean, IsUnknown boolean, SourceID string, OrderType string""",
    "fact_target": """
        DateKey int, StoreID string, StoreName string, RegionName string, StoreType string,
        AM_Name string, Channel string, ChannelGroup string, Platform string,
        TargetRevenue decimal(18,2), TargetAOV decimal(18,2), TargetOrders int, TargetItems int""",
    "customer_rfm": """
        CustomerID string, Recency_Days int, Frequency bigint, Monetary decimal(38,4),
        R_Score int, F_Score int, M_Score int, RFM_Score string, RFM_Segment string""",
}

# Raw tables and the columns read from them. Text where the source
# is known to hold dirty values.
RAW = {
    "rms.E00ItemSKUs": """
        SKUCode string, ItemCode string, sku_attr1 string, sku_attr2 string, COGS decimal(18,2),
        SalesPrice decimal(18,2), IsActive boolean, BarCode string, IsDelete int""",
    "rms.E00ItemMST": """
        ItemCode string, ItemName string, ItemCategory string, ItemCollection string,
        IsOnlyOnline int, ProductBrand string, PackageWeight string, MonthOfCollection int,
        YearOfCollection int, IsDelete int""",
    "rms.E00ItemCategory": "CateID int, CateName string",
    "rms.E00Collection": "collectionMonth int, collectionYear int, collectionName string",
    "rms.E00Store_AM": """
        StoreID string, StoreName string, EmpID string, AmName string, RegionCode string,
        RegionName string, StoreType string""",
    "mdm.E00CORStores": """
        No_ string, IsFranchise boolean, City string, District string, Ward string,
        Address string, Phone string, IsDelete int""",
    "mdm.E00Employee": """
        emp_id string, emp_name string, Gender string, Department string, BGD string,
        SiteID string, IsActive string, isEmp string, start_date string, end_date string""",
    "gmc.E00EmployeeOnline": "Code string, Name string, Department string, IsLeader string",
    "mdm.E00Calendar": """
        date_key int, date timestamp_ntz, date_name string, day_of_month int, week_of_year int,
        week_number string, week_name string, month int, month_of_year int, month_name string,
        quarter string, quarter_name string, quarter_of_year int, year_name string,
        is_working_day string, is_holiday string, week_start_date date, week_end_date date""",
    "gmc.E01OrderHeader": """
        ID bigint, CustomerID bigint, CustomerName string, PhoneNumber string,
        CustomerGender string, BirthDay string, Provinces string, DistrictID string,
        WardID string, Email string, IsWholesaler string, CustomerHeight string,
        CustomerWeight string, CustomerWaistSize string, CreateDate string, IsDelete int,
        AssignTo string, PaymentMethod string, ShipPrice string, StatusID int, Source string,
        CategoryID string""",
    "gmc.E01OrderItemsOnline": """
        OrderID bigint, ID bigint, SuccessDate string, ProductID string, Quantity string,
        UnitPrice string, OriginalPrice string, Total string""",
    "gmc.E00OrderStatus": "ID int, Name string",
    "rms.E01OrderHeader": """
        OrderCode string, SiteID string, DocDate timestamp_ntz, SalesNo string, CustID string,
        CustName string, ShipCost string, Status int, Source string, OrderType string""",
    "rms.E01OrderItems": """
        OrderCode string, SiteID string, SKUCode string, Qty decimal(18,2), UnitPrice string,
        StandardPrice string, DiscItemValue string, IsFreeitem int, IsExchange int""",
    "rms.E00Status": "StatusID int, FunctType string, StatusName string",
    "ecom.E01LazadaOrders": """
        orderNumber bigint, orderItemId bigint, createTime string, deliveredDate string,
        sellerSku string, customerName string, shippingCity string, payMethod string,
        paidPrice string, unitPrice string, sellerDiscountTotal decimal(18,2),
        shippingFee decimal(18,2), status string, orderType string""",
    "ecom.E01ShopeeOrders": """
        MaDonHang string, Id bigint, NgayDatHang string, ThoiGianHoanThanhDonHang string,
        SKUSanPham string, TenNguoiNhan string, TinhThanhPho string, QuanHuyen string,
        PhuongXa string, PhuongThucThanhToan string, SoLuong string, GiaUuDai string,
        GiaGoc string, TongGiaBanSanPham string, PhiCoDinh string, PhiDichVu string,
        PhiThanhToan string, PhiVanChuyenDuKien string, TrangThaiDonHang string,
        LoaiDonHang string""",
    "ecom.E01TikiOrders": """
        MaDonHang string, Id bigint, NgayDat string, NgayGiaoHangThanhCong string, SSKU string,
        PhuongThucThanhToan string, SLBan string, DonGia string, DoanhThu string,
        PhiPhaiTraTiki string, TrangThai string""",
    "rms.E00TargetStores": """
        Datekey string, StoreId string, StoreName string, Region string, StoreType string,
        AM string, Target decimal(18,2)""",
    "gmc.E00Target": """
        DateKey string, Target decimal(18,2), AOV string, Orders string, Items string""",
    "ecom.E00Target": "DateKey string, Platform string, TargetGMV decimal(18,2)",
}


def output_schema(product: str) -> T.StructType:
    return T.StructType.fromDDL(OUTPUT[product])


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW[table])


def contract_columns(product: str, values: Mapping[str, object]) -> list[Column]:
    """All columns of a product in contract order and type.

    `values` maps column names to columns or constants; a column it leaves out
    is a null of the right type. A name outside the contract is a mistake.
    """
    schema = output_schema(product)
    stray = set(values) - set(schema.names)
    if stray:
        raise ValueError(f"not columns of {product}: {sorted(stray)}")
    return [as_column(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema]


def as_column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
