"""The registered queries in standard SQL over the given tables, for DuckDB.

Written on its own, feed by feed, and not generated from the Spark code.
"""

from __future__ import annotations

MONEY = "DECIMAL(18,2)"

# One line with its order; shared derivations of the source adapter.
LINES = """
lines AS (
  SELECT o_orderkey, o_orderpriority AS feed, o_orderstatus AS state, o_totalprice AS order_total,
    CAST(o_orderdate AS DATE) AS day, o_custkey AS cust, o_custkey // 15 AS store_no, o_custkey % 25 AS area,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS ship_cost,
    CASE WHEN o_totalprice > 250000 THEN 'VIP' ELSE 'Retail' END AS kind,
    CASE WHEN o_totalprice > 250000 THEN 'Bank' ELSE 'COD' END AS payment,
    CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS line_no, CAST(l_partkey AS VARCHAR) AS sku,
    CASE WHEN o_orderstatus = 'F' THEN CAST(l_shipdate AS DATE) END AS done_day,
    CAST(l_quantity AS INTEGER) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
      AS DECIMAL(18,2)) AS paid,
    l_discount > 0 AS discounted, l_tax > 0 AS taxed, CAST(l_tax AS DECIMAL(4,2)) AS tax,
    l_quantity < 2 AS is_free, l_returnflag = 'R' AND l_linestatus = 'F' AS is_exchange
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
)"""

_ORDER_PART = """
    CAST(o_orderkey AS VARCHAR) AS OrderID, {line} AS LineID, '{channel}' AS Channel, '{group}' AS ChannelGroup,
    {platform} AS Platform, CAST(year(day) * 10000 + month(day) * 100 + day(day) AS INTEGER) AS DateKey,
    day AS OrderDate, {done} AS SuccessDate, {store} AS StoreID, {emp} AS EmpID, sku AS SKUCode,
    {cust} AS CustomerID, {name} AS CustomerName, {province} AS CustomerProvince, {district} AS CustomerDistrict,
    {ward} AS CustomerWard, {payment} AS PaymentMethod, {qty} AS Quantity, {sale} AS SalePrice, {listed} AS ListPrice,
    CAST({discount} AS DECIMAL(38,4)) AS DiscountAmount, CAST({gmv} AS DECIMAL(38,4)) AS GMV,
    CAST({net} AS DECIMAL(38,4)) AS NetRevenue, CAST({fee} AS DECIMAL(20,2)) AS PlatformFee,
    CAST({ship} AS DECIMAL(18,2)) AS ShippingFee, {raw} AS StatusRaw, {status} AS StatusName,
    {success} AS IsSuccess, {cancelled} AS IsCancelled, {unknown} AS IsUnknown, '{source}' AS SourceID,
    {kind} AS OrderType"""


def _branch(priority: str, where: str = "", **parts: str) -> str:
    blank = "CAST(NULL AS VARCHAR)"
    values = dict(
        line="line_no", done="done_day", store=blank, emp=blank, cust=blank, name="'Customer ' || cust",
        province=blank, district=blank, ward=blank, payment="payment", qty="qty", sale="paid", listed="price",
        fee="0", ship="0", unknown="FALSE", kind="kind",
    ) | parts
    return f"SELECT {_ORDER_PART.format(**values)}\n  FROM lines WHERE feed = '{priority}' {where}"


def _texts(final: tuple[str, str], partly: tuple[str, str], open_: tuple[str, str]) -> str:
    return " ".join(
        ["CASE"]
        + [
            f"WHEN state = '{s}' THEN CASE WHEN order_total > 250000 THEN '{high}' ELSE '{low}' END"
            for s, (low, high) in zip("FPO", (final, partly, open_))
        ]
        + ["END"]
    )


_LAZADA = _texts(("delivered", "delivered"), ("Canceled by buyer", "returned"), ("In transit", "pending"))
_SHOPEE = _texts(("Hoàn thành", "Đã HOÀN TẤT"), ("Đã hủy", "ĐÃ HUỶ"), ("Đang giao", "Chờ lấy hàng"))
_TIKI = _texts(("Giao hàng thành công", "THÀNH CÔNG"), ("Đã hủy", "HUỶ"), ("Đang xử lý", "Mới"))


def _has(text: str, *parts: str) -> str:
    tests = " OR ".join(f"contains(lower({text}), lower('{p}'))" for p in parts)
    return f"coalesce({tests}, FALSE)"


_STORE_NET = (
    "qty * price - CASE WHEN discounted THEN CAST((price - paid) * qty AS DECIMAL(18,2)) END"
)
_SHOPEE_FEES = """(CAST(paid * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(18,2))
      + CASE WHEN taxed THEN CAST(paid * tax AS DECIMAL(18,2)) ELSE 0 END
      + CASE WHEN discounted THEN CAST(paid * CAST(0.02 AS DECIMAL(4,2)) AS DECIMAL(18,2)) ELSE 0 END)"""
_FREIGHT = "CASE WHEN taxed THEN tax * 100 ELSE 0 END"
_TOTAL = "CAST(paid * qty AS DECIMAL(18,2))"

FACT_SALES = (
    LINES
    + ",\nfact_sales AS (\n  "
    + "\n  UNION ALL ".join(
        [
            _branch(
                "1-URGENT", "AND NOT is_free AND NOT is_exchange", channel="RMS", group="Offline",
                line="CAST(o_orderkey AS VARCHAR) || '_' || sku", platform="CAST(NULL AS VARCHAR)",
                done="CAST(NULL AS DATE)", store="CAST(store_no AS VARCHAR)", emp="'E' || store_no",
                cust="CAST(cust AS VARCHAR)", payment="CAST(NULL AS VARCHAR)",
                discount="CASE WHEN discounted THEN CAST((price - paid) * qty AS DECIMAL(18,2)) END",
                gmv=_STORE_NET, net=_STORE_NET, ship="ship_cost",
                raw="CASE state WHEN 'F' THEN '4' WHEN 'P' THEN '5' WHEN 'O' THEN '0' END",
                status="CASE state WHEN 'F' THEN 'Thành công' WHEN 'P' THEN 'Đã hủy' WHEN 'O' THEN 'Chưa rõ' END",
                success="coalesce(state = 'F', FALSE)", cancelled="coalesce(state = 'P', FALSE)",
                unknown="coalesce(state = 'O', FALSE)", source="POS",
            ),
            _branch(
                "2-HIGH", "AND order_total >= 10000", channel="GMC", group="Online", platform="'GMC'",
                emp="'T' || area", cust="CAST(cust AS VARCHAR)", province="'Province ' || area",
                discount="(price - paid) * qty", gmv=_TOTAL, net=_TOTAL, ship="ship_cost",
                raw="CASE state WHEN 'F' THEN '3' WHEN 'P' THEN '4' WHEN 'O' THEN '1' END",
                status="CASE state WHEN 'F' THEN 'Thành công' WHEN 'P' THEN 'Đã hủy' END",
                success="coalesce(state = 'F', FALSE)", cancelled="coalesce(state = 'P', FALSE)", source="Phone",
            ),
            _branch(
                "3-MEDIUM", channel="Lazada", group="Ecom", platform="'Lazada'", province="'City ' || area", qty="1",
                discount="CASE WHEN discounted THEN price - paid ELSE 0 END", gmv="paid", net="paid", ship=_FREIGHT,
                raw=_LAZADA, status=_LAZADA, success=f"coalesce(({_LAZADA}) = 'delivered', FALSE)",
                cancelled=_has(_LAZADA, "cancel", "return"), source="Lazada",
            ),
            _branch(
                "4-NOT SPECIFIED", channel="Shopee", group="Ecom", platform="'Shopee'", province="'City ' || area",
                district="'District ' || area", ward="'Ward ' || area",
                listed="CAST(CASE WHEN taxed THEN price ELSE 0 END AS DECIMAL(18,2))",
                discount="CASE WHEN taxed AND price > 0 THEN (price - paid) * qty ELSE 0 END", gmv=_TOTAL,
                net=f"{_TOTAL} - {_SHOPEE_FEES}", fee=_SHOPEE_FEES, ship=_FREIGHT, raw=_SHOPEE, status=_SHOPEE,
                success=_has(_SHOPEE, "Hoàn thành", "hoàn tất"), cancelled=_has(_SHOPEE, "Hủy", "huỷ"),
                source="Shopee",
            ),
            _branch(
                "5-LOW", channel="Tiki", group="Ecom", platform="'Tiki'", name="CAST(NULL AS VARCHAR)", sale="price",
                discount=f"CASE WHEN price > 0 AND qty > 0 THEN price * qty - {_TOTAL} ELSE 0 END",
                gmv="price * qty", net=_TOTAL,
                fee="CASE WHEN taxed THEN -CAST(paid * CAST(0.09 AS DECIMAL(4,2)) AS DECIMAL(18,2)) ELSE 0 END",
                raw=_TIKI, status=_TIKI, success=_has(_TIKI, "thành công"), cancelled=_has(_TIKI, "Hủy", "huỷ"),
                source="Tiki", kind="CAST(NULL AS VARCHAR)",
            ),
        ]
    )
    + "\n)"
)

MONTHS = """
months AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE) AS first_day
  FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)
)"""

DIM_DATE = """
days AS (
  SELECT CAST(unnest(generate_series(make_date(CAST(year(lo) AS INTEGER), 1, 1),
    make_date(CAST(year(hi) AS INTEGER), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)
),
marked AS (
  SELECT d, CAST(d - CAST(isodow(d) - 1 AS INTEGER) AS DATE) AS monday,
    (month(d), day(d)) IN ((1, 1), (4, 30), (5, 1), (9, 2)) AS holiday
  FROM days
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS FullDate,
    CASE isodow(d) WHEN 7 THEN 'Chủ nhật' ELSE 'Thứ ' || (isodow(d) + 1) END AS DateName,
    CAST(day(d) AS INTEGER) AS DayOfMonth, CAST(week(d) AS INTEGER) AS WeekOfYear, 'W' || week(d) AS WeekNumber,
    strftime(monday, '%d/%m/%Y') || ' - ' || strftime(monday + 6, '%d/%m/%Y') AS WeekName,
    CAST(strftime(d, '%Y%m') AS INTEGER) AS YearMonth, CAST(month(d) AS SMALLINT) AS MonthNum,
    'Tháng ' || month(d) AS MonthName, year(d) || '-Q' || quarter(d) AS YearQuarter,
    'Quý ' || quarter(d) AS QuarterName, CAST(quarter(d) AS SMALLINT) AS QuarterNum, CAST(year(d) AS SMALLINT) AS Year,
    CASE WHEN isodow(d) <= 5 AND NOT holiday THEN 1 ELSE 0 END AS IsWorkingDay,
    CASE WHEN holiday THEN 1 ELSE 0 END AS IsHoliday, monday AS WeekStartDate, CAST(monday + 6 AS DATE) AS WeekEndDate
  FROM marked
)"""

DIM_PRODUCT = """
dim_product AS (
  SELECT CAST(p_partkey AS VARCHAR) AS SKUCode, 'I' || p_partkey AS ItemCode,
    CASE WHEN live THEN p_name END AS ProductName, split_part(p_name, ' ', 1) AS ColorCode,
    CAST(p_size AS VARCHAR) AS SizeCode, CASE WHEN live AND p_type <> 'PROMO' THEN p_type END AS CategoryName,
    CASE WHEN live THEN CAST(ascii(p_type) * 100 + length(p_type) AS INTEGER) END AS CategoryID,
    CASE WHEN live THEN 'C' || p_size END AS CollectionCode,
    CASE WHEN p_size <= 45 THEN 'Collection ' || p_size END AS CollectionName,
    CASE WHEN p_size <= 45 THEN CAST(p_size % 12 + 1 AS SMALLINT) END AS CollectionMonth,
    CASE WHEN p_size <= 45 THEN CAST(p_size // 12 + 2015 AS SMALLINT) END AS CollectionYear,
    CASE WHEN p_size <= 45 THEN CAST((p_size // 12 + 2015) * 100 + p_size % 12 + 1 AS INTEGER) END AS CollectionYearMonth,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS CostOfGoods,
    CAST(p_retailprice AS DECIMAL(18,2)) AS ListPrice, p_size <> 1 AS IsActive,
    CASE WHEN live AND p_size > 45 THEN 1 ELSE 0 END AS IsOnlineOnly, CASE WHEN live THEN p_brand END AS Brand,
    '893' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS BarCode,
    CASE WHEN live AND p_size <> 7 THEN CAST(p_size + 0.25 AS DECIMAL(10,3)) END AS PackageWeight_kg
  FROM (SELECT *, p_size <> 49 AS live FROM part) WHERE p_size <> 50
)"""

DIM_STORE = """
dim_store AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS StoreID, s_name AS StoreName, 'AM' || n_nationkey AS AM_EmpID, n_name AS AM_Name,
    'R' || r_regionkey AS RegionCode, r_name AS RegionName,
    CASE WHEN s_acctbal < 0 THEN 'NHƯỢNG QUYỀN' ELSE 'TRỰC THUỘC' END AS StoreType,
    CASE WHEN s_acctbal < 0 THEN 'Franchise' ELSE 'Directly Owned' END AS OwnershipType,
    CASE WHEN listed THEN s_acctbal < 0 END AS IsFranchise, CASE WHEN listed THEN 'City ' || s_nationkey END AS City,
    CASE WHEN listed THEN 'District ' || s_suppkey END AS District, CASE WHEN listed THEN 'Ward ' || s_suppkey END AS Ward,
    CASE WHEN listed THEN s_name || ' street' END AS Address,
    CASE WHEN listed THEN '028' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') END AS Phone
  FROM (SELECT *, s_acctbal <= 9000 AS listed FROM supplier)
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

DIM_EMPLOYEE = """
dim_employee AS (
  SELECT 'E' || s_suppkey AS EmpID, s_name AS EmpName, CASE WHEN s_acctbal > 2000 THEN 'Nữ' END AS Gender,
    'Store' AS Department, CASE WHEN s_acctbal > 5000 THEN 'Manager' ELSE 'Staff' END AS Role,
    CAST(s_suppkey AS VARCHAR) AS StoreID, s_acctbal > 0 AS IsActive, 'Offline' AS Channel,
    CASE WHEN s_acctbal > 1000 THEN CAST(DATE '2010-03-01' + s_nationkey AS DATE) END AS StartDate,
    CASE WHEN s_acctbal < 0 THEN DATE '2020-06-30' END AS EndDate
  FROM supplier WHERE s_acctbal > -500
  UNION ALL
  SELECT 'T' || n_nationkey, n_name, NULL, 'Telesales', CASE WHEN n_regionkey = 1 THEN 'Manager' ELSE 'Staff' END, NULL,
    TRUE, 'Online', NULL, NULL
  FROM nation
)"""

DIM_CUSTOMER = """
dim_customer AS (
  SELECT CAST(o_custkey AS VARCHAR) AS CustomerID, 'Customer ' || o_custkey AS CustomerName,
    '09' || lpad(CAST(max(c_custkey) AS VARCHAR), 8, '0') AS Phone,
    CASE max(c_mktsegment) WHEN 'FURNITURE' THEN 'Nữ' WHEN 'BUILDING' THEN 'Female' WHEN 'MACHINERY' THEN 'Nam'
      WHEN 'AUTOMOBILE' THEN 'male' ELSE '' END AS Gender,
    CASE max(c_mktsegment) WHEN 'FURNITURE' THEN 'Nữ' WHEN 'BUILDING' THEN 'Nữ' WHEN 'MACHINERY' THEN 'Nam'
      WHEN 'AUTOMOBILE' THEN 'Nam' ELSE 'Không xác định' END AS New_Gender,
    CASE WHEN max(c_acctbal) >= 0 THEN CAST(DATE '1960-01-01' + CAST(o_custkey % 15000 AS INTEGER) AS DATE) END AS BirthDate,
    'Province ' || (o_custkey % 25) AS Province,
    CASE WHEN max(c_acctbal) <= 9000 THEN CAST(max(c_nationkey) AS VARCHAR) END AS DistrictID,
    CAST(max(c_nationkey) AS VARCHAR) AS WardID, lower(max(c_name)) || '@example.com' AS Email,
    max(c_acctbal) > 8000 AS IsWholesaler, CAST(o_custkey % 30 + 150.5 AS DECIMAL(5,1)) AS Height_cm,
    CAST(o_custkey % 30 + 40 AS DECIMAL(5,1)) AS Weight_kg,
    CASE WHEN o_custkey % 30 > 3 THEN CAST(o_custkey % 30 + 60 AS DECIMAL(5,1)) END AS WaistSize_cm,
    CAST(min(o_orderdate) AS DATE) AS FirstOrderDate, CAST(max(o_orderdate) AS DATE) AS LastOrderDate,
    count(DISTINCT o_orderkey) AS TotalOrders
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderpriority = '2-HIGH' AND o_totalprice >= 10000
  GROUP BY o_custkey
)"""

FACT_TARGET = (
    MONTHS
    + """,
fact_target AS (
  SELECT CAST(strftime(first_day, '%Y%m%d') AS INTEGER) AS DateKey, CAST(s_suppkey AS VARCHAR) AS StoreID,
    s_name AS StoreName, r_name AS RegionName,
    CASE WHEN s_acctbal < 0 THEN 'NHƯỢNG QUYỀN' ELSE 'TRỰC THUỘC' END AS StoreType, n_name AS AM_Name, 'RMS' AS Channel,
    'Offline' AS ChannelGroup, CAST(NULL AS VARCHAR) AS Platform,
    CAST(CAST(s_acctbal AS DECIMAL(18,2)) * 10 + 200000 AS DECIMAL(18,2)) AS TargetRevenue,
    CAST(NULL AS DECIMAL(18,2)) AS TargetAOV, CAST(NULL AS INTEGER) AS TargetOrders, CAST(NULL AS INTEGER) AS TargetItems
  FROM months, supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT CAST(strftime(first_day, '%Y%m%d') AS INTEGER), NULL, 'GMC Telesales', NULL, NULL, NULL, 'GMC', 'Online', NULL,
    CAST(n * 10000 AS DECIMAL(18,2)), CAST(month(first_day) * 1000 + 100000 AS DECIMAL(18,2)), CAST(n // 20 AS INTEGER),
    CASE WHEN month(first_day) <> 2 THEN CAST(n // 4 AS INTEGER) END
  FROM months, (SELECT count(*) AS n FROM customer)
  UNION ALL
  SELECT CAST(strftime(first_day, '%Y%m%d') AS INTEGER), NULL, platform, NULL, NULL, NULL, 'Ecom', 'Ecom', platform,
    CAST(n * length(platform) * 1000 AS DECIMAL(18,2)), NULL, NULL, NULL
  FROM months, (SELECT count(*) AS n FROM customer), (SELECT unnest(['Lazada', 'Shopee', 'Tiki']) AS platform)
)"""
)

RFM = (
    FACT_SALES
    + ","
    + DIM_DATE
    + """,
base AS (
  SELECT CustomerID, CAST((SELECT max(FullDate) FROM dim_date) - max(FullDate) AS INTEGER) AS Recency_Days,
    count(DISTINCT OrderID) AS Frequency, CAST(sum(NetRevenue) AS DECIMAL(38,4)) AS Monetary
  FROM fact_sales JOIN dim_date USING (DateKey) WHERE IsSuccess AND CustomerID IS NOT NULL GROUP BY CustomerID
),
scored AS (
  SELECT *, CAST(6 - ntile(5) OVER (ORDER BY Recency_Days NULLS FIRST, CustomerID) AS INTEGER) AS R_Score,
    CAST(ntile(5) OVER (ORDER BY Frequency NULLS FIRST, CustomerID) AS INTEGER) AS F_Score,
    CAST(ntile(5) OVER (ORDER BY Monetary NULLS FIRST, CustomerID) AS INTEGER) AS M_Score
  FROM base
),
rfm AS (
  SELECT *, R_Score || '' || F_Score || '' || M_Score AS RFM_Score,
    CASE WHEN R_Score >= 4 AND F_Score >= 4 AND M_Score >= 4 THEN 'Champion'
      WHEN R_Score >= 3 AND F_Score >= 3 AND M_Score >= 3 THEN 'Loyal'
      WHEN R_Score >= 4 AND F_Score <= 2 THEN 'New Customer'
      WHEN R_Score >= 3 AND F_Score >= 2 AND M_Score >= 3 THEN 'Potential Loyalist'
      WHEN R_Score <= 2 AND F_Score >= 3 AND M_Score >= 3 THEN 'At Risk'
      WHEN R_Score = 1 AND F_Score >= 3 THEN 'Lost Champion'
      WHEN R_Score <= 2 AND F_Score <= 2 THEN 'Lost' ELSE 'Need Attention' END AS RFM_Segment
  FROM scored
)"""
)

SCOPED = (
    FACT_SALES
    + ","
    + FACT_TARGET
    + """,
actuals AS (
  SELECT DateKey // 100 AS YearMonth, ChannelGroup,
    CASE ChannelGroup WHEN 'Offline' THEN StoreID WHEN 'Online' THEN Channel ELSE Platform END AS Scope,
    sum(NetRevenue) AS Actual
  FROM fact_sales WHERE IsSuccess GROUP BY ALL
),
compared AS (
  SELECT t.DateKey // 100 AS YearMonth, t.Channel, t.ChannelGroup, t.StoreID, t.RegionName, t.AM_Name, t.TargetRevenue,
    a.Actual
  FROM fact_target t LEFT JOIN actuals a ON a.YearMonth = t.DateKey // 100 AND a.ChannelGroup = t.ChannelGroup
    AND a.Scope = CASE t.ChannelGroup WHEN 'Offline' THEN t.StoreID WHEN 'Online' THEN t.Channel ELSE t.Platform END
)"""
)


def _pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100.0 / nullif(CAST({whole} AS DOUBLE), 0), 6)"


def _ratio(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0), 6)"


def _achieved(keys: str, where: str = "TRUE") -> str:
    prefix = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT *, {_pct("Actual", "Target")} AS Achievement_Pct FROM (
  SELECT {prefix}CAST(sum(TargetRevenue) AS DECIMAL(28,2)) AS Target,
    CAST(coalesce(sum(Actual), 0) AS DECIMAL(38,4)) AS Actual FROM compared WHERE {where} {group})"""


def _shared(inner: str, value: str = "Revenue") -> str:
    return f"SELECT *, {_pct(value, f'sum({value}) OVER ()')} AS Share_Pct FROM ({inner})"


_REVENUE = "CAST(coalesce(sum(NetRevenue) FILTER (WHERE IsSuccess), 0) AS DECIMAL(38,4))"
_SKU_LINES = "(SELECT * FROM fact_sales WHERE IsSuccess) f LEFT JOIN dim_product p ON p.SKUCode = f.SKUCode"


def _store_share(attribute: str) -> str:
    return _shared(
        f"SELECT coalesce({attribute}, '(unknown)') AS {attribute}, {_REVENUE} AS Revenue "
        f"FROM fact_sales f LEFT JOIN dim_store s ON s.StoreID = f.StoreID WHERE IsSuccess GROUP BY 1"
    )


def _mix(attribute: str) -> str:
    return _shared(
        f"SELECT coalesce({attribute}, '(unknown)') AS {attribute}, CAST(sum(Quantity) AS BIGINT) AS Units, "
        f"CAST(sum(NetRevenue) AS DECIMAL(38,4)) AS Revenue FROM {_SKU_LINES} GROUP BY 1"
    )


def _with(parts: str | list[str], body: str) -> str:
    ctes = parts if isinstance(parts, str) else ",".join(parts)
    return f"WITH {ctes.strip()}\n{body}"


_DAILY = """daily AS (
  SELECT d.FullDate, d.YearMonth, d.Year, CAST(coalesce(s.r, 0) AS DECIMAL(38,4)) AS Revenue
  FROM dim_date d LEFT JOIN (
    SELECT OrderDate, sum(NetRevenue) FILTER (WHERE IsSuccess) AS r FROM fact_sales GROUP BY 1) s ON s.OrderDate = d.FullDate
)"""


# The fact after the changes that the upkeep queries apply.
CHANGED = """
changed AS (
  SELECT * REPLACE (
    CAST(Quantity + CASE WHEN n % 20 = 1 THEN 1 ELSE 0 END AS INTEGER) AS Quantity,
    CAST(year(day) * 10000 + month(day) * 100 + day(day) AS INTEGER) AS DateKey)
  FROM (
    SELECT *, CAST(OrderID AS BIGINT) AS n,
      CASE WHEN CAST(OrderID AS BIGINT) % 20 = 2 THEN CAST(OrderDate + 31 AS DATE) ELSE OrderDate END AS day
    FROM fact_sales
  ) WHERE n % 20 <> 0 OR n % 40 = 0
)"""

REJECTS = f"""
WITH {MONTHS}, rejects AS (
  SELECT 'gmc.E01OrderHeader' AS Source, 'BirthDay' AS ColumnName, count(*) AS Rejects
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '2-HIGH' AND c_acctbal < 0
  UNION ALL
  SELECT 'gmc.E01OrderHeader', 'DistrictID', count(*)
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '2-HIGH' AND c_acctbal > 9000
  UNION ALL
  SELECT 'mdm.E00Employee', 'start_date', count(*) FROM supplier WHERE s_acctbal <= 1000
  UNION ALL
  SELECT 'rms.E00ItemMST', 'PackageWeight', count(*) FROM part WHERE p_size = 7
  UNION ALL
  SELECT 'gmc.E00Target', 'Items', count(*) FROM months WHERE month(first_day) = 2
)
SELECT * FROM rejects WHERE Rejects > 0
"""


def oracle_sql() -> dict[str, str]:
    sales = FACT_SALES
    found = {
        "dim_product": _with(DIM_PRODUCT, "SELECT * FROM dim_product"),
        "dim_store": _with(DIM_STORE, "SELECT * FROM dim_store"),
        "dim_employee": _with(DIM_EMPLOYEE, "SELECT * FROM dim_employee"),
        "dim_date": _with(DIM_DATE, "SELECT * FROM dim_date"),
        "dim_customer": _with(DIM_CUSTOMER, "SELECT * FROM dim_customer"),
        "fact_sales": _with(sales, "SELECT * FROM fact_sales"),
        "fact_sales_union": _with(sales, "SELECT * FROM fact_sales"),
        "fact_target": _with(FACT_TARGET, "SELECT * FROM fact_target"),
        "customer_rfm": _with(RFM, "SELECT * FROM rfm"),
        "customer_rfm_distributed": _with(RFM, "SELECT * FROM rfm"),
        "row_count_audit": _with(
            [sales, FACT_TARGET, DIM_PRODUCT, DIM_STORE, DIM_EMPLOYEE, DIM_DATE, DIM_CUSTOMER],
            "\nUNION ALL ".join(
                f"SELECT '{view}' AS ViewName, count(*) AS Rows FROM {table}"
                for view, table in [
                    ("v_DimProduct", "dim_product"),
                    ("v_DimStore", "dim_store"),
                    ("v_DimEmployee", "dim_employee"),
                    ("v_DimDate", "dim_date"),
                    ("v_DimCustomer", "dim_customer"),
                    ("v_FactSales", "fact_sales"),
                    ("v_FactTarget", "fact_target"),
                ]
            ),
        ),
        "channel_breakdown": _with(
            sales,
            f"""SELECT Channel, ChannelGroup, count(DISTINCT OrderID) AS Orders, CAST(sum(Quantity) AS BIGINT) AS Units,
  {_REVENUE} AS Revenue_Success,
  {_ratio("sum(NetRevenue) FILTER (WHERE IsSuccess)", "count(NetRevenue) FILTER (WHERE IsSuccess)")} AS AvgLineRevenue,
  {_pct("count(*) FILTER (WHERE IsSuccess)", "count(*)")} AS SuccessRate_Pct
FROM fact_sales GROUP BY Channel, ChannelGroup ORDER BY Revenue_Success DESC""",
        ),
        "total_revenue": _with(
            sales,
            f"""SELECT *, {_ratio("Revenue", "Orders")} AS RevenuePerOrder FROM (
  SELECT {_REVENUE} AS Revenue, count(DISTINCT OrderID) AS Orders, count(*) AS OrderLines FROM fact_sales)""",
        ),
        "channel_share": _with(
            sales,
            _shared(
                f"SELECT Channel, ChannelGroup, {_REVENUE} AS Revenue FROM fact_sales WHERE IsSuccess "
                "GROUP BY Channel, ChannelGroup"
            ),
        ),
        "channel_group_share": _with(
            sales, _shared(f"SELECT ChannelGroup, {_REVENUE} AS Revenue FROM fact_sales WHERE IsSuccess GROUP BY ChannelGroup")
        ),
        "overall_success": _with(
            sales,
            f"""SELECT *, {_pct("SuccessOrders", "Orders")} AS SuccessRate_Pct, {_pct("SuccessLines", "OrderLines")} AS LineSuccessRate_Pct
FROM (SELECT count(DISTINCT OrderID) AS Orders, count(DISTINCT OrderID) FILTER (WHERE IsSuccess) AS SuccessOrders,
    count(*) AS OrderLines, count(*) FILTER (WHERE IsSuccess) AS SuccessLines FROM fact_sales)""",
        ),
        "platform_fee_rate": _with(
            sales,
            f"""SELECT *, {_pct("PlatformFee", "GMV")} AS FeeRate_Pct FROM (
  SELECT Channel, Platform, CAST(sum(abs(PlatformFee)) AS DECIMAL(38,4)) AS PlatformFee,
    CAST(sum(GMV) AS DECIMAL(38,4)) AS GMV FROM fact_sales GROUP BY Channel, Platform)""",
        ),
        "net_after_fee": _with(
            sales,
            """SELECT Channel, Platform, CAST(sum(GMV) AS DECIMAL(38,4)) AS GMV,
  CAST(sum(abs(PlatformFee)) AS DECIMAL(38,4)) AS PlatformFee, CAST(sum(NetRevenue) AS DECIMAL(38,4)) AS NetAfterFee
FROM fact_sales WHERE IsSuccess GROUP BY Channel, Platform""",
        ),
        "avg_discount": _with(
            sales,
            f"""SELECT *, {_pct("Discount", "ListValue")} AS Discount_Pct,
  {_pct("sum(Discount) OVER ()", "sum(ListValue) OVER ()")} AS Overall_Discount_Pct FROM (
  SELECT Channel, CAST(sum(DiscountAmount) AS DECIMAL(38,4)) AS Discount,
    CAST(sum(CAST(ListPrice AS DECIMAL(20,2)) * Quantity) AS DECIMAL(38,4)) AS ListValue FROM fact_sales GROUP BY Channel)""",
        ),
        "order_quality": _with(
            sales,
            f"""SELECT *, {_pct("SuccessOrders", "Orders")} AS SuccessRate_Pct, {_pct("CancelledOrders", "Orders")} AS CancelRate_Pct,
  {_pct("ReturnedOrders", "Orders")} AS ReturnRate_Pct, {_pct("SuccessLines", "OrderLines")} AS LineSuccessRate_Pct FROM (
  SELECT Channel, Platform, count(DISTINCT OrderID) AS Orders,
    count(DISTINCT OrderID) FILTER (WHERE IsSuccess) AS SuccessOrders,
    count(DISTINCT OrderID) FILTER (WHERE IsCancelled) AS CancelledOrders,
    count(DISTINCT OrderID) FILTER (WHERE contains(lower(StatusRaw), 'return')) AS ReturnedOrders,
    count(*) AS OrderLines, count(*) FILTER (WHERE IsSuccess) AS SuccessLines
  FROM fact_sales GROUP BY Channel, Platform)""",
        ),
        "top_products": _with(
            [sales, DIM_PRODUCT],
            f"""SELECT f.SKUCode, ProductName, CategoryName, CollectionName, CAST(sum(Quantity) AS BIGINT) AS TotalUnits,
  CAST(sum(NetRevenue) AS DECIMAL(38,4)) AS TotalRevenue FROM {_SKU_LINES}
GROUP BY f.SKUCode, ProductName, CategoryName, CollectionName ORDER BY TotalRevenue DESC, f.SKUCode LIMIT 10""",
        ),
        "category_mix": _with([sales, DIM_PRODUCT], _mix("CategoryName")),
        "collection_mix": _with([sales, DIM_PRODUCT], _mix("CollectionName")),
        "gross_margin": _with(
            [sales, DIM_PRODUCT],
            f"""SELECT *, {_pct("Margin", "Revenue")} AS Margin_Pct FROM (
  SELECT CategoryName, Revenue, Cost, CAST(Revenue - Cost AS DECIMAL(38,4)) AS Margin FROM (
    SELECT coalesce(CategoryName, '(unknown)') AS CategoryName,
      CAST(coalesce(sum(NetRevenue), 0) AS DECIMAL(38,4)) AS Revenue,
      CAST(coalesce(sum(CAST(CostOfGoods AS DECIMAL(20,2)) * Quantity), 0) AS DECIMAL(38,4)) AS Cost
    FROM {_SKU_LINES} GROUP BY 1))""",
        ),
        "region_share": _with([sales, DIM_STORE], _store_share("RegionName")),
        "ownership_share": _with([sales, DIM_STORE], _store_share("OwnershipType")),
        "revenue_vs_target": _with(SCOPED, _achieved("YearMonth, Channel, ChannelGroup")),
        "overall_achievement": _with(SCOPED, _achieved("")),
        "region_achievement": _with(SCOPED, _achieved("RegionName", "ChannelGroup = 'Offline'")),
        "region_month_achievement": _with(SCOPED, _achieved("YearMonth, RegionName", "ChannelGroup = 'Offline'")),
        "manager_vs_target": _with(SCOPED, _achieved("YearMonth, AM_Name", "ChannelGroup = 'Offline'")),
        "store_vs_target": _with(
            SCOPED,
            f"""SELECT *, CAST(row_number() OVER (PARTITION BY YearMonth ORDER BY Actual DESC, StoreID) AS INTEGER) AS Revenue_Rank
FROM ({_achieved("YearMonth, StoreID", "ChannelGroup = 'Offline'")})""",
        ),
        "store_ranking": _with(
            SCOPED,
            f"""SELECT *, CAST(row_number() OVER (ORDER BY Actual DESC, StoreID) AS INTEGER) AS Revenue_Rank
FROM ({_achieved("StoreID", "ChannelGroup = 'Offline'")})""",
        ),
        "target_fanout_demo": _with(
            [sales, FACT_TARGET],
            """SELECT t.DateKey // 100 AS YearMonth, t.Channel, t.ChannelGroup,
  CAST(sum(t.TargetRevenue) AS DECIMAL(38,4)) AS Target,
  CAST(sum(CASE WHEN fs.IsSuccess AND fs.NetRevenue IS NOT NULL THEN fs.NetRevenue ELSE 0 END) AS DECIMAL(38,4)) AS Actual
FROM fact_target t LEFT JOIN fact_sales fs ON fs.DateKey // 100 = t.DateKey // 100 AND fs.Channel = t.Channel
  AND (t.StoreID IS NULL OR fs.StoreID = t.StoreID)
GROUP BY 1, 2, 3""",
        ),
        "aov_vs_target": _with(
            [sales, FACT_TARGET],
            f"""SELECT YearMonth, Channel, coalesce(Orders, 0) AS Orders, CAST(coalesce(Items, 0) AS BIGINT) AS Items,
  CAST(coalesce(Revenue, 0) AS DECIMAL(38,4)) AS Revenue, {_ratio("Revenue", "Orders")} AS AOV,
  {_ratio("Items", "Orders")} AS ItemsPerOrder, TargetAOV, TargetOrders, TargetItems,
  {_pct("CAST(Revenue AS DOUBLE) / nullif(Orders, 0)", "TargetAOV")} AS AOV_Pct, {_pct("coalesce(Orders, 0)", "TargetOrders")} AS Orders_Pct,
  {_pct("coalesce(Items, 0)", "TargetItems")} AS Items_Pct
FROM (SELECT DateKey // 100 AS YearMonth, Channel, count(DISTINCT OrderID) AS Orders, CAST(sum(Quantity) AS BIGINT) AS Items,
    CAST(coalesce(sum(NetRevenue), 0) AS DECIMAL(38,4)) AS Revenue FROM fact_sales WHERE IsSuccess GROUP BY 1, 2)
FULL JOIN (SELECT DateKey // 100 AS YearMonth, Channel, max(TargetAOV) AS TargetAOV,
    CAST(sum(TargetOrders) AS BIGINT) AS TargetOrders, CAST(sum(TargetItems) AS BIGINT) AS TargetItems
  FROM fact_target WHERE TargetAOV IS NOT NULL OR TargetOrders IS NOT NULL OR TargetItems IS NOT NULL GROUP BY 1, 2) USING (YearMonth, Channel)""",
        ),
        "mtd_ytd_daily": _with(
            [sales, DIM_DATE, _DAILY],
            """SELECT FullDate, Revenue,
  CAST(sum(Revenue) OVER (PARTITION BY YearMonth ORDER BY FullDate ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,4)) AS MTD_Revenue,
  CAST(sum(Revenue) OVER (PARTITION BY Year ORDER BY FullDate ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,4)) AS YTD_Revenue
FROM daily""",
        ),
        "yoy_monthly": _with(
            [sales, DIM_DATE, _DAILY,
             "monthly AS (SELECT YearMonth, CAST(sum(Revenue) AS DECIMAL(38,4)) AS Revenue FROM daily GROUP BY 1)"],
            f"""SELECT m.YearMonth, m.Revenue, b.Revenue AS LastYear_Revenue, {_pct("m.Revenue - b.Revenue", "b.Revenue")} AS YoY_Pct
FROM monthly m LEFT JOIN monthly b ON b.YearMonth = m.YearMonth - 100""",
        ),
        "workday_split": _with(
            [sales, DIM_DATE],
            _shared(
                """SELECT IsWorkingDay, IsHoliday, count(DISTINCT DateKey) AS SalesDays, count(*) AS OrderLines,
  CAST(coalesce(sum(NetRevenue), 0) AS DECIMAL(38,4)) AS Revenue
FROM fact_sales LEFT JOIN dim_date USING (DateKey) WHERE IsSuccess GROUP BY 1, 2"""
            ),
        ),
        "gender_share": _with(
            DIM_CUSTOMER, _shared("SELECT New_Gender, count(*) AS Customers FROM dim_customer GROUP BY 1", "Customers")
        ),
        "segment_distribution": _with(
            RFM, _shared("SELECT RFM_Segment, count(*) AS Customers FROM rfm GROUP BY 1", "Customers")
        ),
        "segment_value_ratio": _with(
            RFM,
            f"""SELECT *, {_ratio("AvgMonetary", "max(AvgMonetary) FILTER (WHERE RFM_Segment = 'Lost') OVER ()")} AS RatioToLost
FROM (SELECT RFM_Segment, count(*) AS Customers, {_ratio("sum(Monetary)", "count(*)")} AS AvgMonetary FROM rfm GROUP BY 1)""",
        ),
        "at_risk_customers": _with(
            RFM, "SELECT * FROM rfm WHERE RFM_Segment = 'At Risk' ORDER BY Monetary DESC, CustomerID"
        ),
        "star_sales": _with(
            [sales, DIM_DATE, DIM_PRODUCT, DIM_STORE, DIM_EMPLOYEE, DIM_CUSTOMER],
            """SELECT coalesce(YearQuarter, '(unknown)') AS YearQuarter, coalesce(CategoryName, '(unknown)') AS CategoryName,
  coalesce(RegionName, '(unknown)') AS RegionName, coalesce(Role, '(unknown)') AS EmployeeRole,
  coalesce(New_Gender, '(unknown)') AS CustomerGender, count(*) AS OrderLines, CAST(sum(Quantity) AS BIGINT) AS Units,
  CAST(sum(NetRevenue) AS DECIMAL(38,4)) AS Revenue
FROM fact_sales f LEFT JOIN dim_date d ON d.DateKey = f.DateKey LEFT JOIN dim_product p ON p.SKUCode = f.SKUCode
  LEFT JOIN dim_store s ON s.StoreID = f.StoreID LEFT JOIN dim_employee e ON e.EmpID = f.EmpID
  LEFT JOIN dim_customer c ON c.CustomerID = f.CustomerID
WHERE IsSuccess GROUP BY 1, 2, 3, 4, 5""",
        ),
        "star_target": _with(
            [FACT_TARGET, DIM_DATE, DIM_STORE],
            """SELECT coalesce(YearQuarter, '(unknown)') AS YearQuarter, coalesce(s.RegionName, '(unknown)') AS RegionName,
  coalesce(OwnershipType, '(unknown)') AS OwnershipType, count(*) AS Targets,
  CAST(sum(TargetRevenue) AS DECIMAL(28,2)) AS Target
FROM fact_target t LEFT JOIN dim_date d ON d.DateKey = t.DateKey LEFT JOIN dim_store s ON s.StoreID = t.StoreID
GROUP BY 1, 2, 3""",
        ),
        "distinct_orders_bitmap": _with(
            [sales],
            """SELECT ChannelGroup, count(DISTINCT OrderID) AS Orders, count(DISTINCT CustomerID) AS Customers
FROM fact_sales GROUP BY 1
UNION ALL SELECT 'All', count(DISTINCT OrderID), count(DISTINCT CustomerID) FROM fact_sales""",
        ),
        "distinct_sketch_rollup": _with(
            [sales],
            """SELECT DateKey // 100 AS YearMonth, ChannelGroup, count(DISTINCT OrderID) AS Orders,
  count(DISTINCT CustomerID) AS Customers, TRUE AS OrdersNear, TRUE AS CustomersNear
FROM fact_sales GROUP BY 1, 2""",
        ),
        "customers_kept": _with(
            [sales, DIM_DATE,
             """active AS (
  SELECT DISTINCT CAST(Year * 4 + QuarterNum AS INTEGER) AS Quarter, CustomerID
  FROM fact_sales JOIN dim_date USING (DateKey) WHERE CustomerID IS NOT NULL
)"""],
            """SELECT a.Quarter, count(*) AS Customers, count(b.CustomerID) AS Kept, TRUE AS KeptNear
FROM active a LEFT JOIN active b ON b.Quarter = a.Quarter + 1 AND b.CustomerID = a.CustomerID GROUP BY 1""",
        ),
        "sales_upkeep": _with(
            [sales, CHANGED],
            """SELECT DateKey // 100 AS YearMonth, Channel, count(*) AS OrderLines, count(DISTINCT OrderID) AS Orders,
  CAST(sum(Quantity) AS BIGINT) AS Units, CAST(sum(NetRevenue) AS DECIMAL(38,4)) AS NetRevenue
FROM changed GROUP BY 1, 2""",
        ),
        "customer_base_upkeep": _with(
            [sales, CHANGED, DIM_DATE],
            """SELECT CustomerID, CAST((SELECT max(FullDate) FROM dim_date) - max(FullDate) AS INTEGER) AS Recency_Days,
  count(DISTINCT OrderID) AS Frequency, CAST(sum(NetRevenue) AS DECIMAL(38,4)) AS Monetary
FROM changed JOIN dim_date USING (DateKey) WHERE IsSuccess AND CustomerID IS NOT NULL GROUP BY CustomerID""",
        ),
        "quarter_sales_pruned": _with(
            [sales, DIM_DATE],
            """SELECT YearMonth, Channel, IsWorkingDay, count(*) AS OrderLines,
  CAST(sum(NetRevenue) AS DECIMAL(38,4)) AS NetRevenue
FROM fact_sales JOIN dim_date USING (DateKey) WHERE YearQuarter = '1996-Q2' GROUP BY 1, 2, 3""",
        ),
        "cast_rejects": REJECTS,
    }
    return found | {"channel_breakdown_bucketed": found["channel_breakdown"]}
