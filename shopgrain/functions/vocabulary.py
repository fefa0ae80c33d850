"""The words, codes and labels that make up the data contract.

They are compared with, or written into, the data, so they must stay exactly as
they are. Nothing here is logic.
"""

# Channel, channel group, platform and source labels, per feed.
FEEDS = ("store", "telesales", "lazada", "shopee", "tiki")
CHANNEL = {"store": "RMS", "telesales": "GMC", "lazada": "Lazada", "shopee": "Shopee", "tiki": "Tiki"}
CHANNEL_GROUP = {"store": "Offline", "telesales": "Online", "lazada": "Ecom", "shopee": "Ecom", "tiki": "Ecom"}
PLATFORM = {"store": None, "telesales": "GMC", "lazada": "Lazada", "shopee": "Shopee", "tiki": "Tiki"}
TARGET_ECOM_CHANNEL = "Ecom"
TARGET_TELESALES_NAME = "GMC Telesales"

# Order status codes and the function type of store order statuses.
STORE_SUCCESS, STORE_CANCELLED, STORE_UNKNOWN = 4, 5, 0
TELESALES_SUCCESS, TELESALES_CANCELLED = 3, 4
ORDER_FUNCTION_TYPE = "O"

# Order status words. Success on Lazada is the whole text; the rest are parts of it.
LAZADA_SUCCESS = "delivered"
LAZADA_CANCELLED = ("cancel", "return")
SHOPEE_SUCCESS = ("Hoàn thành", "hoàn tất")
TIKI_SUCCESS = ("thành công",)
VIETNAMESE_CANCELLED = ("Hủy", "huỷ")
RETURNED = ("return",)

# Text spellings of a true flag, and of a yes in the calendar.
TRUE_TEXT = ("1", "True", "true")
CALENDAR_YES = "Y"

# Gender spellings and labels.
MALE_TEXT = ("Male", "male", "MALE", "Nam", "nam")
FEMALE_TEXT = ("Female", "female", "FEMALE", "Nữ", "nữ", "Nu", "nu")
GENDER_MALE, GENDER_FEMALE, GENDER_UNKNOWN = "Nam", "Nữ", "Không xác định"

# Store type text and ownership labels.
DIRECT_STORE_TYPE = "TRỰC THUỘC"
OWNED_DIRECTLY, OWNED_BY_FRANCHISE = "Directly Owned", "Franchise"

# Staff labels.
ROLE_MANAGER, ROLE_STAFF = "Manager", "Staff"
STAFF_OFFLINE, STAFF_ONLINE = "Offline", "Online"

# Names under which the eight products are published.
VIEW_NAMES = {
    "dim_product": "v_DimProduct",
    "dim_store": "v_DimStore",
    "dim_employee": "v_DimEmployee",
    "dim_date": "v_DimDate",
    "dim_customer": "v_DimCustomer",
    "fact_sales": "v_FactSales",
    "fact_target": "v_FactTarget",
    "customer_rfm": "v_CustomerRFM",
}

# Calendar wording: days from Monday, month and quarter prefixes, and the public
# holidays that fall on the same day each year (month, day).
DAY_NAMES = ("Thứ 2", "Thứ 3", "Thứ 4", "Thứ 5", "Thứ 6", "Thứ 7", "Chủ nhật")
MONTH_PREFIX, QUARTER_PREFIX = "Tháng", "Quý"
HOLIDAYS = ((1, 1), (4, 30), (5, 1), (9, 2))

# Label of the member that stands for "no matching dimension row".
UNKNOWN_MEMBER = "(unknown)"
