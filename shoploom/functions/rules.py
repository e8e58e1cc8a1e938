"""Business rules as data: patterns, labels, thresholds and their order.

Everything in this module is a fixed value that results depend on. First match wins.
"""

from __future__ import annotations

from dataclasses import dataclass

PACIFIC = "America/Los_Angeles"


@dataclass(frozen=True)
class Store:
    """Per-store settings of the order and line staging."""

    name: str
    price_threshold: int
    default_salesperson: str


# The two stores.
STORES = (Store("regular", 55, "DTC"), Store("commercial", 40, "Commercial"))

# Line classification. Prefixes are matched as written, fragments in lower case.
SAMPLE_SKU_PREFIXES = ("SA-%", "KIT%")
SAMPLE_TITLE_PARTS = ("%cut%", "%sample%", "%plank%")
SAMPLE_SKU_PARTS = ("%cut%", "%full%")
PRODUCT_SKU_PREFIX = "FL-%"
NOT_PRODUCT_TITLE = "%nosing%"
CUT_TITLE_PARTS = ("%cut%", "%sample%")
CUT_SKU_PART = "%cut%"
PLANK_TITLE_PART = "%plank%"
PLANK_SKU_PART = "%full%"
SAMPLE_CUT, SAMPLE_PLANK = "Sample - Cut", "Sample - Plank"
SAMPLE, PRODUCT, ACCESSORIES = "Sample", "Product", "Accessories"

# Tag patterns and customer groups.
SALESPERSON_TAG = "Salesperson: (.*?),"
CUSTOMER_TYPE_TAG = "Customer Type: (.*?),"
DEFAULT_CUSTOMER_TYPE = "DTC"
CUSTOMER_GROUPS = (
    ("Pending Trade Rewards", ("%pending%",)),
    ("Trade Rewards", ("%trade%", "%legacy tr%", "%partner plus%")),
)
DEFAULT_CUSTOMER_GROUP = "Retail"
MARKETPLACE_EMAIL = "%amazon%"

# Sampled categories by sku pattern (flag name, label, patterns).
CATEGORIES = (
    ("signature", "Signature", ("%-S-%", "%-7210-%")),
    ("base", "Base", ("%-B-%", "%-4805-%")),
    ("craftsman", "Craftsman", ("%-C-%",)),
    ("silvan", "Silvan Hardwood", ("%-7-%", "%-7T-%")),
)
# The set of sampled categories and its label; any other set is mixed.
SAMPLE_ORDER_TYPES = (
    (("base",), "Base Sample Only"),
    (("signature",), "Signature Sample Only"),
    (("craftsman",), "Craftsman Sample Only"),
    (("silvan",), "Silvan Sample Only"),
    (("base", "signature"), "Base and Signature Sample Only"),
    (("base", "craftsman"), "Base and Craftsman Sample Only"),
    (("signature", "craftsman"), "Signature and Craftsman Sample Only"),
)
MIXED_SAMPLES, NO_SAMPLES = "Mixed or Other", "No Samples"

MIN_PRODUCT_SUBTOTAL = 250
CONVERSION_WINDOWS = (15, 30, 60, 120)
REVENUE_WINDOW = 60
# Upper edge in days and label.
CONVERSION_BUCKETS = ((15, "0-15 days"), (30, "16-30 days"), (60, "31-60 days"), (120, "61-120 days"))
BUCKET_ABOVE, BUCKET_NONE = "120+ days", "No Conversion"
NO_GAP = 999999
# Lower edge of lifetime product revenue and label.
SEGMENTS = ((5000, "High Value"), (2000, "Medium Value"), (500, "Low Value"))

# Web event names turned into flags.
EVENT_FLAGS = (
    "purchase", "add_to_cart", "remove_from_cart", "view_item", "view_item_list", "select_item",
    "begin_checkout", "add_payment_info", "add_shipping_info", "page_view", "session_start", "first_visit",
)
# Fixed values: (output column, parameter key, stored type).
EVENT_PARAMS = (
    ("page_location", "page_location", "string"), ("page_referrer", "page_referrer", "string"),
    ("page_title", "page_title", "string"), ("ga_session_id", "ga_session_id", "int"),
    ("ga_session_number", "ga_session_number", "int"), ("engagement_time_msec", "engagement_time_msec", "int"),
    ("transaction_id", "transaction_id", "string"), ("transaction_value", "value", "double"),
    ("currency", "currency", "string"), ("tax", "tax", "double"), ("shipping", "shipping", "double"),
    ("coupon", "coupon", "string"), ("item_id", "item_id", "string"), ("item_name", "item_name", "string"),
    ("item_category", "item_category", "string"), ("item_variant", "item_variant", "string"),
    ("item_price", "price", "double"), ("item_quantity", "quantity", "int"),
    ("utm_campaign", "campaign", "string"), ("utm_source", "source", "string"),
    ("utm_medium", "medium", "string"), ("utm_term", "term", "string"),
    ("utm_content", "content", "string"), ("search_term", "search_term", "string"),
)
# Page type by URL pattern; the home page is '/' or the shop host with a slash.
PAGE_TYPES = (
    ("product_detail", ("%/products/%",)), ("product_list", ("%/collections/%",)), ("cart", ("%/cart%",)),
    ("checkout", ("%/checkout%",)), ("samples", ("%/pages/samples%", "%/sample%")),
)
SHOP_HOST = "shop.example.com"
# Session stages from deepest to first (flag column, label, depth).
FUNNEL_STAGES = (
    ("reached_purchase", "Purchase", 6), ("reached_begin_checkout", "Begin Checkout", 5),
    ("reached_add_to_cart", "Add to Cart", 4), ("reached_pdp", "Product Detail", 3),
    ("reached_plp", "Product List", 2), ("reached_homepage", "Homepage", 1),
)

# Mail categories by name pattern (lower case).
CAMPAIGN_CATEGORIES = (
    ("Welcome Series", ("%welcome%",)), ("Cart Abandonment", ("%abandon%", "%cart%")),
    ("Sample Nurture", ("%sample%",)), ("Winback", ("%win%back%", "%re%engage%")),
    ("Promotion", ("%promo%", "%sale%")), ("Newsletter", ("%newsletter%",)),
)
FLOW_CATEGORIES = (
    ("Welcome Series", ("%welcome%",)), ("Cart Abandonment", ("%abandon%", "%cart%")),
    ("Browse Abandonment", ("%browse%abandon%",)), ("Sample Nurture", ("%sample%",)),
    ("Post-Purchase", ("%post%purchase%", "%thank%you%")), ("Winback", ("%win%back%", "%re%engage%")),
    ("Lifecycle", ("%birthday%", "%anniversary%")),
)

# Product line by sku prefix when the lookup has no row.
PRODUCT_LINES = (
    ("Modin", ("FL-MR-%", "SA-MR-%")), ("Silvan", ("FL-SR-%", "SA-SR-%")),
    ("Arista", ("FL-AR-%", "SA-AR-%")), ("Provenance", ("FL-PE-%", "SA-PE-%")),
    ("Accessories", ("AC-%",)),
)
# Sub-line by lookup values (line, category pattern, bevel or None, label).
SUBLINES = (
    ("Modin", "Signature", "Enhanced", "Signature Enhanced"), ("Modin", "Signature", "Micro", "Signature Micro"),
    ("Modin", "Base", None, "Base"), ("Modin", "Craftsman", None, "Craftsman"),
    ("Modin", "Herringbone", None, "Herringbone"),
    ("Silvan", "7%", None, '7"'), ("Silvan", "6%", None, '6"'), ("Silvan", "Base", None, '6"'),
)
LAUNCH_LINE = "Provenance"
# Size by sku pattern.
SIZE_VARIANTS = (('7.5"', ("%75%",)), ('10"', ("%105%",)))

# Sales channel by salesperson pattern (lower case).
CHANNELS = (
    ("MSR", ("%msr%", "%installer%", "%multi%")), ("Ind. Retail", ("%ind%", "%retail%", "%dealer%")),
)
COMMERCIAL_CHANNEL, DIRECT_CHANNEL, NAMED_SELLER_CHANNEL = "Comm.", "DTC", "Ind. Retail"

# Holidays (month, first day, last day, weekday with 1 = Sunday or None, name).
HOLIDAYS = (
    (1, 1, 1, None, "New Years"), (7, 4, 4, None, "July 4th"), (12, 25, 25, None, "Christmas"),
    (11, 22, 28, 5, "Thanksgiving"), (11, 23, 29, 6, "Black Friday"), (11, 25, 31, 2, "Cyber Monday"),
)
HOLIDAY_WEEK_MONTHS, HOLIDAY_WEEK_DAYS = (1, 7, 11, 12), (1, 4, 25)
HOLIDAY_WEEK_SPAN = (11, 22, 29)
