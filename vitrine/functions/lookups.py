"""Fixed values that must equal the source pipeline's for identical results.

Everything in this module is data, not logic: code lists, names and text
patterns, kept in the order the source pipeline lists them.
"""

# --- FIXED VALUES: state code -> state name (anything else is 'Unknown') ---
STATE_NAMES = {
    "AC": "Acre",
    "AL": "Alagoas",
    "AM": "Amazonas",
    "AP": "Amapa",
    "BA": "Bahia",
    "CE": "Ceara",
    "DF": "Distrito Federal",
    "ES": "Espirito Santo",
    "GO": "Goias",
    "MA": "Maranhao",
    "MG": "Minas Gerais",
    "MS": "Mato Grosso do Sul",
    "MT": "Mato Grosso",
    "PA": "Para",
    "PB": "Paraiba",
    "PE": "Pernambuco",
    "PI": "Piaui",
    "PR": "Parana",
    "RJ": "Rio de Janeiro",
    "RN": "Rio Grande do Norte",
    "RO": "Rondonia",
    "RR": "Roraima",
    "RS": "Rio Grande do Sul",
    "SC": "Santa Catarina",
    "SE": "Sergipe",
    "SP": "Sao Paulo",
    "TO": "Tocantins",
}

# --- FIXED VALUES: region -> state codes (anything else is 'Unknown') ---
REGION_STATES = {
    "North": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Northeast": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Central-West": ["DF", "GO", "MS", "MT"],
    "Southeast": ["ES", "MG", "RJ", "SP"],
    "South": ["PR", "RS", "SC"],
}

UNKNOWN = "Unknown"

# --- FIXED VALUES: order statuses accepted by the data-quality check ---
VALID_ORDER_STATUSES = [
    "delivered",
    "shipped",
    "canceled",
    "invoiced",
    "processing",
    "created",
    "approved",
    "unavailable",
]

# --- FIXED VALUES: product category groups, first match wins, in this order.
# Each group lists the substrings searched (case-sensitive) in the English
# category name; no match (or no name) gives 'Other'.
CATEGORY_GROUPS = [
    ("Fashion & Apparel", ["fashion"]),
    ("Electronics", ["electronics"]),
    ("Health & Beauty", ["health", "beauty"]),
    ("Sports & Leisure", ["sports"]),
    ("Home & Furniture", ["furniture", "home", "bed"]),
    ("Toys & Baby", ["toy", "baby"]),
    ("Books & Media", ["book"]),
    ("Food & Beverages", ["food", "drink"]),
]
OTHER_GROUP = "Other"

# --- FIXED VALUES: review sentiment labels ---
SENTIMENT_POSITIVE = "POSITIVE"  # score >= 4
SENTIMENT_NEUTRAL = "NEUTRAL"  # score = 3
SENTIMENT_NEGATIVE = "NEGATIVE"  # anything else

# --- FIXED VALUES: data-quality reject reasons and keys ---
REJECT_NULL_ORDER_ID = "NULL ORDER_ID"
REJECT_BAD_STATUS = "Invalid ORDER_STATUS"
REJECT_NEGATIVE_AMOUNT = "Negative price/freight"
REJECT_BAD_SCORE = "Score not 1-5"
NULL_KEY_TEXT = "NULL"

# Reasons added here for rows the source pipeline would have aborted on
# (unparseable amounts and dates); they are not in the source's reject set.
REJECT_NON_NUMERIC = "Non-numeric amount"
REJECT_BAD_DATE = "Invalid date"
REJECT_AMOUNT_RANGE = "Amount out of range"
REJECT_BAD_COORDINATE = "Invalid coordinate"

# Reasons for rows that a load leaves out.
REJECT_NULL_CUSTOMER = "NULL CUSTOMER_UNIQUE_ID"
REJECT_NULL_SELLER = "NULL SELLER_ID"
REJECT_NULL_PRODUCT = "NULL PRODUCT_ID"
REJECT_NULL_ITEM_KEY = "NULL ORDER_ID or ORDER_ITEM_ID"
REJECT_NULL_REVIEW = "NULL REVIEW_ID"
REJECT_NO_SCORE = "Score missing or not 1-5"
REJECT_NO_ORDER = "Order not in batch"
REJECT_NO_ORDER_DATE = "Invalid ORDER_PURCHASE_TIMESTAMP"
REJECT_NO_CUSTOMER = "Customer not in DIM_CUSTOMER"
REJECT_NO_PRODUCT = "Product not in DIM_PRODUCT"
REJECT_NO_SELLER = "Seller not in DIM_SELLER"
REJECT_OPEN_QUOTE = "Quoted text without an end"
REJECT_QUOTES = "Malformed quoted text"
REJECT_LONG_ROW = "More fields than columns"
REJECT_CONSTRAINT = "Constraint "  # followed by its name
REJECT_SELLER_ADDRESSES = "Seller with more than one address"

# --- FIXED VALUES: watermark seeds and defaults ---
WATERMARK_SOURCE = "RETAIL_CSV"
WATERMARK_ENTITIES = [
    "ORDERS",
    "ORDER_ITEMS",
    "ORDER_PAYMENTS",
    "ORDER_REVIEWS",
    "CUSTOMERS",
    "SELLERS",
    "PRODUCTS",
    "GEOLOCATION",
    "CATEGORY_TRANSLATION",
]
WATERMARK_DEFAULT_DATE = "2015-01-01"

# --- FIXED VALUES: default calendar range ---
CALENDAR_START = "2015-01-01"
CALENDAR_END = "2030-12-31"

# --- FIXED VALUES: pipeline and step names used in the run log ---
PIPELINE_NAME = "RETAIL_PIPELINE"
BATCH_NAME_PREFIX = "RETAIL_ETL_"
HOURLY_PIPELINE_NAME = "HOURLY_AGG"
HOURLY_BATCH_PREFIX = "HOURLY_AGG_"  # followed by the start time as HHMMSS
STEP_TAG_STAGING = "TAG_STAGING_BATCH"
STEP_DQ = "DQ_VALIDATE_STAGING"
STEP_DIM_CUSTOMER = "LOAD_DIM_CUSTOMER"
STEP_DIM_SELLER = "LOAD_DIM_SELLER"
STEP_DIM_PRODUCT = "LOAD_DIM_PRODUCT"
STEP_FACT_ORDERS = "LOAD_FACT_ORDERS"
STEP_FACT_ITEMS = "LOAD_FACT_ORDER_ITEMS"
STEP_FACT_REVIEWS = "LOAD_FACT_REVIEWS"
STEP_AGG_DAILY = "REFRESH_AGG_DAILY_SALES"
