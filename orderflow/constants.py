"""Fixed values.

The texts, codes, limits and word lists below are part of the output or input
contract, so they are stated literally and kept in one place.
"""

from decimal import Decimal

# --- restaurant listing (CSV / staging), in file order -----------------------
COST_COLUMN = "approx_cost(for two people)"
TYPE_COLUMN = "listed_in(type)"
CITY_COLUMN = "listed_in(city)"
LISTING_COLUMNS = (
    "address",
    "name",
    "online_order",
    "book_table",
    "rate",
    "votes",
    "phone",
    "location",
    "rest_type",
    "cuisines",
    COST_COLUMN,
    "menu_item",
    TYPE_COLUMN,
    CITY_COLUMN,
)

# Longest text each stored column may hold.
MAX_LENGTHS = {
    "location_name": 255,
    "listed_in_city": 255,
    "name": 255,
    "phone": 100,
    "rest_type": 255,
    "listed_in_type": 100,
}

# Rate texts that mean "no rating".
UNRATED_TEXTS = ("NEW", "-", "")
YES = "Yes"
NO = "No"

# Stand-ins of the restaurant dimension for unreadable values.
DEFAULT_RATE = 3.5
DEFAULT_VOTES = 50
DEFAULT_COST = 600
MENU_SIZE = 5
MENU_FILLER = "Chef Special "

# --- restaurant reports ------------------------------------------------------
DELIVERY = "Delivery"
TOP_RATING = Decimal("4.2")
TOP_MIN_RESTAURANTS = 50
TIER_BUDGET = "Budget"
TIER_MID = "Mid-Range"
TIER_PREMIUM = "Premium"
BUDGET_MAX_COST = 500
PREMIUM_MIN_COST = 1000

# --- order history -----------------------------------------------------------
ITEM_ID_FIELDS = ("item_id", "item_name", "food_item")
ITEM_QUANTITY_FIELD = "quantity"
UNKNOWN_ITEM = "Unknown Item"
TOP_ROWS = 10
TOP_CITIES = 20

# Demand by hour of day: band, first hour, hour after the last, factor.
# The night band wraps around midnight; hours in no band are "other".
PEAK_MULTIPLIER = 3.0
DEMAND_BANDS = (
    ("morning", 8, 11, 0.6),
    ("lunch", 12, 15, 1.0 * PEAK_MULTIPLIER),
    ("dinner", 19, 22, 1.2 * PEAK_MULTIPLIER),
    ("night", 23, 6, 0.3),
)
OTHER_BAND = ("other", 1.0)

BREAD_OR_DRINK_WORDS = (
    "bread",
    "roti",
    "naan",
    "paratha",
    "kulcha",
    "drink",
    "lassi",
    "tea",
    "coffee",
    "juice",
    "soda",
)

# --- order validation --------------------------------------------------------
PHONE_PREFIXES = ("+91", "080")
INVALID_PHONE = "INVALID_PHONE"
MODE_CONFLICT = "MODE_CONFLICT"
PRICE_MISMATCH = "PRICE_MISMATCH"
MULTIPLE_ERRORS = "MULTI"
UNKNOWN_ORDER_ID = "UNKNOWN_ID"
PRICE_TOLERANCE = Decimal("0.01")

# --- fraud alerts ------------------------------------------------------------
GEO_ALERT = "GEOGRAPHICAL_IMPOSSIBILITY"
GEO_REASON = "User placed orders across cities: "
VELOCITY_ALERT = "VELOCITY_SPAM_BOT"
VELOCITY_REASON = "User exceeded checkout rate with frequency count: "
VELOCITY_THRESHOLD = 5
WATERMARK_DELAY = "1 minute"
