"""Fixed values that must equal the source system's for identical results.

Kept together, as plain text, in their natural order.
"""

# --- fixed values: event domain -------------------------------------------
EVENT_TYPES = ("view", "add_to_cart", "purchase")

# product catalogue: PROD-001 .. PROD-020, five per category in this order
CATEGORIES = ("Laptops", "Smartphones", "Accessories", "TVs")
PRODUCTS_PER_CATEGORY = 5
PRODUCT_COUNT = 20

DEVICES = ("desktop", "mobile", "tablet")
REFERRERS = ("organic", "paid_search", "email", "social", "direct")

# --- fixed values: stream defaults ----------------------------------------
WINDOW_DURATION = "10 minutes"
SLIDE_DURATION = "1 minute"
WATERMARK_DELAY = "2 minutes"
FLASH_SALE_MIN_VIEWS = 100  # strict: view_count > 100
FLASH_SALE_MAX_PURCHASES = 5  # strict: purchase_count < 5
ALERT_MESSAGE = (
    "High interest detected — consider launching a Flash Sale or targeted discount."
)

# --- fixed values: column length limits of the stored tables --------------
MAX_ID_LENGTH = 64
MAX_EVENT_TYPE_LENGTH = 16
MAX_SEGMENT_LENGTH = 32

# --- fixed values: segments -------------------------------------------------
SEGMENT_BUYER = "Buyer"
SEGMENT_WINDOW_SHOPPER = "Window Shopper"
SEGMENT_PROSPECTIVE = "Prospective Buyer"
SEGMENTS = (SEGMENT_BUYER, SEGMENT_WINDOW_SHOPPER)
UNKNOWN_CATEGORY = "Unknown"

# --- fixed values: daily top-products text report -------------------------
TOP_PRODUCTS_TITLE = "E-Commerce Daily Top Product Summary"
TOP_PRODUCTS_COLUMNS = "Rank | Product ID | Views | Purchases | Conversion Rate"
TOP_PRODUCTS_RULE = "-----|------------|-------|-----------|----------------"
TOP_PRODUCTS_EMPTY = "No clickstream activity was recorded for this interval."
TOP_N = 5

# --- fixed values: conversion report ----------------------------------------
CSV_HEADER = ("category", "product_id", "total_views", "total_purchases", "conversion_rate")
CATEGORY_SUMMARY_TITLE = "Conversion Rate Summary by Product Category"
CATEGORY_SUMMARY_COLUMNS = "Category | Views | Purchases | Conversion Rate"
CATEGORY_SUMMARY_RULE = "---------|-------|-----------|----------------"
CATEGORY_SUMMARY_EMPTY = (
    "No qualifying view activity was recorded for the selected reporting date."
)

# --- fixed values: dashboard -------------------------------------------------
ANNOTATION_SUFFIX = " — Flash Sale Triggered"
ANNOTATION_TAG = "Flash Sale"
FUNNEL_LABELS = ("Views", "Add to Cart", "Purchases")
ALERT_LOG_LIMIT = 50
CONVERSION_TOP_LIMIT = 10
DAILY_PANEL_LIMIT = 10
SEGMENT_DETAIL_LIMIT = 50
# alert-count bands: 0 green, >= 1 orange, >= 5 red
ALERT_COUNT_BANDS = ((5, "red"), (1, "orange"), (None, "green"))
# conversion bands: < 0.05 red, < 0.15 orange, >= 0.15 green
CONVERSION_BANDS = ((0.15, "green"), (0.05, "orange"), (None, "red"))
SEGMENT_COLOURS = ((SEGMENT_BUYER, "green"), (SEGMENT_WINDOW_SHOPPER, "blue"))
# display names of dashboard columns
DISPLAY_NAMES = {
    "view_count": "Views",
    "purchase_count": "Purchases",
    "product_id": "Product ID",
    "created_at": "Triggered At",
    "alert_message": "Recommendation",
    "rank": "#",
    "conversion_rate": "Conversion Rate",
    "segment_date": "Date",
    "user_id": "User ID",
    "segment": "Segment",
}
