"""Names, formats and messages that users of the warehouse rely on."""

from __future__ import annotations

# File name pattern of the weekly exports, and its date format.
EXPORT_FILE_PATTERN = r"order_history_(\d{8})_(\d{8})\.csv$"
EXPORT_FILE_DATE = "yyyyMMdd"

# Order time as the export writes it, "08:05 PM, August 03 2026".
ORDER_TIME_FORMAT = "h:mm a, MMMM d yyyy"

# Export header -> column of silver.orders, with the rule that
# turns the text into the column (text, trim, blank, number, distance, time).
EXPORT_COLUMNS = [
    ("Restaurant ID", "restaurant_id", "text"),
    ("Restaurant name", "restaurant_name", "text"),
    ("Subzone", "subzone", "text"),
    ("City", "city", "text"),
    ("Order ID", "order_id", "text"),
    ("Order Placed At", "order_placed_at", "time"),
    ("Order Status", "order_status", "trim"),
    ("Delivery", "delivery_type", "text"),
    ("Distance", "distance_km", "distance"),
    ("Instructions", "instructions", "blank"),
    ("Discount construct", "discount_construct", "blank"),
    ("Bill subtotal", "bill_subtotal", "number"),
    ("Packaging charges", "packaging_charges", "number"),
    ("Restaurant discount (Promo)", "restaurant_discount_promo", "number"),
    ("Restaurant discount (Flat offs, Freebies & others)", "restaurant_discount_other", "number"),
    ("Gold discount", "gold_discount", "number"),
    ("Brand pack discount", "brand_pack_discount", "number"),
    ("Total", "total", "number"),
    ("Rating", "rating", "number"),
    ("Review", "review", "blank"),
    ("Cancellation / Rejection reason", "cancellation_reason", "blank"),
    ("Restaurant compensation (Cancellation)", "restaurant_compensation", "number"),
    ("Restaurant penalty (Rejection)", "restaurant_penalty", "number"),
    ("KPT duration (minutes)", "kpt_duration_min", "number"),
    ("Rider wait time (minutes)", "rider_wait_min", "number"),
    ("Order Ready Marked", "order_ready_marked", "text"),
    ("Customer complaint tag", "customer_complaint_tag", "blank"),
    ("Customer ID", "customer_id", "text"),
    ("Customer Phone", "customer_phone", "blank"),
]
ITEMS_COLUMN = "Items in order"

# The menu file, by position.
MENU_COLUMNS = [
    ("item_name", "string"),
    ("category", "string"),
    ("subcategory", "string"),
    ("is_veg", "boolean"),
    ("size", "string"),
    ("list_price", "double"),
    ("unit_cost", "double"),
    ("active", "boolean"),
]

# Number columns of the owner's price sheet.
SHEET_NUMBERS = [
    "zomato_list_price",
    "zomato_set_price",
    "local_price",
    "local_offer_price",
    "making_cost",
    "zomato_receipt",
]

# Channel tags of the combined weekly table.
MARKETPLACE, DIRECT = "zomato", "direct"
DELIVERED = "Delivered"

# Fields of the direct-order snapshot that must be present.
DIRECT_REQUIRED = [
    "order_id",
    "status",
    "order_type",
    "food_total",
    "delivery_fee",
    "total",
    "created_at",
    "customer_phone",
    "customer_name",
    "items",
]

# How a price was found, and the audit text that goes with it.
PRICE_METHODS = {
    "sheet": "data/price_sheet.csv zomato_list_price, matched to '",
    "observed": "mode of bill_subtotal, single-item qty=1 orders",
    "derived": "residual solve: (bill_subtotal - known items) / qty, mode across orders",
    "listed": "menu.csv list_price",
    "unknown": "no observation or menu price available",
}

# The standing checks in their order, what one that finds something
# is called, and the text before its list or after its number.
CHECKS = [
    ("missing_week_gaps", "warn", "Weeks with no source CSV: "),
    ("duplicate_order_ids_bronze", "fail", " duplicate Order ID rows in bronze.order_history_raw"),
    ("unparsed_order_placed_at", "fail", " bronze rows where Order Placed At failed to parse"),
    ("unparsed_item_quantity", "fail", " silver.order_items rows where quantity failed to parse"),
    ("orders_with_no_items", "fail", " orders in silver.orders with no matching line items"),
    ("items_with_unknown_price", "warn", " items in gold.item_prices with no resolvable price"),
]
