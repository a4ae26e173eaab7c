"""Table schemas, value domains and document shapes of the commerce model."""

from __future__ import annotations

# Table schemas as DDL text, which every reader takes as it is.
# The source headers misspell "length" in two product columns; the names are kept
# as they come and renamed by ``sources.readers.rename_product_lengths``.
CUSTOMERS = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
    "customer_city string, customer_state string"
)
SELLERS = (
    "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
)
GEOLOCATION = (
    "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
    "geolocation_city string, geolocation_state string"
)
CATEGORIES = ("product_category_name string, product_category_name_english string")
PRODUCTS = (
    "product_id string, product_category_name string, product_name_lenght double, "
    "product_description_lenght double, product_photos_qty double, product_weight_g double, "
    "product_length_cm double, product_height_cm double, product_width_cm double"
)
ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
)
ORDER_ITEMS = (
    "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp, price decimal(12,2), freight_value decimal(12,2)"
)
ORDER_PAYMENTS = (
    "order_id string, payment_sequential int, payment_type string, payment_installments int, "
    "payment_value decimal(12,2)"
)
ORDER_REVIEWS = (
    "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"
)

TABLES = {
    "customers": CUSTOMERS,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
}

# Order states and payment types of the model.
ORDER_STATUSES = [
    "created",
    "approved",
    "invoiced",
    "processing",
    "shipped",
    "delivered",
    "canceled",
    "unavailable",
]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
STATE_PATTERN = "^[A-Z]{2}$"

# Document shapes. Each field maps to the type names it may hold, with
# optional rules. "required" means the key is there; fields not listed are allowed.
_NUMBER_OR_NULL = ["int", "long", "double", "null"]
PRODUCTS_CATALOG_DOC = {
    "required": ["product_id", "category", "attributes", "dimensions"],
    "fields": {
        "product_id": {"types": ["string"]},
        "category": {
            "types": ["object"],
            "required": ["name_pt"],
            "fields": {"name_pt": {"types": ["string"]}, "name_en": {"types": ["string", "null"]}},
        },
        "metrics": {
            "types": ["object"],
            "fields": {
                "name_length": {"types": _NUMBER_OR_NULL},
                "description_length": {"types": _NUMBER_OR_NULL},
                "photos_qty": {"types": _NUMBER_OR_NULL},
            },
        },
        "attributes": {
            "types": ["array"],
            "items": {"required": ["k", "v"], "fields": {"k": {"types": ["string"]}}},
        },
        "dimensions": {
            "types": ["object"],
            "fields": {
                "weight_g": {"types": _NUMBER_OR_NULL},
                "length_cm": {"types": _NUMBER_OR_NULL},
                "height_cm": {"types": _NUMBER_OR_NULL},
                "width_cm": {"types": _NUMBER_OR_NULL},
                "volume_cm3": {"types": _NUMBER_OR_NULL},
            },
        },
    },
}
ORDER_REVIEWS_DOC = {
    "required": ["review_id", "order_id", "review_score"],
    "fields": {
        "review_id": {"types": ["string"]},
        "order_id": {"types": ["string"]},
        "review_score": {"types": ["int", "long"], "min": 1, "max": 5},
        "review_comment_title": {"types": ["string", "null"]},
        "review_comment_message": {"types": ["string", "null"]},
        "review_creation_date": {"types": ["date", "null"]},
        "review_answer_timestamp": {"types": ["date", "null"]},
        "sentiment_hint": {"types": ["string", "null"]},
    },
}
ORDERS_ANALYTICS_DOC = {
    "required": ["order_id", "status", "purchase_ts", "purchase_year_month", "customer"],
    "fields": {
        "order_id": {"types": ["string"]},
        "status": {"types": ["string"]},
        "purchase_ts": {"types": ["date"]},
        "purchase_year_month": {"types": ["string"]},
        "customer": {
            "types": ["object"],
            "required": ["customer_id", "state", "city"],
            "fields": {
                "customer_id": {"types": ["string"]},
                "customer_unique_id": {"types": ["string", "null"]},
                "state": {"types": ["string"]},
                "city": {"types": ["string"]},
                "zip_code_prefix": {"types": ["int", "long", "string", "null"]},
            },
        },
        "payment_summary": {
            "types": ["object"],
            "fields": {
                "total_value": {"types": ["double", "decimal", "int", "long", "null"]},
                "payment_types": {"types": ["array"]},
                "max_installments": {"types": ["int", "long", "null"]},
            },
        },
    },
}
SELLER_STATE_BUCKETS_DOC = {
    "required": ["state", "seller_count", "sellers"],
    "fields": {
        "state": {"types": ["string"]},
        "seller_count": {"types": ["int", "long"]},
        "sellers": {
            "types": ["array"],
            "items": {
                "required": ["seller_id", "city"],
                "fields": {
                    "seller_id": {"types": ["string"]},
                    "city": {"types": ["string"]},
                    "zip_code_prefix": {"types": ["int", "long", "string", "null"]},
                },
            },
        },
    },
}
GEOLOCATION_POINTS_DOC = {
    "required": ["zip_code_prefix", "city", "state", "location"],
    "fields": {
        "zip_code_prefix": {"types": ["int", "long", "string"]},
        "city": {"types": ["string"]},
        "state": {"types": ["string"]},
        "location": {
            "types": ["object"],
            "required": ["type", "coordinates"],
            "fields": {
                "type": {"enum": ["Point"]},
                "coordinates": {"types": ["array"], "min_items": 2, "max_items": 2},
            },
        },
    },
}
