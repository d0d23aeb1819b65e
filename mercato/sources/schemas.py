"""Declared schemas of the eight marketplace tables the operators read.

Only the columns the operators use are declared; extra CSV columns are
carried through untouched.  Ids and zip prefixes are strings in the CSV
export (leading zeros kept); other sources may use integer ids, which the
operators accept as well.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()

SCHEMAS: dict[str, dict[str, T.DataType]] = {
    "orders": {
        "order_id": S,
        "customer_id": S,
        "order_status": S,
        "order_purchase_timestamp": TS,
        "order_approved_at": TS,
        "order_delivered_carrier_date": TS,
        "order_delivered_customer_date": TS,
        "order_estimated_delivery_date": TS,
    },
    "order_items": {
        "order_id": S,
        "order_item_id": I,
        "product_id": S,
        "seller_id": S,
        "shipping_limit_date": TS,
        "price": D,
        "freight_value": D,
    },
    "order_reviews": {
        "review_id": S,
        "order_id": S,
        "review_score": I,
    },
    "customers": {
        "customer_id": S,
        "customer_unique_id": S,
        "customer_zip_code_prefix": S,
        "customer_city": S,
        "customer_state": S,
    },
    "sellers": {
        "seller_id": S,
        "seller_zip_code_prefix": S,
        "seller_city": S,
        "seller_state": S,
    },
    "geolocation": {
        "geolocation_zip_code_prefix": S,
        "geolocation_lat": D,
        "geolocation_lng": D,
        "geolocation_city": S,
        "geolocation_state": S,
    },
    "products": {
        "product_id": S,
        "product_category_name": S,
        "product_name_lenght": I,
        "product_description_lenght": I,
        "product_photos_qty": I,
        "product_weight_g": I,
        "product_length_cm": I,
        "product_height_cm": I,
        "product_width_cm": I,
    },
    "product_category_name_translation": {
        "product_category_name": S,
        "product_category_name_english": S,
    },
}

TABLE_NAMES = tuple(SCHEMAS)
