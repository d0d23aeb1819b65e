"""Hand-made marketplace tables for unit tests."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

S, D, I, L, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampNTZType()

SCHEMAS = {
    "orders": [("order_id", S), ("customer_id", S), ("order_status", S), ("order_purchase_timestamp", TS),
               ("order_approved_at", TS), ("order_delivered_carrier_date", TS),
               ("order_delivered_customer_date", TS), ("order_estimated_delivery_date", TS)],
    "order_items": [("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
                    ("shipping_limit_date", TS), ("price", D), ("freight_value", D)],
    "order_reviews": [("review_id", S), ("order_id", S), ("review_score", I)],
    "customers": [("customer_id", S), ("customer_zip_code_prefix", S)],
    "sellers": [("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S)],
    "geolocation": [("ordinal", L), ("geolocation_zip_code_prefix", S), ("geolocation_lat", D),
                    ("geolocation_lng", D)],
    "products": [("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
                 ("product_description_lenght", I), ("product_photos_qty", I), ("product_weight_g", I),
                 ("product_length_cm", I), ("product_height_cm", I), ("product_width_cm", I)],
    "product_category_name_translation": [("product_category_name", S), ("product_category_name_english", S)],
}


def ts(day, hour=0, minute=0):
    return datetime(2018, 1, 1) + timedelta(days=day or 0, hours=hour, minutes=minute)


def make_tables(spark, **rows):
    out = {}
    for name, cols in SCHEMAS.items():
        schema = T.StructType([T.StructField(c, t) for c, t in cols])
        out[name] = spark.createDataFrame(rows.get(name, []), schema)
    return out


def order(oid, cust="c1", status="delivered", purchase=0, approved=0, carrier=1, delivered=3, estimated=5):
    return (oid, cust, status, None if purchase is None else ts(purchase),
            None if approved is None else ts(approved), None if carrier is None else ts(carrier),
            None if delivered is None else ts(delivered), None if estimated is None else ts(estimated))


def item(oid, n, pid, sid, limit=1, price=10.0, freight=1.0):
    return (oid, n, pid, sid, None if limit is None else ts(limit), price, freight)
