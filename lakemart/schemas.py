"""Declared schemas of the raw documents and files.

Jobs never infer schemas: inference is a full extra pass over the input and
turns open key/value bags into wide structs.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


# Raw order document (JSON array file): numbers arrive as quoted strings.
ATTEMPT = T.StructType([_f("provider", S), _f("status", S), _f("attempted_at", S),
                        _f("error", T.StructType([_f("code", S)]))])
ADJUSTMENT = T.StructType([_f("type", S), _f("amount", S), _f("reason", S)])
ITEM = T.StructType([_f("line_no", L), _f("product_id", L), _f("sku", S), _f("quantity", S),
                     _f("unit_price", S), _f("category_path", T.ArrayType(S)),
                     _f("adjustments", T.ArrayType(ADJUSTMENT))])
ORDER_DOC = T.StructType([
    _f("order_id", L), _f("cart_id", L),
    _f("customer", T.StructType([_f("user_id", L), _f("city", S)])),
    _f("status", S), _f("created_at", S),
    _f("channel", T.StructType([_f("name", S), _f("utm", T.StructType([_f("source", S), _f("campaign", S)]))])),
    _f("payment", T.StructType([_f("payment_id", S), _f("status", S), _f("amount", S), _f("currency", S),
                                _f("attempts", T.ArrayType(ATTEMPT))])),
    _f("items", T.ArrayType(ITEM)),
])

# Event lines: the open bags are maps, not structs.
EVENT_LINE = T.StructType([
    _f("event_id", S), _f("user_id", L), _f("order_id", L), _f("event_type", S), _f("event_time", S),
    _f("context", T.MapType(S, S)), _f("attributes", T.MapType(S, S)),
])

SHIPMENT = T.StructType([
    _f("shipment_id", S), _f("order_id", L), _f("provider", S),
    _f("events", T.ArrayType(T.StructType([_f("status", S), _f("event_time", S), _f("city", S)]))),
])

CUSTOMER_CSV = "user_id BIGINT, email STRING, country STRING, segment STRING, status STRING"

# Paged product API payload (one page).
API_PRODUCT = T.StructType([_f("id", L), _f("title", S), _f("price", D), _f("stock", L)])
API_PAGE = T.StructType([_f("products", T.ArrayType(API_PRODUCT)), _f("total", L), _f("skip", L),
                         _f("limit", L)])

# Typed order rows of the raw-order table.
RAW_ORDER_COLUMNS = ["order_id", "cart_id", "user_id", "city", "status", "created_at", "channel",
                     "items_count", "payment_id", "payment_status", "payment_amount", "currency",
                     "raw_payload", "loaded_at"]

# Driver event table as declared text (JSON/CSV round trips keep microsecond
# timestamps through an explicit format).
EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
NTZ_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
