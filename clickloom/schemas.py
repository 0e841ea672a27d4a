"""Column layouts of every layer, and the fixed vocabulary."""

from __future__ import annotations

from pyspark.sql import types as T

# Event names, feature names and their order, cut-offs.
VIEW = "view"
ADD_TO_CART = "addtocart"
TRANSACTION = "transaction"
EVENT_TYPES = [VIEW, ADD_TO_CART, TRANSACTION]

COUNT_FEATURES = [
    "user_views_7d",
    "user_addtocart_7d",
    "user_transactions_30d",
    "user_sessions_30d",
]
RATE_FEATURES = [
    "avg_session_duration_30d",
    "user_cart_items_avg_popularity_7d",
    "user_cart_top_seller_ratio_7d",
]
MODEL_FEATURES = COUNT_FEATURES + RATE_FEATURES
INTERACTION_FEATURES = COUNT_FEATURES[:3]
MIN_INTERACTIONS = 5
TARGET = "purchase_next_7d"

SHORT_WINDOW_DAYS = 7
LONG_WINDOW_DAYS = 30
SESSION_TIMEOUT_MINUTES = 30
TOP_SELLER_QUANTILE = 0.90

ROOT_PARENT = -1
CATEGORY_PROPERTY = "categoryid"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_EVENTS_CSV = _struct(
    ("timestamp", T.LongType()),
    ("visitorid", T.LongType()),
    ("event", T.StringType()),
    ("itemid", T.LongType()),
    ("transactionid", T.LongType()),
)

ITEM_PROPERTIES_CSV = _struct(
    ("timestamp", T.LongType()),
    ("itemid", T.LongType()),
    ("property", T.StringType()),
    ("value", T.StringType()),
)

CATEGORY_TREE_CSV = _struct(
    ("categoryid", T.LongType()),
    ("parentid", T.LongType()),
)

BRONZE = _struct(
    ("event_time", T.TimestampType()),
    ("visitorid", T.LongType()),
    ("event", T.StringType()),
    ("itemid", T.LongType()),
    ("transactionid", T.LongType()),
)
BRONZE_COLUMNS = BRONZE.fieldNames()

SILVER = BRONZE

QUARANTINE = T.StructType(
    BRONZE.fields + [T.StructField("_dq_error", T.StringType(), True)]
)

GOLD = T.StructType(
    [
        T.StructField("visitorid", T.LongType(), True),
        T.StructField("snapshot_day", T.IntegerType(), True),
        *[T.StructField(name, T.LongType(), True) for name in COUNT_FEATURES],
        *[T.StructField(name, T.DoubleType(), True) for name in RATE_FEATURES],
    ]
)

TRAINING = T.StructType(GOLD.fields + [T.StructField(TARGET, T.ByteType(), True)])

PREDICTIONS = _struct(
    ("visitorid", T.LongType()),
    ("purchase_probability", T.DoubleType()),
)
