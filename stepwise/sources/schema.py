"""Raw event record: only the fields the staging layer reads.

One row per event; products are a repeated record inside the event. Session
ids live in a key/value list, not a map: a key may repeat, and the first
occurrence wins.
"""

from pyspark.sql import types as T

PARAM_VALUE = T.StructType(
    [
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
    ]
)

EVENT_PARAM = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", PARAM_VALUE),
    ]
)

ITEM = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("item_brand", T.StringType()),
        T.StructField("item_category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("item_revenue", T.DoubleType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        # yyyyMMdd string; the directory partition column of the sharded table.
        # Declared as string so partition inference does not turn it into int.
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),  # epoch microseconds, UTC
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
        T.StructField("platform", T.StringType()),
        T.StructField("device", T.StructType([T.StructField("category", T.StringType())])),
        T.StructField(
            "traffic_source",
            T.StructType(
                [
                    T.StructField("source", T.StringType()),
                    T.StructField("medium", T.StringType()),
                    T.StructField("name", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "ecommerce",
            T.StructType(
                [
                    T.StructField("transaction_id", T.StringType()),
                    T.StructField("purchase_revenue", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("items", T.ArrayType(ITEM)),
    ]
)
