"""Columns of the input tables the jobs read.

Ids are strings in a warehouse and integers in the test tables; the jobs only compare
them, so ``ID`` is a placeholder that a loader may override.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.StringType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


DATE, STRING, DOUBLE = T.DateType(), T.StringType(), T.DoubleType()
INT, BOOL, TIME = T.IntegerType(), T.BooleanType(), T.TimestampNTZType()

SCHEMAS: dict[str, T.StructType] = {
    "assignment": _table(user_id=ID, experiment_id=STRING, variation_id=INT,
                         timestamp_assigned=TIME, event_date=DATE),
    "first_visit": _table(user_id=ID, first_visit_date=DATE),
    "active": _table(user_id=ID, active_date=DATE, keep_alive_flag=INT),
    "subscribe": _table(event_id=ID, user_id=ID, event_date=DATE, revenue=DOUBLE,
                        new_subscription=BOOL, new_product_subscription=BOOL),
    "currency": _table(event_id=ID, user_id=ID, event_date=DATE, revenue=DOUBLE,
                       is_first_flux=INT),
    "all_purchase": _table(user_id=ID, event_date=DATE, revenue=DOUBLE, type=STRING),
    "ads_impression": _table(event_id=ID, user_id=ID, event_date=DATE, ad_revenue=DOUBLE),
    "ads_end": _table(event_id=ID, user_id=ID, event_date=DATE, ad_revenue=DOUBLE),
    "session": _table(event_id=ID, user_id=ID, event_date=DATE, duration=DOUBLE),
    "geo": _table(user_id=ID, event_date=DATE, country=STRING),
    "chat": _table(event_id=ID, user_id=ID, ingest_timestamp=TIME, event_date=DATE,
                   conversation_id=ID, prompt_id=ID, method=STRING, source=STRING),
    "bot_view": _table(event_id=ID, user_id=ID, event_date=DATE, bot_id=ID, source=STRING),
    "show_card": _table(event_id=ID, user_id=ID, event_date=DATE, current_page=STRING,
                        tab_name=STRING),
    "follow": _table(event_id=ID, user_id=ID, event_date=DATE),
    "reset": _table(event_id=ID, user_id=ID, event_date=DATE),
    "image": _table(event_id=ID, user_id=ID, event_date=DATE),
    "google": _table(user_id=ID, order_id=ID, sub_date=DATE, notification_type=STRING,
                     new_subscription=INT),
    "apple": _table(user_id=ID, order_id=ID, sub_date=DATE, notification_type=STRING,
                    new_subscription=INT),
    "business_user": _table(user_id=ID, first_active_date=DATE),
    "daily_revenue": _table(user_id=ID, event_date=DATE, ad_revenue=DOUBLE,
                            subscribe_revenue=DOUBLE, flux_revenue=DOUBLE),
    "app_event": _table(user_id=ID, geo=STRING),
    "user_aov": _table(user_id=ID, variation_id=INT, user_aov=DOUBLE),
}

EXPERIMENT_DOCUMENTS = T.StructType([
    T.StructField("name", STRING),
    T.StructField("tags", T.ArrayType(STRING)),
    T.StructField("variations", T.ArrayType(_table(key=STRING, name=STRING))),
    T.StructField("phases", T.ArrayType(_table(dateStarted=STRING, dateEnded=STRING))),
])
