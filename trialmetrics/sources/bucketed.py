"""Tables stored by user, so that reports join them where they lie.

Facts, assignments and activity are all grouped and joined by user, or by user and day. Stored in as many buckets by user, they need
no exchange for that: a report of one stream, or retention, shuffles its few result rows only. Reports that stack several streams
gain nothing, since Spark forgets the buckets of a union whose parts compute columns. It pays where the same days are read by many
reports; a bucket is one task, so a user with a large share of all rows is better served by the plain layout, whose
exchanges split.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from trialmetrics.sources.tables import Tables

#: A join by user and day uses the buckets by user of both sides.
SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
USER_TABLES = ("assignment", "first_visit", "active", "subscribe", "currency", "all_purchase", "ads_impression", "ads_end", "session", "geo", "chat",
               "bot_view", "show_card", "follow", "reset", "image", "google", "apple", "business_user", "daily_revenue", "app_event")


def store_by_user(t: Tables, database: str, buckets: int, names: Iterable[str] = USER_TABLES) -> Tables:
    """Write tables of ``t`` into ``database``, bucketed and sorted by user, and return them as stored. Rows are dealt
    to the buckets first, so a bucket is one file."""
    spark = t.spark
    for name in names:
        t[name].repartition(buckets, "user_id").write.bucketBy(buckets, "user_id").sortBy("user_id").mode("overwrite") \
            .format("parquet").saveAsTable(f"{database}.{name}")
    return stored_by_user(spark, database)


def stored_by_user(spark: SparkSession, database: str) -> Tables:
    return Tables(spark, lambda name: spark.table(f"{database}.{name}"))
