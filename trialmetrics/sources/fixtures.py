"""The input tables derived from the test tables ``events`` and ``nation``."""

from __future__ import annotations

from datetime import datetime
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trialmetrics.experiment import Experiment
from trialmetrics.sources.tables import Tables

# Declared, so that opening a table reads no file.
RAW = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}
PHASE = Experiment("exp_a", "demo", datetime(2024, 1, 2, 6), datetime(2024, 1, 28, 18))

def _nth(divisor: int) -> Column:
    return F.col("event_id") % divisor


def fixture_tables(spark: SparkSession, folder: str, hard: bool = False, **options) -> Tables:
    """``hard`` adds what the plain events lack: events delivered twice, users and variations that are
    NULL, a third variation and one that is idle in the phase, and more bots."""
    day = F.to_date("ts").alias("event_date")
    bots = 40 if hard else 5

    @cache
    def raw(name: str) -> DataFrame:
        return spark.read.schema(RAW[name]).parquet(f"{folder}/{name}.parquet")

    def events(*kinds: str) -> DataFrame:
        rows = raw("events")
        if hard:
            rows = rows.withColumn("user_id", F.when(_nth(29) != 0, F.col("user_id")))
            rows = rows.union(rows.filter(_nth(7) == 0))
        return rows.filter(F.col("event_type").isin(*kinds)) if kinds else rows

    def by_country(rows: DataFrame) -> DataFrame:
        return rows.join(raw("nation"), F.col("n_nationkey") == F.col("user_id") % 25)

    def ids(kind: str, divisor: int) -> DataFrame:
        return events(kind).filter(_nth(divisor) == 0).select("event_id", "user_id", day)

    def assignment() -> DataFrame:
        flips = F.when(_nth(17) == 0, 1).otherwise(0)
        variation = (F.col("user_id") + flips) % (3 if hard else 2)
        if hard:
            late = F.to_date("ts") > F.lit(PHASE.last_day)
            variation = F.when(_nth(31) == 0, None).when(late, 3).otherwise(variation)
        # Not a literal, which would be folded out of joins that real ids stay in.
        experiment = F.when(F.col("event_id").isNotNull(), "exp_a")
        return events("signup", "view").select(
            "user_id", experiment.alias("experiment_id"),
            variation.cast("int").alias("variation_id"),
            F.col("ts").alias("timestamp_assigned"), day)

    def first_visit() -> DataFrame:
        return events("signup").groupBy("user_id").agg(F.min(F.to_date("ts")).alias("first_visit_date"))

    def active() -> DataFrame:
        flag = F.max(F.when(F.col("event_type") == "error", 0).otherwise(1))
        return (events().groupBy("user_id", F.to_date("ts").alias("active_date"))
                .agg(flag.alias("keep_alive_flag")))

    def purchases(odd: int) -> DataFrame:
        return events("purchase").filter(_nth(2) == odd)

    def subscribe() -> DataFrame:
        return purchases(0).select(
            "event_id", "user_id", day, F.col("value").alias("revenue"),
            (_nth(3) == 0).alias("new_subscription"), (_nth(5) != 0).alias("new_product_subscription"))

    def currency() -> DataFrame:
        return purchases(1).select(
            "event_id", "user_id", day, F.col("value").alias("revenue"),
            F.when(_nth(4) == 1, 1).otherwise(0).alias("is_first_flux"))

    def all_purchase() -> DataFrame:
        kind = (F.when(_nth(2) == 0, "subscription").when(_nth(10) == 1, "gift").otherwise("currency"))
        return events("purchase").select("user_id", day, F.col("value").alias("revenue"), kind.alias("type"))

    def ads() -> DataFrame:
        return events("error").select("event_id", "user_id", day, (F.col("value") / 1000).alias("ad_revenue"))

    def session() -> DataFrame:
        return events().select("event_id", "user_id", day, (F.col("value") * 60000).alias("duration"))

    def geo() -> DataFrame:
        seen = events().filter(F.col("user_id") % 10 != 9).select("user_id", day).distinct()
        return by_country(seen).select("user_id", "event_date", F.col("n_name").alias("country"))

    source = F.when(_nth(3) == 0, "tag:Explore").otherwise("home").alias("source")

    def chat() -> DataFrame:
        method = (F.when(_nth(6) == 0, "edit").when(_nth(6) == 1, "continue").when(_nth(6) == 2, "regenerate")
                  .when(_nth(6) == 3, "generate").when(_nth(6) == 4, "send"))
        return events("click").select(
            "event_id", "user_id", F.col("ts").alias("ingest_timestamp"), day,
            (F.col("user_id") * 1000 + _nth(7)).alias("conversation_id"), _nth(bots).alias("prompt_id"),
            method.alias("method"), source)

    def bot_view() -> DataFrame:
        return events("view").select("event_id", "user_id", day, _nth(bots).alias("bot_id"), source)

    def show_card() -> DataFrame:
        tab = F.when(_nth(2) == 0, "Explore").otherwise("Following")
        return events("view", "error").select(
            "event_id", "user_id", day, F.lit("home").alias("current_page"), tab.alias("tab_name"))

    def store(first: str, second: str, third: str, odd: int) -> DataFrame:
        kind = F.when(_nth(3) == 0, first).when(_nth(3) == 1, second).otherwise(third)
        return events("purchase", "signup").filter(F.col("user_id") % 2 == odd).select(
            "user_id", _nth(2).alias("order_id"), F.to_date("ts").alias("sub_date"),
            kind.alias("notification_type"), F.when(_nth(4) == 0, 1).otherwise(0).alias("new_subscription"))

    def daily_revenue() -> DataFrame:
        kind, value = F.col("event_type"), F.col("value")
        return events().groupBy("user_id", day).agg(
            F.sum(F.when(kind == "error", value / 1000)).alias("ad_revenue"),
            F.sum(F.when((kind == "purchase") & (_nth(2) == 0), value)).alias("subscribe_revenue"),
            F.sum(F.when((kind == "purchase") & (_nth(2) == 1), value)).alias("flux_revenue"))

    def app_event() -> DataFrame:
        geo_text = F.when(F.col("user_id") % 10 == 9, "{}").otherwise(
            F.concat(F.lit('{"country":"'), "n_name", F.lit('"}')))
        return by_country(events()).select("user_id", geo_text.alias("geo"))

    def user_aov() -> DataFrame:
        return events("purchase").groupBy("user_id").agg(F.avg("value").alias("user_aov")).select(
            "user_id", (F.col("user_id") % 2).cast("int").alias("variation_id"), "user_aov")

    openers = {
        "assignment": assignment, "first_visit": first_visit, "active": active, "subscribe": subscribe,
        "currency": currency, "all_purchase": all_purchase, "ads_impression": ads, "ads_end": ads,
        "session": session, "geo": geo, "chat": chat, "bot_view": bot_view, "show_card": show_card,
        "follow": lambda: ids("signup", 2), "reset": lambda: ids("error", 3), "image": lambda: ids("click", 4),
        "google": lambda: store("2", "4", "3", 1),
        "apple": lambda: store("SUBSCRIBED", "DID_RENEW", "DID_CHANGE_RENEWAL_STATUS", 0),
        "business_user": lambda: first_visit().withColumnRenamed("first_visit_date", "first_active_date"),
        "daily_revenue": daily_revenue, "app_event": app_event, "user_aov": user_aov,
    }
    return Tables(spark, lambda name: openers[name](), **options)
