"""Daily subscription reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trialmetrics.experiment import Experiment, Experiments
from trialmetrics.functions.ratios import ratio_or_zero, total
from trialmetrics.operators import assignment, windows
from trialmetrics.operators.assignment import labelled, labelled_value
from trialmetrics.operators.events import USER_DAY, of, stacked
from trialmetrics.sources.tables import Tables

REPORT = ["event_date", "variation_id"]


def subscription_orders(t: Tables, exp: Experiment | Experiments, fanout: bool = False) -> DataFrame:
    """U1. New subscribers, subscription and currency orders, repeat and renewal rates.

    ``fanout`` reproduces the original report, where the orders of each kind are counted
    once per order of the other kind in the same group. The same numbers come from
    multiplying the counts, without joining orders to orders.
    """
    days = windows.without_first(exp)
    orders = stacked(
        sub=t["subscribe"].filter(days.contain("event_date")).select(
            *USER_DAY, "new_subscription", "new_product_subscription"),
        flux=t["currency"].filter(days.contain("event_date")).select(*USER_DAY, "is_first_flux"))
    facts = orders.groupBy(*USER_DAY).agg(
        total(of("sub")).alias("subs"), total(of("flux")).alias("fluxes"),
        total(F.col("new_subscription")).alias("new_subs"), total(~F.col("new_subscription")).alias("repeat_subs"),
        total(~F.col("new_product_subscription")).alias("renewals"),
        total(F.col("is_first_flux") == 0).alias("repeat_fluxes"))

    def whole(name: str):
        return F.coalesce(F.sum(labelled_value(name)), F.lit(0))

    sums = assignment.resolve(t, exp, "daily_first", days).join(facts, USER_DAY, "left").groupBy(*exp.keys, *REPORT).agg(
        F.count("*").alias("experiment_user_count"), total(labelled(F.col("new_subs") > 0)).alias("new_subscribe_users"),
        whole("subs").alias("n_subs"), whole("fluxes").alias("n_fluxes"), whole("repeat_subs").alias("repeat_subs"),
        whole("renewals").alias("renewals"), whole("repeat_fluxes").alias("repeat_fluxes"))
    one = F.lit(1)
    by_flux = F.greatest("n_fluxes", one) if fanout else one
    by_sub = F.greatest("n_subs", one) if fanout else one
    counted = sums.select(
        *exp.keys, *REPORT, "experiment_user_count", "new_subscribe_users",
        (F.col("n_subs") * by_flux).alias("subscribe_orders"),
        (F.col("repeat_subs") * by_flux).alias("subscribe_repeat_orders"),
        (F.col("renewals") * by_flux).alias("subscribe_renew_orders"),
        (F.col("n_fluxes") * by_sub).alias("flux_orders"),
        (F.col("repeat_fluxes") * by_sub).alias("flux_repeat_orders"))
    repeat = F.col("subscribe_repeat_orders") + F.col("flux_repeat_orders")
    counted = counted.withColumn("total_orders", F.col("subscribe_orders") + F.col("flux_orders"))
    return counted.select(
        *exp.keys, *REPORT, "experiment_user_count", "new_subscribe_users",
        ratio_or_zero("new_subscribe_users", "experiment_user_count").alias("subscribe_rate"),
        "subscribe_orders", "subscribe_repeat_orders", "subscribe_renew_orders",
        ratio_or_zero("subscribe_repeat_orders", "subscribe_orders").alias("subscribe_repurchase_rate"),
        ratio_or_zero("subscribe_renew_orders", "subscribe_orders").alias("subscribe_renew_rate"),
        "flux_orders", "flux_repeat_orders",
        ratio_or_zero("flux_repeat_orders", "flux_orders").alias("flux_repurchase_rate"),
        "total_orders", ratio_or_zero(repeat, "total_orders").alias("repurchase_rate"))


def _subscriber_rate(t: Tables, exp: Experiment | Experiments, days: windows.Days | windows.EachDays, only_new: bool, users: str, rate: str) -> DataFrame:
    """Assigned users of a day and how many of them bought a subscription in either store that day."""
    def bought(store: str, kind: str) -> DataFrame:
        day = F.to_date("sub_date")
        rows = t[store].filter(days.contain(day) & (F.col("notification_type") == kind))
        if only_new:
            rows = rows.filter("new_subscription = 1")
        return rows.select("user_id", day.alias("event_date"))

    buyers = bought("google", "4").unionByName(bought("apple", "SUBSCRIBED")).distinct().withColumn("bought", F.lit(True))
    sums = (
        assignment.resolve(t, exp, "daily_first", days).join(buyers, USER_DAY, "left")
        .groupBy(*exp.keys, F.col("event_date").alias("sub_date"), "variation_id")
        .agg(F.count("*").alias("group_user_count"),
             total(labelled(F.col("bought"))).alias(users))
    )
    return sums.withColumn(rate, ratio_or_zero(users, "group_user_count", 4))


def subscription_rate(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """U2. Share of a day's assigned users with a subscription order."""
    return _subscriber_rate(t, exp, windows.without_first(exp), False, "new_subscribe_users", "order_rate")


def first_subscription_rate(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """U3. As U2 for first subscriptions only."""
    return _subscriber_rate(t, exp, windows.whole(exp), True, "first_subscribe_users", "first_subscribe_rate")
