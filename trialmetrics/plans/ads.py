"""Advertising of the whole phase and its evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trialmetrics.experiment import Experiment, Experiments
from trialmetrics.functions.means import assumed_normal_win
from trialmetrics.functions.proportions import beta_comparison, relative_uplift
from trialmetrics.functions.ratios import half_up, money, ratio, ratio_or_zero
from trialmetrics.operators import assignment, windows
from trialmetrics.operators.assignment import labelled_value
from trialmetrics.operators.events import USER_DAY, of, stacked
from trialmetrics.plans.recharge import beside_control
from trialmetrics.sources.tables import Tables


def ads(t: Tables, exp: Experiment | Experiments, date_filter: bool = False) -> DataFrame:
    """V1. Ad revenue and exposure per variation. A user counts in every variation seen.

    Ad events of all dates count unless ``date_filter`` limits them to the phase.
    """
    days = windows.whole(exp)
    users = assignment.resolve(t, exp, "any", days)
    events = stacked(end=t["ads_end"], impression=t["ads_impression"])
    if date_filter:
        events = events.filter(days.contain("event_date"))
    events = events.select(*USER_DAY, F.when(of("end"), F.col("ad_revenue")).alias("revenue"), of("impression").cast("int").alias("shown"))
    added = {name: F.sum(name) for name in ("revenue", "shown")}
    if exp.keys and date_filter:
        events = events.groupBy(*USER_DAY).agg(*[value.alias(name) for name, value in added.items()])
        with_ads = assignment.with_sums(users, events, days, exp, added)
    else:
        with_ads = users.join(events.groupBy("user_id").agg(*[value.alias(name) for name, value in added.items()]), "user_id", "left")
    sums = with_ads.groupBy(*exp.keys, "variation_id").agg(
        F.count("*").alias("total_active_users"), money(labelled_value("revenue")).alias("revenue"),
        F.count(F.when(labelled_value("shown") > 0, 1)).alias("ad_exposure_users"),
        F.coalesce(F.sum(labelled_value("shown")), F.lit(0)).alias("ad_exposure_count"))
    revenue = F.coalesce("revenue", F.lit(0.0))
    ecpm = half_up(ratio("revenue", "ad_exposure_count") * 1000, 4)
    return sums.select(
        *exp.keys, "variation_id", "total_active_users", revenue.alias("total_ad_revenue"),
        ratio(revenue, "total_active_users", 4).alias("ad_arpu"), "ad_exposure_users",
        ratio("ad_exposure_users", "total_active_users", 4).alias("ad_exposure_rate"), "ad_exposure_count",
        F.when(F.col("ad_exposure_count") == 0, F.lit(0.0)).otherwise(ecpm).alias("ecpm"),
        ratio_or_zero("ad_exposure_count", "ad_exposure_users", 4).alias("ad_exposure_per_user"))


def ads_evaluation(report: DataFrame, exp: Experiment, evaluate: bool = True) -> DataFrame:
    """V2. Exposure rate and ad revenue per user of each treatment against the control."""
    rows = beside_control(report.withColumnRenamed("variation_id", "variation"), exp, {
        "total_active_users": ("control_users", "exp_group_users"),
        "ad_exposure_users": ("_control", "_exp"),
        "ad_exposure_rate": ("control_ad_exposure_rate", "exp_group_ad_exposure_rate"),
        "ad_arpu": ("control_ad_arpu", "exp_group_ad_arpu")})
    rows = rows.withColumns({
        "exposure_rate_uplift": relative_uplift("exp_group_ad_exposure_rate", "control_ad_exposure_rate"),
        "ad_arpu_uplift": relative_uplift("exp_group_ad_arpu", "control_ad_arpu")})
    wins = []
    if evaluate:
        rows = beta_comparison(rows, "_control", "control_users", "_exp", "exp_group_users", "_")
        rows = rows.withColumns({
            "exposure_rate_chance_to_win": F.round("_chance_to_win", 6),
            "ad_arpu_chance_to_win": F.round(assumed_normal_win("control_ad_arpu", "exp_group_ad_arpu"), 6)})
        wins = ["exposure_rate_chance_to_win", "ad_arpu_chance_to_win"]
    return rows.select(
        "variation", "control_users", "control_ad_exposure_rate", "control_ad_arpu", "exp_group_users",
        "exp_group_ad_exposure_rate", "exp_group_ad_arpu", "exposure_rate_uplift", *wins[:1],
        "ad_arpu_uplift", *wins[1:])
