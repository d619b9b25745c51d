"""Currency recharge of the whole phase and its evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from trialmetrics.experiment import Experiment, Experiments
from trialmetrics.functions.means import assumed_normal_win
from trialmetrics.functions.proportions import beta_comparison, relative_uplift
from trialmetrics.functions.ratios import money, ratio
from trialmetrics.operators import assignment, windows
from trialmetrics.operators.assignment import labelled_value
from trialmetrics.operators.events import USER_DAY
from trialmetrics.sources.tables import Tables


def recharge(t: Tables, exp: Experiment | Experiments, strict_bounds: bool = False) -> DataFrame:
    """G1. Revenue, conversion and orders per payer. A user counts in every variation seen."""
    days = windows.between_times(exp, strict_bounds)
    users = assignment.resolve(t, exp, "any", days)
    bought = t["currency"].filter(days.contain("event_date")).withColumn("orders", F.lit(1))

    added = {name: F.sum(name) for name in ("revenue", "orders")}
    if exp.keys:
        bought = bought.groupBy(*USER_DAY).agg(*[value.alias(name) for name, value in added.items()])
    sums = assignment.with_sums(users, bought, days, exp, added).groupBy(*exp.keys, "variation_id").agg(
        F.count("*").alias("total_active_users"), money(labelled_value("revenue")).alias("total_recharge_revenue"),
        F.sum(labelled_value("orders")).alias("orders"), F.count(labelled_value("orders")).alias("payers"))
    converted = F.when(F.col("payers") > 0, F.col("payers"))
    return sums.select(
        *exp.keys, F.col("variation_id").alias("variation"), "total_active_users", "total_recharge_revenue",
        ratio("total_recharge_revenue", "total_active_users", 4).alias("recharge_ARPU"),
        ratio(converted, "total_active_users", 4).alias("recharge_conversion_rate"),
        ratio("orders", converted, 4).alias("recharge_frequency"))


def rolled_up(report: DataFrame) -> DataFrame:
    """G2. One row per variation, and tag if there is one; rows without a variation are dropped."""
    keys = [name for name in ("tag", "variation") if name in report.columns]
    sums = report.filter("variation IS NOT NULL").groupBy(*keys).agg(
        F.sum("total_active_users").alias("total_active_users"),
        *[money(name).alias(name) for name in ("total_recharge_revenue", "recharge_conversion_rate", "recharge_frequency")])
    return sums.select(
        *keys, "total_active_users", "total_recharge_revenue",
        ratio("total_recharge_revenue", "total_active_users", 4).alias("recharge_ARPU"),
        "recharge_conversion_rate", "recharge_frequency")


def beside_control(report: DataFrame, exp: Experiment, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Each treatment row with the control's figures; nothing if there is no control.

    ``columns`` maps a source column to its control and treatment names. ``report`` has
    one row per variation.
    """
    everyone = Window.partitionBy(F.lit(1))
    is_control = F.col("variation") == exp.control
    picked = []
    for source, (control, treatment) in columns.items():
        picked.append(F.max(F.when(is_control, F.col(source))).over(everyone).alias(control))
        picked.append(F.col(source).alias(treatment))
    has_control = F.max(is_control).over(everyone).alias("_has_control")
    return (
        report.filter("variation IS NOT NULL").select("variation", *picked, has_control)
        .filter(F.col("_has_control") & ~is_control).drop("_has_control")
    )


def recharge_evaluation(report: DataFrame, exp: Experiment, evaluate: bool = True) -> DataFrame:
    """G3. Conversion and revenue per user of each treatment against the control."""
    rows = beside_control(report, exp, {
        "total_active_users": ("control_users", "exp_users"),
        "recharge_conversion_rate": ("control_conversion_rate", "exp_conversion_rate"),
        "recharge_ARPU": ("control_ARPU", "exp_ARPU")})
    uplifts = {"conversion_uplift": relative_uplift("exp_conversion_rate", "control_conversion_rate"),
               "ARPU_uplift": relative_uplift("exp_ARPU", "control_ARPU")}
    rows = rows.withColumns(uplifts)
    wins = []
    if evaluate:
        converted = {f"_{side}": F.col(f"{side}_users") * F.col(f"{side}_conversion_rate") for side in ("control", "exp")}
        rows = beta_comparison(rows.withColumns(converted), "_control", "control_users", "_exp", "exp_users", "_")
        rows = rows.withColumns({
            "conversion_chance_to_win": F.round("_chance_to_win", 6),
            "ARPU_chance_to_win": F.round(assumed_normal_win("control_ARPU", "exp_ARPU"), 6)})
        wins = ["conversion_chance_to_win", "ARPU_chance_to_win"]
    return rows.select(
        "variation", "control_users", "control_conversion_rate", "control_ARPU", "exp_users", "exp_conversion_rate",
        "exp_ARPU", "conversion_uplift", *wins[:1], "ARPU_uplift", *wins[1:])
