"""Retention: daily cohorts, confidence intervals, uplift and overall rates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from trialmetrics.experiment import Experiment, Experiments
from trialmetrics.functions.proportions import beta_comparison, posterior_mean, wald_interval
from trialmetrics.functions.ratios import ratio, total
from trialmetrics.operators import activity, assignment, windows
from trialmetrics.operators.events import stacked, of
from trialmetrics.operators.history import home_countries
from trialmetrics.sources.tables import Tables

HORIZONS = (1, 3, 7, 15)
KEYS = ["dt", "variation"]
COUNTERS = ["new_users", *[f"d{n}" for n in HORIZONS]]


def _cohort_day(day: str, offset: str, until: str | None = None) -> str:
    """SQL struct of a cohort day, given also as an offset into ``bits``, with a 0/1 per horizon; days after the
    offset ``until`` do not count."""
    def came(n: int) -> str:
        known = f" AND {offset} + {n} <= {until}" if until else ""
        return f"({activity.is_active(f'{offset} + {n}')}{known})"

    returned = ", ".join(f"'d{n}', CAST({came(n)} AS BIGINT)" for n in HORIZONS)
    return f"named_struct('dt', {day}, {returned})"


def _first_assignments(t: Tables, exp: Experiment | Experiments, midnights: bool = False) -> DataFrame:
    """Per user the first assignment within the phase, or between its midnights, and the first one of all."""
    key = F.struct("timestamp_assigned", "variation_id")
    in_phase = F.col("timestamp_assigned").between(*windows.phase_times(exp, midnights))
    rows, by = assignment.assignments(t, exp), [*exp.keys, "user_id"]
    if t.history is not None:  # of the rows only those of the phase are read
        phase = rows.filter(in_phase).groupBy(*by).agg(F.min(key).alias("phase"))
        ever = assignment.kept_users(t, exp).select(*by, F.col("user_first").alias("ever"))
        users = ever.join(phase, by, "full").withColumn("ever", F.least("ever", "phase"))
    else:
        users = rows.groupBy(*by).agg(F.min(F.when(in_phase, key)).alias("phase"), F.min(key).alias("ever"))
    return (
        users.select(*exp.keys, "user_id", F.col("phase.variation_id").alias("variation"),
                F.to_date("ever.timestamp_assigned").alias("assigned_on"),
                F.col("ever.variation_id").alias("assigned_to"))
    )


def _cohort_report(users: DataFrame, extra: list[str]) -> DataFrame:
    """Sum cohort and assignment rows; groups without cohort users are still included.

    Each input row is one user with ``cohort``, an array of (dt, d1..d15) structs, and
    the day and variation the user was first assigned to. The assigned users are counted
    on the same pass as the cohort, so the assignment table is read and shuffled once.
    """
    def row(day: str, variation: str, counted: dict[str, str]) -> str:
        counts = ", ".join(f"'{name}', CAST({counted.get(name, '0')} AS BIGINT)" for name in [*COUNTERS, "total_assigned"])
        return f"named_struct('dt', {day}, 'variation', {variation}, {counts})"

    assigned = row("assigned_on", "assigned_to", {"total_assigned": "1"})
    member = row("c.dt", "variation", {"new_users": "1", **{name: f"c.{name}" for name in COUNTERS[1:]}})
    rows = users.select(*extra, F.expr(
        f"inline(concat(array({assigned}), CASE WHEN cohort IS NULL THEN array() ELSE transform(cohort, c -> {member}) END))"))
    return (
        rows.filter("dt IS NOT NULL AND variation IS NOT NULL").groupBy("dt", "variation", *extra)
        .agg(*[F.sum(name).alias(name) for name in [*COUNTERS, "total_assigned"]])
    )


def new_user_retention(t: Tables, exp: Experiment | Experiments, strict_bounds: bool = False,
                       parts: int | None = None) -> DataFrame:
    """R1. Users by first-visit day, and how many came back exactly 1, 3, 7, 15 days later.

    Activity is read inside the phase only. ``parts`` splits the users into hash parts,
    kept apart in column ``part``, for runs that add parts up later.
    """
    days, observed = windows.whole(exp), windows.between_times(exp, strict_bounds)
    bits, origin = activity.observed_bits(t, observed)
    day = F.to_date("first_visit_date")
    visits = t["first_visit"].filter(days.contain(day)).select(F.col("user_id").alias("visitor"), day.alias("visit")).distinct()
    users = _first_assignments(t, exp)
    seen = F.col("user_id") == F.col("visitor")
    until = f"{(observed.last - origin).days}" if t.history is not None else None
    if exp.keys:
        users = observed.bounded(days.bounded(users, "phase_from", "phase_to"), "observed_from", "observed_to")
        seen &= F.col("visit").between(F.col("phase_from"), F.col("phase_to"))
        until = f"datediff(observed_to, DATE '{origin}')"
    cohort_day = _cohort_day("visit", f"datediff(visit, DATE '{origin}')", until)
    cohort = F.expr(f"CASE WHEN visit IS NOT NULL AND variation IS NOT NULL THEN array({cohort_day}) END")
    users = users.join(visits, seen, "left").drop("visitor").join(bits, "user_id", "left").withColumn("cohort", cohort)
    if parts is None:
        return _cohort_report(users, exp.keys).filter("new_users > 0")
    part = F.pmod(F.crc32(F.col("user_id").cast("string").cast("binary")), F.lit(parts))
    split = _cohort_report(users.withColumn("part", part.cast("int")), [*exp.keys, "part"])
    totals = Window.partitionBy(*exp.keys, "dt", "variation")
    return split.withColumn("total_assigned", F.sum("total_assigned").over(totals)).filter("new_users > 0")


def active_user_retention(t: Tables, exp: Experiment | Experiments, strict_bounds: bool = False) -> DataFrame:
    """R2. As R1 for every user active on a day; returns are looked up to 15 days past the phase."""
    days = windows.between_times(exp, strict_bounds)
    bits, origin = activity.observed_bits(t, days.widened(after=max(HORIZONS)))
    users, active_days = _active_days(_first_assignments(t, exp).join(bits, "user_id", "left"), days, origin)
    cohort = F.expr(f"CASE WHEN variation IS NOT NULL THEN {active_days} END")
    return _cohort_report(users.withColumn("cohort", cohort), exp.keys).filter("new_users > 0")


def _active_days(users: DataFrame, days: windows.Days | windows.EachDays, origin: date) -> tuple[DataFrame, str]:
    """``users`` and a SQL array of their active days of the window, each with its returns."""
    start = (days.first - origin).days
    first, last, some = str(start), str(start + max(0, len(days) - 1)), f"{len(days)} > 0"
    if isinstance(days, windows.EachDays):
        users = days.bounded(users, "active_from", "active_to")
        first, some = f"datediff(active_from, DATE '{origin}')", "active_from <= active_to"
        last = f"datediff(greatest(active_from, active_to), DATE '{origin}')"
    offsets = f"filter(sequence({first}, {last}), d -> {some} AND {activity.is_active('d')})"
    return users, f"transform({offsets}, d -> {_cohort_day(f"date_add(DATE '{origin}', d)", 'd')})"


def country_retention(t: Tables, exp: Experiment | Experiments, distinct_totals: bool = True) -> DataFrame:
    """R3. As R2 by the user's country, the greatest one found in the app events.

    ``total_assigned`` is of the day and variation over all countries. Without
    ``distinct_totals`` a user counts on every day and variation assigned.
    """
    days = windows.whole(exp)
    home = t.history.home() if t.history is not None else home_countries(t["app_event"])
    bits, origin = activity.observed_bits(t, days.widened(after=max(HORIZONS)))
    member = "variation IS NOT NULL AND country IS NOT NULL AND bits IS NOT NULL"
    users = _first_assignments(t, exp, midnights=True).join(home, "user_id", "left").join(bits, "user_id", "left")
    users, active_days = _active_days(users, days, origin)
    report = _cohort_report(users.withColumn("cohort", F.expr(f"CASE WHEN {member} THEN {active_days} END")), [*exp.keys, "country"])
    keys = [*exp.keys, *KEYS]
    if distinct_totals:
        everywhere = F.sum("total_assigned").over(Window.partitionBy(*keys))
        return report.withColumn("total_assigned", everywhere).filter("new_users > 0")
    assigned = assignment.assignments(t, exp).select(
        *exp.keys, "user_id", F.to_date("timestamp_assigned").alias("dt"), F.col("variation_id").alias("variation")).distinct()
    totals = assigned.groupBy(*keys).agg(F.count("*").alias("total_assigned"))
    return report.drop("total_assigned").filter("new_users > 0").join(totals, keys, "left").withColumn(
        "total_assigned", F.coalesce("total_assigned", F.lit(0)))


def merge_partials(partials: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """R4. Add up counters of disjoint user parts; the assigned total is the same in all of them."""
    return partials.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in COUNTERS], F.max("total_assigned").alias("total_assigned"))


def retention_rates(wide: DataFrame) -> DataFrame:
    """R5. One row per date, variation and horizon with the rate and its 95% interval."""
    horizons = F.array(*[F.struct(F.lit(n).alias("day"), F.col(f"d{n}").alias("retained")) for n in HORIZONS])
    long = wide.filter("new_users > 0").select("dt", "variation", F.col("new_users").alias("users"), F.inline(horizons))
    return wald_interval(long, "retained", "users", rate="retention_rate")


def _is_control(exp: Experiment) -> Column:
    return F.col("variation") == exp.control


def daily_report(wide: DataFrame, exp: Experiment, trim: bool = True, evaluate: bool = True) -> DataFrame:
    """R6 (trimmed) and R7. One row per date and treatment variation beside the control.

    Without ``evaluate`` the columns of the Bayesian comparison are left out.
    """
    long = retention_rates(wide)
    if trim:
        long = windows.trimmed(long)

    def on(day: int, name: str) -> Column:
        return F.max(F.when(F.col("day") == day, F.col(name)))

    wide_rates = long.groupBy(*KEYS).agg(
        *[on(n, "retention_rate").alias(f"d{n}_rate") for n in HORIZONS],
        on(1, "users").alias("exp_users"), on(1, "retained").alias("exp_retained"),
        on(1, "ci_lower").alias("exp_ci_lower"), on(1, "ci_upper").alias("exp_ci_upper"))
    same_date = Window.partitionBy("dt")

    def control(name: str) -> Column:
        return F.max(F.when(_is_control(exp), F.col(name))).over(same_date)

    report = wide_rates.select(
        *KEYS, control("exp_users").alias("control_users"), control("exp_retained").alias("control_retained"),
        control("d1_rate").alias("control_rate"), "exp_users", "exp_retained",
        F.col("d1_rate").alias("exp_rate"), *[f"d{n}_rate" for n in HORIZONS],
        F.lit(None).cast("double").alias("coverage_ratio"), "exp_ci_lower", "exp_ci_upper",
    ).filter(~_is_control(exp))
    if evaluate:
        report = beta_comparison(report, "control_retained", "control_users", "exp_retained", "exp_users")
    return report.drop("control_retained", "exp_retained")


def overall_report(wide: DataFrame, exp: Experiment, filter_by_cutoff: bool = True) -> DataFrame:
    """R8 and R9. Rates of the whole phase per horizon and treatment variation.

    Dates that have not matured for a horizon are left out of it (if ``filter_by_cutoff``).
    ``freq_uplift`` pools all treatment variations.
    """
    series = Window.partitionBy("day")
    long = windows.trimmed(retention_rates(wide).withColumn("latest", F.max("dt").over(series)))
    if filter_by_cutoff:
        long = windows.matured(long, F.col("latest"))
    sums = long.groupBy("day", "variation").agg(
        F.sum("users").alias("exp_users"), F.sum("retained").alias("exp_retained"))

    def side(is_control: bool, name: str) -> Column:
        mine = _is_control(exp) if is_control else ~_is_control(exp)
        return F.sum(F.when(mine, F.col(name))).over(series)

    report = sums.select(
        "day", "variation", side(True, "exp_users").alias("control_users"),
        side(True, "exp_retained").alias("control_retained"), "exp_users", "exp_retained",
        side(False, "exp_users").alias("pooled_users"), side(False, "exp_retained").alias("pooled_retained"),
    ).filter(~_is_control(exp) & F.col("control_users").isNotNull())
    report = beta_comparison(report, "control_retained", "control_users", "exp_retained", "exp_users")
    control_rate = ratio("control_retained", "control_users")
    pooled = ratio(ratio("pooled_retained", "pooled_users") - control_rate, control_rate)
    return report.select(
        "day", "variation", "control_users", "control_retained",
        F.round(control_rate, 6).alias("control_freq_rate"),
        F.round(posterior_mean("control_retained", "control_users"), 6).alias("control_bayes_rate"),
        "exp_users", "exp_retained", ratio("exp_retained", "exp_users", 6).alias("exp_freq_rate"),
        F.round(posterior_mean("exp_retained", "exp_users"), 6).alias("exp_bayes_rate"),
        *[F.when(F.col("day") == n, F.round("uplift", 6)).alias(f"overall_d{n}_uplift") for n in HORIZONS],
        F.round("chance_to_win", 6).alias("overall_chance_to_win"),
        F.round(F.coalesce(pooled, F.lit(0.0)), 6).alias("freq_uplift"))


def image_use_rate(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """R10. Of the users who chatted on a day, the share that generated an image."""
    days = windows.without_last(exp)
    use = stacked(**{name: t[name].filter(days.contain("event_date")).select("user_id", "event_date")
                     for name in ("chat", "image")})
    flags = use.groupBy("user_id", "event_date").agg(
        F.max(of("chat")).alias("chatted"), F.max(of("image")).alias("generated"))
    report = (
        assignment.resolve(t, exp, "any_daily", days).join(flags, ["user_id", "event_date"])
        .groupBy(*exp.keys, F.col("event_date").alias("event_day"), "variation_id")
        .agg(total("chatted").alias("test_chat_users"), total(assignment.labelled(F.col("generated"))).alias("generate_user"))
        .filter("test_chat_users > 0")
    )
    return report.withColumn("generate_image_use_rate", ratio("generate_user", "test_chat_users", 3))
