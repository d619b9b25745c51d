"""All reports by name, and a run of all of them for all tags."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame

from trialmetrics.experiment import Experiment, Experiments
from trialmetrics.plans import ads, business, catalog, chat, engagement, recharge, retention, subscription
from trialmetrics.publish import publish, publish_tags, published
from trialmetrics.publish.snapshots import Files
from trialmetrics.sources.tables import Tables

log = logging.getLogger(__name__)

Report = Callable[[Tables, Experiment | Experiments], DataFrame]


@dataclass(frozen=True)
class Derived:
    """A report made from another one that is already published."""

    base: str
    build: Callable[[DataFrame, Experiment], DataFrame]


MODULES: dict[str, dict[str, Report | Derived]] = {
    "retention": {
        "retention_new": retention.new_user_retention,
        "retention_active": retention.active_user_retention,
        "retention_country": retention.country_retention,
        "retention_new_report": Derived("retention_new", retention.daily_report),
        "retention_active_report": Derived("retention_active", partial(retention.daily_report, trim=False)),
        "retention_new_overall": Derived("retention_new", retention.overall_report),
        "retention_active_overall": Derived("retention_active", retention.overall_report),
        "image_use_rate": retention.image_use_rate,
    },
    "chat": {
        "click_rate": chat.click_rate,
        "start_rate": chat.start_rate,
        "chat_depth": chat.chat_depth,
        "bots_viewed_per_user": chat.bots_viewed_per_user,
        "bots_chatted_per_user": chat.bots_chatted_per_user,
        "time_spent": chat.time_spent,
        "explore_click_rate": chat.explore_click_rate,
        "explore_start_rate": chat.explore_start_rate,
        "explore_chat_depth": chat.explore_chat_depth,
        "recall_impressions": chat.recall_impressions,
    },
    "engagement": {
        "continues": engagement.continues,
        "conversation_resets": engagement.conversation_resets,
        "edits": engagement.edits,
        "follows": engagement.follows,
        "new_conversations": engagement.new_conversations,
        "regenerations": engagement.regenerations,
        "edits_of_phase": engagement.edits_of_phase,
    },
    "business": {
        "order_value": business.order_value,
        "new_user_order_value": business.new_user_order_value,
        "new_user_subscription_value": partial(business.new_user_order_value, subscriptions_only=True),
        "revenue_per_user": business.revenue_per_user,
        "revenue_per_paying_user": business.revenue_per_paying_user,
        "lifetime_value": business.lifetime_value,
        "payment_rate_by_country": business.payment_rate_by_country,
        "new_user_payment_rate": business.new_user_payment_rate,
        "payment_ratio": business.payment_ratio,
        "cancellation_rate": business.cancellation_rate,
    },
    "recharge": {
        "recharge": lambda t, exp: recharge.rolled_up(recharge.recharge(t, exp)),
        "recharge_evaluation": Derived("recharge", recharge.recharge_evaluation),
    },
    "subscription": {
        "subscription_orders": subscription.subscription_orders,
        "subscription_rate": subscription.subscription_rate,
        "first_subscription_rate": subscription.first_subscription_rate,
    },
    "ads": {
        "ads": ads.ads,
        "ads_evaluation": Derived("ads", ads.ads_evaluation),
    },
}

REPORTS = {name: job for module in MODULES.values() for name, job in module.items()}


@dataclass
class RunLog:
    seconds: dict[tuple[str, str], float] = field(default_factory=dict)
    failures: dict[tuple[str, str], Exception] = field(default_factory=dict)
    skipped: set[tuple[str, str]] = field(default_factory=set)


class RunFailed(RuntimeError):
    def __init__(self, run: RunLog):
        self.run = run
        super().__init__("; ".join(f"{tag}/{name}: {error}" for (tag, name), error in run.failures.items()))


def run_report(t: Tables, exp: Experiment, name: str, root: str) -> None:
    """Compute one report and replace its rows for the experiment's tag."""
    job = REPORTS[name]
    if isinstance(job, Derived):
        report = job.build(published(t.spark, root, job.base, exp.tag), exp)
    else:
        report = job(t, exp)
    publish(report, root, name, exp.tag)


class BaseFailed(RuntimeError):
    """A derived report was not made, because what is published of its base is of an earlier run."""


class Record:
    """What runs over one version of the input have made, a small file for each tag and report."""

    def __init__(self, t: Tables, root: str, version: str | None):
        self.files = Files(t.spark, f"{root}/_runs/{version}") if version else None

    def has(self, tag: str, name: str) -> bool:
        place = f"{tag}/{name}.json"
        return bool(self.files) and f"{name}.json" in self.files.names(tag) and json.loads(self.files.read(place))["outcome"] == "made"

    def put(self, tag: str, name: str, seconds: float, error: Exception | None) -> None:
        if self.files:
            outcome = {"outcome": "failed" if error else "made", "seconds": round(seconds, 3), "error": error and str(error)[:1000]}
            self.files.remove(f"{tag}/{name}.json")
            self.files.create(f"{tag}/{name}.json", json.dumps(outcome))


def run_all(t: Tables, experiments: Iterable[Experiment], root: str, names: Iterable[str] | None = None,
            at_once: int = 4, share: bool = True, together: bool = True, version: str | None = None) -> RunLog:
    """Every report for every experiment. One failure does not stop the others; all of
    them are raised together at the end.

    ``together`` makes a report of all experiments in one job, which reads each source once; if it fails, they are
    tried one at a time, so that only those fail which have to. A derived report is made from published
    rows, after its base, which is run even if it is not among ``names``; if the base fails, so does the derived
    report, and its last published rows stay. ``at_once`` reports are submitted together. With ``share`` an
    assignment that several reports need is resolved once and removed at the end.

    ``version`` names the state of the input. What an earlier run of the same version has made is skipped, but for
    derived reports whose base is made again.
    """
    run, names, experiments = RunLog(), list(names or REPORTS), list(experiments)
    derived = [name for name in names if isinstance(REPORTS[name], Derived)]
    first = list(dict.fromkeys([*(n for n in names if n not in derived), *(REPORTS[n].base for n in derived)]))
    tables, record = t.sharing() if share else t, Record(t, root, version)

    def needed(exp: Experiment, name: str) -> bool:
        again = name in derived and (exp.tag, REPORTS[name].base) in run.seconds
        if again or not record.has(exp.tag, name):
            return True
        run.skipped.add((exp.tag, name))
        return False

    def ended(exp: Experiment, name: str, started: float, error: Exception | None = None) -> None:
        run.seconds[exp.tag, name] = seconds = time.perf_counter() - started
        if error:
            run.failures[exp.tag, name] = error
        record.put(exp.tag, name, seconds, error)
        log.info("%s for %s: %.1f s", name, exp.tag, seconds)

    def made(job: tuple[Experiment, str]) -> None:
        exp, name = job
        started = time.perf_counter()
        try:
            if name in derived and (exp.tag, REPORTS[name].base) in run.failures:
                raise BaseFailed(f"{REPORTS[name].base} failed")
            run_report(tables, exp, name, root)
        except Exception as error:
            log.exception("%s failed for %s", name, exp.tag)
            ended(exp, name, started, error)
        else:
            ended(exp, name, started)

    def made_together(name: str) -> None:
        started, wanted = time.perf_counter(), [exp for exp in experiments if needed(exp, name)]
        if together and len(wanted) > 1:
            try:
                publish_tags(REPORTS[name](tables, Experiments(wanted)), root, name, [exp.tag for exp in wanted])
            except Exception:
                log.exception("%s failed for all tags; they are tried one at a time", name)
            else:
                for exp in wanted:
                    ended(exp, name, started)
                return
        for exp in wanted:
            made((exp, name))

    try:
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(made_together, first))
            list(pool.map(made, [(exp, name) for exp in experiments for name in derived if needed(exp, name)]))
    finally:
        if share:
            tables.release()
    if run.failures:
        raise RunFailed(run)
    return run


def run_documents(t: Tables, documents: DataFrame, as_of: datetime, root: str, overrides: DataFrame | None = None,
                  **options) -> RunLog:
    """From experiment documents to published reports: the experiment table is made and stored, and every
    report is run for the experiment of every tag in it."""
    table = catalog.store(catalog.experiment_table(documents, as_of, overrides), f"{root}/experiments")
    return run_all(t, catalog.experiments(table), root, **options)
