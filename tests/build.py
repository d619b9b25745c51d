"""Small input tables from rows written in a test."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import SparkSession

from trialmetrics import Experiment, Tables
from trialmetrics.sources.schemas import SCHEMAS

JULY = Experiment("exp", "tag", datetime(2024, 7, 1, 6), datetime(2024, 7, 10, 18))


def day(n: int) -> date:
    return date(2024, 7, n)


def at(n: int, hour: int = 12, minute: int = 0) -> datetime:
    return datetime(2024, 7, n, hour, minute)


def given(user, variation, n: int, hour: int = 12, experiment: str = "exp") -> dict:
    """An assignment row."""
    return {"user_id": user, "experiment_id": experiment, "variation_id": variation,
            "timestamp_assigned": at(n, hour), "event_date": day(n)}


def tables(spark: SparkSession, **rows: list[dict]) -> Tables:
    """Tables with the given rows; those not named are empty, columns not named are NULL."""
    def opener(name: str):
        schema = SCHEMAS[name]
        return spark.createDataFrame([tuple(row.get(field.name) for field in schema) for row in rows.get(name, [])], schema)

    return Tables(spark, opener)


def got(df, *keys: str) -> dict:
    """Rows by their keys."""
    return {tuple(row[k] for k in keys): row for row in df.collect()}
