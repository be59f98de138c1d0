"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterhouse.plans import registry


def _load() -> None:
    from meterhouse.plans import (  # noqa: F401
        queries_dims,
        queries_events,
        queries_history,
        queries_quota,
        queries_streams,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
