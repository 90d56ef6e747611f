"""All registered queries over the driver's tables, with their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import additions, boxes, counts, documents, files, metrics, more, orders, places, scores, series, stateful, streams

_PARTS = (counts, series, places, orders, boxes, metrics, documents, more, additions, files, stateful, scores, streams)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for part in _PARTS for name, (query, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
