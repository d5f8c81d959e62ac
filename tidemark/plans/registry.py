"""Registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import NUDGE, rounded
from . import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, body: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``body`` is its SQL over the views."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if body is not None:
            ORACLES[name] = views.sql(body)
        return f

    return add


def shown(df: DataFrame, ids: list[str], cols: list[str], places: int = 4) -> DataFrame:
    """The ids as they are and the measures rounded."""
    return df.select(*ids, *(rounded(F.col(c).cast("double"), places).alias(c) for c in cols))


def r(places: int = 4, **exprs: str) -> str:
    """The SQL of the same: rounded expressions by name."""
    return ", ".join(f"round(({e}) + {NUDGE}, {places}) + 0.0 AS {n}" for n, e in exprs.items())
