"""Name -> (Spark query, SQL oracle). Importing the catalogue modules fills the registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own or a given name; ``oracle`` is SQL over the same tables."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return add


def rounded(digits: int, *columns: str) -> list[Column]:
    """Columns rounded so that both engines agree although they sum in different orders."""
    return [F.round(c, digits).alias(c) for c in columns]


def load_all() -> None:
    from . import click_queries, panel_queries, posterior_queries  # noqa: F401
