"""Registration of queries and their check SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import tools
from .fixtures import TABLES, VIEWS, needed_views, with_views

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ["scalars", "records", "places", "links_marks", "jobs_web"]


# tables with per-row text work, and a column to spread them by when they come as one small file
SPREAD_BY = {"lineitem": ["l_orderkey", "l_partkey"], "orders": ["o_orderkey"], "documents": ["doc_id"], "pages": ["page_id"]}


class Views:
    """DataFrames over one data folder: ``v.table("orders")`` or ``v.raw_records`` for a view."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return tools.spread(df, SPREAD_BY[name]) if name in SPREAD_BY else df

    def sql(self, text: str) -> DataFrame:
        body = with_views(text)
        for name in TABLES:
            if name in body:
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(body)

    def __getattr__(self, name: str) -> DataFrame:
        view = f"fx_{name}"
        if view not in VIEWS:
            raise AttributeError(name)
        return self.sql(f"select * from {view}")


def query(key: str, oracle: str | None = None):
    """Register ``fn(views) -> DataFrame`` under ``key``; ``oracle`` may mention the views by name."""
    def wrap(fn):
        if key in _QUERIES:
            raise ValueError(f"duplicate query {key}")
        _QUERIES[key] = lambda spark, folder: fn(Views(spark, folder))
        if oracle is not None:
            _ORACLES[key] = with_views(oracle)
        return fn
    return wrap


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__package__}.{m}")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


__all__ = ["Views", "query", "all_queries", "all_oracles", "needed_views"]
