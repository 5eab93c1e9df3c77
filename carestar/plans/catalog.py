"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every entry reads the driver tables of ``sf_dir`` (through the binding) so
its work grows with them.  Modules add their entries with ``@register``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .warehouse import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def wh_query(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(Warehouse(spark, sf_dir))


def bi_query(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    """A BI question: runs on the published warehouse build (built on first use)."""
    from .build import warehouse_for
    QUERIES[name] = lambda spark, sf_dir: build(warehouse_for(spark, sf_dir))


def all_queries() -> dict[str, QueryFn]:
    # importing the modules fills the registry
    from . import queries_core, queries_io, queries_measures, queries_quality, queries_report  # noqa: F401
    return dict(QUERIES)
