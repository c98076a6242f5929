"""Registry of keyed queries: a Spark job plus its independent SQL oracle.

Each entry is a function ``(spark, sf_dir) -> DataFrame`` built over the bound
views.  ``oracle`` holds DuckDB SQL computing the same answer from the raw
tables; it is appended to the bound-view CTEs of ``bindings.ORACLE_VIEWS``, so
it starts either with ``SELECT`` or with further ``, name AS (...)`` CTEs.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.bindings import ORACLE_VIEWS

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    key: str
    survey_id: str
    fn: QueryFn
    oracle: str | None


REGISTRY: dict[str, QuerySpec] = {}


def register(key: str, survey_id: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = QuerySpec(key, survey_id, fn, oracle)
        return fn
    return wrap


def oracle_text(spec: QuerySpec) -> str | None:
    if spec.oracle is None:
        return None
    return ORACLE_VIEWS + spec.oracle


def load_all() -> dict[str, QuerySpec]:
    """Import every plan module so their registrations run."""
    from lakemart.plans import (  # noqa: F401
        aggregates, joins, keyed_loads, lake, landing, layers, marts, nested, order_analysis, scalars,
        sources, streaming, windows,
    )
    return REGISTRY
