"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where SQL can
express it, the DuckDB oracle text over the same tables."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    from appraise.plans import (cleaning, evaluation, linking, loading, modelling, profiling,  # noqa: F401
                                recoding, repair, resampling)
