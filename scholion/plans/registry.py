"""All registered queries."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from scholion.plans import query_answers, query_routing, query_runs, query_sections

MODULES = (query_sections, query_routing, query_answers, query_runs)


def _with_shared_folder(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with a folder of its own for checkpoints if a local session names none."""
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        if not context.getCheckpointDir() and context.master.startswith("local") and "cluster" not in context.master:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="scholion-"))
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _with_shared_folder(fn) for m in MODULES for name, fn in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
