"""Counters of each stage, as (metric, value) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.operators.answers import with_status
from scholion.operators.merge import as_metrics
from scholion.operators.predict import done_task_ids, pending_tasks


def doc_split_stats(docs: DataFrame, sections: DataFrame) -> DataFrame:
    one = docs.agg(F.count(F.lit(1)).alias("doc_count"), F.count_if("md5_fallback").alias("fallback_md5_count"))
    return as_metrics(one).unionByName(as_metrics(sections.agg(F.count(F.lit(1)).alias("block_count"))))


def main_signal_before_stats(tasks: DataFrame) -> DataFrame:
    no_experiment = ~F.exists("source_refs", lambda r: F.array_contains(r["roles"], "experimental"))
    return as_metrics(tasks.agg(
        F.count_distinct("doc_id").alias("doc_count"), F.count(F.lit(1)).alias("task_count"),
        F.count_if(no_experiment).alias("empty_experiment_count")))


def route_counters(route: str) -> dict[str, Column]:
    """Tasks without methods, without results (or support), without both, and on fallback."""
    names = (("method_excerpt_count", "support_excerpt_count", "used_method_fallback") if route == "proc"
             else ("method_window_count", "result_window_count", "used_result_fallback"))
    method, result, fallback = (F.col(f"route_stats.{n}") for n in names)
    second = "empty_support_count" if route == "proc" else "empty_result_count"
    return {"empty_method_count": F.count_if(method == 0), second: F.count_if(result == 0),
            "empty_context_count": F.count_if((method == 0) & (result == 0)), "fallback_count": F.count_if(fallback)}


def route_before_stats(tasks: DataFrame, route: str) -> DataFrame:
    """The number of tasks and the counters of a route."""
    return as_metrics(tasks.agg(F.count(F.lit(1)).alias("task_count"), *[c.alias(n) for n, c in route_counters(route).items()]))


def predict_stats(tasks: DataFrame, earlier: DataFrame, produced: DataFrame) -> DataFrame:
    """Counters of a prediction run: earlier answers, open tasks and outcomes."""
    status = with_status(produced).agg(
        F.count_if(F.col("status") == "ok").alias("success_count"),
        F.count_if(F.col("status") == "parse_error").alias("parse_error_count"),
        F.count_if(F.col("status") == "invoke_error").alias("invoke_error_count"))
    tables = [
        tasks.agg(F.count(F.lit(1)).alias("total_task_count")),
        done_task_ids(earlier).agg(F.count(F.lit(1)).alias("existing_done_count")),
        pending_tasks(tasks, earlier).agg(F.count(F.lit(1)).alias("todo_count")), status,
    ]
    return reduce(DataFrame.unionByName, [as_metrics(t) for t in tables])
