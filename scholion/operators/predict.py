"""The model step: which tasks are open, prompts, batched calls, resumable runs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from string import Formatter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.functions.text import has_text
from scholion.operators.answers import is_valid


def done_task_ids(predictions: DataFrame) -> DataFrame:
    return predictions.where(
        has_text(F.coalesce("task_id", F.lit(""))) & is_valid(F.col("parse"), F.col("error"))
    ).select("task_id").distinct()


def pending_tasks(tasks: DataFrame, predictions: DataFrame) -> DataFrame:
    """Tasks without a valid earlier answer."""
    return tasks.join(done_task_ids(predictions), "task_id", "left_anti")


def limit_pending(pending: DataFrame, n: int, order_by: str = "task_id") -> DataFrame:
    """The first n open tasks in task order; 0 keeps all."""
    return pending.orderBy(order_by).limit(n) if n > 0 else pending


def prompt_blocks(template: str) -> list[tuple[str, str]]:
    """(role, content) blocks of a template; a template without blocks is one user message."""
    found = re.findall(r"<(system|user|assistant)>\s*(.*?)\s*</\1>", template, re.I | re.S)
    return [(role.lower(), content.strip()) for role, content in found] or [("user", template)]


def template_variables(template: str) -> list[str]:
    names = [f for _, c in prompt_blocks(template) for _, f, _, _ in Formatter().parse(c) if f]
    return list(dict.fromkeys(names))


def render_prompts(tasks: DataFrame, template: str, fixed: dict[str, str] | None = None) -> DataFrame:
    """Add ``messages``: the blocks with variables filled in from columns or ``fixed``."""
    fixed = fixed or {}

    def filled(content: str) -> Column:
        parts: list[Column] = []
        for literal, name, _, _ in Formatter().parse(content):
            if literal:
                parts.append(F.lit(literal))
            if name:
                parts.append(F.lit(fixed[name]) if name in fixed else F.coalesce(F.col(name).cast("string"), F.lit("")))
        return F.concat(*parts) if parts else F.lit("")

    messages = [F.struct(F.lit(role).alias("role"), filled(content).alias("content"))
                for role, content in prompt_blocks(template)]
    return tasks.withColumn("messages", F.array(*messages))


def check_task_inputs(tasks: DataFrame, required: list[str], inputs: str = "inputs") -> DataFrame:
    """Rows whose input map has unused entries; a missing entry raises."""
    keys = F.map_keys(inputs)
    wanted = F.array(*[F.lit(r) for r in required])
    missing = F.array_sort(F.array_except(wanted, keys))
    checked = F.when(F.size(missing) > 0, F.raise_error(F.concat(
        F.lit("missing template variables: "), F.array_join(missing, ", "))).cast("array<string>")).otherwise(
        F.array_sort(F.array_except(keys, wanted)))
    return tasks.withColumn("extra_inputs", checked).where(F.size("extra_inputs") > 0)


def missing_inputs(tasks: DataFrame, required: list[str], inputs: str = "inputs") -> DataFrame:
    """Rows that lack required entries, without raising."""
    missing = F.array_sort(F.array_except(F.array(*[F.lit(r) for r in required]), F.map_keys(inputs)))
    return tasks.withColumn("missing_inputs", missing).where(F.size("missing_inputs") > 0)


def predict(tasks: DataFrame, fn: Callable[..., str], batch_size: int = 20, prompt_name: str = "",
            model_name: str = "", partitions: int | None = None) -> DataFrame:
    """Call ``fn`` on each task; a failed call yields an error row, never a failed job.

    Tasks with ``messages`` (see ``render_prompts``) pass them as a list of role and content;
    others pass their text.

    Calls of one batch run side by side, tasks spread over ``partitions``. Write the result
    to a table before using it twice, so that no call is repeated.
    """
    given = "messages" if "messages" in tasks.columns else "text"
    keep = [c for c in tasks.columns if c not in ("text", "messages", "route_stats")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tasks.select(*keep).schema)
    schema += ", prompt_name string, model_name string, raw_text string, error string"

    def call(task) -> tuple[str, str | None]:
        try:
            return fn(task if given == "text" else [dict(m) for m in task]), None
        except Exception as exc:  # the error is the row's result
            return "", f"{type(exc).__name__}: {exc}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max_workers=batch_size) as pool:
            for frame in batches:
                for at in range(0, len(frame), batch_size):
                    part = frame.iloc[at:at + batch_size]
                    answers = list(pool.map(call, part[given]))
                    yield part[keep].assign(
                        prompt_name=prompt_name, model_name=model_name,
                        raw_text=[a for a, _ in answers], error=[e for _, e in answers])

    spread = tasks.repartition(partitions, "task_id") if partitions else tasks
    return spread.select(*keep, given).mapInPandas(run, schema)


def result_column(df: DataFrame) -> str:
    """The column that holds results: the first whose name contains 'result'."""
    for name in df.columns:
        if "result" in name:
            return name
    raise ValueError("no column with 'result' in its name")


def pending_samples_v1(main: DataFrame, texts: DataFrame, checkpoint: DataFrame | None, paper_info: str) -> DataFrame:
    """Material samples still to do: (file_name, material_id) without an error-free result.

    ``main`` has (file_name, material_ids), ``texts`` the text bundles per file.
    """
    rows = main.select("file_name", F.explode("material_ids").alias("m")).select(
        "file_name", F.col("m.id").alias("material_id"), F.col("m.aliases").alias("aliases"))
    if checkpoint is not None:
        done = checkpoint.where(F.col(f"{result_column(checkpoint)}.error").isNull()).select("file_name", "material_id")
        rows = rows.join(done.distinct(), ["file_name", "material_id"], "left_anti")
    info = F.struct(F.col("material_id").alias("id"), "aliases").alias("material_info")
    return rows.join(texts.select("file_name", F.col(paper_info).alias("paper_info")), "file_name").select(
        "file_name", "material_id", "paper_info", info)
