"""Whole runs: each stage writes its table under the run and later stages read it.

A run can be started again: sections and first tasks that are there are read, and the model is
asked only for tasks without a valid answer. Answers are committed slice by slice, each start under
its own number (see ``operators.calls``); stage tables count only when their write came to its end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scholion.operators import answers, calls, context, entities, final, merge, normalize, predict, sectioning, stats, tasks, validate
from scholion.operators.anchors import explode_samples, require_sections
from scholion.sources import corpus
from scholion.sources.jsonl import stage_path

Model = Callable[..., str]
BUILD = {"char": tasks.build_char_tasks, "prop": tasks.build_prop_tasks, "proc": tasks.build_proc_tasks}


def identity(raw: DataFrame) -> tuple[int, int]:
    """Number of rows and a checksum of names and contents, in one pass."""
    rows, check = raw.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64(*[c for c in ("file_name", "md5", "content") if c in raw.columns])), F.lit(0))).first()
    return rows, check


def run(spark: SparkSession, raw: DataFrame, base: str, run_id: str, main_model: Model, route_models: dict[str, Model],
        order_by: str = "file_name", batch_size: int = 20, templates: dict[str, str] | None = None, limit: int = 0,
        per_commit: int = calls.PER_COMMIT) -> DataFrame:
    """From (file_name, md5, content) rows to one record per file.

    Files of equal content are worked on once, and each gets the record.

    ``templates`` has prompt templates by ``main_signal`` or route; a model with one is called
    with messages, the others with the task text. ``limit`` bounds the calls of each model,
    ``per_commit`` the calls that a crash can cost. The counters of all stages, taken while they
    are written, go to the ``manifest`` stage. A run id belongs to one input: another one is refused.
    """
    counts: dict[str, dict[str, int]] = {}

    def done(df: DataFrame, name: str, again: bool = True, **counters: Column) -> DataFrame:
        """Write a stage table and read it back; without ``again`` one that is whole stays."""
        path = stage_path(base, run_id, name)
        metrics = [F.count(F.lit(1)).alias("row_count"), *[c.alias(n) for n, c in counters.items()]]
        if again or not calls.is_complete(spark, path):
            seen = Observation(name)
            df.observe(seen, *metrics).write.mode("overwrite").parquet(path)
            counts[name] = seen.get
            return spark.read.parquet(path)
        kept = spark.read.parquet(path)
        counts[name] = kept.agg(*metrics).first().asDict()
        return kept

    def asked(todo: DataFrame, model: Model, name: str, entity: entities.Entity) -> DataFrame:
        log = calls.CallLog(spark, stage_path(base, run_id, f"{name}_calls"))
        given = predict.render_prompts(todo, templates[name]).select("task_id", "messages") if templates and name in templates else todo.select("task_id", "text")
        settled = lambda earlier: predict.done_task_ids(answers.parse_responses(earlier, entity))
        replies = log.ask(given, model, settled, per_commit, limit, batch_size=batch_size)
        if replies is None:
            replies = predict.predict(given.limit(0), model).withColumns({"attempt": F.lit(0), "slice": F.lit(0)})
        parsed = answers.parse_responses(replies, entity).withColumn("file_order", F.col("attempt")).withColumn("seq", F.lit(0))
        status = answers.status_of(F.col("parse"), F.col("error"))
        return done(parsed, f"{name}_parsed", **{f"{x}_count": F.count_if(status == y) for x, y in (
            ("success", "ok"), ("parse_error", "parse_error"), ("invoke_error", "invoke_error"))})

    mark = stage_path(base, run_id, "input")
    given = identity(raw)
    if calls.is_complete(spark, mark):
        if tuple(spark.read.parquet(mark).first()) != given:
            raise ValueError(f"run {run_id} was started with another input")
    else:
        spark.createDataFrame([given], "row_count long, checksum long").write.mode("overwrite").parquet(mark)
    sections = done(sectioning.split_sections(sectioning.normalize_raw(raw, order_by), run_id), "doc_split", again=False,
                    doc_count=F.count_if(F.col("section_index") == 1))
    every_file = sections
    sections, listed = corpus.one_per_content(every_file)
    files = done(listed, "files", again=False)
    main_tasks = done(context.build_main_signal_tasks(sections), "main_signal_before", again=False,
                      empty_experiment_count=F.count_if(~F.exists("source_refs", lambda r: F.array_contains(r["roles"], "experimental"))))
    first = normalize.first_good_prediction(asked(main_tasks, main_model, "main_signal", entities.MAIN_SIGNAL))
    keys = main_tasks.select("run_id", "doc_id", "task_id", "file_name")
    cleaned = first.withColumn("parse", validate.clean_main_signal(F.col("parse")))
    documents = done(normalize.normalize_documents(cleaned.join(keys, "task_id")), "main_signal_after")

    payloads = {}
    for route, model in route_models.items():
        samples = require_sections(explode_samples(documents, route), sections)
        route_tasks = done(BUILD[route](sections, samples), f"{route}_before", **stats.route_counters(route))
        preds = asked(route_tasks, model, route, entities.ROUTE_RESULT[route])
        if route == "proc":
            preds = answers.recover_raw_text(preds, entities.PROC_RESULT)
        after = done(merge.after_stage(route_tasks, preds, route), f"{route}_after")
        payloads[route] = final.payloads_by_sample(after.withColumn("ord", F.col("task_id")), route)
    result = done(final.final_documents(documents, payloads), "final_merge", sample_count=F.coalesce(F.sum(F.size("samples")), F.lit(0)))
    manifest = spark.createDataFrame([(stage, of["row_count"], {k: v for k, v in of.items() if k != "row_count"}) for stage, of in counts.items()],
                                     "stage string, row_count long, counters map<string,long>")
    manifest.write.mode("overwrite").parquet(stage_path(base, run_id, "manifest"))
    return corpus.for_every_file(result, files)
