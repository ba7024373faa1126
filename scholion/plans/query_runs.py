"""Checked queries on the mechanisms of whole runs: committed calls, numbered lines, ordered folds."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.operators import anchors, answers, calls, entities, folds, merge, predict, sectioning
from scholion.plans import derived, literature, query_answers
from scholion.session import ensure_checkpoint_dir
from scholion.sources import corpus
from scholion.sources.jsonl import read_jsonl

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def fresh_folder(spark) -> str:
    """A folder of its own in the shared one."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


@query("committed_calls", f"""WITH {query_answers.TASKS_CTE},
n AS (SELECT count(*) AS tasks, greatest(250, count(*) // 8) AS per FROM tagged),
dealt AS (SELECT concat('run__', doc_id, '__main_signal') AS task_id, contains(text, '[RESULTS]') AS failed, len(text) AS size, ceil(tasks / per)::BIGINT AS slices FROM tagged, n),
placed AS (SELECT *, ('0x' || substr(md5(task_id), 1, 8))::BIGINT % slices < slices // 2 AS early FROM dealt),
asked AS (SELECT *, 0 AS attempt FROM placed WHERE early UNION ALL SELECT *, 1 FROM placed WHERE NOT early OR failed)
SELECT task_id, attempt, CASE WHEN failed THEN 'TimeoutError: no answer' END AS error, CASE WHEN NOT failed THEN cast(size AS varchar) END AS why FROM asked""")
def _(spark, sf):
    # the first attempt ends after half of its slices; the second asks what no committed answer settles
    tasks = query_answers.main_tasks(spark, sf).select("task_id", "text")
    total = tasks.count()
    per = max(250, total // 8)
    log = calls.CallLog(spark, fresh_folder(spark))
    settled = lambda found: predict.done_task_ids(answers.parse_responses(found, entities.MAIN_SIGNAL))
    for last in (-(-total // per) // 2, None):
        found = log.ask(tasks, query_answers.echo_model, settled, per, max_slices=last)
    return answers.parse_responses(found, entities.MAIN_SIGNAL).select("task_id", "attempt", "error", F.col("parse.why").alias("why"))


@query("numbered_lines", """WITH l AS (SELECT conv_id // 500 AS part, row_number() OVER (PARTITION BY conv_id // 500 ORDER BY conv_id, turn) AS line, conv_id, turn, len(text) AS n_chars FROM conversations)
SELECT part, line, conv_id, turn, n_chars FROM l WHERE (conv_id + turn) % 5 <> 3""")
def _(spark, sf):
    # one file per 500 conversations, in which every fifth line is cut off
    row = F.to_json(F.struct("conv_id", "turn", "text"))
    lines = derived.table(spark, sf, "conversations").select(
        F.floor(F.col("conv_id") / 500).alias("part"), "conv_id", "turn",
        F.when((F.col("conv_id") + F.col("turn")) % 5 == 3, F.left(row, F.lit(9))).otherwise(row).alias("value"))
    folder = fresh_folder(spark)
    lines.repartition("part").sortWithinPartitions("part", "conv_id", "turn").select("part", "value").write.partitionBy("part").text(folder)
    schema = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "text").schema
    read = read_jsonl(spark, folder, schema, "skip", positions=True)
    return read.select(F.regexp_extract("file", r"part=(\d+)", 1).cast("long").alias("part"), "line", "conv_id", "turn", F.length("text").alias("n_chars"))


def trail(left: dict, right: dict) -> dict:
    """A merge that depends on the order: marks in a row, the first and the last note."""
    return {"marks": left["marks"] + right["marks"], "first_note": left["first_note"] or right["first_note"],
            "last_note": right["last_note"] or left["last_note"]}


@query("folded_predictions", f"""WITH {query_answers.CHAR_ROWS.strip()}, f AS (SELECT CASE WHEN seq % 3 = 0 THEN 'hot' ELSE task_id END AS task_id, file_order, seq, substr(a, 1, 1) AS mark, sem FROM crows)
SELECT task_id, count(*) AS n, string_agg(mark, '' ORDER BY file_order, seq) AS marks, arg_min(sem, (file_order, seq)) FILTER (sem IS NOT NULL) AS first_note,
  arg_max(sem, (file_order, seq)) FILTER (sem IS NOT NULL) AS last_note FROM f GROUP BY task_id""")
def _(spark, sf):
    # a third of all records belong to one task
    sem = F.col("parse.characterization.morphology.sem")
    rows = merge.valid_predictions(query_answers.stored(spark, sf, "char")).select(
        F.when(F.col("seq") % 3 == 0, "hot").otherwise(F.col("task_id")).alias("task_id"), F.struct("file_order", "seq").alias("ord"),
        F.struct(F.left(F.col("parse.characterization.ftir.peaks_cm_1")[0], F.lit(1)).alias("marks"), sem.alias("first_note"), sem.alias("last_note")).alias("payload"))
    return folds.ordered_fold(rows, ["task_id"], "ord", "payload", trail).select("task_id", "n", "payload.*")


@query("copied_files", """WITH f AS (SELECT concat('f', doc_id, '.md') AS file_name, md5(concat('# Abstract', chr(10), text)) AS doc_id FROM documents),
c AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_files FROM f)
SELECT file_name, n_files, route, concat('run__', doc_id, '__001__', route) AS task_id, 1 AS n_front FROM c, (VALUES ('characterization'), ('property'), ('process')) v(route)""")
def _(spark, sf):
    # documents has exact copies, so files of equal content and equal doc_id
    texts = derived.table(spark, sf, "documents").select(
        F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"), F.concat(F.lit("# Abstract\n"), F.col("text")).alias("content"))
    sections = sectioning.split_sections(sectioning.normalize_raw(corpus.raw_rows(texts)), derived.RUN_ID)
    kept, files = corpus.one_per_content(sections)
    counted = files.join(files.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_files")), "doc_id")
    # one sample for each front section that a route gets to see
    samples = kept.where("section_index = 1").groupBy("run_id", "doc_id").agg(F.count(F.lit(1)).alias("n_front")).select(
        "run_id", "doc_id", "n_front", F.lit(1).alias("sample_index"), F.concat(F.lit("s_"), "doc_id").alias("sample_id"),
        F.lit("PI film").alias("name"), F.lit("PI").alias("category_code"), F.lit("Polyimide").alias("category_name"), F.lit("Film").alias("sample_form"))
    built = [make(kept, anchors.anchor_rows(samples, route)).select("run_id", "doc_id", F.lit(anchors.ROUTE_STAGE[route]).alias("route"), "task_id")
             for route, make in literature.BUILD.items()]
    everything = reduce(DataFrame.unionByName, built).join(samples.select("run_id", "doc_id", "n_front"), ["run_id", "doc_id"])
    return corpus.for_every_file(everything, counted).select("file_name", "n_files", "route", "task_id", "n_front")
