"""Model calls that survive a crash: tasks are asked slice by slice, and each slice is committed.

Below its folder a call log keeps ``open`` (the tasks of an attempt, dealt to numbered slices),
``answers`` (one folder per attempt and slice) and ``commits`` (one row per finished slice). Only
committed slices are read, so whatever a lost job left behind counts for nothing, and a later
attempt asks only what no committed answer settles. A crash costs the calls of one slice at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholion.operators import predict

#: Calls between two commits.
PER_COMMIT = 10_000
COMMIT = "attempt int, slice int, n_answers long"


def slice_of(task_id: Column, n: int) -> Column:
    """The slice of a task, from the hash of its id alone."""
    return F.pmod(F.conv(F.substr(F.md5(task_id.cast("binary")), F.lit(1), F.lit(8)), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def table_at(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote a folder came to its end."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


class CallLog:
    """Answers of one model below a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> DataFrame | None:
        return table_at(self.spark, f"{self.path}/commits")

    def answers(self) -> DataFrame | None:
        """All committed answers with ``attempt`` and ``slice``; None before the first commit."""
        finished = self.commits()
        if finished is None:
            return None
        rows = self.spark.read.parquet(f"{self.path}/answers")
        return rows.join(finished.select("attempt", "slice").distinct(), ["attempt", "slice"], "left_semi")

    def next_attempt(self) -> int:
        """A number that no attempt has, also none that was lost."""
        earlier = [t.agg(F.max("attempt")).first()[0] for t in (table_at(self.spark, f"{self.path}/{x}") for x in ("open", "commits")) if t is not None]
        return max((a for a in earlier if a is not None), default=-1) + 1

    def deal(self, tasks: DataFrame, attempt: int, per_commit: int) -> int:
        """Write the open tasks of an attempt in slices of about ``per_commit``; their number."""
        listed = f"{self.path}/listed/attempt={attempt}"
        tasks.write.mode("overwrite").parquet(listed)
        kept = self.spark.read.schema(tasks.schema).parquet(listed)
        slices = -(-kept.count() // per_commit)
        if slices:
            kept.withColumn("slice", slice_of(F.col("task_id"), slices)).repartition("slice").write.mode("overwrite").partitionBy(
                "slice").parquet(f"{self.path}/open/attempt={attempt}")
        return slices

    def ask(self, tasks: DataFrame, model: Callable[..., str], settled: Callable[[DataFrame], DataFrame], per_commit: int = PER_COMMIT,
            limit: int = 0, max_slices: int | None = None, **options) -> DataFrame | None:
        """Ask for the tasks without a settled answer; all committed answers, old and new.

        ``settled`` picks from committed answers the rows whose tasks need no further call.
        ``limit`` bounds the calls, ``max_slices`` the slices of this attempt; ``options`` go to
        ``predict``.
        """
        earlier = self.answers()
        todo = tasks if earlier is None else tasks.join(settled(earlier).select("task_id").distinct(), "task_id", "left_anti")
        attempt = self.next_attempt()
        slices = self.deal(predict.limit_pending(todo, limit), attempt, per_commit)
        for k in range(slices if max_slices is None else min(slices, max_slices)):
            part = self.spark.read.schema(todo.schema).parquet(f"{self.path}/open/attempt={attempt}/slice={k}") if self._has(attempt, k) else None
            if part is not None:
                self._commit(predict.predict(part, model, **options), attempt, k)
        return self.answers()

    def _has(self, attempt: int, k: int) -> bool:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/open/attempt={attempt}/slice={k}")
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)

    def _commit(self, answers: DataFrame, attempt: int, k: int) -> None:
        path = f"{self.path}/answers/attempt={attempt}/slice={k}"
        answers.write.mode("overwrite").parquet(path)
        n = self.spark.read.schema(answers.schema).parquet(path).count()
        self.spark.createDataFrame([(attempt, k, n)], COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
