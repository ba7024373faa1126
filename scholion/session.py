"""Session settings shared by the entry point, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str, master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the jobs rely on; sizes stay with the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # the expressions are large; recording a call site for each part slows planning
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``; it must be set."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(shared)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that losing an executor does not lose the result."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


INPUT_PARTITIONS = "scholion.input.partitions"


def dealt(df: DataFrame) -> DataFrame:
    """The rows over as many partitions as the session names in ``scholion.input.partitions``.

    Without the setting the splits of the files stay, unless they are too few to keep the cores
    busy: small compact files hold many rows, and a row costs far more than its bytes.
    """
    wanted = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    if wanted:
        return df.repartition(int(wanted))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(3 * cores) if df.rdd.getNumPartitions() < 2 * cores else df
