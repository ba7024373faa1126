"""Work that must not be done twice or without need, with the results it had before."""

from pyspark.sql import functions as F

from scholion.functions.arrays import as_made
from scholion.operators import anchors, lines, segments, windows
from scholion.sources.routing_config import route_config


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_exploded_windows_are_made_once(spark):
    keys = "'r' AS run_id, cast(id AS string) AS doc_id, 1 AS sample_index, 't' AS task_id"
    made = spark.range(3).selectExpr(*keys.split(", "), "transform(sequence(1, cast(id AS int) + 1), i -> struct(md5(concat('w', i)) AS text, array('method') AS uses)) AS windows")
    rows = windows.build_windows(made)
    assert _optimized(rows).count("md5(") == 1 and rows.count() == 6
    judged = made.withColumnRenamed("windows", "candidates")
    assert _optimized(segments.segment_rows(judged)).count("md5(") == 1


def test_null_and_empty_arrays_give_no_row(spark):
    rows = spark.createDataFrame([([1, None],), ([],), (None,)], "xs array<int>")
    assert [r[0] for r in rows.select(F.explode(as_made("xs"))).collect()] == [1, None]


def test_labels_are_those_of_every_pattern(spark):
    config = route_config("char")
    texts = ["FT-IR and SEM", "sem of BET", "better", "ſem", "NMR 13C-NMR 2θ XRD", "LC MS", "", None, "Fourier  transform\tinfrared"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    every = F.array_compact(F.array(*[F.when(F.col("t").rlike("(?iU)" + "|".join(f"(?:{p})" for p in ps)), F.lit(label))
                                      for label, ps in config.keywords.items()]))
    for r in rows.select("t", lines.labels_of(F.col("t"), config).alias("a"), F.coalesce(every, F.array().cast("array<string>")).alias("b")).collect():
        assert r["a"] == r["b"], r["t"]


def test_codes_are_searched_before_their_pattern_is_built(spark):
    """A pattern that no regex compiler takes is never built where the code does not stand in the text."""
    rows = spark.createDataFrame([("plain words", "PI", True, "(")], "text string, label string, is_code boolean, pattern string")
    terms = F.array(F.struct("label", "is_code", "pattern", F.lower("label").alias("needle")))
    got = rows.select(anchors.any_term(F.col("text"), terms).alias("a"), F.size(anchors.term_hits(F.col("text"), terms)).alias("b"),
                      anchors.strong_hit(F.col("text"), terms, "prop", F.lit(False)).alias("c")).first()
    assert tuple(got) == (False, 0, False)


def test_strong_hits_keep_letters_that_only_a_pattern_equates(spark):
    texts = ["the \u212aelvin film", "Kelvin film", "kelvin film-doped", "elvin film", "KELVIN FILM and more"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    terms = anchors.term_structs(F.array(F.lit("Kelvin film")), "prop")
    got = [r[0] for r in rows.select(anchors.strong_hit(F.col("text"), terms, "prop", F.lit(False))).collect()]
    assert got == [True, True, False, False, True]
