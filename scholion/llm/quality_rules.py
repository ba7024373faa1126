"""Quality rules that look at a document and at the host it comes from, as DataFrame expressions.

Every document is measured in its own row. Rule failures are summed by host, each rate is drawn
towards an empirical beta prior over the hosts, and the host's verdict is joined to its documents:
a rejected host loses all documents, a watched host those that fail a rule.

Defined cases: a null or empty text has no words and fails the base rules; null hosts form one
host; repeated rows count as often as they occur; an empty table gives no rows; other columns of
the input are ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import WORD, let, stored, unused, words

MIN_WORDS, REPEAT_PERCENT, WINDOW = 50, 50, 3
#: A document fails the soft rules if over so many percent of its word characters are symbols,
#: or of its lines with a word are repetitions.
SYMBOL_PERCENT, DUP_LINE_PERCENT = 10, 50
#: Shrunk failure rates from which a host is watched or rejected.
WATCH_RATE, REJECT_RATE = 0.02, 0.5
SYMBOLS = "#*$%&|<>"
RULES = ("short", "repetitive", "symbols", "dup_lines")
#: Variances up to this count as none.
FLAT = 1e-12


def repeated_words(found: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the text.

    A window becomes one number: its hash, with its place in the low bits. Sorted, equal windows
    lie side by side; neighbours of equal hash are compared word by word.
    """

    def places(w: Column, low: Column) -> Column:
        right, left = (lambda x: F.call_function("shiftright", x, low)), (lambda x: F.call_function("shiftleft", x, low))
        window = lambda i: F.slice(w, i, WINDOW)

        def covered(s: Column) -> Column:
            place = lambda k: (F.element_at(s, k) - left(right(F.element_at(s, k)))).cast("int")

            def paired(hashes: Column) -> Column:
                beside = F.filter(F.sequence(F.lit(1), F.size(s) - 1), lambda k: F.element_at(hashes, k) == F.element_at(hashes, k + 1))
                equal = F.filter(F.transform(beside, lambda k: F.array(place(k), place(k + 1))), lambda p: window(p[0]) == window(p[1]))
                return F.size(F.array_distinct(F.flatten(F.transform(F.flatten(equal), lambda p: F.array(p, p + 1, p + 2)))))

            return let(F.transform(s, right), lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(s), 0).otherwise(paired(hashes)))

        marks = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: left(right(F.xxhash64(
            *[F.element_at(w, i + j) for j in range(WINDOW)]))).bitwiseOR(i.cast("long")))
        return let(F.sort_array(marks), covered)

    def count(w: Column) -> Column:
        return F.when(F.size(w) <= WINDOW, 0).otherwise(let(F.length(F.bin(F.size(w).cast("long"))), lambda low: places(w, low)))

    return let(found, count).cast("long")


def measures(text: Column) -> Column:
    """Struct of the counts that the rules read."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD))

    def of_words(w: Column) -> Column:
        return let(lines, lambda rows: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.when(body.rlike(f"[{SYMBOLS}]"), F.char_length(F.regexp_replace(body, f"[^{SYMBOLS}]+", ""))).otherwise(0).cast("long").alias("n_symbols"),
            (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(rows).cast("long").alias("n_lines")))

    return let(words(body), of_words)


def failures(m: Column) -> dict[str, Column]:
    return {
        "short": m["n_words"] < MIN_WORDS,
        "repetitive": 100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"],
        "symbols": 100 * m["n_symbols"] > SYMBOL_PERCENT * m["word_chars"],
        "dup_lines": 100 * m["n_dup_lines"] > DUP_LINE_PERCENT * m["n_lines"],
    }


def host_verdicts(measured: DataFrame) -> DataFrame:
    """One row per host: host, n_docs, the shrunk failure rate of each rule, verdict.

    ``measured`` has ``host`` and a boolean column for each of the rules. A rule's prior has the
    mean and variance of the hosts' rates; where these do not vary, all hosts get the common rate.
    Sums are taken before the shuffle, so a host with a third of all documents costs no more than
    another. The prior is one row of numbers.
    """
    sums = stored(measured.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *[
        F.sum(F.col(r).cast("long")).alias(f"f_{r}") for r in RULES]))
    rate = lambda r: F.round(F.col(f"f_{r}") / F.col("n_docs"), 9).cast("decimal(10,9)")  # noqa: E731  exact sums don't depend on order
    prior = sums.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n_docs").alias("docs"), *[
        c for r in RULES for c in (F.sum(f"f_{r}").alias(f"f_{r}"), F.sum(rate(r)).alias(f"s_{r}"), F.sum(rate(r) * rate(r)).alias(f"q_{r}"))]).first()

    def shrunk(r: str) -> Column:
        if not prior["hosts"]:
            return F.lit(0.0).alias(f"rate_{r}")
        mean = float(prior[f"s_{r}"]) / prior["hosts"]
        variance = float(prior[f"q_{r}"]) / prior["hosts"] - mean * mean
        if variance <= FLAT or mean * (1 - mean) <= variance:
            return F.lit(round(prior[f"f_{r}"] / prior["docs"], 6)).alias(f"rate_{r}")
        strength = mean * (1 - mean) / variance - 1  # alpha + beta of the beta distribution with these moments
        return F.round((F.col(f"f_{r}") + mean * strength) / (F.col("n_docs") + strength), 6).alias(f"rate_{r}")

    rates = sums.select("host", "n_docs", *[shrunk(r) for r in RULES])
    worst = reduce(F.greatest, [F.col(f"rate_{r}") for r in RULES])
    return stored(rates.withColumn("verdict", F.when(worst >= REJECT_RATE, "reject").when(worst >= WATCH_RATE, "watch").otherwise("trust")))


def _kept(verdict: Column, flags: str = "") -> Column:
    failed = {r: F.col(flags + r) for r in RULES}
    return ~(failed["short"] | failed["repetitive"]) & F.when(verdict == "reject", False).when(
        verdict == "watch", ~(failed["symbols"] | failed["dup_lines"])).otherwise(True)


def _host(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: key, host, the measures, base_failed, host_verdict, kept.

    The measures are taken once and written out without the texts. The table of hosts joins by
    its true size: broadcast if small, else by a shuffle of narrow rows that can split hot hosts.
    """
    measured = docs.select(F.col(key).alias("key"), _host(host).alias("host"), measures(F.col(text)).alias("m"))
    rows = stored(measured.select("key", "host", "m.*", *[c.alias(r) for r, c in failures(F.col("m")).items()]))
    verdicts = host_verdicts(rows).select("host", "verdict")
    return rows.join(verdicts, "host").select(
        F.col("key").alias(key), "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("short") | F.col("repetitive")).alias("base_failed"), F.col("verdict").alias("host_verdict"), _kept(F.col("verdict")).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents, with all their columns, that the rules and their host's verdict keep."""
    flags, of_host = unused(docs, "__rules"), unused(docs, "__host")
    failed = F.struct(_host(host).alias("host"), *[c.alias(r) for r, c in failures(F.col(flags)).items()])
    rows = stored(docs.withColumn(flags, measures(F.col(text))).withColumn(flags, failed))
    verdicts = host_verdicts(rows.select(f"{flags}.*")).select(F.struct("host", "verdict").alias(of_host))
    joined = rows.join(verdicts, F.col(f"{flags}.host") == F.col(f"{of_host}.host"))
    return joined.where(_kept(F.col(f"{of_host}.verdict"), f"{flags}.")).select(*[rows[c] for c in docs.columns])
