"""Quality rules whose cutoffs keep false rejections limited, stratum by stratum.

Each rule compares a statistic of a text with a cutoff. The cutoffs of all rules are
tightened together, step by step. On labelled good documents a step is accepted if an
exact binomial test rejects "the rules together turn down more than RISK of the good
documents of the stratum". Steps are tried from the loosest and the last before the first
failure counts (a fixed sequence needs no correction); the level is divided by the number
of strata tested (Bonferroni). Which strata are tested depends on their sizes alone: the
largest ones, as many as could pass at the level left for each. So with probability of at
least 1 - LEVEL no stratum loses more than RISK of its good documents. Strata with too few
labelled good documents, or none, get no cutoff and keep what passes the base rules.

A single stratum takes 149 such documents without a rejection, four take 217 each.

SQL functions only; statistics are computed once and stored.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.stage import stored

RISK, LEVEL = 0.02, 0.05
MIN_WORDS, REPEAT_PERCENT = 50, 50
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

# Statistic of each rule, and its cutoffs from the loosest to the tightest.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols_per_word": ("n_symbols / n_words", (2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1)),
    "repeated_line_share": ("n_dup_lines / greatest(n_lines, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    "repeated_word_share": ("n_repeat_words / n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
    "upper_case_share": ("n_upper / greatest(word_chars, 1)", (0.8, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "exclamations_per_word": ("n_exclamations / n_words", (1.0, 0.7, 0.5, 0.3, 0.2)),
    "word_length": ("word_chars / n_words", (40.0, 30.0, 20.0, 15.0, 12.0)),
}


def bound(value: Column, use) -> Column:
    """`use` of a value that is evaluated once, although it is used within other lambdas."""
    return F.transform(F.array(value), use)[0]


def count_of(pattern: str) -> Column:
    """Characters of the text that are of a class, given the pattern of all others."""
    return F.length(F.regexp_replace("_text", pattern, "")).cast("long")


def repeated_words(words: Column) -> Column:
    """Number of words within 3-word windows that occur at least twice.

    Windows are sorted with their positions behind them; equal ones become neighbours.
    """

    def of_windows(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda w, i: F.concat(w, F.lit(" "), F.lpad(i.cast("string"), 10, "0"))))
        order = F.transform(placed, lambda w: F.substring(w, -10, 10).cast("int"))

        def of_order(at: Column) -> Column:
            def repeats(p: Column, j: Column) -> Column:
                here = F.get(windows, p)
                before, after = F.get(windows, F.get(at, j - 1)), F.get(windows, F.get(at, j + 1))
                return F.coalesce(here == before, F.lit(False)) | F.coalesce(here == after, F.lit(False))

            hits = F.filter(at, repeats)
            return F.size(F.array_distinct(F.flatten(F.transform(hits, lambda p: F.array(p, p + 1, p + 2)))))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(bound(order, of_order))

    def of_words(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 3)
        windows = F.transform(places, lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 4, 0).otherwise(bound(windows, of_windows))

    return bound(words, of_words).cast("long")


def with_statistics(docs: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, the stratum and the statistics of each row's whole text; null counts as empty."""
    words = F.filter(F.split("_text", GAP), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD))
    base = docs.select(F.col("doc_id"), F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), F.coalesce(text, F.lit("")).alias("_text"))
    line_counts = bound(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    word_counts = bound(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again")))
    counted = base.select(
        "doc_id",
        "stratum",
        word_counts.alias("w"),
        line_counts.alias("l"),
        count_of(GAP).alias("word_chars"),
        count_of(r"[^#*$%&|<>]+").alias("n_symbols"),
        count_of(r"[^A-Z]+").alias("n_upper"),
        count_of(r"[^!]+").alias("n_exclamations"),
    )
    return counted.select(
        "doc_id", "stratum", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.col("l.dup").cast("long").alias("n_dup_lines"), F.col("w.again").alias("n_repeat_words"),
        F.col("l.n").cast("long").alias("n_lines"), "n_upper", "n_exclamations",
    ).withColumn("base_failed", base_failed())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def at_most(n: Column, k: Column, p: float) -> Column:
    """Probability of at most k hits in n trials of probability p, summed term by term in logarithms."""
    odds = math.log(p / (1 - p))
    none = n * math.log1p(-p)

    def add(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        return F.struct(term.alias("term"), (a["total"] + F.exp(term)).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(none.alias("term"), F.exp(none).alias("total"))
    return F.aggregate(steps, start, add, lambda a: a["total"])


STEPS = max(len(cuts) for _, cuts in RULES.values())


def cut_at(rule: str, step: int) -> float:
    """The rule's cutoff at a step; rules with fewer cutoffs stay at their tightest."""
    cuts = RULES[rule][1]
    return cuts[min(step, len(cuts) - 1)]


def exceeds(step: int) -> Column:
    """Whether a text exceeds any rule's cutoff of a step."""
    return reduce(or_, [F.coalesce(F.expr(statistic) > cut_at(rule, step), F.lit(False)) for rule, (statistic, _) in RULES.items()])


def tested_sizes(counts: DataFrame, risk: float, level: float) -> DataFrame:
    """One row: the least size of the strata that are tested, and how many those are; no row if none can pass.

    A stratum of n documents without a rejection passes if (1 - risk)^n is at most its
    share of the level, so that up to level / (1 - risk)^n strata of that size may share it.
    Only the distinct sizes meet in one task; their sum is at most the number of labels.
    """
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("strata"))
    larger = F.sum("strata").over(Window.orderBy(F.desc("n")))
    may_share = F.floor(level * F.exp(F.least(F.col("n") * -math.log1p(-risk), F.lit(40.0))))
    placed = sizes.withColumn("m", larger).withColumn("can", F.least("m", may_share)).where("can > 0")
    return placed.agg(F.max(F.struct("can", "n", "m")).alias("best")).where("best is not null").select(F.col("best.n").alias("least"), F.col("best.m").alias("m"))


def cutoffs(statistics: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """stratum, n, step: the last step accepted for a stratum; strata without one are left out.

    Labelled good documents that pass the base rules are the holdout.
    """
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("of")).distinct()
    held = statistics.where(~F.col("base_failed")).join(good, F.col("doc_id") == F.col("of"), "left_semi")
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(exceeds(i)).alias(f"k{i}") for i in range(STEPS)])
    counts = stored(counts, "holdout-counts")
    sizes = tested_sizes(counts, risk, level)
    tested = counts.where(F.col("n") >= sizes.select("least").scalar())
    trial = tested.select("stratum", "n", F.posexplode(F.array(*[F.col(f"k{i}") for i in range(STEPS)])).alias("step", "k"))
    # A share of rejections at or above the limit fails at once; only below it is the sum needed.
    tail = at_most(F.col("n"), F.col("k"), risk)
    passed = trial.withColumn("passed", F.when(F.col("k") >= F.col("n") * risk, False).otherwise(tail <= F.lit(level) / sizes.select("m").scalar()))
    fails = F.coalesce(F.min(F.when(~F.col("passed"), F.col("step"))), F.lit(STEPS))
    return stored(passed.groupBy("stratum", "n").agg((fails - 1).alias("step")).where("step >= 0"), "cutoffs")


def with_verdict(statistics: DataFrame, limits: DataFrame) -> DataFrame:
    """Add `kept`: false for texts that fail the base rules or exceed the accepted cutoffs of their stratum.

    The few rows of limits are broadcast where Spark finds them small; else a stratum that
    holds a large share of the rows is split by adaptive execution.
    """
    rows = limits.select(F.col("stratum").alias("of"), F.col("step").alias("up_to"))
    joined = statistics.join(rows, F.col("stratum") == F.col("of"), "left")
    over = reduce(or_, [(F.col("up_to") == i) & exceeds(i) for i in range(STEPS)])
    kept = F.when(F.col("base_failed"), False).otherwise(~F.coalesce(over, F.lit(False)))
    return joined.withColumn("kept", kept).select(*statistics.columns, "kept")


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """Statistics and verdict of every row. Texts are read once; the statistics are stored.

    A null text counts as empty and fails the base rules. A null stratum is one of its own,
    named ''. Rows that repeat an id are judged one by one, and each counts in the holdout if
    the id is labelled; rows without an id are never in it. Empty tables give no rows, or no
    cutoffs. Columns other than the id, the text and the stratum are not read and not
    returned, whatever their names.
    """
    statistics = stored(with_statistics(docs, text, stratum), "statistics")
    return with_verdict(statistics, cutoffs(statistics, labels))
