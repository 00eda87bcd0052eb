"""Quality rules: a table of thresholds compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelift.llm.common import WORD, ascii_lower

#: Function words of the four corpus languages: fixed values.
STOP_WORDS = (
    "the be to of and that have with in is it for on was are as by from this an "
    "der die das und ist von zu mit den ein eine nicht sich auf im dem "
    "le la les de des et un une est dans que pour qui en du avec "
    "el los las y que se con por una del para su al como"
).split()


@dataclass(frozen=True)
class Threshold:
    """A figure of a text must stay between ``low`` and ``high``; None leaves that side open."""

    figure: str
    low: float | None = None
    high: float | None = None


#: Production thresholds.  A ratio whose divisor is zero is null and breaks no rule.
RULES = (
    Threshold("mean_word_chars", 2.0, 15.0),
    Threshold("symbol_ratio", high=0.1),
    Threshold("dup_line_ratio", high=0.5),
    Threshold("stop_words", low=2),
)


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


#: What a rule can name, as an expression over the counted columns.
FIGURES = {
    "n_words": lambda: F.col("n_words"),
    "mean_word_chars": lambda: ratio(F.col("word_chars"), F.col("n_words")),
    "symbol_ratio": lambda: ratio(F.col("n_symbols"), F.col("n_words")),
    "dup_line_ratio": lambda: ratio(F.col("n_dup_lines"), F.col("n_lines")),
    "repeat_word_ratio": lambda: ratio(F.col("n_repeat_words"), F.col("n_words")),
    "stop_words": lambda: F.col("n_stop_words"),
}


def compile_rules(rules: tuple[Threshold, ...] = RULES) -> Column:
    """One boolean column: no rule is broken."""
    passed = F.lit(True)
    for rule in rules:
        if rule.figure not in FIGURES:
            raise ValueError(f"unknown figure {rule.figure}")
        figure = FIGURES[rule.figure]()
        if rule.low is not None:
            passed = passed & F.coalesce(figure >= rule.low, F.lit(True))
        if rule.high is not None:
            passed = passed & F.coalesce(figure <= rule.high, F.lit(True))
    return passed


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, and only where the result is asked for."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_window_words(words: Column, windows: Column, size: int = 3) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the array.

    ``windows`` holds a 64-bit hash for each window (within a text of 20,000 words two different
    windows share one with a chance of 1e-11).  Sorted with their places, equal windows are
    neighbours; the places found, sorted again, each cover as many new words as they are away
    from the place before, at most ``size``.  A text without equal windows is not sorted.
    """

    def covered(ordered: Column) -> Column:
        equal = F.filter(
            ordered,
            lambda w, k: (F.get(ordered, k - 1)["h"] == w["h"]) | (F.get(ordered, k + 1)["h"] == w["h"]),
        )
        places = F.sort_array(F.transform(equal, lambda w: w["i"]))
        total = F.aggregate(
            places, F.struct(F.lit(-size).alias("last"), F.lit(0).alias("n")),
            lambda state, i: F.struct(i.alias("last"), (state["n"] + F.least(F.lit(size), i - state["last"])).alias("n")),
        )
        return total["n"]

    # before the first and behind the last window get() gives null, and null or true is true
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(placed, covered))


def window_hashes(words: Column, size: int = 3) -> Column:
    places = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The counts of every whole text, added to the columns of docs as one struct-free projection."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    split = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"),
        lines.alias("lines"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    hashed = split.select("*", window_hashes(F.col("words")).alias("windows"))
    words = F.col("words")
    return hashed.select(
        "row",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(words, F.col("windows")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


#: Fewer words than this, or more than half of them in repeated windows, fail a text before any rule.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def judge(docs: DataFrame, text: str = "text", rules: tuple[Threshold, ...] = RULES) -> DataFrame:
    """Columns ``row`` (the input row), the counts, ``base_failed`` and ``kept``.

    A null or empty text counts nothing and fails; an empty table stays empty; the input columns
    sit in ``row``, so none of their names can clash.  Repeated rows are judged alike.
    """
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = counted(docs, text).withColumn("base_failed", base)
    # the number of the row, always true here, stops the optimiser from moving a filter on the verdict below the
    # counts, where it would work them out once more for each mention
    here = F.monotonically_increasing_id() >= 0
    return out.withColumn("kept", ~F.col("base_failed") & compile_rules(rules) & here)


def score_quality(docs: DataFrame, rules: tuple[Threshold, ...] = RULES) -> DataFrame:
    """The figures and the verdict of every document."""
    return judge(docs, rules=rules).select(
        F.col("row")["doc_id"].alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_stop_words",
    )


def keep_good(docs: DataFrame, rules: tuple[Threshold, ...] = RULES) -> DataFrame:
    """The documents that pass, with their columns as they were."""
    return judge(docs, rules=rules).filter("kept").select("row.*")
