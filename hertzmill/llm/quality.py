"""Weak supervision for text quality, in DataFrame functions only.

Rules look at measures of the whole text and vote good (+1), bad (-1) or abstain (0).
Nobody knows which rules are right: expectation-maximisation estimates each rule's
accuracy from how the rules agree. It works on the histogram of vote patterns (at most
3^rules rows, whatever the corpus), one small aggregate per round; the posterior
probability that a document is good then replaces an all-must-pass filter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAK, materialize

WINDOW = 8
#: Words among which distinct ones are counted; the share of distinct words falls with length.
STRETCH = 400


@dataclass(frozen=True)
class Rule:
    """SQL conditions over the measures; bad is asked first, neither means abstain."""

    name: str
    bad: str
    good: str


#: Thresholds are those commonly published for web text (length, word length, symbols,
#: repeated lines and repeated n-grams, sentence ends, capitals).
RULES = (
    Rule("length", "n_words < 20", "false"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 10 * n_words", "word_chars between 3.5 * n_words and 7 * n_words"),
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("letters", "n_marks > 0.2 * word_chars", "n_marks <= 0.08 * word_chars"),
    Rule("separators", "n_bars > 0.1 * n_words", "false"),
    Rule("line_length", "n_lines >= 5 and n_words < 4 * n_lines", "false"),
    Rule("repeated_lines", "n_dup_lines > 0.3 * n_lines", "false"),
    Rule("repeated_words", "n_repeat_words > 0.2 * n_words", "false"),
    Rule("vocabulary", "n_words >= 50 and n_distinct < 0.2 * n_words", "false"),
    Rule("capitals", "n_upper > 0.4 * word_chars", "false"),
    Rule("exclaims", "n_exclaims > 0.15 * n_words", "false"),
)


def _let(value: Column, body) -> Column:
    """Evaluate value once and hand it to body, also where body uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def _pairs(a: Column, step: int) -> Column:
    n = F.greatest(F.size(a) - step, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(1 + step), n), lambda x, y: F.xxhash64(x, y))


def _count(text: Column, pattern: str) -> Column:
    return (F.size(F.split(text, pattern, -1)) - 1).cast("long")


def _covered(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more; windows hold the hashes by first word."""

    def cover(places: Column) -> Column:
        gaps = F.zip_with(F.slice(places, F.lit(1), F.greatest(F.size(places) - 1, F.lit(0))), F.slice(places, F.lit(2), F.greatest(F.size(places) - 1, F.lit(0))), lambda x, y: F.least(y - x, F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda total, x: total + x)

    def places(s: Column) -> Column:
        again = F.transform(s, lambda x, i: F.when((F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"]))
        return F.array_sort(F.filter(again, lambda x: x.isNotNull()))

    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(_let(_let(by_hash, places), cover))


def _distinct(words: Column) -> Column:
    """Distinct words of each stretch, summed over all stretches."""
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(words), F.lit(1)) - 1) / STRETCH).cast("int"))
    return F.aggregate(starts, F.lit(0).cast("long"), lambda total, k: total + F.size(F.array_distinct(F.slice(words, k * STRETCH + 1, F.lit(STRETCH)))))


def measures(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id and the measures of each whole text; a null text measures as an empty one.

    row: name of a column that holds the whole row as a struct, none by default.

    Words are runs of characters other than space, tab, LF, VT, FF and CR. Windows of
    eight words are told apart by 64-bit hashes.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = [F.struct(*[docs[c] for c in docs.columns]).alias(row)] if row else []
    also = [row] if row else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"), *whole)
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.translate(x, " \t\n\x0b\f\r", "") != "")
    hashes = F.transform(F.col("w"), lambda x: F.xxhash64(x))
    eights = _let(_let(_let(hashes, lambda a: _pairs(a, 1)), lambda a: _pairs(a, 2)), lambda a: _pairs(a, 4))
    eights = F.slice(eights, F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(0)))
    return docs.withColumn("w", F.array_remove(F.split("t", WORD_BREAK, -1), "")).select(
        "doc_id",
        *also,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _count(F.col("t"), r"[#*$%&|<>]").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
        F.when(F.size("w") > WINDOW, _let(eights, _covered)).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        _count(F.col("t"), r"[^\p{L} \t-\r]").alias("n_marks"),
        _count(F.col("t"), "[A-ZÀ-ÖØ-Þ]").alias("n_upper"),
        _count(F.col("t"), r" [#*$%&|<>•·/=~-]+(?= )").alias("n_bars"),
        _count(F.col("t"), "!").alias("n_exclaims"),
        _distinct(F.col("w")).alias("n_distinct"),
    ).select("doc_id", *also, "n_words", "word_chars", "n_symbols", F.col("lines.n").alias("n_lines"), F.col("lines.dup").alias("n_dup_lines"), "n_repeat_words", "n_marks", "n_upper", "n_bars", "n_exclaims", "n_distinct")


def votes(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds votes, an array with +1, -1 or 0 by rule."""
    each = [F.when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0) for r in rules]
    return measured.withColumn("votes", F.array(*each))


def _posterior(accuracies: list[float], prior: float) -> Column:
    odds = F.lit(math.log(prior / (1 - prior)))
    for j, a in enumerate(accuracies):
        odds = odds + F.col("votes")[j] * F.lit(math.log(a / (1 - a)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def estimate(voted: DataFrame, n_rules: int, rounds: int = 25, start: float = 0.75, prior: float = 0.7) -> tuple[list[float], float]:
    """Accuracy of each rule where it votes, and the share of good documents.

    A rule that never votes keeps its start. Accuracies stay in [0.55, 0.99] so that
    good and bad can't change places; the prior stays in [0.05, 0.95]. Values are rounded to six
    digits, so that the order of sums doesn't show. With no rows the start is returned.
    """
    patterns = materialize(voted.groupBy("votes").agg(F.count("*").alias("n")), "patterns")
    accuracies = [start] * n_rules
    for _ in range(rounds):
        p, n = F.col("p"), F.col("n")
        sums = [F.sum(n * F.when(F.col("votes")[j] == 1, p).when(F.col("votes")[j] == -1, 1 - p).otherwise(0.0)) for j in range(n_rules)]
        cast = [F.sum(n * F.abs(F.col("votes")[j])) for j in range(n_rules)]
        row = patterns.withColumn("p", _posterior(accuracies, prior)).agg(F.sum(n), F.sum(n * p), *sums, *cast).first()
        if not row[0]:
            break
        now = [round(min(0.99, max(0.55, s / c)), 6) if c else a for s, c, a in zip(row[2 : 2 + n_rules], row[2 + n_rules :], accuracies, strict=True)]
        share = round(min(0.95, max(0.05, row[1] / row[0])), 6)
        moved = max(abs(a - b) for a, b in zip([*now, share], [*accuracies, prior], strict=True))
        accuracies, prior = now, share
        if moved < 1e-5:
            break
    return accuracies, prior


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep_from: float = 0.5, row: str | None = None) -> DataFrame:
    """The measures, votes, posterior, base_failed and kept of every row of docs.

    base_failed: fewer than 20 words, or more than 30 in 100 words in repeated windows.
    kept: not base_failed and a posterior of at least keep_from. Only doc_id and text
    are read; each row, repeated or not, is judged by its own text; a null doc_id stays
    null; a null or empty text has no words and so fails; no rows give no rows. row: a
    column to hold the whole row as a struct.
    """
    measured = materialize(measures(docs, row), "measures")
    voted = votes(measured, rules)
    accuracies, prior = estimate(voted, len(rules))
    return (
        voted.withColumn("posterior", _posterior(accuracies, prior))
        .withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from))
    )


def without_rejected(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep_from: float = 0.5) -> DataFrame:
    """The rows of docs that judge() keeps, all columns as they were; no row is shuffled."""
    return judge(docs, rules, keep_from, "whole_row").where("kept").select(F.col("whole_row.*"))
