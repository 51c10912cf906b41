"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a boolean column over the text that says "reject". Its cost and its selectivity are
estimated on a sample, and the rules run in order of rejection per cost inside one CASE, which
stops at the first rule that fires; a document is kept when none does. The order changes only the
time taken, never the verdict.

The measures are linear-logarithmic in the length of a text and need no shuffle: repeated windows
are found by sorting (window hash, position) inside the row.

Defined cases: a null text has no words and measures of 0; a text without words fails the base
rule; rows are independent, so ties and repeated rows need no rule; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WHITE, WORD, bound, bounded_sample, cut_lineage, whole_text, words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 3
# Rows on which costs and selectivities are estimated; the verdict does not depend on them.
SAMPLE_ROWS = 1024


def with_counts(docs: DataFrame, text: Column) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long)."""
    return docs.withColumns({
        "n_words": F.regexp_count(text, F.lit(WORD)).cast("bigint"),
        "word_chars": (F.char_length(text) - F.regexp_count(text, F.lit(WHITE))).cast("bigint"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"),
        "n_dup_lines": bound(worded_lines(text), lambda lines: repeats(lines)).cast("bigint"),
        "n_repeat_words": bound(words(text), repeated_words),
    })


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def repeats(items: Column) -> Column:
    return F.size(items) - F.size(F.array_distinct(items))


def repeated_words(word: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the same text. Each array is built once per row."""
    starts = F.when(F.size(word) >= WINDOW, F.sequence(F.lit(0), F.size(word) - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    windows = F.transform(
        starts, lambda i: F.struct(F.xxhash64(*[F.get(word, i + k) for k in range(WINDOW)]).alias("h"), i.alias("p")))
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    twice = lambda sorted_: F.array_compact(F.transform(
        sorted_, lambda x, i: F.when(same(x, F.get(sorted_, i - 1)) | same(x, F.get(sorted_, i + 1)), x["p"])))
    covered = lambda at: F.transform(
        at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
    total = lambda at: F.aggregate(covered(at), F.lit(0).cast("bigint"), lambda sum_, x: sum_ + x)
    return bound(F.sort_array(windows), lambda sorted_: bound(F.sort_array(twice(sorted_)), total))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def default_rules(text: Column) -> list[Rule]:
    """Rejects junk: symbol noise, shouting, table dumps, immediate repeats, repeated lines, odd word lengths.

    Each counts against the words of the text, in whole numbers.
    """
    n_words = F.regexp_count(text, F.lit(WORD))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    many_repeats = bound(worded_lines(text), lambda lines: repeats(lines) * 100 > F.size(lines) * 40)
    same_as_before = F.aggregate(
        words(text),
        F.struct(F.lit("").alias("last"), F.lit(0).alias("n")),
        lambda seen, word: F.struct(word.alias("last"), (seen["n"] + (word == seen["last"]).cast("int")).alias("n")),
    )["n"]
    return [
        Rule("symbols", count(SYMBOLS) * 100 > n_words * 15),
        Rule("shouting", count("!!") * 100 > n_words * 15),
        Rule("long words", F.char_length(text) > n_words * 30),
        Rule("immediate repeats", same_as_before * 100 > n_words * 20),
        Rule("repeated lines", many_repeats),
    ]


def estimate(docs: DataFrame, rules: Sequence[Rule], key_cols: Sequence[str], rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, share rejected, seconds) on a sample of about `rows` rows with a small key hash.

    Every task of the scan writes its own sampled rows; only what was written is brought into one task.
    """
    sample = cut_lineage(cut_lineage(bounded_sample(docs, rows, *key_cols)).coalesce(1))

    def timed(column: Column) -> tuple[float, float]:
        began = time.perf_counter()
        row = sample.agg(F.avg(F.coalesce(column, F.lit(False)).cast("int")), F.count(F.lit(1))).first()
        return row[0] or 0.0, time.perf_counter() - began

    idle = min(timed(F.lit(False))[1] for _ in range(3))
    found = []
    for rule in rules:
        runs = [timed(rule.rejects) for _ in range(2)]
        found.append((rule.name, runs[0][0], max(min(s for _, s in runs) - idle, 1e-4)))
    return found


def cascade(rules: Sequence[Rule], estimates: Sequence[tuple[str, float, float]]) -> Column:
    """True where no rule rejects; rules run by rejection per cost, ties by name, and stop at the first that fires."""
    worth = {name: share / seconds for name, share, seconds in estimates}
    ordered = sorted(rules, key=lambda r: (-worth[r.name], r.name))
    verdict = F.when(F.lit(False), F.lit(False))
    for rule in ordered:
        verdict = verdict.when(rule.rejects, F.lit(False))
    return verdict.otherwise(F.lit(True))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """Per row: doc_id, the base measures, base_failed, kept."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("_text"))
    rules = default_rules(F.col("_text")) if rules is None else list(rules)
    passes = cascade(rules, estimate(rows, rules, ["doc_id", "_text"]))
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (
        with_counts(rows, F.col("_text"))
        .withColumn("base_failed", base)
        # the cascade is only entered by what passes the base rule
        .withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(passes))
        .drop("_text")
    )
