"""Quality rules as a short-circuit cascade, with Spark expressions only.

Statistics of a text are computed once; the rules are conditions on them.  On a
bounded sample each rule is tried on every row, which gives its cost (the mean
number of values and characters it looks at) and the rows it rejects.  Rules are
ordered greedily by rejections, among rows no earlier rule rejects, per cost, and
a row stops at the first rule that rejects it.
The order affects only which rule is named and how much is evaluated, never
whether a row is kept.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import SPACE_CHARS, bind, words_of

#: Rows of the sample on which selectivities are measured; a bound, whatever the input.
SAMPLE_ROWS = 2000
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """SQL on the fields of `text_statistics` and the raw text ``t``: a condition, and what it costs on a row."""

    name: str
    rejects: str
    work: str


RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "2"),
    Rule("word_length", "word_chars > 12 * n_words OR word_chars < 2 * n_words", "4"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines", "2"),
    Rule("shouting", "2 * regexp_count(t, '(?<![A-Za-z])[A-Z]{2}') > n_words", "2 * length(t)"),
    Rule("exclamations", "3 * regexp_count(t, '!') > n_words", "length(t)"),
)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window which occurs twice or more, the first occurrence included.

    Windows are compared by 64-bit hash within one text.
    """
    last = F.size(words) - 2
    windows = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct(F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)).alias("h"), i.alias("p")),
    )
    ordered = F.sort_array(windows)

    def covered(sorted_windows: Column) -> Column:
        again = F.filter(
            sorted_windows,
            lambda w, i: F.coalesce(F.get(sorted_windows, i - 1)["h"] == w["h"], F.lit(False))
            | F.coalesce(F.get(sorted_windows, i + 1)["h"] == w["h"], F.lit(False)),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(again, lambda w: F.array(w["p"], w["p"] + 1, w["p"] + 2)))))

    return F.when(last >= 1, bind(ordered, covered)).otherwise(0).cast("long")


def text_statistics(text: Column) -> Column:
    """Struct: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (all long)."""

    def of(bound: Column) -> Column:
        words = bound["words"]
        lines = F.filter(F.split(bound["text"], "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
        count_lines = lambda held: F.struct(
            F.size(held).cast("long").alias("n"), (F.size(held) - F.size(F.array_distinct(held))).cast("long").alias("dup")
        )
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(bound["text"], F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            bind(lines, count_lines).alias("lines"),
            repeated_words(words).alias("n_repeat_words"),
        )

    held = F.struct(F.coalesce(text, F.lit("")).alias("text"), words_of(text).alias("words"))
    return bind(held, of)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def _on(sql: str, text: str, stats: str) -> Column:
    """The SQL of a rule, on a text expression and a statistics column."""
    sql = re.sub(r"\b(n_words|word_chars|n_symbols|n_repeat_words)\b", rf"{stats}.\1", sql)
    sql = re.sub(r"\bn_lines\b", f"{stats}.lines.n", re.sub(r"\bn_dup_lines\b", f"{stats}.lines.dup", sql))
    return F.expr(re.sub(r"\(t\b", lambda _: f"({text}", sql))


def _rejects(rule: Rule, text: str, stats: str) -> Column:
    return F.coalesce(_on(rule.rejects, text, stats), F.lit(False))


def cascade_order(judged: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per cost among the rows still left, ties by name.

    Measured on the first ``sample_rows`` rows of a frame with columns t and s; only
    as many partitions run as those need, and only figures reach the driver.
    """
    flags = [_rejects(r, "coalesce(t, '')", "s").alias(f"r{i}") for i, r in enumerate(rules)]
    works = [_on(r.work, "coalesce(t, '')", "s").cast("double").alias(f"w{i}") for i, r in enumerate(rules)]
    rows = [r for r in judged.select(base_failed(F.col("s")).alias("base"), *flags, *works).limit(sample_rows).collect() if not r["base"]]
    order, left = [], list(rows)
    waiting = set(range(len(rules)))
    while waiting:

        def gain(i: int) -> tuple[float, str]:
            work = sum(r[f"w{i}"] for r in left) or 1.0
            return -sum(r[f"r{i}"] for r in left) / work, rules[i].name

        best = min(waiting, key=gain)
        waiting.remove(best)
        order.append(rules[best])
        left = [r for r in left if not r[f"r{best}"]]
    return order


def judge_quality(documents: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All rows and columns plus ``quality``: the statistics, base_failed, rejected_by and kept.

    Null or blank text has no words and fails the base.  ``rejected_by`` is "base",
    the first rule of the cascade that rejects the row, or null; ``kept`` means null
    there.  Rows are judged one by one, so ties, repeats and columns of any other
    name are left alone; an existing column ``quality`` is replaced.
    """
    source = F.col(f"`{text}`")
    raw = f"coalesce(`{text}`, '')"
    order = cascade_order(documents.select(source.alias("t")).select("t", text_statistics(F.col("t")).alias("s")), rules, sample_rows)
    stats = documents.withColumn("quality", text_statistics(source))
    verdict = F.when(base_failed(F.col("quality")), "base")
    for rule in order:
        verdict = verdict.when(_rejects(rule, raw, "quality"), rule.name)
    verdict = verdict.otherwise(F.lit(None).cast("string"))
    q = F.col("quality")
    return stats.withColumn(
        "quality",
        F.struct(
            q["n_words"].alias("n_words"), q["word_chars"].alias("word_chars"), q["n_symbols"].alias("n_symbols"),
            q["lines"]["n"].alias("n_lines"), q["lines"]["dup"].alias("n_dup_lines"), q["n_repeat_words"].alias("n_repeat_words"),
            base_failed(q).alias("base_failed"), verdict.alias("rejected_by"), verdict.isNull().alias("kept"),
        ),
    )


def keep_good(documents: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows, with all their columns, that the rules keep; see `judge_quality`."""
    held = documents.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("t"))
    return judge_quality(held, "t", rules).filter("quality.kept").select("row.*")
