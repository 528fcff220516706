"""Operator 7 [native]: quality rules as a short-circuit cascade.

Each rule is a condition under which a document goes.  On a bounded sample
(``SAMPLE_ROWS`` rows as the table gives them) every rule's cost (seconds)
and rejection rate are measured, and the rules run in the order of
rejections per cost; a document that one rule rejects is not shown to the
next.  The verdict is the same in any order, so the sample only decides how fast it is reached.

Words are runs of bytes other than ASCII white space.  Everything is a
DataFrame expression over one row: nothing is shuffled, no Python worker runs.

Null and empty texts have no words and fail the base rules.  Repeated rows
give repeated results.  The measures live in one struct column, so columns
named like a measure cannot clash; input columns named ``measures``,
``base_failed``, ``rejected_by`` or ``kept`` are replaced by ours.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import prepare

#: Rows on which costs and rejection rates are measured.
SAMPLE_ROWS = 1000
#: Fixed values of the base measures.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50

_GAPS = "\t\n\x0b\x0c\r"
_SPACES = " " + _GAPS


@dataclass(frozen=True)
class Rule:
    """``rejects``: a boolean SQL expression over ``text`` and the base measures."""

    name: str
    rejects: str


#: What a document must not be: thresholds far from prose, so that clean documents pass.
RULES = [
    Rule("symbols", "n_symbols * 20 > word_chars"),
    Rule("duplicate_lines", "n_dup_lines * 2 > size(split(text, '\\n'))"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("capitals", "2 * length(regexp_replace(text, '[^\\\\p{Lu}]', '')) "
                     "> length(regexp_replace(text, '[^\\\\p{L}]', ''))"),
    Rule("ellipsis", "10 * size(filter(split(text, '\\n'), x -> endswith(rtrim(x), '...'))) "
                     "> 3 * size(split(text, '\\n'))"),
    Rule("letters", "2 * length(regexp_replace(text, '[^\\\\p{L}]', '')) < word_chars"),
]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _GAPS, " " * len(_GAPS)), " "), "")


def with_measures(df: DataFrame, text_col: str = "text", into: str = "measures") -> DataFrame:
    """``df`` with a struct of the base measures: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Repeated words: the 3-word windows of a text are sorted by hash and words,
    so equal ones are neighbours; the places they cover are counted once.
    The steps are columns of their own, because an array that a lambda reads
    must be computed once per row and not once per element.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = [F.col(f"`{c}`") for c in df.columns if c != into]
    steps = df.select(*kept, F.struct(_words(text).alias("words"), text.alias("text")).alias("__base"))
    words = F.col("__base.words")
    windows = F.when(F.size(words) >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("hash"),
                           F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"),
                           F.get(words, i + 2).alias("c"), i.alias("at"))))).otherwise(
        F.expr("CAST(array() AS array<struct<hash: bigint, a: string, b: string, c: string, at: int>>)"))
    steps = steps.select(*kept, "__base", windows.alias("__windows"))
    sorted_ = F.col("__windows")

    def same(x: Column, j: Column) -> Column:
        other = F.get(sorted_, j)
        return F.coalesce((x["hash"] == other["hash"]) & (x["a"] == other["a"]) & (x["b"] == other["b"])
                          & (x["c"] == other["c"]), F.lit(False))

    twice = F.filter(sorted_, lambda x, j: same(x, j - 1) | same(x, j + 1))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2))))
    base = F.col("__base.text")
    lines = F.filter(F.split(base, "\n"), lambda x: F.length(F.translate(x, _SPACES, "")) > 0)
    measures = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(base, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(base) - F.length(F.translate(base, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
    )
    return steps.select(*kept, measures.alias(into))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])


def _scope(df: DataFrame, text_col: str) -> DataFrame:
    """The names that a rule may use: the text and the measures."""
    return df.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), "measures.*")


def order_rules(df: DataFrame, rules: list[Rule], text_col: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per cost, measured on the sample."""
    sample = _scope(with_measures(df.select(text_col).limit(sample_rows), text_col), text_col).persist()
    try:
        rows = max(1, sample.count())

        def seconds(condition: Column) -> tuple[float, int]:
            began = time.perf_counter()
            hits = sample.agg(F.sum(condition.cast("int"))).first()[0] or 0
            return time.perf_counter() - began, hits

        idle = min(seconds(F.lit(False))[0] for _ in range(2))
        rated = []
        for rule in rules:
            runs = [seconds(F.expr(rule.rejects)) for _ in range(2)]
            cost = max(1e-4, min(s for s, _ in runs) - idle)
            rated.append((runs[0][1] / rows / cost, rule))
    finally:
        sample.unpersist()
    return [rule for _, rule in sorted(rated, key=lambda x: -x[0])]


def cascade(df: DataFrame, rules: list[Rule] | None = None, text_col: str = "text",
            ordered: list[Rule] | None = None) -> DataFrame:
    """``df`` with ``measures``, ``base_failed``, ``rejected_by`` (the first rule that rejects, or null) and ``kept``."""
    prepare(df.sparkSession)
    ordered = ordered or order_rules(df, rules or RULES, text_col)
    measured = with_measures(df.drop("base_failed", "rejected_by", "kept"), text_col)
    m = F.col("measures")
    # a rule's names stand for the measures and the text
    names = {n: f"measures.{n}" for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    names["text"] = f"coalesce(`{text_col}`, '')"
    verdict = F.when(base_failed(m), F.lit("base"))
    for rule in ordered:
        verdict = verdict.when(F.expr(_named(rule.rejects, names)), F.lit(rule.name))
    return (measured.withColumn("base_failed", base_failed(m)).withColumn("rejected_by", verdict)
            .withColumn("kept", F.col("rejected_by").isNull()))


def _named(expression: str, names: dict[str, str]) -> str:
    return re.sub(r"\b(" + "|".join(names) + r")\b", lambda x: names[x[0]], expression)
