"""Quality rules as a short-circuit cascade, in built-in functions alone.

Every rule is a predicate that rejects a document. On a sample of bounded size the operator
estimates the share that each rule rejects and what it costs: the sample is repeated until
it has TIMED characters, each rule is counted over it, and the time beyond that of a count
alone is the rule's cost. Rules are ordered by rejection per cost. The cascade is one CASE
expression: Spark evaluates its branches in turn and stops at the first that holds.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, materialize, words_of

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Characters over which each rule is timed.
TIMED = 1 << 23


def measures(text: Column) -> Column:
    """A struct of the base measures of a text (null: no words): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    whole = F.coalesce(text, F.lit(""))
    kept = lambda chars: F.length(F.translate(whole, chars, ""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    # The hash of the window that starts at each word but the last two.
    grams = lambda ws: F.slice(F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2))), F.lit(1), F.greatest(F.size(ws) - 2, F.lit(0)))
    # Windows in the order of their hash: one that equals a neighbour occurs twice or more.
    ordered = lambda g: F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    repeated = lambda s: F.filter(
        F.transform(s, lambda x, k: F.when((x["g"] == F.get(s, k - 1)["g"]) | (x["g"] == F.get(s, k + 1)["g"]), x["i"])), lambda i: i.isNotNull()
    )
    # Each repeated window covers its words up to the next repeated one.
    covered = lambda p: F.aggregate(
        p,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    of_words = lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        let(grams(ws), in_repeated).cast("long").alias("n_repeat_words"),
    )
    # Most texts repeat no window: telling so takes no sort.
    in_repeated = lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(F.sort_array(let(ordered(g), repeated)))).otherwise(0)
    counted = let(words_of(text), of_words)
    dup = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return let(
        counted,
        lambda c: F.struct(
            c["n_words"].alias("n_words"),
            kept(SPACES).cast("long").alias("word_chars"),
            (F.length(whole) - kept(SYMBOLS)).cast("long").alias("n_symbols"),
            dup.cast("long").alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


@dataclass(frozen=True)
class Rule:
    """`rejects`: a predicate; null counts as no."""

    name: str
    rejects: Column


def default_rules(text: str = "text") -> list[Rule]:
    """Rules beyond the base ones, over the columns of `measures` and the text itself."""
    t, c = F.coalesce(F.col(text), F.lit("")), F.col
    letters = lambda: F.length(F.regexp_replace(t, "\\P{L}+", ""))
    capitals = lambda: F.length(F.regexp_replace(t, "\\P{Lu}+", ""))
    return [
        Rule("word_length", (c("word_chars") > 20 * c("n_words")) | (c("word_chars") < 2 * c("n_words"))),
        Rule("symbols", 5 * c("n_symbols") > c("n_words")),
        Rule("dup_lines", 10 * c("n_dup_lines") > 3 * F.size(F.split(t, "\n"))),
        Rule("exclamations", 10 * (F.length(t) - F.length(F.translate(t, "!?", ""))) > 3 * c("n_words")),
        Rule("letters", 2 * letters() < c("word_chars")),
        Rule("capitals", 10 * capitals() > 3 * F.greatest(F.lit(30), letters())),
    ]


def costs(df: DataFrame, rules: list[Rule], text: str = "text") -> list[float]:
    """Nanoseconds a document that each rule takes, measured on the rows of `df`: the best of two counts, less a count alone, to the nearest power of two.

    Rounded, so that runs of one machine mostly agree. The rows are repeated until they have
    TIMED characters, so the time is the rule's and not that of starting a job.
    """
    size = df.agg(F.count("*").alias("rows"), F.sum(F.length(F.col(text))).alias("chars")).first()
    if not size["rows"]:
        return [1.0] * len(rules)
    copies = max(1, TIMED // max(size["rows"], size["chars"] or 0))
    many = df.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias(free_name(df, "copy")))

    def seconds(predicate: Column) -> float:
        took = []
        for _ in range(2):
            start = time.perf_counter()
            many.agg(F.count_if(predicate)).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    base = seconds(F.length(F.col(text)) < 0)
    spent = [max(1.0, (seconds(r.rejects) - base) * 1e9 / (size["rows"] * copies)) for r in rules]
    return [2.0 ** round(math.log2(x)) for x in spent]


def cascade(df: DataFrame, rules: list[Rule], text: str = "text") -> list[Rule]:
    """The rules, ordered by rejection per cost as the rows, a sample with its measures, show them; ties by cost, then name.

    The order decides what work is saved, never which documents are rejected, so the
    sample bounds nothing else.
    """
    df = materialize(df)
    aggs = [F.avg(F.coalesce(r.rejects, F.lit(False)).cast("double")).alias(f"r{i}") for i, r in enumerate(rules)]
    rejected, cost = df.agg(*aggs).first() if rules else {}, costs(df, rules, text)
    order = sorted(range(len(rules)), key=lambda i: (-(rejected[f"r{i}"] or 0.0) / cost[i], cost[i], rules[i].name))
    return [rules[i] for i in order]


def quality_filter(df: DataFrame, text: str = "text", min_words: int = 50, max_repeat: int = 50, rules: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """Add the base measures, `base_failed`, `kept` and `rejected_by` (the first rule of the cascade that rejects; null if kept).

    Null and empty texts have no words and fail the base rules (rejected_by: base).
    Rows repeat independently; an empty table gives an empty result. Columns with the
    added names are replaced. Whole texts count, however long. Which of several rules that
    reject a document is named depends on their order, and so on the measured costs.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    df = df.drop(*names, "base_failed", "kept", "rejected_by")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))

    def measured(rows: DataFrame) -> DataFrame:
        m = free_name(rows, "measures")
        rows = rows.withColumn(m, measures(F.col(text)))
        return rows.select(*df.columns, *[F.col(m)[n].alias(n) for n in names]).withColumn("base_failed", base)

    # About `sample_rows` rows, sampled before they are measured.
    share = min(1.0, sample_rows / max(1, df.count()))
    ordered = cascade(measured(df.sample(fraction=share, seed=17)), default_rules(text) if rules is None else rules, text)
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for r in ordered:
        verdict = verdict.when(F.coalesce(r.rejects, F.lit(False)), F.lit(r.name))
    return measured(df).withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())
