"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

A document stays when every rule passes it. The verdict is a conjunction, so the order of the rules
changes only the work: a rule is evaluated for a document only while all rules before it have
passed. ``plan_order`` estimates each rule's selectivity (the share that it rejects) and cost (the
time of evaluating it alone) on a sample, and sorts by rejection per cost.

The words of a text are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words and fail the
rule on the number of words. Extra columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import let, text_of, words

#: The symbols that count as markup.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows of the sample on which cost and selectivity are estimated, and the longest text in it.
SAMPLE_ROWS, SAMPLE_TEXT = 200, 100_000


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are in ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(lines_with_words(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))


def repeated_words(ws: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more, the first one included.

    Hashes of the windows tell the texts without any repetition; the others compare the windows
    themselves: sorted with their positions, equal neighbours mark the repeated places.
    """
    starts = F.sequence(F.lit(0), F.size(ws) - window)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(ws, i + 1, window)))
    placed = F.sort_array(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(ws, i + 1, window), " ").alias("g"), i.alias("p"))))

    def repeated(s: Column) -> Column:
        same = lambda a, k: F.coalesce(F.get(s, k)["g"] == a["g"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda a, k: same(a, k - 1) | same(a, k + 1)), lambda a: a["p"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    exact = let(let(placed, repeated), covered)
    unrepeated = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(F.size(ws) <= window, F.lit(0)).when(unrepeated, F.lit(0)).otherwise(exact).cast("long")


@dataclass(frozen=True)
class Rule:
    """A named test; ``rejects`` gets the text and its words and is true where the text fails."""

    name: str
    rejects: Callable[[Column, Column], Column]


def _stutter(ws: Column) -> Column:
    return F.size(F.filter(ws, lambda w, k: (k > 0) & (w == F.get(ws, k - 1))))


def _with_letter(ws: Column) -> Column:
    return F.size(F.filter(ws, lambda w: w.rlike(r"\p{L}")))


def _share_of_lines(text: Column, pattern: str) -> Column:
    return let(lines_with_words(text), lambda x: F.size(F.filter(x, lambda line: line.rlike(pattern))) / F.greatest(F.size(x), F.lit(1)))


#: The two rules that the base verdict has.
TOO_SHORT = Rule("too_few_words", lambda t, ws: F.size(ws) < 20)
REPETITIVE = Rule("repeated_windows", lambda t, ws: 100 * repeated_words(ws) > 30 * F.size(ws))
BASE_RULES = (TOO_SHORT, REPETITIVE)
RULES = (
    *BASE_RULES,
    Rule("symbols_per_word", lambda t, ws: 5 * count_of(t, SYMBOLS) > F.size(ws)),
    Rule("shouting", lambda t, ws: let(F.length(F.regexp_replace(t, r"[^\p{L}]+", "")), lambda n: 10 * F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")) > 6 * n)),
    Rule("word_length", lambda t, ws: let(word_chars(t), lambda n: (2 * n < 5 * F.size(ws)) | (n > 14 * F.size(ws)))),
    Rule("stuttering", lambda t, ws: 10 * _stutter(ws) > 3 * F.size(ws)),
    Rule("duplicate_lines", lambda t, ws: 10 * duplicate_lines(t) > 3 * F.size(lines_with_words(t))),
    Rule("words_without_letters", lambda t, ws: 10 * _with_letter(ws) < 6 * F.size(ws)),
    Rule("bullet_lines", lambda t, ws: (F.size(ws) > 0) & (_share_of_lines(t, r"^\s*[-*•]") > 0.9)),
    Rule("ellipsis_lines", lambda t, ws: _share_of_lines(t, r"(\.\.\.|…)\s*$") > 0.3),
)


def cascade(rules: Sequence[Rule], text: Column, ws: Column) -> Column:
    """True where all rules pass; a rule is evaluated only where the rules before it passed."""
    verdict = None
    for rule in rules:
        failed = F.coalesce(rule.rejects(text, ws), F.lit(True))
        verdict = F.when(failed, F.lit(False)) if verdict is None else verdict.when(failed, F.lit(False))
    return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def plan_order(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost, as a sample of at most ``rows`` rows shows them.

    The sample is what a few partitions give first, thinned with a fixed seed; it affects the order
    only. Without rows the order is as given.
    """
    spark = docs.sparkSession
    thin = docs.select(text_of(docs, text_col).alias("text")).sample(0.25, 7).filter(F.length("text") <= SAMPLE_TEXT)
    taken = thin.take(rows) or docs.select(text_of(docs, text_col).alias("text")).filter(F.length("text") <= SAMPLE_TEXT).take(rows)
    if not taken:
        return list(rules)
    sample = spark.createDataFrame(taken, "text string").coalesce(1)

    def trial(tests: Sequence[Rule]) -> tuple[float, list[int]]:
        flags = let(words(F.col("text")), lambda ws: F.struct(F.size(ws).alias("n"), *[F.coalesce(r.rejects(F.col("text"), ws), F.lit(True)).alias(f"r{k}") for k, r in enumerate(tests)]))
        job = sample.select(flags.alias("f")).agg(F.sum("f.n").alias("n"), *[F.count_if(F.col(f"f.r{k}")).alias(f"r{k}") for k in range(len(tests))])
        began = time.perf_counter()
        found = job.first()
        return time.perf_counter() - began, [found[f"r{k}"] for k in range(len(tests))]

    trial(rules)
    floor, _ = trial(())
    worth = {}
    for rule in rules:
        took, (rejected,) = trial((rule,))
        worth[rule.name] = (rejected / len(taken)) / max(took - floor, 1e-4)
    return sorted(rules, key=lambda r: -worth[r.name])


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", order: Sequence[Rule] | None = None) -> DataFrame:
    """The rows that every rule passes, with all their columns."""
    order = plan_order(docs, rules, text_col) if order is None else order
    text = text_of(docs, text_col)
    return docs.filter(let(words(text), lambda ws: cascade(order, text, ws)))


def quality_report(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", order: Sequence[Rule] | None = None) -> DataFrame:
    """Per row: id, the measures of the base rules, ``base_failed`` and ``kept``."""
    order = plan_order(docs, rules, text_col) if order is None else order
    rest = [r for r in order if r not in BASE_RULES]
    text = F.col("text")

    def measures(ws: Column) -> Column:
        return let(repeated_words(ws), lambda repeated: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            repeated.alias("n_repeat_words"),
            ((F.size(ws) < 20) | (100 * repeated > 30 * F.size(ws))).alias("base_failed"),
            F.when((F.size(ws) < 20) | (100 * repeated > 30 * F.size(ws)), F.lit(False)).otherwise(cascade(rest, text, ws)).alias("kept"),
        ))

    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return rows.select(
        "id",
        let(words(text), measures).alias("m"),
        word_chars(text).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        duplicate_lines(text).cast("long").alias("n_dup_lines"),
    ).select(
        F.col("id").alias(id_col), "m.n_words", "word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words", "m.base_failed", "m.kept",
    )
