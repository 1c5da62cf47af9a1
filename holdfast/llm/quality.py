"""Quality rules: a table of thresholds compiled into one projection of text measures.

Each rule bounds one measure from below, above or both; ``compile_rules`` turns the table into boolean columns, so all
rules together are one narrow stage without a shuffle and without user functions. Repeated three-word windows are
found by sorting a text's own window hashes (64 bits, seeded per word), n log n in its length.

Null and empty texts have no words and fail the rule on the number of words. Texts of fewer than three words have no
window. Null ids and extra columns pass through. Rows alike get rows alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import SPACE_RUN, text_of, words_of


class Rule(NamedTuple):
    """Reject a text whose ``measure`` is under ``low`` or over ``high``; None: no bound."""

    measure: str
    low: float | None = None
    high: float | None = None


#: Very common words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from he in is it of on or that the this to was were with you "
    "au aux avec ce des du elle en et il la le les ne ou par pas pour que qui sur un une "
    "auf das dem den der des die ein eine er es ist mit nicht sich sie und von zu "
    "con de del el ella en esta las lo los no para por se su una y"
).split()

#: The rules that decide ``kept``, besides the two of ``BASE_RULES``.
RULES = (
    Rule("mean_word_chars", 2.5, 12.0),
    Rule("symbol_ratio", None, 0.10),
    Rule("stop_ratio", 0.01, None),
    Rule("alpha_word_ratio", 0.70, None),
    Rule("upper_ratio", None, 0.40),
    Rule("dup_line_ratio", None, 0.40),
    Rule("ellipsis_line_ratio", None, 0.30),
    Rule("bullet_line_ratio", None, 0.90),
)
BASE_RULES = (Rule("n_words", 50, None), Rule("repeat_percent", None, 50))


def compile_rules(rules: Sequence[Rule]) -> list[Column]:
    """One boolean column per rule, true where it is broken; a null measure breaks none."""
    broken = []
    for rule in rules:
        value = F.col(rule.measure)
        tests = [value < rule.low] if rule.low is not None else []
        tests += [value > rule.high] if rule.high is not None else []
        if not tests:
            raise ValueError(f"the rule on {rule.measure} has no bound")
        test = tests[0] if len(tests) == 1 else tests[0] | tests[1]
        broken.append(F.coalesce(test, F.lit(False)))
    return broken


def measure(docs: DataFrame, *, text: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``docs`` with a struct column ``quality_measures``: counts (long) and ratios (double) of the whole text."""
    stops = sorted({form for word in stop_words for form in (word, word.capitalize())})
    words, lines, windows = F.col("_words"), F.col("_lines"), F.col("_windows")
    taken = {"_text", "_words", "_lines", "_windows", "quality_measures"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are used by the operator")
    step = docs.withColumn("_text", text_of(text))
    step = step.withColumns({
        "_words": words_of(F.col("_text")),
        "_lines": F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })
    ends = F.size(words) - 3
    step = step.withColumn(
        "_windows",
        F.when(ends >= 0, F.sort_array(F.transform(
            F.sequence(F.lit(0), F.greatest(ends, F.lit(0))),
            lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
        ))),
    )
    again = F.filter(
        F.transform(windows, lambda w, j: F.when((w["h"] == F.get(windows, j - 1)["h"]) | (w["h"] == F.get(windows, j + 1)["h"]), w["i"])),
        lambda i: i.isNotNull(),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda i: F.array(i, i + 1, i + 2)))))
    counts = step.select(
        *docs.columns,
        # Nothing that depends on a row number is pushed down: a filter on the verdict must not measure texts a second time.
        F.monotonically_increasing_id().alias("_mark"),
        F.size(words).cast("long").alias("_n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("_word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("_n_symbols"),
        F.size(lines).cast("long").alias("_n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("_n_dup_lines"),
        F.when(windows.isNull(), F.lit(0)).otherwise(covered).cast("long").alias("_n_repeat_words"),
        F.size(F.filter(words, lambda word: word.isin(stops))).cast("long").alias("_n_stop"),
        F.regexp_count("_text", F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])")).cast("long").alias("_n_no_letter"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("_n_upper"),
        F.regexp_count("_text", F.lit(r"(?m)(?:\.\.\.|\x{2026})[\x20\x09\x0D]*$")).cast("long").alias("_n_ellipsis"),
        F.regexp_count("_text", F.lit(r"(?m)^[\x20\x09]*(?:[-*\x{2022}])[\x20\x09]")).cast("long").alias("_n_bullet"),
    )
    per_word = lambda c: F.try_divide(F.col(c).cast("double"), F.col("_n_words"))
    per_line = lambda c: F.try_divide(F.col(c).cast("double"), F.col("_n_lines"))
    return counts.select(
        *docs.columns,
        F.struct(
            F.col("_n_words").alias("n_words"),
            F.col("_word_chars").alias("word_chars"),
            F.col("_n_symbols").alias("n_symbols"),
            F.col("_n_dup_lines").alias("n_dup_lines"),
            F.col("_n_repeat_words").alias("n_repeat_words"),
            per_word("_word_chars").alias("mean_word_chars"),
            per_word("_n_symbols").alias("symbol_ratio"),
            per_word("_n_stop").alias("stop_ratio"),
            (F.lit(1.0) - per_word("_n_no_letter")).alias("alpha_word_ratio"),
            F.try_divide(F.col("_n_upper").cast("double"), F.col("_word_chars")).alias("upper_ratio"),
            per_line("_n_dup_lines").alias("dup_line_ratio"),
            per_line("_n_ellipsis").alias("ellipsis_line_ratio"),
            per_line("_n_bullet").alias("bullet_line_ratio"),
            (per_word("_n_repeat_words") * 100).alias("repeat_percent"),
            F.col("_mark").alias("mark"),
        ).alias("quality_measures"),
    )


def judge(docs: DataFrame, *, text: str = "text", rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """``docs`` with ``quality_measures``, ``base_failed``, ``kept`` and ``broken_rules`` (names, in the table's order)."""
    clash = {"base_failed", "kept", "broken_rules"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are the operator's results")
    table = [*base, *rules]
    at = [r._replace(measure=f"quality_measures.{r.measure}") for r in table]
    broken = compile_rules(at)
    failed = broken[0]
    for test in broken[1 : len(base)]:
        failed = failed | test
    names = F.array_compact(F.array(*[F.when(b, F.lit(r.measure)) for b, r in zip(broken, table, strict=True)]))
    judged = measure(docs, text=text).withColumn("broken_rules", names).withColumn("base_failed", failed)
    return judged.withColumn("kept", (F.size("broken_rules") == 0) & (F.col("quality_measures.mark") >= 0))


def kept_only(docs: DataFrame, *, text: str = "text", rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, with the columns of ``docs`` whatever their names."""
    parts = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    return judge(parts, rules=rules, base=base).filter("kept").select("row.*")
