import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdfast.llm import quality
from holdfast.llm.queries import op2_quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, repeat = len(words), len(covered)
    failed = n < 50 or 100 * repeat > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, failed


def measured(df):
    m = "quality_measures"
    return quality.judge(df).select("text", f"{m}.n_words", f"{m}.word_chars", f"{m}.n_symbols", f"{m}.n_dup_lines", f"{m}.n_repeat_words", "base_failed").collect()


def test_measures_against_brute_force(spark, awkward):
    for r in measured(awkward.select("doc_id", "text")):
        assert tuple(r[1:]) == brute(r["text"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("ab #\n\t", max_size=60), min_size=1, max_size=40))
def test_measures_of_any_text(spark, texts):
    for r in measured(spark.createDataFrame([(t,) for t in texts], "text string")):
        assert tuple(r[1:]) == brute(r["text"])


def test_query_against_brute_force_and_labels(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    quality_of = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op2_quality_rules(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(docs[r.doc_id])
        assert not (r.kept and r.base_failed)
        if r.doc_id in quality_of and not r.base_failed:
            assert r.kept == (quality_of[r.doc_id] == 1)


def test_rules_bound_both_sides_and_name_what_is_broken(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,), (None,)], "x double")
    (broken,) = quality.compile_rules([quality.Rule("x", 2.0, 4.0)])
    assert [r[0] for r in df.select(broken).collect()] == [True, False, True, False]
    with pytest.raises(ValueError):
        quality.compile_rules([quality.Rule("x")])


def test_no_user_function_and_no_shuffle(awkward):
    plan = quality.judge(awkward.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan


def test_kept_only_keeps_columns_and_rows(awkward, nothing):
    kept = quality.kept_only(awkward)
    assert kept.columns == awkward.columns
    assert {r["doc_id"] for r in kept.collect()} <= {1, 7}
    assert quality.kept_only(nothing).count() == 0
    assert quality.judge(nothing.select("text")).filter(F.col("kept")).count() == 0
