"""Permutations by packed lists: many small lists, ties and texts give what a sort of the whole table gives."""

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from holdfast.plans import interpret


def test_small_lists_give_the_order_of_a_whole_sort(spark, monkeypatch):
    monkeypatch.setattr(interpret, "SENT_ROWS", 64)
    monkeypatch.setattr(interpret, "BUCKET_ROWS", 32)
    monkeypatch.setattr(interpret, "PLACES", 50)
    rows = [(i, None if i % 7 == 0 else i / 3.0, None if i % 11 == 0 else f"w{i}", i * 2**40) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, x double, w string, b long").repartition(3)
    found = {}
    for r in interpret.permuted(df, ["x", "w", "b"], ["id"], n_repeats=2, seed=5).collect():
        found.setdefault((r["column"], r["repeat"]), {})[r["id"]] = r[r["column"]]

    def order(*tags):
        return sorted(range(700), key=lambda i: (hashlib.md5("|".join(["5", *tags, str(i)]).encode()).hexdigest()[:13], i))

    home = order()
    assert len(found) == 6
    for (column, repeat), values in found.items():
        at = {"x": 1, "w": 2, "b": 3}[column]
        assert [values[i] for i in home] == [rows[i][at] for i in order(column, str(repeat))]


def test_equal_hashes_are_ordered_by_key(spark, monkeypatch):
    monkeypatch.setattr(interpret, "_numbers", lambda md5: interpret.np.zeros(len(md5), "int64"))
    df = spark.createDataFrame([(k, float(i)) for i, k in enumerate("dacb")], "k string, x double").repartition(2)
    handed = interpret._handed(df, [("x", 0)], ["double"], ["k"], 4, 1)
    assert [r["__v0"] for r in handed.orderBy("__place").collect()] == [1.0, 3.0, 2.0, 0.0]


def test_rows_do_not_fan_out_before_they_meet(house):
    made = interpret.permuted(house, ["median_income"], ["id"], n_repeats=2)
    text = made._jdf.queryExecution().executedPlan().toString()
    assert text.count("FlatMapGroupsInArrow") >= 1 and "collect_list" not in text


def test_numbers_are_those_of_spark(spark):
    texts = [hashlib.md5(str(i).encode()).hexdigest() for i in range(50)]
    from holdfast.functions.keys import hash_number

    known = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(hash_number(F.col("t"))).collect()]
    assert sorted(interpret._numbers(pa.array(texts)).tolist()) == sorted(known)
    assert interpret._numbers(pa.array(texts).slice(3, 2)).tolist() == [int(t[:13], 16) for t in texts[3:5]]


@pytest.mark.parametrize("n", [0, 1])
def test_hardly_any_rows(spark, n):
    df = spark.createDataFrame([(i, 2.5) for i in range(n)], "id long, x double")
    assert [r["x"] for r in interpret.permuted(df, ["x"], ["id"], n_repeats=1).collect()] == [2.5] * n


def test_no_list_is_held_and_columns_go_one_at_a_time(spark, house, monkeypatch):
    asked, made = [], interpret.permuted

    def recorded(df, columns, keys, **options):
        asked.append((columns, spark.conf.get(interpret._CLEANUP)))
        return made(df, columns, keys, **options)

    monkeypatch.setattr(interpret, "permuted", recorded)
    before, held = spark.conf.get(interpret._CLEANUP, None), spark.sparkContext._jsc.getPersistentRDDs().size()
    table = interpret.importance_table(interpret.LinearScorer({"median_income": 1.0}), house, ["id"], columns=["median_income", "ocean_proximity"], n_repeats=2)
    assert {r["column"] for r in table.collect()} == {"median_income", "ocean_proximity"}
    assert asked == [(["median_income"], "true"), (["ocean_proximity"], "true")]
    assert spark.conf.get(interpret._CLEANUP, None) == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
