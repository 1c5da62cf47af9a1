"""Splits, folds and samples: exact, seeded, partition-independent, hot groups included."""

import pytest
from pyspark.sql import functions as F

from holdfast.functions import expressions as fx
from holdfast.operators import rank, split
from holdfast.operators.rank import global_rank

SEEDS = [0, 1, 7, 42, 2024]


def test_sides_partition_the_table(house, sides):
    row = split.split_partition_check(house, *sides, ["id"]).first()
    assert (row["on_both"], row["lost"], row["added"]) == (0, 0, 0)
    assert row["n_test"] == -(-house.count() // 5)


@pytest.mark.parametrize("seed", SEEDS)
def test_rare_level_is_on_both_sides_at_every_seed(house, seed):
    found = split.strata(house, fx.income_band(), F.col("ocean_proximity"))
    report = split.coverage_report(split.with_side(house, found, ["id"], seed=seed))
    island = report.where("ocean_proximity = 'ISLAND'").first()
    assert (island["train"], island["test"]) == (4, 1)


def test_band_alone_leaves_the_rare_level_to_luck(house):
    naive = split.coverage_by_seed(house, split.naive_strata(house, fx.income_band()), ["id"], range(30), "ocean_proximity")
    shares = {r["test"] for r in naive.where("ocean_proximity = 'ISLAND'").collect()}
    assert 0 in shares and len(shares) > 1


def test_same_split_at_any_partitioning(house, sides):
    want = {r["id"] for r in sides[1].select("id").collect()}
    for n in (1, 16):
        _, test = split.split_train_test(house.repartition(n), ["id"])
        assert {r["id"] for r in test.select("id").collect()} == want


def test_seeds_differ(house):
    found = split.strata(house, fx.income_band(), F.col("ocean_proximity"))
    a, b = (split.with_side(house, found, ["id"], seed=s).where("side = 'test'").select("id") for s in (1, 2))
    assert a.exceptAll(b).count() > 0


def test_singleton_group_collapses_its_whole_level(frame):
    rows = [(i, 2.0 if i % 2 else 3.5, "INLAND") for i in range(40)] + [(100 + i, 2.0, "ISLAND") for i in range(4)]
    df = frame([*rows, (200, 3.5, "ISLAND")], "id int, median_income double, ocean_proximity string")
    found = split.strata(df, fx.income_band(), F.col("ocean_proximity"))
    assert found.collapsed == ["ISLAND"] and found.sizes["ISLAND"] == 5
    assert found.sizes["2|INLAND"] == 20
    table = split.stratum_table(df, fx.income_band(), F.col("ocean_proximity"))
    assert {r["stratum"]: r["count"] for r in table.groupBy("stratum").count().collect()} == found.sizes


def test_single_row_level_is_refused_by_name(frame):
    rows = [(i, 2.0, "INLAND") for i in range(40)] + [(100, 2.0, "ISLAND")]
    df = frame(rows, "id int, median_income double, ocean_proximity string")
    with pytest.raises(ValueError, match="ISLAND"):
        split.split_train_test(df, ["id"])


def test_null_band_and_null_level_are_strata_of_their_own(frame):
    rows = [(i, None, "INLAND") for i in range(10)] + [(50 + i, 2.0, None) for i in range(10)]
    df = frame(rows, "id int, median_income double, ocean_proximity string")
    found = split.strata(df, fx.income_band(), F.col("ocean_proximity"))
    assert found.sizes == {"<NA>|INLAND": 10, "2|None": 10}
    train, test = split.split_train_test(df, ["id"])
    assert (train.count(), test.count()) == (16, 4)


def test_allocation_is_by_largest_remainder():
    assert split.allocate({"a": 5, "b": 95}, 0.2) == {"a": 1, "b": 19}
    sizes = {f"s{i}": 3 for i in range(7)}
    taken = split.allocate(sizes, 0.2)
    assert sum(taken.values()) == 5 and max(taken.values()) <= 1


@pytest.mark.parametrize("k", [2, 5, 7])
def test_folds_differ_by_at_most_one_and_the_first_are_larger(house, k):
    n = house.count()
    sizes = [r["count"] for r in split.with_fold(house, ["id"], k).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [n // k + (i < n % k) for i in range(k)]


def test_folds_do_not_depend_on_partitioning(house):
    want = {tuple(r) for r in split.with_fold(house, ["id"]).select("id", "fold").collect()}
    assert {tuple(r) for r in split.with_fold(house.repartition(13), ["id"]).select("id", "fold").collect()} == want


@pytest.mark.parametrize("n", [1, 100, 1499, 1500, 9999])
def test_sample_is_exact(house, n):
    assert split.sample_n(house, n, ["id"]).count() == min(n, house.count())


def test_hot_stratum_and_many_buckets(spark, monkeypatch):
    """Two thirds of the rows in one group; the search is forced through every pass."""
    monkeypatch.setattr(rank, "RANKED_ROWS", 0)
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5)).alias("lv"))
    found = split.strata(df, F.lit(1), F.col("lv"))
    sided = split.with_side(df, found, ["id"])
    got = {r["lv"]: r["n"] for r in sided.where("side = 'test'").groupBy("lv").agg(F.count("*").alias("n")).collect()}
    want = split.allocate(found.sizes, 0.2)
    assert got == {k.split("|")[1]: v for k, v in want.items()}


def test_many_strata_take_the_broadcast_table(house, monkeypatch):
    want = {tuple(r) for r in sided_ids(house)}
    monkeypatch.setattr(rank, "LITERAL_GROUPS", 0)
    assert {tuple(r) for r in sided_ids(house)} == want


def sided_ids(house):
    found = split.strata(house, fx.income_band(), F.col("ocean_proximity"))
    return split.with_side(house, found, ["id"]).select("id", "side").collect()


@pytest.mark.parametrize("bits, left", [(3, 50), (10, 300), (52, 0)])
def test_cuts_do_not_depend_on_the_passes(house, monkeypatch, bits, left):
    want = {tuple(r) for r in split.with_fold(house, ["id"], 7).select("id", "fold").collect()}
    monkeypatch.setattr(rank, "RANKED_ROWS", left)
    monkeypatch.setattr(rank, "PASS_BITS", min(bits, 30))
    assert {tuple(r) for r in split.with_fold(house, ["id"], 7).select("id", "fold").collect()} == want


def test_keys_that_do_not_tell_rows_apart_are_refused(frame):
    df = frame([(1,)] * 20, "id int")
    with pytest.raises(ValueError, match="key columns"):
        split.sample_n(df, 5, ["id"])


def test_global_rank_is_exact_over_many_buckets(house, monkeypatch):
    from holdfast.functions.keys import hash_number, seeded_md5

    monkeypatch.setattr(rank, "prefix_bits", lambda n, per_bucket: 6)
    ranked = global_rank(house.select("id"), hash_number(seeded_md5(42, ["id"])), "place", house.count(), ties=["id"])
    rows = ranked.select("id", "place", F.md5(F.concat_ws("|", F.lit("42"), "id")).alias("m")).collect()
    assert [r["place"] for r in sorted(rows, key=lambda r: r["m"])] == list(range(1, 1501))


def test_the_split_is_a_filter_not_a_shuffle(house, plan):
    found = split.strata(house, fx.income_band(), F.col("ocean_proximity"))
    sided = split.with_side(house, found, ["id"])
    tree = plan(sided)
    assert "Exchange" not in tree.split("InMemoryTableScan")[0] and "Window" not in tree.split("InMemoryTableScan")[0]


def test_strata_in_a_table_give_the_listed_split(house, monkeypatch):
    """Hot strata go through several buckets; sides, refusals and coverage are those of the listed strata."""
    band, level = fx.income_band(), F.col("ocean_proximity")
    listed = split.strata(house, band, level)
    want = {tuple(r) for r in sided_ids(house)}
    by_seed = split.coverage_by_seed(house, listed, ["id"], [1, 2], "ocean_proximity").collect()
    monkeypatch.setattr(split, "LISTED_STRATA", 3)
    monkeypatch.setattr(rank, "ROWS_PER_BUCKET", 16)
    found = split.strata(house, band, level)
    assert found.sizes is None and {tuple(r) for r in found.size_table.collect()} == set(listed.sizes.items())
    sided = split.with_side(house, found, ["id"])
    assert set(sided.columns) == {*house.columns, "side"}
    assert {tuple(r) for r in sided.select("id", "side").collect()} == want == {tuple(r) for r in sided_ids(house)}
    assert split.coverage_by_seed(house, found, ["id"], [1, 2], "ocean_proximity").collect() == by_seed
    with pytest.raises(ValueError, match="Cannot stratify"):
        split.strata(house, band, level, min_per_stratum=10_000)


def test_strata_in_a_table_collapse_refuse_equal_keys_and_allow_none(frame, monkeypatch):
    monkeypatch.setattr(split, "LISTED_STRATA", 1)
    monkeypatch.setattr(rank, "ROWS_PER_BUCKET", 2)
    rows = [(i, i % 3, "big") for i in range(60)] + [(100 + i, i, "rare") for i in range(3)] + [(200 + i, None, None) for i in range(7)]
    df = frame(rows, "id int, b int, lv string")
    found = split.strata(df, F.col("b"), F.col("lv"))
    assert {tuple(r) for r in found.size_table.collect()} == {("0|big", 20), ("1|big", 20), ("2|big", 20), ("rare", 3), ("<NA>|None", 7)}
    sizes = {r["stratum"]: r["n"] for r in found.size_table.collect()}
    given = {r["stratum"]: r["n_test"] for r in split.allocate_table(found.size_table, 0.2).collect()}
    assert given == split.allocate(sizes, 0.2)
    assert split.with_side(df, found, ["id"]).where("side = 'test'").count() == sum(given.values())
    same = df.withColumn("id", F.lit(1))
    with pytest.raises(Exception, match="tell rows apart"):
        split.with_side(same, split.strata(same, F.col("b"), F.col("lv")), ["id"]).collect()


def test_level_codes(frame):
    from holdfast.operators.order import LevelCodes

    df = frame([(1, "b"), (2, None), (3, "a"), (4, "b"), (5, "")], "code int, value string")
    codes = LevelCodes.fit(df, "value")
    later = codes.transform(df.unionByName(frame([(6, "zz")], "code int, value string")))
    assert sorted(map(tuple, later.collect())) == [(1, 2.0), (2, -1.0), (3, 1.0), (4, 2.0), (5, 0.0), (6, -1.0)]
    assert LevelCodes.fit(df.limit(0), "value").transform(df).where("value <> -1").count() == 0
