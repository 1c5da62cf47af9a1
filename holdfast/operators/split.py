"""Stratified split, folds and samples: exact sizes, seeded, the same in every engine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import config
from holdfast.functions import expressions as fx
from holdfast.functions.keys import hash_number, key_text, seeded_md5
from holdfast.operators.order import settled, with_place
from holdfast.operators.rank import cut_table, hash_cuts, up_to_cut

#: Strata that are listed on the driver; more of them stay a table.
LISTED_STRATA = 10_000


@dataclass(frozen=True)
class Strata:
    """A fitted stratification: the key expression, its group sizes, the levels that collapsed.

    Of more than ``LISTED_STRATA`` strata sizes and collapsed levels are tables (``stratum, n`` and ``level``); then
    ``sizes`` is None and ``key`` is the stratum of a level that didn't collapse.
    """

    key: Column
    sizes: dict[str, int] | None
    collapsed: list[str]
    size_table: DataFrame | None = None
    collapsed_table: DataFrame | None = None
    text: Column | None = None

    def keyed(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with its stratum as column ``name``."""
        if self.collapsed_table is None:
            return df.withColumn(name, self.key)
        small = self.collapsed_table.select(F.col("level").alias("__level"), F.lit(True).alias("__small"))
        joined = df.withColumn("__level", self.text).join(small, "__level", "left")
        stratum = F.when(F.col("__small"), F.col("__level")).otherwise(self.key)
        return joined.withColumn(name, stratum).drop("__level", "__small")


def strata(
    df: DataFrame, band: Column, level: Column, *, min_per_stratum: int = 2, check: bool = True
) -> Strata:
    """``band|level``, except that a level with any group too small is one stratum on its own."""
    text, full = fx.level_text(level), fx.composite_key(band, level)
    groups = df.groupBy(full.alias("key"), text.alias("level")).count()
    counts = groups.limit(LISTED_STRATA + 1).collect()
    if len(counts) > LISTED_STRATA:
        groups = settled(groups)
        marked = _marked(groups, "level", "small", min_per_stratum)
        key = F.when(F.col("small"), F.col("level")).otherwise(F.col("key"))
        sizes = settled(marked.groupBy(key.alias("stratum")).agg(F.sum("count").alias("n")))
        found = Strata(full, None, [], sizes, marked.where("small").select("level").distinct(), text)
    else:
        collapsed = sorted({r["level"] for r in counts if r["count"] < min_per_stratum})
        listed: dict[str, int] = {}
        for r in counts:
            key = r["level"] if r["level"] in collapsed else r["key"]
            listed[key] = listed.get(key, 0) + r["count"]
        found = Strata(F.when(text.isin(collapsed), text).otherwise(full) if collapsed else full, listed, collapsed)
    if check:
        refuse_small(found, min_per_stratum)
    return found


def _marked(groups: DataFrame, level: str, name: str, least: int) -> DataFrame:
    """``groups`` with column ``name``: has their level a group of fewer than ``least`` rows?

    A level may hold any number of groups, so its smallest is found by partial sums and joined; a window would put all
    groups of a level into one task. Levels are joined without a hint: there may be few or many.
    """
    smallest = groups.groupBy(level).agg((F.min("count") < least).alias(name))
    return groups.join(smallest, level)


def refuse_small(found: Strata, min_per_stratum: int) -> None:
    if found.sizes is None:
        few = found.size_table.where(F.col("n") < min_per_stratum).orderBy("stratum").limit(20)
        small = {r["stratum"]: r["n"] for r in few.collect()}
    else:
        small = {k: n for k, n in sorted(found.sizes.items()) if n < min_per_stratum}
    if small:
        raise ValueError(f"Cannot stratify: fewer than {min_per_stratum} rows even after collapsing: {small}")


def stratum_table(df: DataFrame, band: Column, level: Column, *, min_per_stratum: int = 2) -> DataFrame:
    """Every row with its stratum, as one lazy plan: counts, smallest count per level, join back."""
    rows = df.withColumn("__level", fx.level_text(level)).withColumn("__full", fx.composite_key(band, level))
    groups = _marked(rows.groupBy("__level", "__full").count(), "__level", "__small", min_per_stratum).drop("count")
    # No hint: the group table is small as a rule, and the optimizer knows its size at run time.
    return (
        rows.join(groups, ["__level", "__full"])
        .withColumn("stratum", F.when(F.col("__small"), F.col("__level")).otherwise(F.col("__full")))
        .drop("__level", "__full", "__small")
    )


def allocate(sizes: dict[str, int], test_size: float) -> dict[str, int]:
    """Test rows per stratum: the train side is dealt by largest remainder, ties by name."""
    total = sum(sizes.values())
    n_test = -int(-total * test_size // 1)
    n_train = total - n_test
    train = {k: n * n_train // total for k, n in sizes.items()}
    by_remainder = sorted(sizes, key=lambda k: (-(sizes[k] * n_train % total), k))
    for k in by_remainder[: n_train - sum(train.values())]:
        train[k] += 1
    return {k: n - train[k] for k, n in sizes.items()}


def allocate_table(sizes: DataFrame, test_size: float) -> DataFrame:
    """stratum, n, n_test: ``allocate`` for strata in a table. Remainders are ranked by range partitions."""
    total = sizes.agg(F.sum("n")).first()[0]
    n_train = total + int(-total * test_size // 1)
    # n * n_train may pass 64 bits.
    dealt = F.expr(f"cast(n as decimal(19, 0)) * cast({n_train} as decimal(19, 0))")
    parts = sizes.withColumn("__dealt", dealt).withColumns({
        "__train": F.expr(f"__dealt div cast({total} as decimal(19, 0))"),
        "__rest": F.expr(f"cast(__dealt % cast({total} as decimal(19, 0)) as bigint)"),
    })
    placed = with_place(parts.drop("__dealt"), [F.desc("__rest"), F.col("stratum")], "__place")
    left = n_train - placed.agg(F.sum("__train")).first()[0]
    train = F.col("__train") + (F.col("__place") <= left).cast("bigint")
    return placed.select("stratum", "n", (F.col("n") - train).alias("n_test"))


def with_side(
    df: DataFrame,
    found: Strata,
    keys: Sequence[str],
    *,
    test_size: float = 0.2,
    seed=config.RANDOM_SEED,
) -> DataFrame:
    """Add ``side`` = train/test. Two small jobs find the cuts; the result is a narrow projection.

    Strata in a table have their cuts in a table, which the rows are joined with.
    """
    number = hash_number(seeded_md5(seed, keys))
    if found.sizes is None:
        rows = found.keyed(df, "__stratum").withColumn("__h", number)
        wanted = allocate_table(found.size_table, test_size).withColumnRenamed("stratum", "__stratum")
        cuts = cut_table(rows.select("__stratum", "__h"), wanted.withColumnRenamed("n_test", "r"), ["__stratum"])
        side = F.when(F.col("__h") <= F.col("cut"), "test").otherwise("train")
        return rows.join(cuts, "__stratum").withColumn("side", side).drop("__stratum", "__h", "cut")
    test = allocate(found.sizes, test_size)
    cuts = hash_cuts(df, number, {g: [n] for g, n in test.items()}, found.sizes, found.key)
    rows, taken = up_to_cut(df, number, {g: c[0] for g, c in cuts.items()}, found.key)
    return rows.withColumn("side", F.when(taken, F.lit("test")).otherwise(F.lit("train"))).drop("__cut")


def split_train_test(
    df: DataFrame,
    keys: Sequence[str],
    *,
    test_size: float = 0.2,
    seed=config.RANDOM_SEED,
    band: Column | None = None,
    level: Column | None = None,
    min_per_stratum: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """Exact-size stratified split on income band and category level."""
    band = fx.income_band() if band is None else band
    level = F.col("ocean_proximity") if level is None else level
    found = strata(df, band, level, min_per_stratum=min_per_stratum)
    sided = with_side(df, found, keys, test_size=test_size, seed=seed)
    return sided.where("side = 'train'").drop("side"), sided.where("side = 'test'").drop("side")


def naive_strata(df: DataFrame, band: Column) -> Strata:
    """The contrast: the band alone, which leaves a rare level to luck."""
    key = F.coalesce(band.cast("string"), F.lit("<NA>"))
    counts = df.groupBy(key.alias("stratum")).agg(F.count("*").alias("n"))
    rows = counts.limit(LISTED_STRATA + 1).collect()
    if len(rows) > LISTED_STRATA:
        return Strata(key, None, [], settled(counts))
    return Strata(key, {r["stratum"]: r["n"] for r in rows}, [])


def split_partition_check(whole: DataFrame, train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows on both sides, rows on none, rows from nowhere: three zeros for a proper split."""
    marks = (
        whole.select(*keys, F.lit(1).alias("w"), F.lit(0).alias("a"), F.lit(0).alias("b"))
        .unionAll(train.select(*keys, F.lit(0), F.lit(1), F.lit(0)))
        .unionAll(test.select(*keys, F.lit(0), F.lit(0), F.lit(1)))
        .groupBy(*keys).agg(F.sum("w").alias("w"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    return marks.agg(
        F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("on_both"),
        F.count_if(F.col("a") + F.col("b") < F.col("w")).alias("lost"),
        F.count_if(F.col("a") + F.col("b") > F.col("w")).alias("added"),
        F.sum("a").alias("n_train"),
        F.sum("b").alias("n_test"),
    )


def coverage_report(sided: DataFrame, level: str = "ocean_proximity") -> DataFrame:
    """Rows per level on each side, absent = 0, most frequent first."""
    return (
        sided.groupBy(level)
        .agg(F.count_if(F.col("side") == "train").alias("train"), F.count_if(F.col("side") == "test").alias("test"))
        .orderBy(F.desc("train"), level)
    )


def coverage_by_seed(
    df: DataFrame, found: Strata, keys: Sequence[str], seeds: Sequence, level: str, *, test_size: float = 0.2
) -> DataFrame:
    """Coverage of every level for several seeds: rows fan out over a literal seed list, in one pass each."""
    seeded = F.explode(F.array(*[F.lit(str(s)) for s in seeds]))
    fanned = found.keyed(df, "__stratum").withColumn("seed", seeded)
    number = hash_number(F.md5(key_text(F.col("seed"), *[F.col(k) for k in keys])))
    if len(seeds) * (len(found.sizes) if found.sizes is not None else LISTED_STRATA) >= LISTED_STRATA:
        by = ["seed", "__stratum"]
        sizes = found.size_table
        if sizes is None:
            sizes = df.sparkSession.createDataFrame(list(found.sizes.items()), "stratum string, n bigint")
        wanted = allocate_table(sizes, test_size).withColumn("seed", seeded)
        wanted = wanted.withColumnsRenamed({"stratum": "__stratum", "n_test": "r"})
        rows = fanned.withColumn("__h", number)
        rows = rows.join(cut_table(rows.select(*by, "__h"), wanted, by), by)
        taken = F.col("__h") <= F.col("cut")
    else:
        test = allocate(found.sizes, test_size)
        group = F.concat_ws("#", "seed", "__stratum")
        sizes = {f"{s}#{g}": n for s in seeds for g, n in found.sizes.items()}
        cuts = hash_cuts(fanned, number, {f"{s}#{g}": [n] for s in seeds for g, n in test.items()}, sizes, group)
        rows, taken = up_to_cut(fanned, number, {g: c[0] for g, c in cuts.items()}, group)
    return (
        rows.withColumn("__test", F.coalesce(taken, F.lit(False)))
        .groupBy(F.col("seed").cast("int").alias("seed"), level)
        .agg(F.count_if(~F.col("__test")).alias("train"), F.count_if("__test").alias("test"))
        .orderBy("seed", F.desc("train"), level)
    )


def with_fold(
    df: DataFrame, keys: Sequence[str], n_splits: int = 5, *, seed=config.RANDOM_SEED, name: str = "fold"
) -> DataFrame:
    """Add a shuffled, seeded fold 0..k-1; sizes differ by at most one, the first folds are larger."""
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    number = hash_number(seeded_md5(seed, keys))
    n = df.count()
    ranks, upto = [], 0
    for i in range(n_splits - 1):
        upto += n // n_splits + (i < n % n_splits)
        ranks.append(upto)
    cuts = hash_cuts(df, number, {"all": ranks}, {"all": n})["all"]
    fold = F.lit(0)
    for cut in cuts:
        fold = fold + (number > cut).cast("int")
    return df.withColumn(name, fold)


def align_labels(labels: DataFrame, piece: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The labels of the rows in ``piece``, once each, by key."""
    return labels.join(piece.select(*keys), list(keys), "left_semi")


def sample_n(df: DataFrame, n: int, keys: Sequence[str], *, seed=config.RANDOM_SEED) -> DataFrame:
    """Exactly n rows without replacement (all rows when there are fewer): a filter on the hash."""
    total = df.count()
    if n >= total:
        return df
    number = hash_number(seeded_md5(seed, keys))
    cut = hash_cuts(df, number, {"all": [n]}, {"all": total})["all"][0]
    return df.where(number <= cut)
