"""Profile tables: the numbers behind the figures, each one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import config
from holdfast.functions import expressions as fx
from holdfast.operators.moments import pair_moments


def censoring(df: DataFrame, target: str = config.TARGET, cap=config.TARGET_CAP, floor=config.TARGET_FLOOR):
    y = F.col(target)
    return df.agg(
        F.count_if(y == cap).alias("at_cap"),
        F.count_if(y == floor).alias("at_floor"),
        F.min(y).alias("min_value"),
        F.max(y).alias("max_value"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width counts with empty bins kept and the last bin closed."""
    x = F.col(column).cast("double")
    edge = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if edge["lo"] is None:
        raise ValueError(f"{column} holds no value to count")
    low, width = edge["lo"], (edge["hi"] - edge["lo"]) / bins or 1.0
    bucket = F.least(F.floor((x - low) / width).cast("bigint"), F.lit(bins - 1))
    counts = df.where(x.isNotNull()).groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def value_counts(df: DataFrame, column: str, *, normalize: bool = False) -> DataFrame:
    """Rows (or shares) per non-null level, most frequent first."""
    rows = df.where(F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return counts.orderBy(F.desc("n"), column)
    total = rows.count()
    return counts.select(column, (F.col("n") / total).alias("share")).orderBy(F.desc("share"), column)


def rare_levels(df: DataFrame, column: str, below: int = 100) -> DataFrame:
    return value_counts(df, column).withColumn("rare", F.col("n") < below)


def geo_grid(df: DataFrame, cell: float = 0.5, target: str = config.TARGET) -> DataFrame:
    """The map as a grid: rows, average value and population per cell."""
    return df.groupBy(
        F.floor(F.col("longitude") / cell).alias("lon_cell"), F.floor(F.col("latitude") / cell).alias("lat_cell")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("avg_value"), F.sum("population").alias("population")
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, over the rows that hold both; long form, from one scan. Null where a column does not vary."""
    found = pair_moments(df, columns).correlations()
    rows = [(a, b, None if np.isnan(found[i, j]) else float(found[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "column string, other string, corr double")


def missing_by_level(df: DataFrame, column: str = "total_bedrooms", level: str = "ocean_proximity") -> DataFrame:
    """Nulls per level and overall (the row whose level is null), most frequent level first."""
    missing = F.col(column).isNull().cast("int")
    return (
        df.where(F.col(level).isNotNull())
        .rollup(level)
        .agg(F.sum(missing).alias("missing"), F.avg(missing).alias("share"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), level)
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in names])
    return one.select(F.inline(rows)).where("nulls > 0")


def corrected_skew(x: Column) -> Column:
    """Bias-corrected sample skewness (G1)."""
    n = F.count(x)
    return F.when(n > 2, F.skewness(x) * F.sqrt(n.cast("double") * (n - 1)) / (n - 2))


def skew(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Skewness as measured and after log1p."""
    one = df.agg(*[
        a for c in columns
        for a in (corrected_skew(F.col(c)).alias(f"{c}_raw"), corrected_skew(F.log1p(c)).alias(f"{c}_log"))
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_raw").alias("skew"), F.col(f"{c}_log").alias("skew_log1p"))
        for c in columns
    ])
    return one.select(F.inline(rows))


def band_shares(sided: DataFrame, band: Column | None = None, labels: Sequence[int] = tuple(config.INCOME_BAND_LABELS)):
    """Share of rows per band in the whole table and on each side; absent bands are 0."""
    band = fx.income_band() if band is None else band
    counted = sided.select(band.alias("band"), "side").where("band is not null")
    sides = {"whole": F.lit(True), "train": F.col("side") == "train", "test": F.col("side") == "test"}
    one = counted.agg(*[
        F.try_divide(F.count_if(mask & (F.col("band") == b)), F.count_if(mask)).alias(f"{s}_{b}")
        for s, mask in sides.items() for b in labels
    ])
    rows = F.array(*[
        F.struct(F.lit(b).alias("band"), *[F.coalesce(f"{s}_{b}", F.lit(0.0)).alias(s) for s in sides]) for b in labels
    ])
    return one.select(F.inline(rows))


def row_counts(sided: DataFrame, columns: int | None = None) -> DataFrame:
    width = len(sided.columns) - 1 if columns is None else columns
    return sided.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(width).alias("n_columns"),
        F.count_if(F.col("side") == "train").alias("n_train"),
        F.count_if(F.col("side") == "test").alias("n_test"),
    )


def top_k(df: DataFrame, k: int, by: str, keys: Sequence[str], *, largest: bool = False) -> DataFrame:
    """The k rows with the smallest (or largest) value, ties by key, nulls never: each task keeps k rows, nothing is sorted whole."""
    order = F.desc(by) if largest else F.asc(by)
    return df.where(F.col(by).isNotNull()).orderBy(order, *keys).limit(k)


def align_counts(tables: dict[str, DataFrame], by: Sequence[str]) -> DataFrame:
    """Rows of each table per key side by side, absent = 0: one aggregation over all tables, no join."""
    marked = [
        table.select(*by, *[F.lit(int(name == other)).alias(other) for other in tables]) for name, table in tables.items()
    ]
    return reduce(DataFrame.unionAll, marked).groupBy(*by).agg(*[F.sum(name).cast("bigint").alias(name) for name in tables])


def table_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Content digest that ignores row order and partitioning but not duplicates.

    Row hashes are added up, so it is a map-side aggregation at any size; nothing is sorted.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in columns or df.columns])
    halves = [F.conv(F.substring(F.md5(text), at, 13), 16, 10).cast("decimal(20,0)") for at in (1, 14)]
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.concat_ws("-", *[F.coalesce(F.sum(h).cast("string"), F.lit("0")) for h in halves]).alias("digest"),
    )


def profile_all(df: DataFrame, sided: DataFrame, target: str = config.TARGET) -> dict[str, DataFrame]:
    """All profile tables in their fixed order; cache the input to share its scan."""
    numeric = [*config.NUMERIC_COLUMNS, target]
    return {
        "censoring": censoring(df, target),
        "target_histogram": histogram(df, target, 120),
        "rare_levels": rare_levels(df, "ocean_proximity"),
        "geo_grid": geo_grid(df, target=target),
        "correlations": corr_matrix(df, numeric),
        "missing_by_level": missing_by_level(df),
        "skew": skew(df, config.HEAVY_TAILED_COLUMNS),
        "band_shares": band_shares(sided),
        "coverage": _coverage(sided),
    }


def _coverage(sided: DataFrame) -> DataFrame:
    from holdfast.operators.split import coverage_report

    return coverage_report(sided)
