"""Regression metrics, overall and by segment, each table one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import config
from holdfast.functions import expressions as fx

METRIC_NAMES = ("rmse", "mae", "r2", "n")


def metric_columns(y: Column, prediction: Column, mask: Column | None = None) -> dict[str, Column]:
    """rmse, mae, r2 and n as aggregates; undefined values are null.

    r2 needs two rows; on a constant target it is 1 for exact predictions, else 0.
    """
    y, error = (y, y - prediction) if mask is None else (F.when(mask, y), F.when(mask, y - prediction))
    n, residual = F.count(error), F.sum(error * error)
    known = F.when(error.isNotNull(), y)
    spread = _spread(n * F.var_pop(known), F.min(known), F.max(known))
    r2 = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(spread > 0, 1.0 - F.try_divide(residual, spread))
        .when(residual == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return {"rmse": F.sqrt(F.avg(error * error)), "mae": F.avg(F.abs(error)), "r2": r2, "n": n}


def _spread(found: Column, low: Column, high: Column) -> Column:
    """The squares about the mean, zero where all values are one: merged by parts, a mean of equal values may miss them by a bit."""
    return F.when(high - low == 0, F.lit(0.0)).otherwise(found)


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    found = metric_columns(F.col(label), F.col(prediction))
    return df.groupBy(*by).agg(*[c.alias(k) for k, c in found.items()])


def segments(label: Column, level: Column) -> dict[str, Column]:
    """The five overlapping segments, in reading order."""
    censored, inland = fx.censored_mask(label), fx.category_mask(level)
    return {
        "all": F.lit(True),
        "uncensored": ~censored,
        "censored": censored,
        "inland": inland,
        "coastal": ~inland,
    }


def segment_table(
    df: DataFrame,
    label: str = config.TARGET,
    prediction: str = "prediction",
    *,
    masks: dict[str, Column] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Metrics per segment, in order, empty segments included with n = 0.

    Segments overlap, but the cells they are made of do not: rows are summed up once per combination
    of masks (four cells for the five segments), and the few cells are added up per segment. No row
    is copied, and sums of squares are merged about the segment's mean.
    """
    masks = segments(F.col(label), F.col("ocean_proximity")) if masks is None else masks
    error = (F.col(label) - F.col(prediction)).cast("double")
    y = F.when(error.isNotNull(), F.col(label).cast("double"))
    flags = {f"__in{i}": F.coalesce(mask, F.lit(False)) for i, mask in enumerate(masks.values())}
    cells = (
        df.select(*by, y.alias("__y"), error.alias("__e"), *[m.alias(f) for f, m in flags.items()])
        .groupBy(*by, *flags)
        .agg(
            F.count("__e").alias("n"), F.sum(F.col("__e") * F.col("__e")).alias("se"), F.sum(F.abs("__e")).alias("ae"),
            F.avg("__y").alias("mean"), F.var_pop("__y").alias("var"), F.min("__y").alias("low"), F.max("__y").alias("high"),
        )
    )
    if not by:
        nothing = [F.lit(False)] * len(flags) + [F.lit(0).cast("bigint")] + [F.lit(0.0)] * 6
        cells = cells.unionAll(df.sparkSession.range(1).select(*nothing))
    hits = F.array(*[
        F.struct(F.lit(i).alias("at"), F.lit(s).alias("segment"), F.col(f).alias("hit"))
        for i, (s, f) in enumerate(zip(masks, flags))
    ])
    part = cells.select(*by, "n", "se", "ae", "mean", "var", "low", "high", F.inline(hits))
    part = part.withColumn("n", F.when(F.col("hit"), F.col("n")).otherwise(0))
    inside = F.col("n") > 0
    sums = part.groupBy(*by, "at", "segment").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(inside, F.col("se"))).alias("se"),
        F.sum(F.when(inside, F.col("ae"))).alias("ae"),
        # Var(y) of the union: variance within the cells plus variance of their means.
        F.try_divide(F.sum(F.when(inside, F.col("n") * F.col("var"))), F.sum("n")).alias("within"),
        F.try_divide(F.sum(F.when(inside, F.col("n") * F.col("mean"))), F.sum("n")).alias("mean"),
        F.collect_list(F.when(inside, F.struct("n", "mean"))).alias("cells"),
        F.min(F.when(inside, F.col("low"))).alias("low"),
        F.max(F.when(inside, F.col("high"))).alias("high"),
    )
    between = F.aggregate(
        "cells", F.lit(0.0), lambda acc, c: acc + c["n"] * (c["mean"] - F.col("mean")) * (c["mean"] - F.col("mean"))
    )
    spread = _spread(F.col("n") * F.col("within") + between, F.col("low"), F.col("high"))
    r2 = (
        F.when(F.col("n") < 2, F.lit(None).cast("double"))
        .when(spread > 0, 1.0 - F.try_divide(F.col("se"), spread))
        .when(F.col("se") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return sums.orderBy(*by, "at").select(
        *by, "segment", F.sqrt(F.try_divide("se", "n")).alias("rmse"), F.try_divide("ae", "n").alias("mae"),
        r2.alias("r2"), "n",
    )


def compare(results: dict[str, DataFrame]) -> DataFrame:
    """One-row metric tables of several arms as one table, best rmse first."""
    out = None
    for arm, table in results.items():
        tagged = table.select(F.lit(arm).alias("arm"), "*")
        out = tagged if out is None else out.unionByName(tagged)
    return out.orderBy("rmse") if "rmse" in out.columns else out


def headline(segment_rows: DataFrame) -> DataFrame:
    """The 'all' row of each arm, best first."""
    return segment_rows.where("segment = 'all'").select("arm", *METRIC_NAMES).orderBy("rmse")
