"""The table contract: names, then type class, then value ranges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import config
from holdfast.errors import ColumnTypeError, MissingColumnsError, ValueRangeError


@dataclass(frozen=True)
class Contract:
    schema: T.StructType
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    target: str | None = None

    def expected_columns(self, *, require_target: bool = True) -> list[str]:
        return [c for c in self.schema.fieldNames() if require_target or c != self.target]

    def features_and_target(self, df: DataFrame, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
        """The table without its target, and keys and target alone: two narrow projections of one scan."""
        if self.target not in df.columns:
            raise MissingColumnsError(f"Missing required column(s) {[self.target]}; got {df.columns}")
        return df.drop(self.target), df.select(*keys, self.target)

    # -- schema checks: no job ------------------------------------------------

    def check_missing(self, df: DataFrame, *, require_target: bool = True) -> None:
        expected = self.expected_columns(require_target=require_target)
        absent = [c for c in expected if c not in df.columns]
        if absent:
            raise MissingColumnsError(f"Missing required column(s) {absent}; expected {expected}, got {df.columns}")

    def check_types(self, df: DataFrame, *, require_target: bool = True) -> None:
        wrong = []
        for name in self.expected_columns(require_target=require_target):
            want, got = self.schema[name].dataType, df.schema[name].dataType
            kind = T.NumericType if isinstance(want, T.NumericType) else T.StringType
            if not isinstance(got, kind):
                wrong.append(f"{name} (got {got.simpleString()}, expected {want.simpleString()})")
        if wrong:
            raise ColumnTypeError("Wrong column type: " + "; ".join(wrong))

    # -- data checks: one aggregation -------------------------------------------

    def violations(self, df: DataFrame, *, require_target: bool = True) -> DataFrame:
        """One row per column with values out of range: count, smallest and largest offender."""
        present = [c for c in self.expected_columns(require_target=require_target) if c in self.ranges]
        bad = {c: _outside(F.col(c), *self.ranges[c]) for c in present}
        one = df.agg(*[
            a
            for c in present
            for a in (
                F.count_if(bad[c]).alias(f"{c}_n"),
                F.min(F.when(bad[c], F.col(c).cast("double"))).alias(f"{c}_lo"),
                F.max(F.when(bad[c], F.col(c).cast("double"))).alias(f"{c}_hi"),
            )
        ])
        rows = F.array(*[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}_n").alias("n_bad"),
                F.col(f"{c}_lo").alias("min_bad"),
                F.col(f"{c}_hi").alias("max_bad"),
            )
            for c in present
        ])
        return one.select(F.inline(rows)).where("n_bad > 0")

    def check_ranges(self, df: DataFrame, *, require_target: bool = True) -> None:
        found = self.violations(df, require_target=require_target).collect()
        if found:
            raise ValueRangeError("Value(s) outside the contract range: " + "; ".join(
                f"{r['column']}: {r['n_bad']} row(s) outside {self.ranges[r['column']]} "
                f"(observed {r['min_bad']} .. {r['max_bad']})"
                for r in found
            ))

    def validate(self, df: DataFrame, *, require_target: bool = True) -> DataFrame:
        """The frame unchanged, or the most specific refusal; the data is read last."""
        self.check_missing(df, require_target=require_target)
        self.check_types(df, require_target=require_target)
        self.check_ranges(df, require_target=require_target)
        return df

    # -- raw text ------------------------------------------------------------------

    def bad_casts(self, raw: DataFrame) -> DataFrame:
        """Per numeric column of an all-text frame: values that are there but are no number."""
        numeric = [f.name for f in self.schema if isinstance(f.dataType, T.NumericType) and f.name in raw.columns]
        one = raw.agg(*[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in numeric
        ])
        rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_bad")) for c in numeric])
        return one.select(F.inline(rows)).where("n_bad > 0")

    def cast_text(self, raw: DataFrame) -> DataFrame:
        """Typed columns from text, or a ColumnTypeError that names the columns at fault."""
        found = self.bad_casts(raw).collect()
        if found:
            raise ColumnTypeError("Wrong column type: " + "; ".join(
                f"{r['column']} ({r['n_bad']} value(s) are not numbers)" for r in found
            ))
        casts = {f.name: F.col(f.name).cast(f.dataType) for f in self.schema if f.name in raw.columns}
        return raw.withColumns(casts)


def _outside(x: Column, low: float, high: float) -> Column:
    return x.isNotNull() & ((x < low) | (x > high))


def check_log_domain(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns where log1p is undefined: rows at or below -1 and the minimum."""
    one = df.agg(*[a for c in columns for a in (
        F.count_if(F.col(c) <= -1.0).alias(f"{c}_n"), F.min(F.col(c).cast("double")).alias(f"{c}_lo"),
    )])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_n").alias("n_bad"), F.col(f"{c}_lo").alias("min_value"))
        for c in columns
    ])
    return one.select(F.inline(rows)).where("n_bad > 0")


HOUSING = Contract(config.SCHEMA, config.VALUE_RANGES, config.TARGET)
