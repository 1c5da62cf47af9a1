"""Scalar expressions: ratios, de-skewing, scaling, clipping, similarity, bands, codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import config


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise NaN to null once, at the door; one NaN would poison every aggregate."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def safe_divide(numerator: Column, denominator: Column, fill: float = 0.0) -> Column:
    """a / b, or ``fill`` when the result is null, NaN or infinite."""
    quotient = F.try_divide(numerator, denominator)
    return F.when(F.abs(quotient) < F.lit(float("inf")), quotient).otherwise(F.lit(fill))


def ratios(columns: dict[str, Column], specs=None, *, keep_original: bool = True) -> dict[str, Column]:
    """The ratio columns by (name, numerator, denominator), with or without their inputs."""
    specs = config.RATIOS if specs is None else specs
    needed = list(dict.fromkeys(c for _, a, b in specs for c in (a, b)))
    missing = [c for c in needed if c not in columns]
    if missing:
        raise ValueError(f"ratios need {missing}; got columns {list(columns)}")
    out = dict(columns) if keep_original else {}
    out.update({name: safe_divide(columns[a], columns[b]) for name, a, b in specs})
    return out


def yeo_johnson(x: Column, lam: float | Column) -> Column:
    """The Yeo-Johnson power transform; lambda may be a number or a column. Null stays null."""
    tiny = F.lit(2.3e-16)
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    rest = F.lit(2.0) - lam
    upper = F.when(F.abs(lam) < tiny, F.log1p(x)).otherwise((F.pow(x + 1.0, lam) - 1.0) / lam)
    lower = F.when(F.abs(rest) < tiny, -F.log1p(-x)).otherwise(-(F.pow(1.0 - x, rest) - 1.0) / rest)
    return F.when(x >= 0, upper).when(x < 0, lower)


def guarded_log1p(x: Column, name: str) -> Column:
    """``log1p`` that stops the job at x <= -1, where Spark would return null without a word."""
    message = F.concat(F.lit(f"log1p is undefined at or below -1: column {name} holds "), x.cast("string"))
    return F.when(x <= -1.0, F.raise_error(message).cast("double")).otherwise(F.log1p(x))


def clip(x: Column, low: float, high: float) -> Column:
    """Winsorise; null stays null (``greatest``/``least`` would replace it by a bound)."""
    return F.when(x < low, F.lit(low)).when(x > high, F.lit(high)).otherwise(x)


def rescale(x: Column, center: float, scale: float) -> Column:
    """(x - center) / scale, a zero scale counting as one."""
    return (x - F.lit(center)) / F.lit(scale or 1.0)


def squared_distance(point: Sequence[Column], center: Sequence[float]) -> Column:
    gaps = [x - float(c) for x, c in zip(point, center)]
    total = gaps[0] * gaps[0]
    for gap in gaps[1:]:
        total = total + gap * gap
    return total


def rbf_similarity(point: Sequence[Column], centers: Sequence[Sequence[float]], gamma: float) -> list[Column]:
    """exp(-gamma * squared distance) to every centre."""
    return [F.exp(squared_distance(point, c) * -float(gamma)) for c in centers]


def band(x: Column, edges: Sequence[float], labels: Sequence[int]) -> Column:
    """Right-closed bands (edge[i], edge[i+1]]; at or below the first edge, or null, is null."""
    out = F.when(x.isNull() | (x <= edges[0]), F.lit(None).cast("int"))
    for label, upper in zip(labels, edges[1:]):
        out = out.when(x <= upper, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def income_band(x: Column | None = None) -> Column:
    x = F.col("median_income") if x is None else x
    return band(x, config.INCOME_BAND_EDGES, config.INCOME_BAND_LABELS)


def composite_key(band_column: Column, level: Column) -> Column:
    """``band|level`` as text; a null band prints as ``<NA>``, a null level as ``None``."""
    return F.concat_ws(
        "|", F.coalesce(band_column.cast("string"), F.lit("<NA>")), level_text(level)
    )


def level_text(level: Column) -> Column:
    return F.coalesce(level.cast("string"), F.lit("None"))


def censored_mask(y: Column, cap: float = config.TARGET_CAP, floor: float = config.TARGET_FLOOR) -> Column:
    return (y >= cap) | (y <= floor)


def null_flag(x: Column, *, nan: bool = False) -> Column:
    """True where a value is missing; with ``nan`` also where a number is none."""
    return x.isNull() | F.isnan(x) if nan else x.isNull()


def category_mask(level: Column, value: str = "INLAND") -> Column:
    """True at the level; null is not the level."""
    return F.coalesce(level == value, F.lit(False))


def declared_codes(level: Column, order: Sequence[str], unknown: float = -1.0) -> Column:
    """Position in a declared order; anything else (null too) gets ``unknown``."""
    table = F.create_map(*[F.lit(v) for i, name in enumerate(order) for v in (name, float(i))])
    return F.coalesce(F.try_element_at(table, level), F.lit(unknown))


# Characters that column names must not carry, and what they become.
UNSAFE_NAME_CHARACTERS = {"<": "lt", ">": "gt", "[": "(", "]": ")", ",": ";", ".": "_", "`": "'"}


def safe_names(names: Sequence[str]) -> list[str]:
    """Names every consumer accepts; a collision is refused rather than merged."""
    table = str.maketrans(UNSAFE_NAME_CHARACTERS)
    out = [" ".join(name.translate(table).split()) for name in names]
    twice = sorted({n for n in out if out.count(n) > 1})
    if twice:
        raise ValueError(f"Cleaning the feature names produced collisions: {twice}")
    return out


def sanitise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*safe_names(df.columns))
