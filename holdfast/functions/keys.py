"""Row identity and seeded order.

Spark has no row index, so a row is known by its key columns, and "random" means the order
of ``md5(seed|key)``: the same in every engine, at every partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of the md5 prefix used as a number (13 hex digits, exact in a double as well).
HASH_BITS = 52


def key_text(*parts) -> Column:
    return F.concat_ws("|", *[F.coalesce(_column(p).cast("string"), F.lit("<null>")) for p in parts])


def seeded_md5(seed, keys: Sequence[str], *tags) -> Column:
    """md5 of ``seed|tag|...|key|...`` as 32 hex digits."""
    return F.md5(key_text(F.lit(str(seed)), *tags, *[F.col(k) for k in keys]))


def hash_number(md5: Column) -> Column:
    """First 52 bits of an md5 text as a bigint; sorts as the text does."""
    return F.conv(F.substring(md5, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _column(part) -> Column:
    return part if isinstance(part, Column) else F.lit(str(part))
