"""Keep one row per key: the first (``first_per_key``) or the latest (``latest_per_key``).

Both are a single hash/sort aggregate over ``min``/``max`` of a struct whose leading
fields are the ordering columns. Unlike ``row_number() over (partition by key ...)``
this aggregate is combined map-side: a key that holds a third of all rows is reduced
to one row per input partition before the shuffle, so no task ever receives the
whole hot group. The ordering columns must make the choice total (add tiebreaks).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PICK = "_pick"


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg) -> DataFrame:
    keys, order = list(keys), list(order)
    payload = [c for c in df.columns if c not in keys and c not in order]
    ordered = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    packed = F.struct(*ordered, *[F.col(c) for c in payload])
    out = df.groupBy(*keys).agg(agg(packed).alias(_PICK))
    restore = [F.col(f"{_PICK}._o{i}").alias(c) for i, c in enumerate(order)]
    restore += [F.col(f"{_PICK}.{c}").alias(c) for c in payload]
    return out.select(*keys, *restore).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the smallest ``order`` tuple per ``keys`` (nulls in ``order`` sort first)."""
    return _pick(df, keys, order, F.min)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the largest ``order`` tuple per ``keys``."""
    return _pick(df, keys, order, F.max)
