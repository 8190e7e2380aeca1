"""Reducing a one-to-many lookup before it is joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest by ``newest_by``.

    An aggregate rather than a window: each task reduces its own rows to one per key before the
    shuffle, so a key that holds a large share of the table costs no more than any other. Rows
    equal in ``newest_by`` are decided by their remaining columns, so the result is stable.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    best = F.max(F.struct(*newest_by, *rest)).alias("_best")
    return (df.groupBy(*keys).agg(best)
            .select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]))
