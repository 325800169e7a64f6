"""Joins that stay even where one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32
_SALT = "__tp_salt"


def join_few(
    many: DataFrame, few: DataFrame, keys: Sequence[str], how: str, salts: int = SALTS
) -> DataFrame:
    """Join with a side of one row per key at most, in ``salts`` parts of each key.

    Rows of ``many`` are dealt over the parts by their row number, the rows of ``few`` are
    repeated for each part. ``how`` is inner, left, left_semi or left_anti.
    """
    dealt = many.withColumn(_SALT, F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    every = few.withColumn(
        _SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    return dealt.join(every, [*keys, _SALT], how).drop(_SALT)
