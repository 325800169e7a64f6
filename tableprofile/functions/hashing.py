"""Row hashes that do not depend on how the rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tableprofile.functions.columns import named


def seeded_md5(keys: Sequence[str], seed: int) -> Column:
    """Hex md5 of the key values and the seed; the same in any SQL engine."""
    parts = [F.coalesce(named(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))


def md5_bucket(keys: Sequence[str], seed: int, buckets: int) -> Column:
    head = F.substring(seeded_md5(keys, seed), 1, 8)
    return F.conv(head, 16, 10).cast("long") % buckets


def content_bucket(columns: Sequence[str], seed: int, buckets: int) -> Column:
    """Bucket from the row's own values, for tables without a key."""
    return F.pmod(F.xxhash64(*[named(c) for c in columns], F.lit(seed)), F.lit(buckets))
