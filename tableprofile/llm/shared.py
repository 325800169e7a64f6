"""Small helpers the operators share: rows by size, byte windows, portable folds, numbering."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.checkpoints import cut_lineage

BATCH_BYTES = 4 << 20

# The characters of [\x09-\x0D] and ASCII punctuation, read as spaces.
_BLANK = bytes.maketrans(
    b"\t\n\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * (5 + 32)
)


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo the number of folds; a null key is fold -1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


def spread_key(key: Column, seed: int = 0) -> Column:
    """A hash of the key in [0, 1): the same row is drawn whatever the partitioning."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def unused(name: str, columns: Iterable[str]) -> str:
    """The name, with more underscores in front while a column begins with it."""
    taken = [c.lower() for c in columns]
    while any(c.startswith(name) for c in taken):
        name = f"_{name}"
    return name


def by_size(
    batch: pa.RecordBatch, limit: int = BATCH_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of about ``limit`` bytes of the texts in the last column, and those texts.

    A longer text is a slice of its own, so Python holds few texts at a time.
    """
    texts = batch.column(batch.num_columns - 1)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += size
    if start < len(texts):
        yield batch.slice(start), texts.slice(start).to_pylist()


def groups_in(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of the rows of each group, from batches sorted by the first ``keys`` columns.

    Consecutive small groups of a batch come together; a group never comes in two.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = _changes(batch, keys)
        if held and not _same(held[-1], batch, keys):
            yield pa.Table.from_batches(held)
            held = []
        last = int(change[-1]) if len(change) else 0
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _changes(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Rows that begin a group, other than the first."""
    new = np.zeros(batch.num_rows, dtype=bool)
    for column in batch.columns[:keys]:
        values = column.to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _same(a: pa.RecordBatch, b: pa.RecordBatch, keys: int) -> bool:
    return all(a.column(k)[a.num_rows - 1] == b.column(k)[0] for k in range(keys))


def plain_bytes(text: str | None) -> bytes:
    """Lower case, UTF-8, ASCII punctuation and white space as single-byte spaces."""
    return b" " + (text or "").lower().encode("utf-8", "replace").translate(_BLANK) + b" "


def byte_windows(data: bytes, width: int) -> np.ndarray:
    """The ``width`` bytes (at most 8) from each position on, as one integer each."""
    n = len(data) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    padded = data + b"\0" * 8
    words = np.ndarray((n,), dtype="<u8", buffer=padded, strides=(1,))
    return words & np.uint64((1 << (8 * width)) - 1)


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of integers (multiply and fold twice)."""
    x = values.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def numbered(df: DataFrame, groups: list[str], column: str) -> DataFrame:
    """Number the rows of each group from 0 without gathering a group in one task.

    Rows are counted per partition and group; the counts before a partition are its
    offset; inside a partition Spark's window numbers the rows of (partition, group).
    The input is cut first, so that every branch sees the same partitions. Groups must
    not be null.
    """
    from pyspark.sql import Window

    kept = cut_lineage(df.withColumn("_part", F.spark_partition_id()).withColumn(
        "_row", F.monotonically_increasing_id()))
    counts = kept.groupBy("_part", *groups).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part")
    offsets = counts.select(
        "_part", *groups, (F.sum("_n").over(before) - F.col("_n")).alias("_before")
    )
    inside = Window.partitionBy("_part", *groups).orderBy("_row")
    return (
        kept.withColumn("_at", F.row_number().over(inside) - 1)
        .join(offsets, ["_part", *groups])
        .withColumn(column, (F.col("_before") + F.col("_at")).cast("long"))
        .drop("_part", "_row", "_at", "_before")
    )


# A key is hot if it holds more than this part of the rows of a join; fewer keys than that are.
HOT_PARTS = 1024


def join_hot(many: DataFrame, few: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Inner join with ``few``, which has a row per key; ``hot`` are its rows of hot keys.

    Keys with more than one in ``HOT_PARTS`` of the rows of ``many`` are fewer than that, so
    ``hot`` is sent to every task and their rows stay where they are. Rows of the other keys
    are shuffled, and no key brings a task more than that part of them.
    """
    values = [F.col(c) for c in few.columns if c != key]
    sent = unused("_hot", [*many.columns, *few.columns])
    marked = many.join(F.broadcast(hot.select(key, F.struct(*values).alias(sent))), key, "left")
    near = marked.where(F.col(sent).isNotNull()).select("*", f"{sent}.*").drop(sent)
    return near.unionByName(marked.where(F.col(sent).isNull()).drop(sent).join(few, key))


def kept_in_worker(name: str, make):
    """What ``make()`` gives, made once in a Python worker and kept for its later tasks."""
    import sys
    import types

    kept = sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def letter_pattern():
    import regex

    return regex.compile(r"\p{L}")


def schema_of(text: str) -> T.StructType:
    return T._parse_datatype_string(text)
