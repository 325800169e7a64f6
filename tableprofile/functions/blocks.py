"""Rows of numbers in blocks, for fits that pass over them many times."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def packed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, whose columns are longs or doubles, some to a block of bytes.

    Handing a row to a Python worker costs several times what a pass computes with it; a
    block is handed over as it is. It holds its rows column by column, NULL as NaN.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = [c.to_numpy(zero_copy_only=False).view(np.int64) for c in batch.columns]
                yield in_block(np.stack(columns))

    return df.mapInArrow(pack, "block binary")


def in_block(columns: np.ndarray) -> pa.RecordBatch:
    """One block of an array with a row for each column."""
    return pa.RecordBatch.from_arrays([pa.array([columns.tobytes()], pa.binary())], names=["block"])


def unpacked(
    batches: Iterable[pa.RecordBatch], width: int, dtype: np.dtype | type = np.int64
) -> Iterator[np.ndarray]:
    """The blocks as arrays with a row for each of ``width`` columns."""
    for batch in batches:
        for block in batch.column(0):
            yield np.frombuffer(block.as_buffer(), dtype).reshape(width, -1)


def over_blocks(
    blocks: DataFrame,
    width: int,
    dtype: np.dtype | type,
    work: Callable[[Iterator[np.ndarray]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """What ``work`` makes of the blocks of each task, as arrays with a row for each column.

    ``mapInArrow`` gathers blocks up to Spark's limit of bytes a batch, and holds a batch
    several times over outside the heap, besides the worker's copy. The rows of an RDD come
    about a megabyte at a time, or block by block where blocks are larger.
    """

    def rows(held: Iterator) -> Iterator[tuple]:
        arrays = (np.frombuffer(row[0], dtype).reshape(width, -1) for row in held)
        for batch in work(arrays):
            yield from zip(*(column.to_pylist() for column in batch.columns))

    return blocks.sparkSession.createDataFrame(
        blocks.rdd.mapPartitions(rows), schema, verifySchema=False)
