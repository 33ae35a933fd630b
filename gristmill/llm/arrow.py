"""Helpers for Arrow-batched operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from gristmill.batches import cut, release  # noqa: F401

#: Bytes of a group after which memory is handed back.
LARGE = 1 << 20


def list_array(values: np.ndarray, lengths, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def map_arrow(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[list]], schema: StructType) -> DataFrame:
    """``mapInArrow`` for functions that give lists of columns in the order of ``schema``."""
    names = schema.fieldNames()

    def run(batches):
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in columns], names)
        release()

    return df.mapInArrow(run, schema)


def freeing(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``work`` on groups, with memory handed back after each large one."""

    def run(table: pa.Table) -> pa.Table:
        out = work(table)
        if table.nbytes > LARGE:
            release()
        return out

    return run
