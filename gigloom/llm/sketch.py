"""Fixed-size counter arrays, one per task, added up over a whole table in two steps on executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICES = 64  # a counter array travels in so many rows
FIELDS = "slice int, counts binary"


def sliced(counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The two columns of FIELDS for an array whose length is a multiple of SLICES."""
    parts = [x.tobytes() for x in counts.astype(np.int32).reshape(SLICES, -1)]
    return pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())


def _added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of one slice, a few rows in memory at a time; a counter stays at 2**31 - 1."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for x in batch.column(batch.schema.get_field_index("counts")):
            one = np.frombuffer(x.as_py(), np.int32)
            total = total + one if len(total) else one.astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array(
        [np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()], pa.binary())], ["slice", "counts"])


def numbered(parts: DataFrame) -> DataFrame:
    """Adds the group of tasks whose counters are added first; call it in the stage that made the rows."""
    return parts.withColumn("part", F.when(F.col("slice").isNotNull(), F.expr("spark_partition_id() div 256")))


def total(parts: DataFrame, size: int) -> np.ndarray:
    """The added counters of `parts` (slice, counts, part): `size` numbers, which the driver holds."""
    some = parts.groupBy("slice", "part").applyInArrow(_added, FIELDS)
    out = np.zeros(size, np.int32)
    step = size // SLICES
    for r in some.groupBy("slice").applyInArrow(_added, FIELDS).collect():
        out[r.slice * step:(r.slice + 1) * step] = np.frombuffer(r.counts, np.int32)
    return out
