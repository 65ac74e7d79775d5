"""Arrow batches in tasks: columns in, columns out, a bounded number of rows at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_ROWS = 512
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``rows`` rows and, but for longer rows, SLICE_BYTES."""
    for batch in batches:
        lengths = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                lengths += pc.fill_null(pc.binary_length(column), 0).to_numpy(False)
        total, start = np.cumsum(lengths), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = int(np.searchsorted(total, before + SLICE_BYTES, "right"))
            stop = min(max(stop, start + 1), start + rows)
            yield batch.slice(start, stop - start)
            start = stop


def map_columns(
    frame: DataFrame,
    make: Callable[[], Callable[[dict[str, list]], dict[str, list]]],
    schema: str,
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """``frame`` through a function from columns to columns (lists or Arrow arrays).

    ``make`` is called once per task and returns that function, so that tables are built once.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(schema)
    wire = to_arrow_schema(struct).serialize().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = pa.ipc.read_schema(pa.py_buffer(wire))
        work = make()
        for batch in slices(batches, rows):
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            made = work(columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[f.name], type=f.type) for f in target], schema=target
            )

    return frame.mapInArrow(run, struct)
