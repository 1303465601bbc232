"""Arrow batches as flat numpy byte buffers, cut into slices of bounded bytes.

Python steps of this subpackage work on whole texts; what bounds their memory is
that at most ``BATCH_ROWS`` rows come at once (``small_batches``), and that they
are handled in slices of consecutive rows of at most ``SLICE_BYTES`` (a single longer
text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = (1 << 19) - 4096
BATCH_ROWS = 1_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """Lowers the session's Arrow batch size to ``BATCH_ROWS`` rows (a smaller setting stays): at Spark's default
    of 10,000, a batch of long texts alone can fill a worker."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ROWS)) <= BATCH_ROWS:
        conf.set(_ROWS, str(BATCH_ROWS))
    return df


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of rows + 1) of a string or binary column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64 if big else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``limit`` bytes each (at least one row)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """(rows of the slice as a RecordBatch, its bytes, its offsets) of a batch."""
    data, offs = text_bytes(batch.column(batch.schema.get_field_index(column)))
    for a, b in slices(offs, limit):
        yield batch.slice(a, b - a), data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]


def texts_of(data: np.ndarray, offs: np.ndarray) -> list[str]:
    """The rows as Python strings (invalid UTF-8 becomes U+FFFD)."""
    raw = data.tobytes()
    return [raw[offs[i]:offs[i + 1]].decode("utf-8", "replace") for i in range(len(offs) - 1)]


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), pa.int32()), pa.array(values, kind))
