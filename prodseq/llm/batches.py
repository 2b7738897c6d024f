"""Text columns as Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prodseq.llm.shipping import send_package

#: Text bytes worked on at once in a task; one longer text makes a slice of its own.
SLICE_BYTES = 4 << 20


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``most`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if end > start:
                yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a missing text counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def over_texts(frame: DataFrame, columns: list[str], function: Callable[[pa.RecordBatch], dict], schema: str, most: int = SLICE_BYTES) -> DataFrame:
    """Apply ``function`` to slices of the given columns, text last; it returns new columns by name.

    All columns but the text are passed through in front of the new ones.
    """
    send_package(frame.sparkSession)
    kept = columns[:-1]
    source = frame.select(*(F.col(c) for c in columns))
    made_fields = StructType.fromDDL(schema).fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, columns[-1], most):
            made = function(part)
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(len(kept))] + [v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()],
                names=[*kept, *made],
            )

    return source.mapInArrow(run, StructType([*(source.schema[c] for c in kept), *made_fields]))
