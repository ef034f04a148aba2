"""numpy steps over the rows of a window, in its order.

Spark deals and sorts the rows (``(symbol, _blk)`` blocks, by time) and numbers them in each block (``AT``, a
``row_number`` of that window); the step then reads a partition batch by batch, keeps what the next batch needs, and
adds columns.  It holds one batch, however long a block is.  Nothing may come between the
numbering and the step that deals or sorts rows anew: that is checked."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Place of a row in its block, from 1.
AT = "_at"


def in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches that have rows, and the places of these."""
    last = 0
    for b in batches:
        if b.num_rows:
            at = b.column(AT).to_numpy(zero_copy_only=False).astype(np.int64)
            if ((np.diff(at, prepend=last) != 1) & (at != 1)).any():
                raise RuntimeError("the rows are not in the order in which they were numbered")
            last = at[-1]
            yield b, at


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The doubles of a column (0 for NULL), and which of them are not NULL."""
    held = column.is_valid().to_numpy(zero_copy_only=False)
    return column.cast(pa.float64(), safe=False).fill_null(0.0).to_numpy(zero_copy_only=False), held


#: Names of columns of doubles, and what maps the (batch, places) of a partition, one by one, to these: (values, which of them are not NULL).
Step = tuple[list[str], Callable]


def _extended(batches: Iterable, names: list[str], step: Callable) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches with the columns of a step."""
    now = []

    def read():
        for pair in batches:
            now[:] = pair
            yield pair

    for made in step(read()):
        b, at = now
        new = [pa.array(v, pa.float64(), mask=~ok) for v, ok in made]
        yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *names]), at


def add_doubles(d: DataFrame, steps: list[Step], drop: Iterable[str] = ()) -> DataFrame:
    """``d`` with the columns of ``steps``, each of which also reads those before it, and without those in ``drop``:
    one way to Python and back for all of them."""
    drop = set(drop)
    fields = [*(T.StructField(f.name, f.dataType) for f in d.schema.fields), *(T.StructField(n, T.DoubleType()) for names, _ in steps for n in names)]
    fields = [f for f in fields if f.name not in drop]
    columns = [f.name for f in fields]

    def run(batches):
        rows = in_order(batches)
        for names, step in steps:
            rows = _extended(rows, names, step)
        for b, _ in rows:
            yield b.select(columns)

    return d.mapInArrow(run, T.StructType(fields))
