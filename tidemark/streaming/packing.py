"""Rows of a key travel to its state together.

Spark hands rows to a stateful function value by value, which costs more than most work
on them.  Packed rows come as arrays, one for each column, many rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql.types import ArrayType, StructField, StructType

#: Rows of a task that are packed together, and their bytes, whichever is reached first.
PACK_ROWS, PACK_BYTES = 1 << 17, 1 << 26


def pack_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys, and every other column as an array of its values, for some rows of a key together.

    A key has a row for each stretch of a task's rows it is in.  NULL is a key like any
    other, and the rows of a key keep their order.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    schema = StructType([*(df.schema[k] for k in keys), *(StructField(c, ArrayType(df.schema[c].dataType)) for c in others)])

    def pack(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        numbered = rows.select(keys).append_column("_at", pa.array(range(rows.num_rows), pa.int64()))
        groups = numbered.group_by(keys, use_threads=False).aggregate([("_at", "list")])
        at = groups.column("_at_list").combine_chunks()
        rows = rows.select(others).take(at.flatten()).combine_chunks()
        arrays = [pa.ListArray.from_arrays(at.offsets, column.combine_chunks()) for column in rows.columns]
        yield from pa.Table.from_arrays([*(groups.column(k) for k in keys), *arrays], [*keys, *others]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= PACK_ROWS or size >= PACK_BYTES:
                yield from pack(held)
                held, n, size = [], 0, 0
        if n:
            yield from pack(held)

    return df.mapInArrow(run, schema)


def unpacked(rows: Iterable[Row], first: int) -> Iterator[tuple]:
    """The rows again, as tuples of the columns from position ``first`` on, where the keys end."""
    for row in rows:
        yield from zip(*row[first:], strict=True)
