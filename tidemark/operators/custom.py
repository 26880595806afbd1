"""User code in Python, for what column expressions cannot say.

Functions get and give plain row tuples, with the values as they are: whole integers,
None for NULL, dicts for structs. They run inside the tasks on Arrow batches; prefer
built-in functions wherever there is one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FlatMap = Callable[..., Iterable[tuple]]


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns))


def _batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(schema)], schema=schema
    )


def flat_map_rows(df: DataFrame, fn: FlatMap, schema: str | StructType) -> DataFrame:
    """UDF-2: ``fn(*row)`` gives any number of output rows."""
    made = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([out for row in _rows(batch) for out in fn(*row)], arrow)

    return df.mapInArrow(run, made)


def map_rows(df: DataFrame, fn: Callable[..., tuple], schema: str | StructType) -> DataFrame:
    """UDF-1: ``fn(*row)`` gives one output row."""
    return flat_map_rows(df, lambda *row: (fn(*row),), schema)


def reduce_rows(
    df: DataFrame, keys: Sequence[str], fn: Callable[[tuple, tuple], tuple], spread: int = 64
) -> DataFrame:
    """UDF-3 and UDF-4: reduce the rows of each key with ``fn(row, row) -> row``.

    ``fn`` must be associative and commutative; rows are the columns besides the keys.
    Each Arrow batch is reduced before the shuffle, then ``spread`` parts of each key
    side by side, and only their results meet in one task.
    """
    keys = list(keys)
    columns = [*keys, *(c for c in df.columns if c not in keys)]
    ordered = df.select(*columns)
    schema, n = ordered.schema, len(keys)
    arrow = to_arrow_schema(schema)

    def squeeze(batch: pa.RecordBatch | pa.Table) -> pa.RecordBatch:
        groups: dict[tuple, list[tuple]] = {}
        for row in _rows(batch):
            groups.setdefault(row[:n], []).append(row[n:])
        return _batch([(*key, *reduce(fn, rows)) for key, rows in groups.items()], arrow)

    def squeeze_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield squeeze(batch)

    def squeeze_table(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([squeeze(table.select(columns))])

    parts = ordered.mapInArrow(squeeze_batches, schema)
    # All that one task has of a key goes to one part. So a task that is run again after
    # a loss, and cuts its batches differently, still gives each part the same total.
    shared = parts.withColumn("_part", F.spark_partition_id() % spread).groupBy(*keys, "_part")
    return shared.applyInArrow(squeeze_table, schema).groupBy(*keys).applyInArrow(squeeze_table, schema)
