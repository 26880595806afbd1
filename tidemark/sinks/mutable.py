"""Applying deletes and updates to a stored, partitioned table.

A change rewrites the files that hold a matching row, once, into a directory of its own
below ``_changes/data``, and takes effect when one small file of the log appears, which
names the files that it replaces and adds and the micro-batches that they belong to.
Until then readers see the old rows, whatever fails.  Files that are appended later, also
by a running stream, are part of the table as before.  A micro-batch that a change has
rewritten is settled: a retry of it stores nothing, as its rows are in the table already,
as changed.

The log is folded into a table now and then (``changelog``), and reading a table costs
two scans, however many changes it has had.  ``read_table`` gives the rows as changed;
Spark's own readers skip ``_changes``.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.mutate import delete_where, update_where
from tidemark.sinks import changelog
from tidemark.sinks.changelog import ADDED, BATCH, CHANGE, DATA, DIRECTORY, DROPPED, REPLACED
from tidemark.sinks.files import LOOKUPS, STORAGE_ORDER, index_options, lay_out
from tidemark.storage import filesystem, names, qualified

FILE = "_metadata.file_path"


# --- reading ----------------------------------------------------------------------------


def _relative(root: str, uri: str) -> str:
    """A file's name below the table, as it is on disk."""
    name = unquote(uri).replace(":///", ":/", 1)
    return name.removeprefix(root.replace(":///", ":/", 1).rstrip("/") + "/")


def _files(spark: SparkSession, path: str, base: str, schema: StructType, found: Sequence[str]) -> DataFrame | None:
    """The rows of files or directories below ``base``, with the columns of their partitions."""
    if not found:
        return None
    return spark.read.option("basePath", f"{path}/{base}" if base else path).schema(schema).parquet(*[f"{path}/{name}" for name in found])


def _base(spark: SparkSession, path: str, replaced: set[str]) -> tuple[StructType, DataFrame | None]:
    """Columns of the table, and the rows of its own files without the replaced ones."""
    whole = spark.read.parquet(path)
    if not replaced:
        return whole.schema, whole
    root, by_folder = qualified(spark, path), defaultdict(list)
    for uri in whole.inputFiles():
        name = _relative(root, uri)
        by_folder[name.rpartition("/")[0]].append(name)
    # Folders of which nothing is replaced go as a whole.
    live = []
    for folder, found in sorted(by_folder.items()):
        left = sorted(set(found) - replaced)
        live += [folder] if folder and len(left) == len(found) else left
    return whole.schema, _files(spark, path, "", whole.schema, live)


def _parts(spark: SparkSession, path: str, manifest: changelog.Manifest) -> tuple[StructType, DataFrame | None, DataFrame | None]:
    """Columns of the table, the live rows of its own files, and those of changed ones."""
    schema, base = _base(spark, path, manifest.replaced)
    inner = StructType([*schema.fields, StructField("_change", StringType())])
    return schema, base, _files(spark, path, DATA, inner, sorted(manifest.added))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored table, with its changes."""
    schema, *parts = _parts(spark, path, changelog.manifest_of(spark, path))
    rows = [part.select(*[F.col(f"`{c}`") for c in schema.names]) for part in parts if part is not None]
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], schema)


# --- changing ---------------------------------------------------------------------------


def _touched(rows: DataFrame | None, predicate: Column, root: str) -> set[str]:
    return set() if rows is None else {_relative(root, r[0]) for r in rows.filter(predicate).select(FILE).distinct().collect()}


def _batches(spark: SparkSession, path: str, touched: set[str]) -> list[str]:
    """Numbers of the micro-batches of these files; an error if one of them is not complete."""
    folders = sorted({name.split("/")[0] for name in touched if name.startswith("batch_id=")})
    for folder in folders:
        if "_SUCCESS" not in names(spark, f"{path}/{folder}"):
            raise RuntimeError(f"{folder} of {path} is not complete; change it when its writer is done")
    return [folder.removeprefix("batch_id=") for folder in folders]


def _rewrite(
    spark: SparkSession,
    path: str,
    parts: Sequence[str],
    order: Sequence[str],
    predicate: Column,
    change: Callable[[DataFrame], DataFrame],
    change_id: str | None,
    keep_batch: bool = True,
) -> int:
    """Rewrite the files that hold a matching row; others are neither read whole nor written.

    Without ``keep_batch`` only files of numbered batches are, and lose the number.
    Returns the number of replaced files.
    """
    changelog.fold(spark, path)
    manifest = changelog.manifest_of(spark, path)
    if change_id is not None and change_id in manifest.ids:
        return 0
    root = qualified(spark, path)
    schema, base, changed = _parts(spark, path, manifest)
    if not keep_batch and "batch_id" not in schema.names:
        base = changed = None
    replaced, dropped = _touched(base, predicate, root), _touched(changed, predicate, root)
    batches = _batches(spark, path, replaced)
    lines = [(CHANGE, change_id)] if change_id is not None else []
    if replaced or dropped:
        inner = StructType([*schema.fields, StructField("_change", StringType())])
        old = [_files(spark, path, "", schema, sorted(replaced)), _files(spark, path, DATA, inner, sorted(dropped))]
        columns = [F.col(f"`{c}`") for c in schema.names]
        rows = change(reduce(DataFrame.unionByName, [part.select(*columns) for part in old if part is not None]))
        if not keep_batch:
            rows = rows.withColumn("batch_id", F.lit(None).cast(schema["batch_id"].dataType))
        by = [c for c in ("batch_id", *parts) if c in rows.columns]
        data = f"{DATA}/_change={uuid.uuid4().hex}"
        laid_out = lay_out(rows, by, [c for c in order if c in rows.columns]).write.options(**index_options(lookups=[c for c in LOOKUPS if c in rows.columns]))
        laid_out.partitionBy(*by).parquet(f"{path}/{data}")
        fs, folder = filesystem(spark, f"{path}/{data}")
        if any(not s.getPath().getName().startswith("_") for s in fs.listStatus(folder)):
            written = spark.read.schema(rows.schema).parquet(f"{path}/{data}").inputFiles()
            lines += [(DIRECTORY, data), *[(ADDED, _relative(root, uri)) for uri in written]]
        lines += [(BATCH, batch) for batch in batches] + [(REPLACED, name) for name in sorted(replaced)] + [(DROPPED, name) for name in sorted(dropped)]
        if batches and not replaced <= {_relative(root, uri) for uri in spark.read.schema(schema).parquet(path).inputFiles()}:
            raise RuntimeError(f"a micro-batch of {path} was stored anew; try again")
    elif change_id is None:
        return 0
    changelog.take_effect(spark, path, manifest.number, lines)
    return len(replaced) + len(dropped)


def delete_from(
    spark: SparkSession,
    path: str,
    predicate: Column,
    parts: Sequence[str] = ("add_month",),
    order: Sequence[str] = STORAGE_ORDER,
    change_id: str | None = None,
) -> int:
    """MU-1 on a stored table. A change with the ``change_id`` of an earlier one does nothing."""
    return _rewrite(spark, path, parts, order, predicate, lambda df: delete_where(df, predicate), change_id)


def update_table(
    spark: SparkSession,
    path: str,
    predicate: Column,
    changes: Mapping[str, Column | str],
    parts: Sequence[str] = ("add_month",),
    order: Sequence[str] = STORAGE_ORDER,
    change_id: str | None = None,
) -> int:
    """MU-2 on a stored table. A partition column cannot be changed."""
    if set(changes) & {"batch_id", *parts}:
        raise ValueError(f"{sorted(set(changes) & {'batch_id', *parts})} partition the table and cannot be updated")
    return _rewrite(spark, path, parts, order, predicate, lambda df: update_where(df, predicate, changes), change_id)


def merge_batches(
    spark: SparkSession,
    path: str,
    last_batch: int,
    parts: Sequence[str] = ("add_month",),
    order: Sequence[str] = STORAGE_ORDER,
    change_id: str | None = None,
) -> int:
    """SNK-6 for a streamed table: batches up to ``last_batch`` become one clustered layout.

    Merged rows have a NULL ``batch_id``; their batches are settled, so a retry of one
    stores nothing. Batches that come later, and rows that an earlier call has merged,
    stay as they are.
    """
    through = F.col("batch_id") <= last_batch
    return _rewrite(spark, path, parts, order, through, lambda df: df, change_id, keep_batch=False)
