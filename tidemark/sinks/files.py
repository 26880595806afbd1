"""File and table outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.rows import stamp
from tidemark.sinks.changelog import settled

# Rows per insert, and the storage order of the fact table.
INSERT_ROWS = 50
STORAGE_ORDER = ("plat", "req_time", "agent_type")
# Fixed value: rows between two marks of the table's index.
PAGE_ROWS = 8192
# Columns that are looked up by value beside the order.
LOOKUPS = ("visit_id",)


def print_rows(df: DataFrame) -> DataStreamWriter | None:
    """SNK-1: show rows; a stream prints each micro-batch."""
    if df.isStreaming:
        return df.writeStream.format("console").option("truncate", "false")
    df.show(truncate=False)
    return None


def write_text(df: DataFrame, path: str, column: str = "value", mode: str = "error") -> None:
    """SNK-2: one line per row."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def lay_out(df: DataFrame, parts: Sequence[str], order: Sequence[str], cluster: bool = True) -> DataFrame:
    """SNK-6: the storage layout: sorted in each file, with ``cluster`` in ranges over the files.

    The ranges follow the partition columns and the order, so files cover narrow ranges
    that parquet statistics can skip, a partition is written by many tasks, and each task
    writes few files. A hash splits rows that share all the sort columns.
    """
    if cluster:
        df = df.repartitionByRange(*parts, *order, F.xxhash64(*df.columns))
    return df.sortWithinPartitions(*parts, *order)


def index_options(page_rows: int = PAGE_ROWS, lookups: Sequence[str] = ()) -> dict[str, str]:
    """SNK-6: writer options of a sparse index.

    Pages hold at most ``page_rows`` rows, each with the least and greatest value of every
    column; rows are sorted, so a filter on the order opens the pages around its values.
    A Bloom filter for each column of ``lookups`` rules out files for values that do not
    follow the order; it is as large as the values of a row group need, 1 MB at most.
    """
    options = {"parquet.page.row.count.limit": str(page_rows)}
    if lookups:
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
    for column in lookups:
        options |= {f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.candidates.number#{column}": "12"}
    return options


def write_fact_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    order: Sequence[str] = STORAGE_ORDER,
    cluster: bool = True,
    rows_per_file: int = 0,
    lookups: Sequence[str] = LOOKUPS,
) -> None:
    """SNK-5 and SNK-6: append to a table partitioned by month of ``add_date``.

    Columns of the order and of ``lookups`` (``index_options``) that the rows do not have
    are left out. A micro-batch leaves ``cluster`` off: it adds one month, and needs no
    shuffle. Errors fail the write.
    """
    monthly = df.withColumn("add_month", F.trunc("add_date", "month"))
    writer = lay_out(monthly, ["add_month"], [c for c in order if c in df.columns], cluster).write.mode(mode)
    writer = writer.options(**index_options(lookups=[c for c in lookups if c in df.columns]))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy("add_month").parquet(path)


def write_stamped(df: DataFrame, path: str, batch_id: int | None = None, order: Sequence[str] = STORAGE_ORDER) -> DataFrame:
    """SNK-3: stamp the rows, store them and give back the input for chaining.

    Rows may have any columns; in a file they are sorted by those of ``order`` that they
    have. With ``batch_id`` the rows go to their own directory, which a retry of the same
    micro-batch replaces, so a batch is stored once; one that a change has rewritten since
    is settled and stays as it is. Ids are drawn in the writing stage itself: no shuffle
    follows that could see two draws of one row.
    """
    if batch_id is not None and settled(df.sparkSession, path, batch_id):
        return df
    target, mode = (path, "append") if batch_id is None else (f"{path}/batch_id={batch_id}", "overwrite")
    write_fact_table(stamp(df), target, mode, order, cluster=False)
    return df


def jdbc_options(url: str, table: str, batch_rows: int = INSERT_ROWS, **options: str) -> dict[str, str]:
    """SNK-4 and SNK-9: options of a relational table, inserting 50 rows at a time."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), **options}


def write_jdbc(df: DataFrame, url: str, table: str, connections: int = 8, **options: str) -> None:
    """SNK-9: append to a relational table over at most ``connections`` connections.

    The rows are dealt out anew, so what made them keeps its own parallelism.
    """
    opts = {**jdbc_options(url, table, **options), "numPartitions": str(connections)}
    df.repartition(connections).write.format("jdbc").options(**opts).mode("append").save()


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, **options: str
) -> DataFrame:
    """SNK-9: read a relational table in ``parts`` ranges of a numeric column."""
    opts = {
        **jdbc_options(url, table, **options),
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }
    return spark.read.format("jdbc").options(**opts).load()
