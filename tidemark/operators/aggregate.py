"""Counts and summaries."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import words

TRAFFIC_KEYS = ("plat", "agent_type", "website")


def tokenize(df: DataFrame, value: str = "value") -> DataFrame:
    """AG-1: ``(n, word)`` with n = 1, one row per word."""
    split = df.select(F.lit(1).cast("bigint").alias("n"), F.explode(words(value)).alias("word"))
    return split.filter(F.col("word") != "")


def keyed_reduce(df: DataFrame, keys: Sequence[str | Column], *aggregates: Column) -> DataFrame:
    """AG-4: reduce the rows of each key; Spark combines before the shuffle."""
    return df.groupBy(*keys).agg(*aggregates)


def word_count(df: DataFrame, value: str = "value") -> DataFrame:
    """AG-3: final ``(n, word)`` per word."""
    return keyed_reduce(tokenize(df, value), ["word"], F.count("*").alias("n")).select("n", "word")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column | None = None,
    value: Column | None = None,
    name: str = "n",
) -> DataFrame:
    """AG-2: the sum of ``value`` (default 1) up to and including each row of its key.

    ``order`` must order the rows of a key totally, and ``block`` must be a
    non-decreasing function of it. No task holds more than one block of a key: the
    blocks are summed first, each block gets the sum of those before it, and only
    then are rows numbered inside their block. The width of the blocks decides how
    a hot key is spread, the result does not depend on it. Without ``block`` a task
    holds all rows of a key, for keys that have few.
    """
    value = F.lit(1).cast("bigint") if value is None else value
    if block is None:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(*df.columns, F.sum(value).over(upto).alias(name))
    # A struct is never NULL, and equal to another with the same NULLs in it: so plain
    # equality serves, and one exchange by key and block serves sums, window and join.
    rows = df.withColumns({"_key": F.struct(*keys), "_block": block, "_value": value}).repartition("_key", "_block")
    before = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy("_key", "_block")
        .agg(F.sum("_value").alias("_sum"))
        .withColumn("_carry", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    inside = (
        Window.partitionBy("_key", "_block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = rows.withColumn("_inside", F.sum("_value").over(inside))
    return numbered.join(carried, ["_key", "_block"]).select(
        *df.columns, (F.col("_carry") + F.col("_inside")).alias(name)
    )


def even_blocks(df: DataFrame, order: str, rows: int) -> Column:
    """Blocks of some ``rows`` rows for running counts, however the ``order`` column is spread.

    Their bounds are approximate quantiles, read in one pass over the column, and looked
    up in two steps of the root of their number. NULL is in the first block.
    """
    many = max(df.count() // rows, 1)
    parts = [i / (many + 1) for i in range(1, many + 1)]
    bounds = df.select(F.percentile_approx(order, parts, max(10_000, 20 * many))).first()[0]
    if not bounds:
        return F.lit(0)
    bounds = sorted(set(bounds))
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda bound: bound <= F.col(order)))

    group = passed(F.lit([g[0] for g in groups]))
    inside = passed(F.get(F.lit(groups), group - 1))
    return F.when(group > 0, (group - 1) * step + inside).otherwise(0)


def _number_items(lists: pa.Table, before: pa.Table) -> pa.Table:
    """Number the items of one block: ``(order, items)`` rows and ``(item, count before)`` rows."""
    order, items = (c.combine_chunks() for c in lists.columns[1:])
    item, count = (c.combine_chunks() for c in before.columns[1:])
    rank = pc.rank(order, null_placement="at_start", tiebreaker="dense").to_numpy()
    by_rank = np.argsort(rank, kind="stable")
    order, items, rank = order.take(pa.array(by_rank)), items.take(pa.array(by_rank)), rank[by_rank]
    sizes = pc.fill_null(pc.list_value_length(items), 0).to_numpy()
    flat, row = pc.list_flatten(items), np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    both = pa.concat_arrays([flat, item.cast(flat.type)]).dictionary_encode(null_encoding="encode")
    codes, known = np.split(both.indices.to_numpy(), [len(row)])
    carry = np.zeros(codes.max(initial=-1) + 1, np.int64)
    carry[known] = count.to_numpy()
    # By item, then by order and position, which lists of equal order share.
    shared = (np.diff(rank) == 0).any()
    by_code = np.lexsort((pos, rank[row], codes)) if shared else np.argsort(codes, kind="stable")
    counts = np.bincount(codes, minlength=len(carry))
    n = np.empty(len(row), np.int64)
    n[by_code] = np.arange(1, len(row) + 1) - np.repeat(np.cumsum(counts) - counts, counts)
    return pa.table({"order": order.take(pa.array(row)), "pos": pos, "n": n + carry[codes], "item": flat})


def running_item_count(
    df: DataFrame, items: str | Column, order: str, block: Column, name: str = "n", item: str = "item"
) -> DataFrame:
    """AG-2 on lists: ``(order, pos, n, item)``, equal items numbered by order and position.

    ``block`` must be a non-decreasing function of the ``order`` column. Rows move once, to
    their block, whose lists a task holds together; by item there move only counts, one for
    each item of a block. The result does not depend on the width of the blocks. Lists that
    are an expression are made after the rows have moved, once to count and once to number.
    """
    # Both branches read the columns that move and filter nothing below, so they share the exchange.
    items = F.col(items) if isinstance(items, str) else items
    lists = df.repartition(block).select(block.alias("_block"), F.col(order).alias("_order"), items.alias("_items"))
    kinds = dict(lists.dtypes)
    kind = kinds["_items"].removeprefix("array<").removesuffix(">")
    exploded = lists.select("_block", F.posexplode_outer("_items").alias("_pos", "_item")).filter("_pos IS NOT NULL")
    sums = exploded.groupBy("_block", "_item").agg(F.count("*").alias("_count"))
    before = running_sum(sums, ["_item"], ["_block"], value=F.col("_count"), name="_n").select(
        "_block", "_item", (F.col("_n") - F.col("_count")).alias("_before")
    )
    blocks = lists.groupBy("_block").cogroup(before.filter("_before > 0").groupBy("_block"))
    numbered = blocks.applyInArrow(_number_items, f"order {kinds['_order']}, pos bigint, n bigint, item {kind}")
    return numbered.toDF(order, "pos", name, item)


def with_request_date(df: DataFrame, req_time: str = "req_time") -> DataFrame:
    """AG-6: add ``req_date`` and ``req_hour`` of epoch seconds, in the session zone."""
    ts = F.timestamp_seconds(F.col(req_time))
    return df.withColumns({"req_date": F.to_date(ts), "req_hour": F.hour(ts)})


def traffic_by_hour(df: DataFrame, keys: Sequence[str] = TRAFFIC_KEYS) -> DataFrame:
    """AG-5: exact page views, visitors and addresses per key, date and hour.

    Distinct ids are merged before the shuffle and spread over it by id, so a busy
    hour or visitor does not end up in one task.
    """
    return df.groupBy(*keys, "req_date", "req_hour").agg(
        F.count("*").alias("pv_count"),
        F.count_distinct("visit_id").alias("uv_count"),
        F.count_distinct("ip").alias("ip_count"),
    )


def traffic_by_hour_sketched(df: DataFrame, keys: Sequence[str] = TRAFFIC_KEYS) -> DataFrame:
    """AG-5 with HLL sketches: one pass, one small shuffle, and mergeable hours."""
    return df.groupBy(*keys, "req_date", "req_hour").agg(
        F.count("*").alias("pv_count"),
        F.hll_sketch_agg("visit_id").alias("uv_sketch"),
        F.hll_sketch_agg("ip").alias("ip_sketch"),
    )


def stat_traffic(hourly: DataFrame) -> DataFrame:
    """Rows of the summary table: date and times as epoch seconds, with an id."""
    now = F.unix_timestamp().cast("int")
    day = F.unix_timestamp(F.col("req_date").cast("timestamp")).cast("int")
    return hourly.select(
        F.expr("uuid()").alias("id"),
        "plat",
        "agent_type",
        "website",
        *[F.col(c).cast("int").alias(c) for c in ("pv_count", "uv_count", "ip_count")],
        day.alias("stat_date"),
        F.col("req_hour").cast("int").alias("stat_hour"),
        (day + F.col("req_hour") * 3600).cast("int").alias("stat_time"),
        now.alias("update_time"),
        now.alias("add_time"),
    )
