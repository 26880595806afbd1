"""Word counts, running counts and the pair iteration."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import joined_words, split_joined
from tidemark.operators import aggregate, custom, iterate, shape
from tidemark.plans.base import Plan
from tidemark.session import new_path
from tidemark.sinks.files import write_text
from tidemark.sources.files import table, text_lines
from tidemark.sources.generate import pair_text

# Event ids, and documents, per block of a running count: what one task holds of one key,
# and of documents, at most is a block.
BLOCK = 1 << 11
DOC_BLOCK = 1 << 10


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.word_count(table(spark, sf, "documents").withColumnRenamed("text", "value"))


def text_line_words(spark: SparkSession, sf: str) -> DataFrame:
    """Write the conversations as text lines and count the words of the lines read."""
    path = new_path(spark, "lines")
    write_text(table(spark, sf, "conversations"), path, "text")
    return aggregate.word_count(text_lines(spark, path))


def running_count(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", F.col("event_type").alias("word"))
    return aggregate.running_sum(
        events, ["word"], ["event_id"], block=F.floor(F.col("event_id") / BLOCK)
    ).select("event_id", "n", "word")


def running_word_count(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "documents").select("doc_id", joined_words("text").alias("words"))
    block = aggregate.even_blocks(joined.select("doc_id"), "doc_id", DOC_BLOCK)
    return aggregate.running_item_count(joined, split_joined("words"), "doc_id", block, item="word")


def keyed_reduce(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return aggregate.keyed_reduce(
        lines,
        ["l_returnflag", "l_linestatus"],
        F.count("*").alias("n"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.max("l_orderkey").alias("last_order"),
    )


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Number pairs as text, one per event."""
    events = table(spark, sf, "events")
    return events.select(
        "event_id", pair_text(F.col("user_id") % 49 + 1, F.col("event_id") % 49 + 1).alias("value")
    )


def iterate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return iterate.sum_pairs(shape.parse_pair(pairs(spark, sf)))


def pair_results(spark: SparkSession, sf: str) -> DataFrame:
    counted = iterate.sum_pairs(shape.parse_pair(pairs(spark, sf)).drop("event_id").distinct())
    return shape.pair_result(counted).select("pair.a", "pair.b", "n")


def custom_reduce(spark: SparkSession, sf: str) -> DataFrame:
    """Visits and greatest k per page type, reduced by Python code."""
    rows = custom.map_rows(
        table(spark, sf, "events").select("event_type", "props"),
        lambda page, props: (page, 1, json.loads(props)["k"]),
        "page STRING, n BIGINT, k BIGINT",
    )
    return custom.reduce_rows(rows, ["page"], lambda a, b: (a[0] + b[0], max(a[1], b[1])))


def custom_flat_map(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the conversations, split by Python code."""
    rows = custom.flat_map_rows(
        table(spark, sf, "conversations").select("text"),
        lambda text: ((1, word) for word in text.lower().split()),
        "n BIGINT, word STRING",
    )
    return aggregate.keyed_reduce(rows, ["word"], F.sum("n").alias("n"))


# The characters that separate words, in the checking engine's syntax.
SPACE = r"[\p{Z}\t-\r\x1C-\x1F\x{85}]+"


def _count_sql(source: str) -> str:
    return f"""
select count(*) as n, word
from (select unnest(regexp_split_to_array(lower(text), '{SPACE}')) as word from {source})
where word <> '' group by word"""


PLANS = [
    Plan("word_count", "AG-1 AG-3 AG-4 UDF-2 UDF-3 UDF-4", word_count, _count_sql("documents")),
    Plan("text_line_words", "SRC-1 SNK-2", text_line_words, _count_sql("conversations")),
    Plan("running_count", "AG-2", running_count, """
select event_id, count(*) over (partition by event_type order by event_id rows unbounded preceding) as n,
       event_type as word from events"""),
    Plan("running_word_count", "AG-2 on words", running_word_count, f"""
with split as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '{SPACE}'), lambda w: w <> '') as ws from documents),
tokens as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as pos from split)
select doc_id, pos, count(*) over (partition by word order by doc_id, pos rows unbounded preceding) as n, word
from tokens"""),
    Plan("keyed_reduce", "AG-4 UDF-3", keyed_reduce, """
select l_returnflag, l_linestatus, count(*) as n, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity,
       max(l_orderkey) as last_order from lineitem group by all"""),
    Plan("custom_reduce", "UDF-1 UDF-3 UDF-4", custom_reduce, """
select event_type as page, count(*) as n, max(cast(json_extract_string(props, '$.k') as bigint)) as k
from events group by all"""),
    Plan("custom_flat_map", "UDF-2", custom_flat_map, _count_sql("conversations")),
    Plan("iterate_pairs", "SRC-3 DEC-13 DEC-14 IT-1 IT-2 ST-6", iterate_pairs, """
with recursive pairs as (select event_id, user_id % 49 + 1 as a, event_id % 49 + 1 as b from events),
steps as (
  select event_id, a, b, a as x, b as y, cast(0 as bigint) as n from pairs
  union all
  select event_id, a, b, y, x + y, n + 1 from steps where n = 0 or (x < 100 and y < 100))
select event_id, a, b, max(n) as n from steps group by all"""),
    Plan("pair_results", "DEC-14 IT-2", pair_results, """
with recursive pairs as (select distinct user_id % 49 + 1 as a, event_id % 49 + 1 as b from events),
steps as (
  select a, b, a as x, b as y, cast(0 as bigint) as n from pairs
  union all
  select a, b, y, x + y, n + 1 from steps where n = 0 or (x < 100 and y < 100))
select a, b, max(n) as n from steps group by all"""),
]
