"""From raw documents to training shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read
again before the next.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark
from tidemark.llm import decontaminate, jaccard_join, mixing, quality, sharding
from tidemark.llm.common import free_name, stored
from tidemark.llm.queries import MIX_WEIGHTS, mix_levels

# Functions travel to the Python workers whole, so these need not have the package.
cloudpickle.register_pickle_by_value(tidemark)

#: Share of the words that are left after the filters which the mix takes.
MIX_SHARE = 0.8


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes to be of quality 1.

    Each row by itself, so repeated rows and null ids stay or go as their texts do; null
    texts count as empty; an empty table stays one; extra columns may have any name.
    """
    machine = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_quality(docs, machine)


def _ids_of_their_own(docs: DataFrame) -> DataFrame:
    """The documents with ids that tell apart different texts: rows of an id that has several get new ids, larger than all others."""
    text_hash = F.coalesce(F.xxhash64("text"), F.lit(0))
    by_id = docs.groupBy("doc_id").agg(F.min(text_hash).alias("low"), F.max(text_hash).alias("high"))
    several = stored(by_id.where("low < high AND doc_id IS NOT NULL").select("doc_id"), "several")
    if several.isEmpty():
        return docs
    largest = docs.agg(F.max("doc_id")).head()[0]
    number = F.monotonically_increasing_id()
    # Stored, so that a row keeps its new id.
    renamed = stored(docs.join(several, "doc_id", "left_semi").select(docs.columns).withColumn("doc_id", F.lit(largest).cast("long") + 1 + number), "renamed")
    return docs.join(several, "doc_id", "left_anti").select(docs.columns).unionByName(renamed)


def keep_first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, once; all with a null id.

    Different texts of one id are documents of their own, whichever of them resemble
    others; where an id has several they come after all other ids, and keep theirs. Null
    and empty texts resemble nothing, but rows that are equal in id and text are one
    document; an empty table stays one; extra columns may have any name.
    """
    own = free_name("own_id", docs.columns)
    kept_ids = docs.withColumn(own, F.col("doc_id"))
    apart = _ids_of_their_own(kept_ids)
    groups = stored(jaccard_join.near_duplicate_groups(apart.select("doc_id", "text")).select("doc_id", "component_id"), "groups")
    others = stored(groups.where("doc_id <> component_id").select("doc_id").distinct(), "others")
    repeated = stored(groups.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    left = apart.join(others, "doc_id", "left_anti")
    if not repeated.isEmpty():
        once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        left = left.join(repeated, "doc_id", "left_anti").select(apart.columns).unionByName(once.select(apart.columns))
    return left.withColumn("doc_id", F.col(own)).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; each row by its own text, whatever its id.

    Null and empty texts hold none and stay, repeated rows stay or go together, an empty
    table stays one, and extra columns may have any name.
    """
    text_id = F.unhex(F.md5(F.col("text").cast("binary")))
    hits = decontaminate.contaminated(docs.select(text_id.alias("text_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="text_id")
    hit = free_name("hit_id", docs.columns)
    ids = stored(hits.select(F.col("doc_id").alias(hit)).distinct(), "contaminated")
    return docs.join(ids, text_id == F.col(hit), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights, each at most once.

    Rows of equal id and text come in or stay out together; null levels are leaves of
    their own; documents without words cost nothing; an empty table stays one; extra
    columns may have any name.
    """
    return mixing.mix_to_weights(docs, mix_levels(), MIX_WEIGHTS, budget_share=MIX_SHARE, max_epochs=1).select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document.

    Null ids and texts and repeated rows have places of their own; only id and text are
    read, so extra columns may have any name; an empty table gives no rows.
    """
    return sharding.feistel_shards(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_first_of_group),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix),
    ("sharding", shard),
]

#: The classifier cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each kept as a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
