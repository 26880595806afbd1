"""One named query for each corpus operator, over whole tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import checking, compression, decontaminate, jaccard_join, licenses, maxent_lm, mixing, neighbours, quality, runs, sharding, token_counts, warc, whitening
from tidemark.session import new_path

#: Weights of the mixing query: an invented tree of domains, languages and sources.
MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}}

#: A public vocabulary with scores, counted with as a unigram model.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix_levels() -> dict:
    """Domain from the source's number, then language and source."""
    number = F.coalesce(F.expr("try_cast(substring(source, 4) as int)"), F.lit(0)) % 3
    domain = F.when(number == 0, "web").when(number == 1, "books").otherwise("code")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return jaccard_join.near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op3_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest neighbours of every hundredth vector among all others."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 8 shards."""
    return sharding.feistel_shards(_table(spark, sf_dir, "documents"))


def op5_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learned from four fifths of them."""
    encoded = maxent_lm.encode(_table(spark, sf_dir, "documents"))
    return maxent_lm.score_encoded(encoded, maxent_lm.fit_encoded(encoded))


def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as WARC records and read back from the archives."""
    path = new_path(spark, "llm-archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path, with_payload=False).where("reason IS NULL")
    return records.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to")


def op7_unigram_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokens of every document under a public vocabulary."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), token_counts.read_vocabulary(vocabulary))


def op8_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of all words, domain before language before source, at most two epochs."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix_to_weights(docs, mix_levels(), MIX_WEIGHTS)
    return mixed.select("doc_id", "mix_levels.*", F.col("mix_tokens").alias("n_tokens"), F.col("mix_epoch").alias("epoch"), F.col("mix_place").alias("place"), F.col("mix_budget").alias("leaf_budget"))


def op9_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labelled two thirds."""
    docs = _table(spark, sf_dir, "documents")
    scored = quality.quality_scores(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark, by item."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return compression.quality_rules(_table(spark, sf_dir, "documents"))


def op12_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four components of largest variance."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, in every tenth with a period planted, and digests of them."""
    return runs.digests(runs.periodic_runs(_table(spark, sf_dir, "documents"), rewrite=runs.planted))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_jaccard_join,
        op3_inverted_multi_index,
        op4_feistel_shards,
        op5_maxent_scores,
        op6_warc_salvage,
        op7_unigram_token_counts,
        op8_mix_to_weights,
        op9_quality_machine,
        op10_spaced_seed_decontamination,
        op11_compression_bands,
        op12_exact_whitening,
        op13_periodic_runs,
    )
}

ORACLES: dict[str, str] = {
    "op2_jaccard_join": checking.JACCARD,
    "op4_feistel_shards": checking.SHARDS,
    "op8_mix_to_weights": checking.mix_sql(MIX_WEIGHTS),
    "op10_spaced_seed_decontamination": checking.CONTAMINATED,
    "op13_periodic_runs": checking.RUNS,
    "op6_warc_salvage": """
with payloads as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
  from pages),
kept as (select *, max(page_id) over (partition by payload_digest) as last_id from payloads)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> last_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> last_id then last_id end as refers_to from kept""",
}
