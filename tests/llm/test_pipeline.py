"""Each stage of the pipeline on what the stage before it kept, against a plainer way."""

from collections import Counter

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import checker, difference
from tidemark.llm import checking, mixing, quality
from tidemark.llm.common import stored
from tidemark.llm.queries import ORACLES


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def with_documents(sf, docs) -> duckdb.DuckDBPyConnection:
    con = checker(sf)
    con.execute("drop view documents")
    con.register("documents", pa.Table.from_pylist([r.asDict() for r in docs.collect()]))
    return con


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], sf), "test-" + name.replace(" ", "-")))
    assert [d.columns for d in seen[1:-1]] == [columns] * (len(seen) - 2)
    counts = [d.count() for d in seen]
    assert counts[-1] > 0
    raw, good, single, clean, mixed, sharded = seen

    machine = quality.fit(raw, spark.read.parquet(f"{sf}/labels.parquet"))
    predicted = quality.quality_scores(raw, machine).where("predicted = 1")
    assert rows_of(good.select("doc_id")) == rows_of(predicted.select("doc_id"))

    con = with_documents(sf, good)
    groups = con.sql(ORACLES["op2_jaccard_join"])
    first = con.sql("select distinct component_id from groups").fetchall()
    assert rows_of(single.select("doc_id")) == Counter(first)
    assert not rows_of(single) - rows_of(good)

    con = with_documents(sf, single)
    hits = {r[0] for r in con.sql("select doc_id from (" + checking.CONTAMINATED + ")").fetchall()}
    assert hits
    assert rows_of(clean) == rows_of(single.where(~F.col("doc_id").isin(*hits)))

    assert not rows_of(mixed) - rows_of(clean)
    words = lambda df: df.agg(F.sum(mixing.token_count())).head()[0]
    assert 0 < words(mixed) <= int(words(clean) * corpus_pipeline.MIX_SHARE)

    assert difference(sharded, with_documents(sf, mixed), ORACLES["op4_feistel_shards"]) is None


def test_rows_are_decontaminated_by_their_own_text(spark, tmp_path):
    """A contaminated row takes no clean one with it that has a null id too, or the same id."""
    item = " ".join(f"b{i}" for i in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, "clean one"), (None, "clean two"), (None, None), (7, "clean " * 30), (8, ""), (9, None)]
    hit = [(None, "x " + item), (7, item + " y"), (7, item + " y"), (10, item)]
    docs = spark.createDataFrame(clean + hit, "doc_id long, text string")
    assert rows_of(corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))) == Counter(clean)


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), "test-empty")
        assert docs.count() == 0


CLASHES = [
    "hit_id", "text_id", "own_id", "text_hash", "mix_budget", "full_epochs", "cutoff", "mix_tokens", "mix_md5", "mix_epochs", "mix_epoch", "mix_levels",
    "mix_0_domain", "mix_row", "mix_id", "component_id", "n_shingles", "set_id", "score", "predicted", "label", "row_number", "position", "size", "shard", "slot", "law", "count", "low", "high",
]


def test_stages_beside_clashing_names(spark, sf):
    """Extra columns, whatever their names, come through every stage as they are, and decide nothing."""
    plain = spark.read.parquet(f"{sf}/documents.parquet")
    odd = plain.select("*", *[F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in CLASHES])
    for name, stage in corpus_pipeline.STAGES:
        plain, odd = (stored(stage(spark, docs, sf), "test-clash") for docs in (plain, odd))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert rows_of(odd.select(plain.columns)) == rows_of(plain)
            assert all(r[c] == f"{c} {r.doc_id}" for r in odd.select("doc_id", *CLASHES).collect() for c in CLASHES)
    assert rows_of(odd.select(plain.columns)) == rows_of(plain)


def test_texts_of_one_id_are_documents_of_their_own(spark, sf):
    text = lambda n, k=40: " ".join(f"w{n}x{i}" for i in range(k))
    rows = [(1, text(1)), (1, text(2)), (1, text(3)), (1, text(3)), (2, text(2) + " more"), (3, text(4)), (3, text(4)), (4, None), (4, text(5)), (None, text(6)), (None, text(6)), (5, ""), (5, "")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    kept = corpus_pipeline.keep_first_of_group(spark, docs, sf)
    assert kept.columns == docs.columns
    # Of the near copies the row of id 2 stays, as rows of an id with several texts come last.
    assert rows_of(kept.select("doc_id", "text")) == Counter(
        [(1, text(1)), (1, text(3)), (2, text(2) + " more"), (3, text(4)), (4, None), (4, text(5)), (None, text(6)), (None, text(6)), (5, "")]
    )
