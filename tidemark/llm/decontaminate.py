"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words at the fixed positions of a mask; the positions between
are ignored, so a seed survives substituted words there.  Seeds of documents meet seeds
of benchmark items, and the words around each meeting are compared position by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slot_count, slot_flags, slots_of_hash

#: Of every stretch of 8 to 13 words with at most a fifth substituted, one of the masks
#: meets four kept words at some place (checked over all substitutions in the tests).
MASKS = ("11101", "110011")
#: Words compared at once, and the least length of a benchmark text that counts.
STRETCH, LEAST = 13, 8


def needed(stretch: Column) -> Column:
    """Equal words asked of a stretch: four fifths, rounded up."""
    return F.ceil(stretch * 4 / 5).cast("int")


def word_hashes(text: str) -> Column:
    """Hashes of the runs of letters and digits, in lower case; an empty array for null."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seed(words: Column, at: Column, mask: str) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"], F.lit(mask))


def _places(words: Column, mask: str) -> Column:
    return F.when(F.size(words) >= len(mask), F.sequence(F.lit(0), F.size(words) - len(mask))).otherwise(F.array().cast("array<int>"))


def seeds_of(words: Column, flags: Column | None = None, n_slots: int = 0) -> Column:
    """Structs of seed and place, over all masks; with ``flags`` of those whose slots are set."""

    def set_there(at: Column, mask: str) -> Column:
        one, other = slots_of_hash(_seed(words, at, mask), n_slots)
        return F.get(flags, one) & F.get(flags, other)

    def found(mask: str) -> Column:
        places = _places(words, mask)
        if flags is not None:
            places = F.filter(places, lambda at: set_there(at, mask))
        return F.transform(places, lambda at: F.struct(_seed(words, at, mask).alias("seed"), at.alias("at")))

    return F.concat(*[found(mask) for mask in MASKS])


def with_context(df: DataFrame) -> DataFrame:
    """One row for each seed, with the words that a stretch over it can reach."""
    reach = STRETCH - 1
    start = F.greatest(F.col("s.at") - reach, F.lit(0))
    # The outer form infers no filter on the size; that would be pushed below the
    # projections together with a copy of them, and run all of it twice or worse.
    rows = df.withColumn("s", F.explode_outer("seeds")).where("s IS NOT NULL").withColumn("from", start)
    return rows.select(
        *[c for c in df.columns if c not in ("seeds", "words")],
        F.col("s.seed").alias("seed"),
        F.col("s.at").alias("at"),
        (F.col("s.at") - F.col("from")).alias("lead"),
        F.slice("words", F.col("from") + 1, F.col("s.at") - F.col("from") + 2 * reach).alias("near"),
    )


def seed_table(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Seeds of the benchmark with their surroundings."""
    items = benchmark.select(F.col(item_col).alias("item_id"), word_hashes(text_col).alias("words"))
    items = items.withColumn("n_words", F.size("words")).where(F.col("n_words") >= LEAST)
    return with_context(items.withColumn("seeds", seeds_of(F.col("words")))).distinct()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_slots: int = 1 << 26,
) -> DataFrame:
    """Documents that hold a passage of a benchmark item, substituted words tolerated.

    A document and an item match when, for some alignment, 13 words in a row (all words of
    an item of 8 to 12) agree in four fifths of their places.  Returns a row per document
    and item: doc_id, item_id, n_seeds (verified seeds), first_word (place of the first)
    and best_equal (most equal words in a stretch).

    Words are runs of letters and digits in lower case.  Null and empty texts match
    nothing, items of under 8 words neither; repeated rows of an id count as one document;
    a null id or item is a value like others; either table may be empty.  Slots beyond
    ``most_slots`` would only thin out better: the join that follows is exact.
    """
    items = seed_table(benchmark, item_col, item_text_col)
    n_seeds = items.agg(F.count_distinct("seed")).head()[0]
    n_slots = slot_count(n_seeds, most_slots)
    slots = slot_flags(items.select("seed"), n_slots)
    read = docs.select(F.col(id_col).alias("doc_id"), word_hashes(text_col).alias("words"))
    # The flags are named once, so the optimizer puts them in place of the column and no
    # row carries them.
    seeds = F.transform(F.array("flags"), lambda flags: seeds_of(F.col("words"), flags, n_slots))[0]
    hits = with_context(read.withColumn("flags", slots).withColumn("seeds", seeds).drop("flags"))
    mine, theirs = hits.alias("d"), items.alias("b")
    pairs = mine.join(theirs, F.col("d.seed") == F.col("b.seed")).select(
        "doc_id",
        "item_id",
        F.col("d.at").alias("at"),
        F.least(F.col("n_words"), F.lit(STRETCH)).alias("stretch"),
        F.least("d.lead", "b.lead").alias("lead"),
        F.col("d.lead").alias("d_lead"),
        F.col("b.lead").alias("b_lead"),
        F.col("d.near").alias("d_near"),
        F.col("b.near").alias("b_near"),
    )
    tail = F.least(F.size("d_near") - F.col("d_lead"), F.size("b_near") - F.col("b_lead"))
    aligned = lambda side: F.slice(f"{side}_near", F.col(f"{side}_lead") - F.col("lead") + 1, F.col("lead") + F.col("tail"))
    equal = F.zip_with(aligned("d"), aligned("b"), lambda x, y: (x == y).cast("int"))
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size("equal") - F.col("stretch") + 1),
            lambda i: F.aggregate(F.slice("equal", i, F.col("stretch")), F.lit(0), lambda a, x: a + x),
        )
    )
    return (
        pairs.withColumn("tail", tail)
        .withColumn("equal", equal)
        .where(F.size("equal") >= F.col("stretch"))
        .withColumn("best", best)
        .where(F.col("best") >= needed(F.col("stretch")))
        .groupBy("doc_id", "item_id")
        .agg(F.count_distinct("at").alias("n_seeds"), F.min("at").alias("first_word"), F.max("best").alias("best_equal"))
    )
