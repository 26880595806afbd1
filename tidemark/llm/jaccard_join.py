"""N-gram Jaccard join with token-combination prefixes, and the groups its links form.

A text's tokens are its distinct 5-word shingles.  Tokens are ordered by class, rare
before frequent, and by hash in a class.  Two texts of which fewer than t tokens of one
can be missing in the other share a signature of their prefixes, where a prefix

* takes rare tokens singly: each is a signature, and each counts 1 towards t,
* then frequent tokens in pairs within a subclass: c of them count c - 1, because all but
  one must be missing before no pair is left,

until it counts t.  Tokens found in one text only come first of all; they count, and need
no signature.  Texts with t of those have no partner.

The work goes in two rounds.  The first looks at the tokens of a part of the hashes, which
decide for most texts that they have no partner, the second at all tokens of the rest.  Sets are
compared where signatures meet, by whole sets of tokens.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, giving_back, stored, words_of
from tidemark.llm.graph import components

#: Words of a shingle; two sets link at a Jaccard similarity of 80 / 100.
WORDS, PERCENT = 5, 80
#: Tokens of more texts than this are frequent.
RARE = 16
#: The first round looks at the tokens whose hash is below this: three tenths of all. As
#: the token alone decides, every text that holds it reports it.
FIRST_BELOW = np.uint64(2**64 * 3 // 10)
#: Texts and tokens of a batch whose tokens are put together before they are shuffled.
BATCH_DOCS, BATCH_TOKENS = 4096, 1 << 20
MANY = 0xFFFF
#: Tokens of a block of texts that are compared with another block at once, about.
BLOCK_TOKENS = 200_000
#: Tokens that one task of a shuffle by token should get, about.
TASK_TOKENS = 8_000_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[0]
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of fewer words, one of the whole sequence."""
    words = words_of(text)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not words:
        return h
    if len(words) < WORDS:
        folded = np.full(1, len(words), np.uint64)
        for x in h:
            folded = _mixed(folded * _MIX[2] + x)
        return folded
    last = len(words) - WORDS + 1
    tokens = _mixed(sum(h[i : i + last] * _MIX[i] for i in range(WORDS)))
    tokens.sort()
    return tokens[np.append(True, tokens[1:] != tokens[:-1])]


def spare(n):
    """Tokens of a set of n that a linked set may lack."""
    return n * (100 - PERCENT) // 100


def _key(tokens: np.ndarray) -> tuple[int, int]:
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh128_digest(tokens.tobytes()), np.int64).tolist())


def _buckets(tokens: np.ndarray, n_buckets: int) -> np.ndarray:
    """Ends of the buckets within sorted tokens; a bucket is a range of hashes."""
    of = ((tokens >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(n_buckets + 1, dtype=np.uint64))


def _batch_ids() -> Iterator[int]:
    from pyspark import TaskContext

    return itertools.count(TaskContext.get().partitionId() << 32)


def _sets(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[tuple]]:
    """Rows of ``columns`` with the text's token set in its place, a bounded batch at a time."""
    hashes, rows, held = WordHashes(), [], 0
    for batch in batches:
        others = [batch.column(c) for c in columns if c != "text"]
        for i, text in enumerate(batch.column("text")):
            tokens = shingle_set(text.as_py(), hashes)
            rows.append((*[c[i].as_py() for c in others], tokens))
            held += len(tokens)
            if len(rows) >= BATCH_DOCS or held >= BATCH_TOKENS:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


FIRST_SCHEMA = "batch long, bucket int, owner int, doc_id long, text_hash long, n long, k1 long, k2 long, tokens binary, owners binary"


def _first_round(n_buckets: int):
    """Rows of texts (bucket -1), and of each bucket's tokens in a batch with their owners.

    A token of several texts of the batch is sent once, with the owner ``MANY``.
    """

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("owner", pa.int32()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("tokens", pa.binary()), ("owners", pa.binary())])
        ids = _batch_ids()
        for rows in _sets(batches, ["doc_id", "text_hash", "text"]):
            batch, owners, found, out = next(ids), {}, [], []
            for doc_id, text_hash, tokens in rows:
                key = _key(tokens) if len(tokens) else (0, 0)
                if doc_id is not None and len(tokens) and key not in owners:
                    owners[key] = len(owners)
                    found.append(tokens[: np.searchsorted(tokens, FIRST_BELOW)])
                out.append({"batch": batch, "bucket": -1, "owner": owners.get(key, 0), "doc_id": doc_id, "text_hash": text_hash, "n": len(tokens), "k1": key[0], "k2": key[1]})
            tokens = np.concatenate([*found, np.empty(0, np.uint64)])
            if len(tokens):
                order = np.argsort(tokens)
                tokens, owner = tokens[order], np.repeat(np.arange(len(found), dtype=np.uint16), [len(x) for x in found])[order]
                first = np.append(True, tokens[1:] != tokens[:-1])
                owner[np.append(tokens[1:] == tokens[:-1], False)] = MANY
                tokens, owner = tokens[first], owner[first]
                ends = _buckets(tokens, n_buckets)
                short = tokens.astype(np.uint32)  # the bucket holds the other bits
                for b, (i, j) in enumerate(itertools.pairwise(ends)):
                    if i < j:
                        out.append({"batch": batch, "bucket": b, "tokens": short[i:j].tobytes(), "owners": owner[i:j].tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


@giving_back
def _count_lone(table: pa.Table) -> pa.Table:
    """Of one bucket: how many tokens of each owner no other text has, by batch."""
    tokens = [np.frombuffer(x, np.uint32) for x in table.column("tokens").to_pylist()]
    owners = np.concatenate([np.frombuffer(x, np.uint16) for x in table.column("owners").to_pylist()])
    lengths = [len(x) for x in tokens]
    tokens = np.concatenate(tokens)
    order = np.argsort(tokens)
    tokens = tokens[order]
    edge = np.append(True, tokens[1:] != tokens[:-1])
    lone = np.zeros(len(tokens), bool)
    lone[order] = edge & np.append(edge[1:], True)
    lone &= owners != MANY
    starts = np.cumsum([0, *lengths])
    counts = [np.bincount(owners[i:j][lone[i:j]]).astype(np.uint32).tobytes() for i, j in itertools.pairwise(starts)]
    return pa.table({"batch": table.column("batch"), "counts": pa.array(counts, pa.binary())})


@giving_back
def _may_link(texts: pa.Table, lone: pa.Table) -> pa.Table:
    """Texts of a batch without as many lone tokens as rule a partner out."""
    found = np.zeros(MANY + 1, np.int64)
    for counts in lone.column("counts").to_pylist():
        counts = np.frombuffer(counts, np.uint32)
        found[: len(counts)] += counts
    n = texts.column("n").to_numpy()
    keep = (found[texts.column("owner").to_numpy()] <= spare(n)) & (n > 0)
    return texts.select(["doc_id", "text_hash", "n", "k1", "k2"]).filter(pa.array(keep))


SECOND_SCHEMA = "batch long, bucket int, doc_id long, set_id long, tokens binary, counts binary"


def _second_round(n_buckets: int):
    """Rows of texts with all tokens (bucket -1), and of each bucket's distinct tokens in a batch with the number of its texts."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("set_id", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary())])
        ids = _batch_ids()
        for rows in _sets(batches, ["doc_id", "set_id", "k1", "k2", "text"]):
            batch, out, seen = next(ids), [], {}
            for doc_id, set_id, k1, k2, tokens in rows:
                # An id may have several texts; each set that was asked for counts, once.
                if set_id not in seen and _key(tokens) == (k1, k2):
                    seen[set_id] = tokens
                    out.append({"batch": batch, "bucket": -1, "doc_id": doc_id, "set_id": set_id, "tokens": tokens.tobytes()})
            if not seen:
                continue
            tokens, counts = np.unique(np.concatenate(list(seen.values())), return_counts=True)
            counts = np.minimum(counts, 255).astype(np.uint8)
            for b, (i, j) in enumerate(itertools.pairwise(_buckets(tokens, n_buckets))):
                if i < j:
                    out.append({"batch": batch, "bucket": b, "tokens": tokens[i:j].tobytes(), "counts": counts[i:j].tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


@giving_back
def _classes(table: pa.Table) -> pa.Table:
    """Of one bucket: the tokens of several texts, rare (1) or frequent (2), by batch."""
    tokens = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()])
    starts = np.cumsum([0, *[len(x) for x in tokens]])
    tokens = np.concatenate(tokens)
    _, place = np.unique(tokens, return_inverse=True)
    total = np.bincount(place, counts)[place]
    kind = np.where(total > RARE, 2, np.where(total > 1, 1, 0)).astype(np.uint8)
    replies = [(t[k > 0].tobytes(), k[k > 0].tobytes()) for t, k in ((tokens[i:j], kind[i:j]) for i, j in itertools.pairwise(starts))]
    return pa.table({"batch": table.column("batch"), "tokens": pa.array([t for t, _ in replies], pa.binary()), "kinds": pa.array([k for _, k in replies], pa.binary())})


def _subclasses(band: int) -> int:
    """Subclasses of frequent tokens for sets of a band of sizes, about a third of a full prefix."""
    return max(1, int(1.25**band) // 15)


def signatures(n: int, tokens: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Signatures of a set of n tokens, of which ``tokens`` (sorted) are in other sets too."""
    need = spare(n) + 1 - (n - len(tokens))
    if need <= 0:
        return np.empty(0, np.uint64)
    rare = tokens[kinds == 1][:need]
    out = [_mixed(rare)]
    if len(rare) < need:
        need, frequent = need - len(rare), tokens[kinds == 2]
        band = int(np.floor(np.log(n) / np.log(1.25)))
        # Linked sets are of the same band or the next; each is indexed for both.
        for scheme in (band, band + 1):
            of = frequent % np.uint64(_subclasses(scheme))
            again = np.ones(len(of), bool)
            again[np.unique(of, return_index=True)[1]] = False
            end = np.searchsorted(np.cumsum(again), need) + 1
            part, of = frequent[:end], of[:end]
            order = np.argsort(of, kind="stable")
            for group in np.split(part[order], np.flatnonzero(np.diff(of[order])) + 1):
                i, j = np.triu_indices(len(group), 1)
                out.append(_mixed(_mixed(group[i] + np.uint64(scheme)) * _MIX[2] + group[j]))
    return np.unique(np.concatenate(out))


@giving_back
def _prefixes(texts: pa.Table, replies: pa.Table) -> pa.Table:
    """Of one batch: each text's shared tokens and signatures."""
    known = np.concatenate([np.frombuffer(x, np.uint64) for x in replies.column("tokens").to_pylist()] or [np.empty(0, np.uint64)])
    kinds = np.concatenate([np.frombuffer(x, np.uint8) for x in replies.column("kinds").to_pylist()] or [np.empty(0, np.uint8)])
    order = np.argsort(known)
    known, kinds = np.append(known[order], np.uint64(2**64 - 1)), np.append(kinds[order], np.uint8(0))
    ids, sets, sizes, shared, signed = [], [], [], [], []
    for doc_id, set_id, tokens in zip(*(texts.column(c).to_pylist() for c in ("doc_id", "set_id", "tokens")), strict=True):
        tokens = np.frombuffer(tokens, np.uint64)
        place = np.searchsorted(known[:-1], tokens)
        in_both = known[place] == tokens
        found = signatures(len(tokens), tokens[in_both], kinds[place[in_both]])
        if len(found):
            ids.append(doc_id)
            sets.append(set_id)
            sizes.append(len(tokens))
            shared.append(tokens[in_both].view(np.int64))
            signed.append(found.view(np.int64))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "set_id": pa.array(sets, pa.int64()), "n": pa.array(sizes, pa.int64()), "shared": pa.array(shared, pa.list_(pa.int64())), "signed": pa.array(signed, pa.list_(pa.int64()))})


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that link, and their ids, by whole sets; tokens that no other text has meet nothing."""
    side = lambda c: sets.select(F.col("set_id").alias(c), F.col("doc_id").alias(f"doc_{c}"), F.col("n").alias(f"n_{c}"), F.col("shared").alias(f"shared_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("shared_a", "shared_b"))
    return both.where(100 * common >= PERCENT * (F.col("n_a") + F.col("n_b") - common)).select("a", "b", "doc_a", "doc_b")


def _overlaps(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Shared tokens of each of one list with each of the other.

    Tokens of many sets go through a product of 0-1 matrices, of which there are few by
    their number of occurrences; the others through their lists of sets.
    """
    sizes = [len(x) for x in (*one, *other)]
    _, token = np.unique(np.concatenate([*one, *other]), return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    common = np.bincount(token) > 64
    column = (np.cumsum(common) - 1)[token]
    dense = np.zeros((len(sizes), common.sum()), np.float32)
    hot = common[token]
    dense[owner[hot], column[hot]] = 1
    out = (dense[: len(one)] @ dense[len(one) :].T).astype(np.int64)
    token, owner = token[~hot], owner[~hot]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for step in range(1, 64):  # sets of one list stand before those of the other
        same = token[step:] == token[:-step]
        if not same.any():
            break
        x, y = owner[:-step][same], owner[step:][same]
        across = (x < len(one)) & (y >= len(one))
        np.add.at(out, (x[across], y[across] - len(one)), 1)
    return out


@giving_back
def _links_of_blocks(table: pa.Table) -> pa.Table:
    """Links between groups, by id, found in one pair of blocks of a family; none that others imply."""
    rows = table.to_pydict()
    low, high = rows["low"][0], rows["high"][0]
    at = [np.flatnonzero(np.array(rows["block"]) == block) for block in (low, high)]
    ids, n, group = (np.array(rows[c], np.int64) for c in ("doc_id", "n", "component"))
    tokens = [np.array(x, np.int64) for x in rows["shared"]]
    links, parent = [], {}
    if all(len(x) for x in at):
        x, y = at
        common = _overlaps([tokens[i] for i in x], [tokens[i] for i in y])
        link = 100 * common >= PERCENT * (n[x][:, None] + n[y][None, :] - common)
        i, j = np.nonzero(link & (group[x][:, None] != group[y][None, :]))

        def root(g: int) -> int:
            while parent.setdefault(g, g) != g:
                parent[g] = parent[parent[g]]
                g = parent[g]
            return g

        for p, q in zip(x[i].tolist(), y[j].tolist(), strict=True):
            one, other = root(int(group[p])), root(int(group[q]))
            if one != other:
                parent[one] = other
                links.append((int(ids[p]), int(ids[q])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _links(sets: DataFrame) -> DataFrame:
    """Links of ids, enough to connect whatever is connected; sets are told apart by their numbers.

    Where a signature meets, all are compared with the smallest number first.  Signatures whose
    texts this leaves in different groups make up families, by that smallest number; in a
    family all texts are compared, in pairs of blocks of bounded size.
    """
    signed = stored(sets.select("set_id", "n", F.explode("signed").alias("signature")), "signed")
    fits = 100 * F.least("n", "first.n") >= PERCENT * F.greatest("n", "first.n")
    first = signed.groupBy("signature").agg(F.min(F.struct("set_id", "n")).alias("first"), F.count("*").alias("texts")).where("texts > 1").drop("texts")
    stars = stored(
        signed.join(first, "signature").where((F.col("set_id") > F.col("first.set_id")) & fits).select(F.col("first.set_id").alias("a"), F.col("set_id").alias("b")).distinct(),
        "stars",
    )
    links = stored(_verified(stars, sets), "links")
    groups = components(links.select("a", "b")).withColumnRenamed("id", "set_id")
    grouped = stored(signed.join(groups, "set_id", "left").select("signature", "set_id", F.coalesce("component", "set_id").alias("component")), "grouped")
    split = grouped.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("set_id").alias("family")).where("low < high").select("signature", "family")
    families = stored(grouped.join(split, "signature").select("family", "set_id", "component").distinct(), "families")
    members = families.join(sets.select("set_id", "doc_id", "n", "shared"), "set_id")
    blocks = families.join(sets.select("set_id", F.size("shared").alias("tokens")), "set_id").groupBy("family").agg(F.ceil(F.sum("tokens") / BLOCK_TOKENS).alias("blocks"))
    dealt = members.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
    paired = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.select("family", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "doc_id", "n", "component", "shared")
    return links.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).unionByName(paired.groupBy("family", "low", "high").applyInArrow(_links_of_blocks, "a long, b long"))


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two texts link when 100 * shared >= 80 * united shingles of five words (A-Z in lower
    case, words between ASCII white space).  A component is named by its smallest id.
    Texts without words are empty and link with nothing; null texts too.  Rows of one id
    are one document, whatever their texts: they share a component.  Rows with a null id
    link with nothing and have a null component.  Whole texts are read, however long; a
    similarity of exactly 80 % links.  Only the id and the text are read, so extra columns
    may have any name.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    size = read.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = stored(read.mapInArrow(_first_round(max(at_least, size // (20 * TASK_TOKENS))), FIRST_SCHEMA), "sets")
    texts = first.where("bucket < 0").select("batch", "owner", "doc_id", "text_hash", "n", "k1", "k2")
    usable = texts.where("doc_id IS NOT NULL AND n > 0")
    lone = first.where("bucket >= 0").select("batch", "bucket", "tokens", "owners").groupBy("bucket").applyInArrow(_count_lone, "batch long, counts binary")
    may_link = usable.groupBy("batch").cogroup(lone.groupBy("batch")).applyInArrow(_may_link, "doc_id long, text_hash long, n long, k1 long, k2 long")
    # An id can hold several sets: they are numbered, and each is asked for by one of its texts.
    smallest = may_link.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"), F.min("n").alias("n"))
    asked = stored(smallest.select(F.monotonically_increasing_id().alias("set_id"), "one.doc_id", "one.text_hash", "k1", "k2", "n"), "asked")
    tokens = asked.agg(F.sum("n")).head()[0] or 0
    second = stored(
        # The same plan at every size: a broadcast would end where the texts get many.
        read.join(asked.drop("n").hint("merge"), ["doc_id", "text_hash"]).select("doc_id", "set_id", "k1", "k2", "text").mapInArrow(_second_round(max(at_least, tokens // TASK_TOKENS)), SECOND_SCHEMA),
        "tokens",
    )
    replies = second.where("bucket >= 0").select("batch", "bucket", "tokens", "counts").groupBy("bucket").applyInArrow(_classes, "batch long, tokens binary, kinds binary")
    whole = second.where("bucket < 0").select("batch", "doc_id", "set_id", "tokens")
    sets = stored(whole.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(_prefixes, "doc_id long, set_id long, n long, shared array<long>, signed array<long>"), "prefixes")
    links = _links(sets)
    # Stored, so that both sides of the join are plain shuffles, where a large group of copies
    # can be split; texts that stand alone have no row there.
    copies = usable.groupBy("k1", "k2").agg(F.min("doc_id").alias("same"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    named = usable.join(stored(copies, "copies"), ["k1", "k2"], "left").select("doc_id", "n", F.coalesce("same", "doc_id").alias("same"))
    several = named.groupBy("doc_id").agg(F.min("same").alias("a"), F.max("same").alias("high")).where("a < high").select("doc_id", "a")
    by_id = named.join(several, "doc_id").where("same > a").select("a", F.col("same").alias("b"))
    groups = stored(components(links.unionByName(by_id)), "components")
    linked = named.join(groups, F.col("same") == F.col("id"), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "same").alias("component_id"))
    alone = texts.where("doc_id IS NULL OR n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
