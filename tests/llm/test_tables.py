"""Sharding, mixing and WARC archives, against plain versions and round trips."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, sharding, warc
from tidemark.llm.queries import MIX_WEIGHTS, mix_levels
from tidemark.session import new_path

DOCS = "doc_id long, text string, lang string, source string, shard int, position string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 1, "x") for i, t, lang, source in rows], DOCS)


# --- sharding ---------------------------------------------------------------------------


def plain_position(x, n, seed):
    """The permutation in plain integers."""
    a, b = sharding.sides(n)
    while True:
        left, right = divmod(x, b)
        for i, (k, c) in enumerate(sharding.round_keys(seed)):
            mixed = (right + k) % sharding.PRIME * ((right + c) % sharding.PRIME) % sharding.PRIME
            mixed = (mixed * sharding.MULTIPLIER + c) % sharding.PRIME
            left, right = right, (left + mixed) % (b if i % 2 else a)
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_positions_are_a_permutation(spark, n):
    rows = sharding.with_position(spark.range(n).withColumnRenamed("id", "row_number"), n, 11).collect()
    assert {r.row_number: r.position for r in rows} == {x: plain_position(x, n, 11) for x in range(n)}
    assert sorted(r.position for r in rows) == list(range(n))


def test_orders_differ_by_seed():
    n = 500
    one, other = ([plain_position(x, n, seed) for x in range(n)] for seed in (1, 2))
    assert sum(a == b for a, b in zip(one, other, strict=True)) < 10
    assert sum(abs(a - b) == 1 for a, b in zip(one, one[1:], strict=False)) < 20


def test_shards_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sharding.feistel_shards(docs, bucket_rows=50).collect()
    want = Counter((r.doc_id, len(r.text.encode()) + 1, zlib.crc32(r.text.encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert sorted(r.row_number for r in rows) == list(range(len(rows)))
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    counts = Counter(r.shard for r in rows).values()
    assert max(counts) - min(counts) <= 1
    again = sharding.feistel_shards(docs.repartition(3), bucket_rows=50)
    assert {(r.doc_id, r.shard, r.slot) for r in again.collect()} == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_sharding_edges(spark):
    rows = [(None, "a"), (None, "a"), (None, None), (1, None), (1, ""), (2, "é" * 50000)] + [(5, "same")] * 200
    got = sharding.feistel_shards(docs_of(spark, [(i, t, "en", "s") for i, t in rows]), bucket_rows=10).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").encode()) + 1) for i, t in rows)
    assert {r.text_crc32 for r in got if r.doc_id == 1} == {0}
    assert sorted(r.slot * 8 + r.shard for r in got) == list(range(len(rows)))
    assert {r.grown_shard for r in got} == {None}
    assert sharding.feistel_shards(docs_of(spark, [])).count() == 0


# --- mixing -----------------------------------------------------------------------------


def plain_fill(budget, caps, weights):
    """Budgets of children by rounds of handing out, as fractions."""
    from fractions import Fraction

    got = dict.fromkeys(caps, Fraction(0))
    left, free = Fraction(min(budget, sum(caps.values()))), {c for c in caps if weights[c]}
    while left > 0 and free:
        share = left / sum(weights[c] for c in free)
        full = {c for c in free if got[c] + share * weights[c] >= caps[c]}
        for c in full or free:
            more = caps[c] - got[c] if full else share * weights[c]
            got[c] += more
            left -= more
        if not full:
            break
        free -= full
    return got


@pytest.mark.parametrize("seed", range(6))
def test_children_share_a_budget(spark, seed):
    rng = random.Random(seed)
    caps = {f"=c{i}": rng.randint(0, 500) for i in range(12)}
    weights = {c: rng.randint(0, 9) for c in caps}
    budget = rng.randint(0, int(1.2 * sum(caps.values())))
    usable = sum(v for c, v in caps.items() if weights[c])
    nodes = spark.createDataFrame([("r", c, caps[c], weights[c], budget) for c in caps], "root string, child string, cap long, weight long, parent_budget long")
    got = {r.child: r.budget for r in mixing.fill(nodes, ["root"], "child").collect()}
    want = plain_fill(budget, caps, weights)
    for c in got:
        assert abs(got[c] - want[c]) <= 1
        assert 0 <= got[c] <= caps[c]
    assert sum(got.values()) == min(budget, usable)


def plain_mix(rows, weights, seed, budget_share, max_epochs):
    leaves = {}
    for r in rows:
        leaves.setdefault(r["leaf"], []).append(r)
    total = sum(r["n"] for r in rows)
    out = Counter()
    for leaf, budget in weights(leaves, int(total * budget_share), max_epochs).items():
        tokens = sum(r["n"] for r in leaves[leaf])
        full = budget // tokens if tokens else 1
        for r in leaves[leaf]:
            for e in range(full):
                out[(r["id"], e)] += 1
        place = lambda r, full=full: hashlib.md5(f"{seed}|{full}|{r['id']}|{hashlib.md5(r['text'].encode()).hexdigest()}".encode()).hexdigest()
        rest, used = budget - full * tokens if tokens else 0, 0
        for r in sorted(leaves[leaf], key=place):
            used += r["n"]
            if used > rest or not rest:
                break
            out[(r["id"], full)] += 1
    return out


def test_leaves_take_whole_epochs_and_a_prefix(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = mixing.mix_to_weights(docs, mix_levels(), MIX_WEIGHTS, budget_share=0.6, max_epochs=3, seed=4)
    rows = mixed.collect()
    given = {}
    for r in rows:
        leaf = tuple(r.mix_levels)
        given[leaf] = r.mix_budget
    number = lambda s: ("web", "books", "code")[int(s[3:]) % 3]
    plain = [{"id": r.doc_id, "text": r.text, "n": len(r.text.encode().split()), "leaf": (number(r.source), r.lang, r.source)} for r in docs.collect()]

    def budgets(leaves, budget, epochs):
        caps = {leaf: epochs * sum(r["n"] for r in rs) for leaf, rs in leaves.items()}
        # Leaves of which nothing was taken have a budget below their first document.
        return {leaf: given[leaf] for leaf in caps if leaf in given}

    assert Counter((r.doc_id, r.mix_epoch) for r in rows) == plain_mix(plain, budgets, 4, 0.6, 3)
    by_leaf = Counter()
    for r in rows:
        by_leaf[tuple(r.mix_levels)] += r.mix_tokens
    assert all(by_leaf[leaf] <= given[leaf] for leaf in given)


def test_shortage_goes_to_siblings_first(spark):
    """Leaf a1 lacks tokens: its sibling a2 takes the rest, and branch b gets no more."""
    rows = [(i, " ".join(["w"] * 10), "a", "a1") for i in range(2)]
    rows += [(100 + i, " ".join(["w"] * 10), "a", "a2") for i in range(50)]
    rows += [(200 + i, " ".join(["w"] * 10), "b", "b1") for i in range(50)]
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    docs = docs_of(spark, rows)
    got = {(r.mix_levels.lang, r.mix_levels.source): r.mix_budget for r in mixing.mix_to_weights(docs, levels, {}, budget_tokens=600, max_epochs=1).collect()}
    assert got == {("a", "a1"): 20, ("a", "a2"): 280, ("b", "b1"): 300}
    # With a branch that cannot take its share, the other branch does.
    got = {(r.mix_levels.lang, r.mix_levels.source): r.mix_budget for r in mixing.mix_to_weights(docs, levels, {"lang": {"a": 1, "b": 9}}, budget_tokens=700, max_epochs=1).collect()}
    assert got == {("a", "a1"): 20, ("a", "a2"): 180, ("b", "b1"): 500}


def test_tokens_below_a_weight_of_zero_make_no_room(spark):
    """A parent whose tokens lie mostly below such a child leaves its rest to its siblings."""
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    sizes = [("a", "x", 100), ("a", "y", 10), ("b", "y", 100)]
    docs = docs_of(spark, [(10 * i + k, "w " * 10, lang, source) for i, (lang, source, n) in enumerate(sizes) for k in range(n // 10)])
    mixed = mixing.mix_to_weights(docs, levels, {"source": {"x": 0}}, budget_tokens=80, max_epochs=1).collect()
    assert {(r.lang, r.source, r.mix_budget) for r in mixed} == {("a", "y", 10), ("b", "y", 70)}
    assert len(mixed) == 8


def test_mixing_edges(spark):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    rows = [(1, None, "en", None), (2, "", None, "s"), (3, "a b", None, "s"), (3, "a b", None, "s"), (None, "a b c", "en", "s"), (4, "w " * 60000, "de", "t")]
    docs = docs_of(spark, rows)
    got = mixing.mix_to_weights(docs, levels, {}, budget_share=1.0, max_epochs=1)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert Counter((r.doc_id, r.mix_epoch) for r in got.collect()) == Counter({(1, 0): 1, (2, 0): 1, (3, 0): 2, (None, 0): 1, (4, 0): 1})
    assert mixing.mix_to_weights(docs, levels, {"lang": {"de": 0}}, budget_share=1.0, max_epochs=1).where("doc_id = 4").count() == 0
    assert mixing.mix_to_weights(docs.limit(0), levels, {}).count() == 0


# --- WARC -------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, payload string, offset int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 0) for i, u, h in rows], PAGES)


def records_of(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        payload = ("<p>" + "".join(rng.choices("abc WARC/1.1\r\n\x1f\x8b", k=rng.randint(0, 400)))).encode("latin-1")
        out.append(warc.build_record(i, "http://a/", payload, hashlib.sha1(payload).hexdigest(), None) + b"\r\n")
    return out


@pytest.mark.parametrize("packed", [False, True])
def test_damage_costs_only_the_records_it_hits(packed):
    pieces = [warc.as_member(r) if packed else r for r in records_of(40)]
    starts = [sum(map(len, pieces[:i])) for i in range(len(pieces))]
    rng = random.Random(2)
    for trial in range(60):
        data, hit = bytearray(b"".join(pieces)), set()
        for _ in range(trial % 5):
            i = rng.randrange(len(pieces))
            at = starts[i] + rng.randrange(len(pieces[i]))
            data[at] ^= 1 << rng.randrange(8)
            hit.add(i)
        found = list(warc.salvage(bytes(data)))
        assert sum(f.length for f in found) == len(data)
        assert [f.offset for f in found] == [sum(g.length for g in found[:i]) for i in range(len(found))]
        ids = [int(f.headers["x-page-id"]) for f in found if f.reason is None and f.headers.get("x-page-id", "").isdigit()]
        assert set(range(len(pieces))) - hit <= set(ids)
        assert len([f for f in found if f.reason]) <= len(hit)


def test_cut_and_joined_archives():
    pieces = records_of(6)
    data = b"junk" + pieces[0] + pieces[1][:-9] + pieces[2] + warc.as_member(pieces[3]) + b"\x1f\x8b\x08 no member " + pieces[4] + pieces[5][:50]
    found = list(warc.salvage(data))
    assert [int(f.headers["x-page-id"]) for f in found if f.reason is None] == [0, 2, 3, 4]
    assert [f.offset for f in found if f.reason] == [0, 4 + len(pieces[0]), len(data) - 50 - len(pieces[4]) - 14, len(data) - 50]
    assert list(warc.salvage(b"")) == []
    assert [f.reason for f in warc.salvage(b"nothing here")] == ["no version line"]


def test_pages_come_back(spark):
    long = "<p>é" + "x" * 2000
    rows = [(1, "http://a/", long), (2, "u\r\nv", long), (3, None, long), (4, "b", None), (5, "b", ""), (6, "c", "short"), (7, "c", "short"), (None, "d", long), (8, "e", "WARC/1.1\r\n" * 300), (9, "f", "y" * 500_000), (9, "f", "y" * 500_000)]
    path = new_path(spark, "test-archives")
    warc.write_archives(pages_of(spark, rows), path, file_bytes=5000)
    got = warc.read_archives(spark, path).collect()
    assert [r for r in got if r.reason] == []
    body = {i: (h or "").encode() for i, _, h in rows}
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter((i, len(body[i]), hashlib.sha1(body[i]).hexdigest()) for i, *_ in rows)
    kinds = {(r.page_id, r.warc_type, r.refers_to) for r in got}
    assert kinds == {(1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None), (None, "revisit", 3), (8, "response", None), (9, "response", None)}
    assert all(r.payload == (b"" if r.warc_type == "revisit" else body[r.page_id]) for r in got)
    empty = new_path(spark, "test-archives")
    warc.write_archives(pages_of(spark, []), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_members_of_any_size_are_read(tmp_path):
    """A payload of many steps, packed to little, between two others; cut short it is a gap."""
    payload = b"<p>" + b"again and again " * (1 << 21)
    small = [warc.build_record(i, "http://a/", b"small", hashlib.sha1(b"small").hexdigest(), None) + b"\r\n" for i in (1, 3)]
    large = warc.build_record(2, "http://b/", payload, hashlib.sha1(payload).hexdigest(), None) + b"\r\n"
    member = warc.as_member(large)
    assert len(member) < len(large) / 50
    data = warc.as_member(small[0]) + member + small[1]
    for keep in (True, False):
        found = list(warc.salvage(data, keep))
        assert [(f.reason, f.payload_bytes) for f in found] == [(None, 5), (None, len(payload)), (None, 5)]
        assert found[1].digest == hashlib.sha1(payload).hexdigest() and found[1].length == len(member)
        assert found[1].payload == (payload if keep else None)
    for broken in (member[: len(member) // 2], member[:-4] + b"\0\0\0\0", warc.as_member(large + b"x"), warc.as_member(large[:-3]), warc.as_member(large.replace(b"again and", b"again  nd", 1))):
        found = list(warc.salvage(warc.as_member(small[0]) + broken + small[1]))
        assert [f.payload_bytes for f in found if f.reason is None] == [5, 5]
        assert [f.length for f in found if f.reason] == [len(broken)]


def test_mixing_beside_clashing_names(spark):
    """Columns named like those that the operator makes come out as they are."""
    clash = ["mix_budget", "full_epochs", "cutoff", "mix_tokens", "mix_md5", "mix_epochs", "mix_epoch", "mix_0_domain", "mix_0", "mix_row", "mix_id", "leaf_tokens", "mix_levels_"]
    rows = [(i, f"word{i} and more", "en" if i % 3 else None, f"src{i % 4}") for i in range(40)] + [(None, None, "en", None)]
    plain = docs_of(spark, rows).select("doc_id", "text", "lang", "source")
    odd = plain.select("*", *[F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(name) for name in clash])
    odd = odd.withColumn("mix_levels", F.lit("own"))
    want = {(r.doc_id, r.mix_epoch, r.mix_place, r.mix_budget) for r in mixing.mix_to_weights(plain, mix_levels(), MIX_WEIGHTS).collect()}
    got = mixing.mix_to_weights(odd, mix_levels(), MIX_WEIGHTS)
    assert got.columns[: len(odd.columns)] == odd.columns and len(set(got.columns)) == len(got.columns)
    found = got.select("doc_id", "mix_epoch_", "mix_place", "mix_budget_", *clash).collect()
    assert want == {(r[0], r[1], r[2], r[3]) for r in found} and len(found) == len(want)
    assert all(r[name] == f"{name} {-1 if r.doc_id is None else r.doc_id}" for r in found for name in clash)
