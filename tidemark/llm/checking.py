"""SQL for the checking engine: the corpus queries that SQL can express, worked out the plain way."""

from __future__ import annotations

from tidemark.llm import decontaminate, jaccard_join, mixing, runs, sharding

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Every text against every other one that shares a shingle.
JACCARD = rf"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
placed as (select doc_id, len(words) as n_words, unnest(words) as word, generate_subscripts(words, 1) as i from texts),
shingles as (
  select distinct doc_id, shingle from (
    select doc_id, i, n_words,
      string_agg(word, ' ') over (partition by doc_id order by i
        rows between current row and {jaccard_join.WORDS - 1} following) as shingle from placed)
  where i <= greatest(n_words - {jaccard_join.WORDS - 1}, 1)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as common
  from shingles x join shingles y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by 1, 2),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= {jaccard_join.PERCENT} * (x.n + y.n - common)),
reached as (select a, b from links union select reached.a, links.b from reached join links on reached.b = links.a),
lowest as (select a, min(b) as low from reached group by a)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id
from texts left join sizes using (doc_id) left join lowest on a = doc_id"""


def _shards(n_shards: int = 8, seed: int = 20, bucket_rows: int = 20_000) -> str:
    keys = sharding.round_keys(seed)
    prime, factor, rounds = sharding.PRIME, sharding.MULTIPLIER, sharding.ROUNDS
    # One row is one step: a round while i < rounds, then a new walk where the place is not below n.
    return f"""
with recursive crcs as (
  select list(list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i) order by i) as crc_of
  from range(256) as t(i)),
octets as (
  select doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint) as octets
  from documents),
read as (
  select doc_id, len(octets) + 1 as size,
    xor(list_reduce(octets, lambda c, o: xor(c >> 8, crc_of[1 + (xor(c, o) & 255)]), 4294967295), 4294967295) as text_crc32
  from octets, crcs),
counted as (
  select count(*) as n, greatest(1, (count(*) + {bucket_rows - 1}) // {bucket_rows}) as buckets,
    cast(ceil(sqrt(count(*))) as bigint) as a from read),
numbered as (
  select doc_id, size, text_crc32, n, a, (n + a - 1) // a as b, row_number() over (
    order by (coalesce(doc_id % {prime}, 0) * {factor} + text_crc32) % {prime} % buckets, doc_id nulls first, text_crc32, size) - 1 as row_number
  from read, counted),
steps as (
  select row_number, n, a, b, row_number // b as l, row_number % b as r, 0 as i from numbered
  union all
  select row_number, n, a, b,
    case when i < {rounds} then r else (l * b + r) // b end,
    case when i < {rounds} then (l + ((r + {[k for k, _ in keys]}[i + 1]) % {prime} * ((r + {[c for _, c in keys]}[i + 1]) % {prime}) % {prime}
      * {factor} + {[c for _, c in keys]}[i + 1]) % {prime}) % (case when i % 2 = 1 then b else a end) else (l * b + r) % b end,
    case when i < {rounds} then i + 1 else 0 end
  from steps where i < {rounds} or l * b + r >= n)
select doc_id, size, text_crc32, 'rows' as law, cast((l * s.b + r) % {n_shards} as integer) as shard,
  (l * s.b + r) // {n_shards} as slot, cast(null as integer) as grown_shard, row_number, l * s.b + r as position
from steps s join numbered using (row_number) where i = {rounds} and l * s.b + r < s.n"""


def _budgets(level: str, parents: list[str], weight: str) -> str:
    """One level of the tree: b_<level> holds the budgets of its nodes, from those of b_<parent>."""
    keys, above = ", ".join([*parents, level]), parents[-1] if parents else "root"
    within = f"partition by {', '.join(parents) or '0'}"
    running = f"{within} order by cap / weight, {level} rows unbounded preceding"
    return f"""
n_{level} as (
  select {keys}, {weight} as weight, cast(sum(cap) as hugeint) as cap from leaves group by {keys}),
f_{level} as (
  select *, sum(cap) over ({running}) * weight + cap * (sum(weight) over ({within}) - sum(weight) over ({running}))
    <= budget * weight as is_full
  from n_{level} {'join' if parents else 'cross join'} b_{above} {f"using ({', '.join(parents)})" if parents else ""}),
o_{level} as (
  select *, budget - sum(case when is_full then cap else 0 end) over ({within}) as rest,
    sum(case when is_full then 0 else weight end) over ({running}) as to_here,
    greatest(sum(case when is_full then 0 else weight end) over ({within}), 1) as total from f_{level}),
b_{level} as (
  select {keys}, case when is_full then cap
    else rest::hugeint * to_here::hugeint // total::hugeint - rest::hugeint * (to_here - weight)::hugeint // total::hugeint end as budget
  from o_{level})"""


def _mix(weights: dict[str, dict[str, int]], max_epochs: int = 2, seed: int = 8) -> str:
    def weight(level: str) -> str:
        cases = "".join(f" when '={value}' then {w}" for value, w in weights.get(level, {}).items())
        return f"cast(case {level}{cases} else 1 end as hugeint)" if cases else "cast(1 as hugeint)"

    place = lambda epoch: f"md5({seed} || '|' || {epoch} || '|' || coalesce(cast(doc_id as varchar), '') || '|' || text_md5)"
    return f"""
with read as (
  select doc_id, lang as lang_, source as source_, len({WORDS}) as n_tokens, md5(coalesce(text, '')) as text_md5,
    case coalesce(try_cast(substring(source, 4) as integer), 0) % 3 when 0 then 'web' when 1 then 'books' else 'code' end as domain_
  from documents),
keyed as (
  select *, '=' || domain_ as domain, coalesce('=' || lang_, '-') as lang, coalesce('=' || source_, '-') as source from read),
leaves as (
  select domain, lang, source, sum(n_tokens)::hugeint as leaf_tokens, sum(n_tokens)::hugeint * {max_epochs} as cap from keyed group by all),
b_root as (select least(cast(floor(sum(leaf_tokens) * 0.5::double) as hugeint), sum(cap)) as budget from leaves),
{_budgets("domain", [], weight("domain"))},
{_budgets("lang", ["domain"], weight("lang"))},
{_budgets("source", ["domain", "lang"], weight("source"))},
planned as (
  select keyed.*, budget, case when leaf_tokens > 0 then budget::hugeint // leaf_tokens else 1 end as whole,
    case when leaf_tokens > 0 then budget::hugeint % leaf_tokens else 0 end as rest
  from keyed join leaves using (domain, lang, source) join b_source using (domain, lang, source)),
taken as (
  select *, whole + case when rest > 0 and sum(n_tokens) over (partition by domain, lang, source order by {place("whole")}) <= rest
    then 1 else 0 end as epochs from planned),
unfolded as (select *, unnest(range(epochs::bigint)) as epoch from taken)
select doc_id, domain_ as domain, lang_ as lang, source_ as source, n_tokens, epoch, {place("epoch")} as place,
  budget::bigint as leaf_budget from unfolded"""


def _seeds() -> str:
    def seed(mask: str) -> str:
        kept = " || ' ' || ".join(f"words[p + {i + 1}]" for i, bit in enumerate(mask) if bit == "1")
        return f"""
  select id, side, row, unnest(list_transform(range(n_words - {len(mask) - 1}),
    lambda p: {{'p': p, 'seed': '{mask} ' || {kept}}}), max_depth := 2)
  from texts where n_words >= {len(mask)}"""

    reach, least = decontaminate.STRETCH - 1, decontaminate.LEAST
    words = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return f"""
with texts as materialized (
  select *, len(words) as n_words, row_number() over () as row from (
    select doc_id as id, 'd' as side, {words} as words from documents
    union all select item_id, 'b', {words} from benchmark)),
seeds as ({" union all ".join(seed(mask) for mask in decontaminate.MASKS)}),
met as (
  select d.id as doc_id, b.id as item_id, d.p as d_at, least(y.n_words, {decontaminate.STRETCH}) as stretch,
    x.words as d_words, y.words as b_words, least(d.p, b.p, {reach}) as lead, d.p - least(d.p, b.p, {reach}) as d_from,
    b.p - least(d.p, b.p, {reach}) as b_from, least(x.n_words - d.p, y.n_words - b.p, {2 * reach}) as tail
  from seeds d join seeds b on d.seed = b.seed and d.side = 'd' and b.side = 'b'
    join texts x on x.row = d.row join texts y on y.row = b.row and y.n_words >= {least}),
compared as (
  select doc_id, item_id, d_at, stretch, list_transform(
    list_zip(d_words[d_from + 1 : d_from + lead + tail], b_words[b_from + 1 : b_from + lead + tail]),
    lambda z: case when z[1] = z[2] then 1 else 0 end) as equal
  from met where lead + tail >= stretch),
scored as (
  select doc_id, item_id, d_at, stretch, list_max(list_transform(range(1, len(equal) - stretch + 2),
    lambda i: list_sum(equal[i : i + stretch - 1]))) as best from compared)
select doc_id, item_id, count(distinct d_at) as n_seeds, cast(min(d_at) as integer) as first_word,
  cast(max(best) as integer) as best_equal
from scored where best >= (stretch * 4 + 4) // 5 group by doc_id, item_id"""



#: Every word against every earlier one that equals it, by their distance.
RUNS = rf"""
with crcs as (
  select list(list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i) order by i) as crc_of
  from range(256) as t(i)),
texts as (
  select row_number() over () as row, doc_id, {WORDS} as words,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(cast(doc_id as varchar))), '..'), lambda h: ('0x' || h)::bigint),
      lambda c, o: xor(c >> 8, crc_of[1 + (xor(c, o) & 255)]), 4294967295), 4294967295) as h
  from documents, crcs),
planted as (
  select *, len(words) as n, h // 10 % greatest(len(words), 1) as a,
    1 + (len(words) - h // 10 % greatest(len(words), 1)) // (3 + h // 10 % 8) as p from texts),
read as materialized (
  select row, doc_id, n, case when h % 10 = 0 and n > 0
    then words[1 : a] || list_transform(range(n - a), lambda i: words[a + i % p + 1]) else words end as words from planted),
placed as materialized (select row, n, unnest(words) as word, generate_subscripts(words, 1) - 1 as i from read),
met as (
  select x.row, x.i, x.i - y.i as q from placed x join placed y
    on x.row = y.row and x.word = y.word and y.i < x.i and {runs.PERIODS} * (x.i - y.i) <= x.n),
stretches as (
  select row, q, min(i) - q as start, count(*) + q as length from (
    select row, q, i, i - row_number() over (partition by row, q order by i) as island from met)
  group by row, q, island having count(*) + q >= greatest({runs.LEAST}, {runs.PERIODS} * q)),
found as materialized (select row, start, length, min(q) as period from stretches group by row, start, length),
summed as (
  select row, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines,
    first({{'start': start, 'length': length, 'period': period}} order by length / period desc, start, period) as best
  from found group by row),
left_over as (
  select row, string_agg(word, ' ' order by i) as collapsed from placed
  where not exists (select 1 from found where found.row = placed.row and placed.i >= start + period and placed.i < start + length)
  group by row)
select doc_id, coalesce(n_runs, 0) as n_runs, best.start as start, best.length as length, best.period as period,
  1000 * best.length // best.period as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
  sha256(coalesce(collapsed, '')) as collapsed_sha256, n as n_words
from read left join summed using (row) left join left_over using (row)"""

SHARDS, CONTAMINATED, mix_sql = _shards(), _seeds(), _mix
