"""The scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.functions.nulls import NULL_ACT_DATETIME, NULL_DATE, NULL_DATETIME
from tidemark.plans.base import TRAFFIC, Plan
from tidemark.sources import clickstream as cs
from tidemark.sources.files import table


def url_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", fn.url_parts("url").alias("u")).select("page_id", "u.*")


def _periods(spark: SparkSession, sf: str) -> DataFrame:
    """A period per order: reversed, one day, or up to three days long."""
    start = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", start.alias("s"), F.date_add(start, (F.col("o_custkey") % 5).cast("int") - 1).alias("e")
    )


def date_range_days(spark: SparkSession, sf: str) -> DataFrame:
    days = _periods(spark, sf).select("o_orderkey", F.explode(fn.day_range("s", "e")).alias("d"))
    return days.groupBy(F.date_format("d", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


def date_range_labels(spark: SparkSession, sf: str) -> DataFrame:
    labels = _periods(spark, sf).select(F.explode(fn.date_labels("s", "e")).alias("label"))
    return labels.groupBy("label").agg(F.count("*").alias("n"))


def date_range_stamps(spark: SparkSession, sf: str) -> DataFrame:
    stamps = _periods(spark, sf).select(F.explode(fn.date_labels("s", "e", stamps=True)).alias("stamp"))
    return stamps.groupBy("stamp").agg(F.count("*").alias("n"))


def date_range_hours(spark: SparkSession, sf: str) -> DataFrame:
    hours = table(spark, sf, "events").select(F.explode(fn.hour_labels(F.to_date("ts"))).alias("label"))
    return hours.groupBy("label").agg(F.count("*").alias("n"))


def half_month(spark: SparkSession, sf: str) -> DataFrame:
    half = table(spark, sf, "orders").select("o_orderkey", fn.half_month(F.to_date("o_orderdate")).alias("h"))
    return half.select(
        "o_orderkey",
        F.date_format("h.start", "yyyy-MM-dd").alias("start_date"),
        F.date_format("h.end", "yyyy-MM-dd").alias("end_date"),
    )


def json_validity(spark: SparkSession, sf: str) -> DataFrame:
    props = F.col("props")
    texts = {
        "whole": props,
        "cut": F.expr("left(props, length(props) - 1)"),
        "trailing": F.concat(props, F.lit(" x")),
        "two": F.concat(props, F.lit(","), props),
        "listed": F.concat(F.lit("["), props, F.lit("]")),
        "word": F.col("event_type"),
    }
    forms = F.array(*[F.struct(F.lit(name).alias("form"), v.alias("v")) for name, v in texts.items()])
    exploded = table(spark, sf, "events").select("event_id", F.explode(forms).alias("f"))
    return exploded.select("event_id", "f.form", fn.is_json("f.v").cast("int").alias("valid"))


def text_json_validity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", fn.is_json(F.to_json(F.struct("text"))).cast("int").alias("packed"), fn.is_json("text").cast("int").alias("bare"))


def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    parsed = table(spark, sf, "events").withColumn("v", fn.strict_json("props"))
    return parsed.select(
        "event_id",
        fn.json_field("v", "k", "int", -1).alias("k"),
        fn.json_field("v", "missing", "string", "none").alias("missing"),
    )


def camel_case(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("_"), F.col("event_type"), F.lit("__K_"), F.col("user_id").cast("string"), F.lit("x_"))
    return table(spark, sf, "events").select("event_id", fn.camel_case(name).alias("name"))


def null_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    closed = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    encoded = orders.select(
        "o_orderkey",
        fn.encode_null(closed, NULL_DATETIME).alias("closed_at"),
        fn.encode_null(F.left(closed, F.lit(10)), NULL_DATE).alias("closed_on"),
        fn.encode_null(closed, NULL_ACT_DATETIME).alias("acted_at"),
    )
    return encoded.select("*", fn.decode_null("closed_at", NULL_DATETIME).alias("decoded"))


def empty_to_default(spark: SparkSession, sf: str) -> DataFrame:
    return cs.traffic(spark, sf).select("event_id", fn.or_default("channel").alias("channel"))


def epoch_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = cs.traffic(spark, sf)
    t = F.col("req_time")
    return rows.select(
        "event_id",
        fn.epoch_seconds(t + 0.75).alias("secs"),
        fn.epoch_millis(t + F.col("k") / 1000.0).alias("millis"),
        fn.format_epoch(t).alias("day"),
        fn.epoch_to_text(t).alias("text"),
        fn.text_to_epoch(fn.epoch_to_text(t)).alias("back"),
        fn.slot_start(t).alias("half_hour"),
        fn.midnight_after(t, 2).alias("midnight"),
        fn.midnight_after(t, 2, raw=True).alias("raw_midnight"),
    )


_PERIODS = """periods as (
  select o_orderkey, cast(o_orderdate as date) as s, cast(o_orderdate as date) + cast(o_custkey % 5 - 1 as integer) as e
  from orders)"""
_DAYS = "select unnest(generate_series(s, e, interval 1 day)) as d from periods where e >= s"

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_PARAMS = r"^((?:.*/)?[^/;]*);([^/]*)$"
# Fixed values, stated here anew: schemes whose last path segment may carry parameters.
_SCHEMES = "'', 'ftp', 'hdl', 'prospero', 'http', 'imap', 'https', 'shttp', 'rtsp', 'rtsps', 'rtspu', 'sip', 'sips', 'mms', 'sftp', 'tel'"

PLANS = [
    Plan("url_breakdown", "F-10", url_breakdown, f"""
with u as (select page_id, lower(regexp_extract(url, '{_URL}', 1, 's')) as scheme,
  regexp_extract(url, '{_URL}', 2, 's') as netloc, regexp_extract(url, '{_URL}', 3, 's') as whole,
  regexp_extract(url, '{_URL}', 4, 's') as query, regexp_extract(url, '{_URL}', 5, 's') as fragment from pages),
p as (select *, scheme in ({_SCHEMES}) and regexp_matches(whole, '{_PARAMS}', 's') as has from u)
select page_id, scheme, netloc, case when has then regexp_extract(whole, '{_PARAMS}', 1, 's') else whole end as path,
  case when has then regexp_extract(whole, '{_PARAMS}', 2, 's') else '' end as params, query, fragment from p"""),
    Plan("date_range_days", "F-3", date_range_days, f"""
with {_PERIODS} select strftime(d, '%Y-%m-%d') as day, count(*) as n from ({_DAYS}) group by all"""),
    Plan("date_range_labels", "F-3 F-4", date_range_labels, f"""
with {_PERIODS}, labels as (
  select strftime(unnest(generate_series(s, e, interval 1 day)), '%Y-%m-%d') as label from periods where e > s
  union all
  select strftime(s, '%Y-%m-%d ') || lpad(cast(unnest(range(24)) as varchar), 2, '0') from periods where e = s)
select label, count(*) as n from labels group by all"""),
    Plan("date_range_stamps", "F-5", date_range_stamps, f"""
with {_PERIODS}, stamps as (
  select cast(epoch(unnest(generate_series(s, e, interval 1 day))) as bigint) as stamp from periods where e > s
  union all
  select cast(epoch(s) as bigint) + 3600 * unnest(range(24)) from periods where e = s)
select stamp, count(*) as n from stamps group by all"""),
    Plan("date_range_hours", "F-4", date_range_hours, """
select strftime(ts, '%Y-%m-%d ') || lpad(cast(h as varchar), 2, '0') as label, count(*) as n
from events, range(24) as hours(h) group by all"""),
    Plan("half_month", "F-6", half_month, """
select o_orderkey,
  strftime(case when day(o_orderdate) <= 15 then date_trunc('month', o_orderdate)
       else date_trunc('month', o_orderdate) + interval 15 day end, '%Y-%m-%d') as start_date,
  strftime(case when day(o_orderdate) <= 15 then date_trunc('month', o_orderdate) + interval 14 day
       else date_trunc('month', o_orderdate) + interval 1 month - interval 1 day end, '%Y-%m-%d') as end_date
from orders"""),
    Plan("json_validity", "F-9", json_validity, """
with forms as (
  select event_id, 'whole' as form, props as v from events
  union all select event_id, 'cut', left(props, length(props) - 1) from events
  union all select event_id, 'trailing', props || ' x' from events
  union all select event_id, 'two', props || ',' || props from events
  union all select event_id, 'listed', '[' || props || ']' from events
  union all select event_id, 'word', event_type from events)
select event_id, form, cast(json_valid(v) as integer) as valid from forms"""),
    Plan("text_json_validity", "F-9 F-16", text_json_validity, """
select doc_id, cast(json_valid(cast(to_json({'text': text}) as varchar)) as integer) as packed,
       cast(json_valid(text) as integer) as bare from documents"""),
    Plan("json_fields", "F-15 F-16", json_fields, """
select event_id, coalesce(cast(json_extract_string(props, '$.k') as integer), -1) as k,
       coalesce(json_extract_string(props, '$.missing'), 'none') as missing from events"""),
    Plan("camel_case", "F-11", camel_case, """
select event_id, array_to_string(list_transform(
         list_filter(string_split(lower('_' || event_type || '__K_' || cast(user_id as varchar) || 'x_'), '_'), lambda p: p <> ''),
         lambda p: upper(p[1]) || p[2:]), '') as name from events"""),
    Plan("null_sentinels", "F-19", null_sentinels, """
with c as (select o_orderkey, case when o_orderstatus = 'F' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as closed
           from orders)
select o_orderkey, coalesce(closed, '1970-01-01 00:00:00') as closed_at,
       coalesce(left(closed, 10), '1970-01-01') as closed_on, coalesce(closed, '1970-01-01 06:28:16') as acted_at,
       closed as decoded from c"""),
    Plan("empty_to_default", "F-17", empty_to_default, f"""
with {TRAFFIC} select event_id, coalesce(nullif(channel, ''), '(not set)') as channel from traffic"""),
    Plan("epoch_format", "F-1 F-2 F-7 F-8 F-12 F-13 F-14", epoch_format, f"""
with {TRAFFIC}
select event_id, req_time as secs, req_time * 1000 + k as millis, req_date as day,
       strftime(to_timestamp(req_time) at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as text, req_time as back,
       req_time // 1800 * 1800 as half_hour,
       (req_time + 28800) // 86400 * 86400 + 2 * 86400 - 28800 as midnight,
       req_time // 86400 * 86400 + 2 * 86400 - 28800 as raw_midnight
from traffic"""),
]
