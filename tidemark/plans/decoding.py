"""Envelope decoding, routing and the hourly summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import decode, routing, shape
from tidemark.operators.aggregate import traffic_by_hour, traffic_by_hour_sketched, with_request_date
from tidemark.plans.base import TRAFFIC, Plan
from tidemark.session import new_path
from tidemark.sources import clickstream as cs
from tidemark.sources.files import collection, table

PIECE = "array<struct<event_id: bigint, visit_id: string, k: int>>"


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    return cs.request_envelopes(cs.traffic(spark, sf))


def requests(spark: SparkSession, sf: str, args_type: str = decode.NORMAL_ARGS) -> DataFrame:
    return decode.decode_envelopes(envelopes(spark, sf), args_type=args_type)


def batches(spark: SparkSession, sf: str) -> DataFrame:
    return decode.decode_envelopes(cs.event_envelopes(cs.traffic(spark, sf)), args_type="STRUCT<events: VARIANT>")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """Page requests that went through the message form and back."""
    elements = decode.decode_elements(envelopes(spark, sf), cs.TOPICS, cs.ELEMENT)
    return with_request_date(elements.withColumnRenamed("topic", "website"))


def traffic_stat_hourly(spark: SparkSession, sf: str) -> DataFrame:
    hourly = traffic_by_hour(pages(spark, sf))
    return hourly.withColumn("req_date", F.date_format("req_date", "yyyy-MM-dd"))


def traffic_stat_sketch(spark: SparkSession, sf: str) -> DataFrame:
    sketched = traffic_by_hour_sketched(pages(spark, sf))
    return sketched.select(
        "plat", "agent_type", "website", F.date_format("req_date", "yyyy-MM-dd").alias("req_date"), "req_hour",
        "pv_count",
        F.hll_sketch_estimate("uv_sketch").alias("uv_estimate"),
        F.hll_sketch_estimate("ip_sketch").alias("ip_estimate"),
    )


def envelope_decode(spark: SparkSession, sf: str) -> DataFrame:
    decoded = decode.decode_envelopes(envelopes(spark, sf), keep_headers=True, post_only=False, as_text=True)
    args = F.from_json("args", "topic STRING, data ARRAY<STRING>")
    return decoded.select(
        "method", "ip", "gateway_uri", "receive_time",
        F.from_json("headers", "host STRING")["host"].alias("header_host"),
        args["topic"].alias("topic"), F.size(args["data"]).cast("bigint").alias("n"),
    )


def envelope_post_only(spark: SparkSession, sf: str) -> DataFrame:
    return requests(spark, sf).groupBy("method", "ip").agg(F.count("*").alias("n"))


def decode_normal(spark: SparkSession, sf: str) -> DataFrame:
    pieces = decode.decode_normal(requests(spark, sf), cs.TOPICS)
    p = F.from_json("data", PIECE)
    return pieces.select(
        "topic", "ip", F.size(p).cast("bigint").alias("n"),
        F.array_min(p["event_id"]).alias("first_event"),
        F.aggregate(p["k"], F.lit(0).cast("bigint"), lambda a, k: a + k).alias("sum_k"),
    )


def decode_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejects = decode.normal_rejects(requests(spark, sf, "VARIANT"), cs.TOPICS)
    args = F.from_json("args", "topic STRING, data ARRAY<STRING>")
    return rejects.select(args["topic"].alias("topic"), F.size(args["data"]).cast("bigint").alias("n"), "reason")


def decode_event_batch(spark: SparkSession, sf: str) -> DataFrame:
    rows = decode.decode_event_batch(batches(spark, sf), cs.BATCH_TOPICS)
    body = F.from_json("data", "event_id BIGINT, visit_id STRING, k INT")
    return rows.select("topic", "ip", body.alias("b")).select("topic", "ip", "b.*")


def event_batch_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejects = decode.event_batch_rejects(batches(spark, sf), cs.BATCH_TOPICS)
    return rejects.groupBy("topic", "reason").agg(F.count("*").alias("n"))


def route_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    return decode.route_passthrough(batches(spark, sf), cs.ROUTES, cs.BATCH_TOPICS)


def route_divert(spark: SparkSession, sf: str) -> DataFrame:
    rows = decode.route_divert(batches(spark, sf), cs.BATCH_TOPICS)
    body = F.from_json("payload", "event_file STRING, sign STRING, datalist STRUCT<event_id: BIGINT, k: INT>")
    return rows.select("uri", body.alias("p")).select(
        "uri", "p.event_file", "p.sign", F.col("p.datalist.event_id"), F.col("p.datalist.k")
    )


def route_events(spark: SparkSession, sf: str) -> DataFrame:
    """One parse for all branches, written by branch; the allow-list is a table."""
    allowed = collection(spark, [(t,) for t in cs.BATCH_TOPICS], "topic STRING")
    path = new_path(spark, "routed")
    decode.route_events(batches(spark, sf), cs.ROUTES, allowed).write.partitionBy("branch").parquet(path)
    event = "STRUCT<event_id: BIGINT, k: INT>"
    text = F.when(F.col("branch") == "reject", F.get_json_object("data", "$.segmentation.data")).otherwise(F.col("data"))
    sent = F.from_json("payload", f"event_file STRING, sign STRING, datalist {event}")
    return spark.read.parquet(path).select(
        "branch", "uri", "topic", "sign", "ip", text.alias("data"), "reason",
        sent["event_file"].alias("event_file"), sent["datalist"]["event_id"].alias("event_id"),
    )


def topic_route_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The routes as a table; events without a route keep a NULL uri."""
    routes = collection(spark, [("view", "/view"), ("click", "/click"), ("signup", "/open")], "topic STRING, uri STRING")
    rows = cs.traffic(spark, sf).select("event_id", F.col("website").alias("topic"))
    return decode.with_uri(rows, routes).select("event_id", "topic", "uri")


def split_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Write once partitioned by topic, then read each branch back with its filter."""
    path = new_path(spark, "by-topic")
    rows = cs.traffic(spark, sf).select(F.col("website").alias("topic"), "ip", "event_id", "k")
    rows.write.partitionBy("topic").parquet(path)
    branches = routing.split_by_value(spark.read.parquet(path), cs.TOPICS)
    counted = [
        df.groupBy("topic", "ip").agg(F.count("*").alias("n"), F.sum("k").alias("sum_k"))
        for df in branches.values()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def split_by_predicate(spark: SparkSession, sf: str) -> DataFrame:
    rows = cs.traffic(spark, sf)
    branches = {
        "paid": F.col("website") == "purchase",
        "tagged": F.col("channel") != "",
        "app": F.col("agent_type").isin(4, 5),
    }
    return routing.tag_branches(rows, branches).select("branch", "event_id")


def split_in_two(spark: SparkSession, sf: str) -> DataFrame:
    low, high = routing.split_in_two(
        table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"),
        shape.all_of([("o_totalprice", "<", 100000.0), shape.any_of([("o_orderstatus", "=", "F"), ("o_orderstatus", "=", "O")])]),
    )
    return low.select("o_orderkey", F.lit("low").alias("branch")).unionByName(
        high.select("o_orderkey", F.lit("rest").alias("branch"))
    )


def payload_only(spark: SparkSession, sf: str) -> DataFrame:
    docs = shape.identity(table(spark, sf, "documents").select(F.col("source").alias("topic"), F.col("text").alias("data")))
    return shape.payload(docs).groupBy(F.md5("data").alias("digest")).agg(F.count("*").alias("n"))


POST = f"with {TRAFFIC}, posted as (select * from traffic where website <> 'error')"
SENT = f"""with {TRAFFIC}, sent as (
  select event_id, visit_id, k, '10.1.0.' || cast((event_id // 100) % 100 as varchar) as ip,
         case website when 'signup' then 'app_open' when 'purchase' then 'app_vip_open'
              when 'error' then 'unknown' else website end as topic,
         case when k < 5 then 'empty data' when k < 10 then 'bad data' end as broken
  from traffic)"""

PLANS = [
    Plan("traffic_stat_hourly", "SRC-4 DEC-1 DEC-2 DEC-4 DEC-9 AG-5 AG-6", traffic_stat_hourly, f"""
with {TRAFFIC}
select plat, agent_type, website, req_date, req_hour, count(*) as pv_count,
       count(distinct visit_id) as uv_count, count(distinct ip) as ip_count
from traffic where website in ('view', 'click', 'purchase') group by all"""),
    # Sketches of few ids hold them all, so at test scale the estimates are the counts.
    Plan("traffic_stat_sketch", "AG-5 (sketched)", traffic_stat_sketch, f"""
with {TRAFFIC}
select plat, agent_type, website, req_date, req_hour, count(*) as pv_count,
       count(distinct visit_id) as uv_estimate, count(distinct ip) as ip_estimate
from traffic where website in ('view', 'click', 'purchase') group by all"""),
    Plan("envelope_decode", "DEC-1 DEC-3 F-15 F-16", envelope_decode, f"""
with {TRAFFIC}
select case when website = 'error' then 'GET' else 'POST' end as method,
       '10.1.0.' || cast((event_id // 100) % 100 as varchar) as ip, '/collect' as gateway_uri,
       max(req_time) as receive_time, '10.1.0.' || cast((event_id // 100) % 100 as varchar) as header_host,
       website as topic, count(*) as n
from traffic group by website, event_id // 100"""),
    Plan("envelope_post_only", "DEC-2", envelope_post_only, f"""
{POST} select 'POST' as method, '10.1.0.' || cast(block % 100 as varchar) as ip, count(*) as n
from (select distinct website, event_id // 100 as block from posted) group by block % 100"""),
    Plan("decode_normal", "DEC-4 DEC-5", decode_normal, f"""
{POST}, numbered as (
  select *, event_id // 100 as block,
         (row_number() over (partition by website, event_id // 100 order by event_id) - 1) // 10 as piece
  from posted where website <> 'signup')
select website as topic, '10.1.0.' || cast(block % 100 as varchar) as ip, count(*) as n,
       min(event_id) as first_event, cast(sum(k) as bigint) as sum_k
from numbered group by website, block, piece"""),
    Plan("decode_rejects", "DEC-11", decode_rejects, f"""
{POST} select website as topic, count(*) as n, 'error topic' as reason
from posted where website = 'signup' group by website, event_id // 100"""),
    Plan("decode_event_batch", "DEC-6", decode_event_batch, f"""
{SENT} select topic, ip, event_id, visit_id, k from sent where broken is null and topic <> 'unknown'"""),
    Plan("event_batch_rejects", "DEC-6 DEC-11", event_batch_rejects, f"""
{SENT} select topic, case when topic = 'unknown' then 'error topic' else broken end as reason, count(*) as n
from sent where topic = 'unknown' or broken is not null group by all"""),
    Plan("route_passthrough", "DEC-7 DEC-10", route_passthrough, f"""
{SENT}, texts as (
  select *, '{{"event_id":' || event_id || ',"visit_id":"' || visit_id || '","k":' || k || '}}' as body from sent)
select case topic when 'view' then '/view' end as uri, topic, ip,
       case when broken = 'bad data' then left(body, length(body) - 1) else body end as data
from texts where topic in ('view', 'click') and coalesce(broken, '') <> 'empty data'"""),
    Plan("route_divert", "DEC-8", route_divert, f"""
{SENT} select '/base' as uri, replace(topic, 'app_vip_open', 'vip_open') as event_file,
       visit_id as sign, event_id, k
from sent where topic in ('app_open', 'app_vip_open') and broken is null"""),
    Plan("route_events", "DEC-7 DEC-8 DEC-9 DEC-10 DEC-11", route_events, f"""
{SENT}, texts as (
  select *, '{{"event_id":' || event_id || ',"visit_id":"' || visit_id || '","k":' || k || '}}' as body,
         case when topic = 'unknown' then 'error topic' when topic in ('view', 'click') and broken = 'bad data' then null
              else broken end as reason
  from sent),
branched as (
  select *, case when reason is not null then 'reject' when topic in ('view', 'click') then 'pass' else 'divert' end as branch,
         case topic when 'app_vip_open' then 'vip_open' else topic end as renamed from texts)
select branch, case branch when 'divert' then '/base' when 'pass' then case topic when 'view' then '/view' end end as uri,
       case branch when 'divert' then renamed else topic end as topic, visit_id as sign, ip,
       case broken when 'empty data' then '' when 'bad data' then left(body, length(body) - 1) else body end as data,
       reason, case branch when 'divert' then renamed end as event_file, case branch when 'divert' then event_id end as event_id
from branched"""),
    Plan("topic_route_lookup", "DEC-10 SRC-2", topic_route_lookup, """
select event_id, event_type as topic,
       case event_type when 'view' then '/view' when 'click' then '/click' when 'signup' then '/open' end as uri
from events"""),
    Plan("split_by_topic", "RT-1 RT-2 UDF-5", split_by_topic, f"""
with {TRAFFIC} select website as topic, ip, count(*) as n, cast(sum(k) as bigint) as sum_k
from traffic where website in ('view', 'click', 'purchase') group by all"""),
    Plan("split_by_predicate", "RT-3 UDF-5", split_by_predicate, f"""
with {TRAFFIC}
select 'paid' as branch, event_id from traffic where website = 'purchase'
union all select 'tagged', event_id from traffic where channel <> ''
union all select 'app', event_id from traffic where agent_type in (4, 5)"""),
    Plan("split_in_two", "RT-3 DEC-16", split_in_two, """
select o_orderkey, case when o_totalprice < 100000.0 and (o_orderstatus = 'F' or o_orderstatus = 'O')
       then 'low' else 'rest' end as branch from orders"""),
    Plan("payload_only", "DEC-12 DEC-15", payload_only, """
select md5(text) as digest, count(*) as n from documents group by all"""),
]
