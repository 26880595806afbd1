"""Unique visitors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.nulls import or_default
from tidemark.operators import uniques
from tidemark.plans.base import TRAFFIC, Plan
from tidemark.sources import clickstream as cs
from tidemark.sources.files import table


def dated(spark: SparkSession, sf: str) -> DataFrame:
    return cs.traffic(spark, sf).withColumn("date", F.date_format(F.timestamp_seconds("req_time"), "yyyy-MM-dd"))


def uv_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return uniques.traffic_uv(dated(spark, sf))


def uv_click(spark: SparkSession, sf: str) -> DataFrame:
    clicks = dated(spark, sf).withColumns({"click_category": F.col("website"), "dime": or_default("channel")})
    return uniques.click_uv(clicks)


def uv_push(spark: SparkSession, sf: str) -> DataFrame:
    return uniques.push_app_uv(dated(spark, sf).withColumnRenamed("k", "detail_id"))


def uv_by_time(spark: SparkSession, sf: str) -> DataFrame:
    """First seen where ids fall as time goes on: the time decides."""
    return uniques.traffic_uv(dated(spark, sf).withColumn("event_id", 100_000_007 - F.col("event_id")))


def uv_without_state(spark: SparkSession, sf: str) -> DataFrame:
    return uniques.traffic_uv(dated(spark, sf), dedupe=False)


def uv_counts(spark: SparkSession, sf: str) -> DataFrame:
    seen = uniques.traffic_uv(dated(spark, sf))
    return seen.groupBy(*uniques.TRAFFIC_KEYS).agg(F.count("*").alias("uv"))


def uv_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sketches per page, merged to one estimate per platform and page."""
    sketches = uniques.uv_sketches(dated(spark, sf), uniques.TRAFFIC_KEYS)
    return uniques.uv_from_sketches(sketches, ["plat", "website"])


def uv_sketch_error(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches too small to hold their ids, merged by platform: within a twentieth of the count."""
    lines = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 2).alias("side"), "l_returnflag", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("visit_id"))
    merged = uniques.uv_from_sketches(uniques.uv_sketches(lines, ["side", "l_returnflag"], lg_k=12), ["side"])
    exact = lines.groupBy("side").agg(F.count_distinct("visit_id").alias("uv"))
    close = F.abs(F.col("uv_estimate") - F.col("uv")) <= 0.05 * F.col("uv")
    return exact.join(merged, "side").select("side", "uv", close.cast("int").alias("close"))


PLANS = [
    Plan("uv_traffic", "UV-1", uv_traffic, f"""
with {TRAFFIC}, ranked as (
  select *, row_number() over (partition by req_date, plat, agent_type, website, visit_id
                               order by req_time, event_id) as rn from traffic)
select req_date as date, plat, agent_type, website, visit_id, event_id from ranked where rn = 1"""),
    Plan("uv_click", "UV-2", uv_click, f"""
with {TRAFFIC}, ranked as (
  select *, row_number() over (partition by req_date, plat, agent_type, website, channel, visit_id
                               order by req_time, event_id) as rn from traffic)
select req_date as date, plat, agent_type, website as click_category,
       case when channel = '' then '(not set)' else channel end as dime, visit_id, event_id
from ranked where rn = 1"""),
    Plan("uv_push", "UV-3", uv_push, f"""
with {TRAFFIC}, ranked as (
  select *, row_number() over (partition by req_date, plat, agent_type, k, visit_id
                               order by req_time, event_id) as rn from traffic)
select req_date as date, plat, agent_type, k as detail_id, visit_id, event_id from ranked where rn = 1"""),
    Plan("uv_by_time", "UV-1", uv_by_time, f"""
with {TRAFFIC}, ranked as (
  select *, row_number() over (partition by req_date, plat, agent_type, website, visit_id
                               order by req_time, event_id desc) as rn from traffic)
select req_date as date, plat, agent_type, website, visit_id, 100000007 - event_id as event_id from ranked where rn = 1"""),
    Plan("uv_sketch_error", "UV-4 (sketch)", uv_sketch_error, """
select l_orderkey % 2 as side, count(distinct l_orderkey || '-' || l_linenumber) as uv, 1 as close from lineitem group by all"""),
    Plan("uv_without_state", "UV-6", uv_without_state, f"""
with {TRAFFIC} select req_date as date, plat, agent_type, website, visit_id, event_id from traffic"""),
    Plan("uv_counts", "UV-1 as counts", uv_counts, f"""
with {TRAFFIC} select req_date as date, plat, agent_type, website, count(distinct visit_id) as uv
from traffic group by all"""),
    # Sketches of few ids hold them all, so at test scale the estimates are the counts.
    Plan("uv_sketch", "UV-4 (sketch)", uv_sketch, f"""
with {TRAFFIC} select plat, website, count(distinct visit_id) as uv_estimate from traffic group by all"""),
]
