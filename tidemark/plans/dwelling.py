"""Page dwell time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dwell
from tidemark.plans.base import TRAFFIC, Plan
from tidemark.sources import clickstream as cs

DAY = 86400


def half_hour_slot(spark: SparkSession, sf: str) -> DataFrame:
    slotted = dwell.with_slot(cs.traffic(spark, sf))
    return slotted.groupBy("plat", "agent_type", "visit_id", "slot").agg(F.count("*").alias("n"))


def dwell_rows(spark: SparkSession, sf: str) -> DataFrame:
    return dwell.dwell_rows(cs.traffic(spark, sf))


def dwell_rows_daily(spark: SparkSession, sf: str) -> DataFrame:
    return dwell.dwell_rows(cs.traffic(spark, sf), width=DAY)


def dwell_totals(spark: SparkSession, sf: str) -> DataFrame:
    return dwell.dwell_totals(cs.traffic(spark, sf))


def dwell_totals_daily(spark: SparkSession, sf: str) -> DataFrame:
    return dwell.dwell_totals(cs.traffic(spark, sf), width=DAY)


def latest_view(spark: SparkSession, sf: str) -> DataFrame:
    return dwell.latest_view(cs.traffic(spark, sf))


def nearest_same_page(spark: SparkSession, sf: str) -> DataFrame:
    """For each request, the nearest view of the same page that day with a channel."""
    rows = cs.traffic(spark, sf)
    found = dwell.nearest_view(rows, rows.filter(F.col("channel") != ""), width=DAY)
    return found.select("event_id", "nearest")


VISIT = "plat, agent_type, visit_id, slot"


def _rows_sql(width: int) -> str:
    return f"""
with {TRAFFIC}, s as (select *, req_time - req_time % {width} as slot from traffic),
f as (select *, lag(website) over w as pw, lag(req_time) over w as pt,
             case when lag(website) over w = website then 0 else 1 end as b
      from s window w as (partition by {VISIT} order by req_time, event_id)),
r as (select *, sum(b) over (partition by {VISIT} order by req_time, event_id
      rows between unbounded preceding and current row) as run from f),
g as (select *, min(req_time) over (partition by {VISIT}, run) as sign from r),
h as (select *, lag(sign) over (partition by {VISIT} order by req_time, event_id) as ps from g)
select event_id, {VISIT}, coalesce(nullif(channel, ''), '(not set)') as channel,
       pw as website, ps as sign, req_time - pt as view_time
from h where req_time > pt"""


def _totals_sql(width: int) -> str:
    return f"""
with {TRAFFIC}, s as (select *, req_time - req_time % {width} as slot from traffic),
f as (select *, case when lag(website) over w = website then 0 else 1 end as b
      from s window w as (partition by {VISIT} order by req_time, event_id)),
r as (select *, sum(b) over (partition by {VISIT} order by req_time, event_id
      rows between unbounded preceding and current row) as run from f),
g as (select {VISIT}, run, min(website) as website, min(req_time) as sign, max(req_time) as last_t
      from r group by all),
h as (select *, lead(sign) over (partition by {VISIT} order by run) as nxt from g)
select {VISIT}, website, sign, coalesce(nxt, last_t) - sign as view_time
from h where coalesce(nxt, last_t) > sign"""


PLANS = [
    Plan("half_hour_slot", "DW-1 F-12", half_hour_slot, f"""
with {TRAFFIC} select plat, agent_type, visit_id, req_time - req_time % 1800 as slot, count(*) as n
from traffic group by all"""),
    Plan("dwell_rows", "DW-2 DW-4 DW-6 F-17", dwell_rows, _rows_sql(1800)),
    Plan("dwell_rows_daily", "DW-2 with a day's slot", dwell_rows_daily, _rows_sql(DAY)),
    Plan("dwell_totals", "DW-3", dwell_totals, _totals_sql(1800)),
    Plan("dwell_totals_daily", "DW-3 with a day's slot", dwell_totals_daily, _totals_sql(DAY)),
    Plan("latest_view", "DW-7", latest_view, f"""
with {TRAFFIC}, s as (select *, req_time - req_time % 1800 as slot from traffic),
ranked as (select *, row_number() over (partition by {VISIT} order by req_time desc, event_id desc) as rn from s)
select {VISIT}, website, req_time from ranked where rn = 1"""),
    Plan("nearest_same_page", "DW-5", nearest_same_page, f"""
with {TRAFFIC}, s as (
  select *, req_time - req_time % {DAY} as slot, case when channel <> '' then req_time end as view from traffic),
b as (select *,
        last_value(view ignore nulls) over (w rows between unbounded preceding and current row) as prev_t,
        first_value(view ignore nulls) over (w rows between current row and unbounded following) as next_t
      from s window w as (partition by {VISIT}, website order by req_time, event_id))
select event_id, case when prev_t is null then next_t when next_t is null then prev_t
       when next_t - req_time < req_time - prev_t then next_t else prev_t end as nearest
from b"""),
]
