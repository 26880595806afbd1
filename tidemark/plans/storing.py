"""Tables that are written, changed and read back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rows import stamp
from tidemark.operators import aggregate, decode, shape
from tidemark.operators.mutate import delete_where, update_where
from tidemark.plans.base import TRAFFIC, Plan
from tidemark.plans.decoding import batches, pages
from tidemark.schemas import DETAILS_TRAFFIC
from tidemark.session import new_path
from tidemark.sinks import delivery, files, keyed, mutable
from tidemark.sources import clickstream as cs
from tidemark.sources.files import table
from pyspark.sql import types as T


def details(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the shape of the fact table, added on the day of the request."""
    rows = aggregate.with_request_date(cs.traffic(spark, sf))
    added = F.timestamp_seconds("req_time")
    known = {
        "id": F.col("event_id").cast("string"),
        "req_time": added,
        "url": F.concat(F.lit("https://site/"), F.col("website")),
        "host": F.lit("site"),
        "loading_time": F.col("k").cast("bigint"),
        "req_status": F.when(F.col("website") == "error", 2).otherwise(1),
        "market_source": F.col("channel"),
        "add_date": F.to_date(added),
        "add_time": added,
        "update_time": added,
    }
    columns = []
    for f in T.StructType.fromDDL(DETAILS_TRAFFIC):
        value = known.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(None))
        columns.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*columns)


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").cast("bigint").alias("event_id"), F.unix_timestamp("req_time").alias("req_time"),
        F.col("plat").cast("int").alias("plat"), F.col("agent_type").cast("int").alias("agent_type"),
        "website", "url", "host", "visit_id", "loading_time", F.col("req_status").cast("int").alias("req_status"),
    )


def _predicate():
    return shape.all_of([
        ("req_date", ">=", "2024-01-05"),
        ("req_date", "<=", "2024-01-16"),
        shape.any_of([("plat", "=", 1), ("website", "=", "error")]),
    ])


def delete_where_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(delete_where(details(spark, sf), _predicate()))


def update_where_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(update_where(details(spark, sf), _predicate(), _CHANGES))


_CHANGES = {"host": "'123'", "loading_time": "loading_time * 2 + 1", "req_status": "2"}


def _stored(spark: SparkSession, sf: str) -> str:
    path = new_path(spark, "details")
    files.write_fact_table(details(spark, sf), path)
    return path


def delete_stored(spark: SparkSession, sf: str) -> DataFrame:
    path = _stored(spark, sf)
    mutable.delete_from(spark, path, _predicate())
    return _shown(mutable.read_table(spark, path))


def update_stored(spark: SparkSession, sf: str) -> DataFrame:
    path = _stored(spark, sf)
    mutable.update_table(spark, path, _predicate(), _CHANGES)
    return _shown(mutable.read_table(spark, path))


def _orders(spark: SparkSession, sf: str) -> str:
    """Orders stored by the month of their date, over several years."""
    path = new_path(spark, "orders")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    files.write_fact_table(rows.withColumn("add_date", F.to_date("o_orderdate")), path, order=["o_custkey", "o_orderkey"])
    return path


def _shown_orders(spark: SparkSession, path: str) -> DataFrame:
    rows = mutable.read_table(spark, path)
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus", F.date_format("add_month", "yyyy-MM-dd").alias("month"))


def delete_months(spark: SparkSession, sf: str) -> DataFrame:
    """Deletes in a table of many months, most of which stay untouched."""
    path = _orders(spark, sf)
    hit = (F.year("add_date") == 1996) & (F.col("o_orderstatus") != "O") | (F.col("o_orderkey") % 1000 == 7)
    mutable.delete_from(spark, path, hit & (F.col("add_month") >= "1996-01-01"), order=["o_custkey", "o_orderkey"])
    return _shown_orders(spark, path)


def update_months(spark: SparkSession, sf: str) -> DataFrame:
    """Two updates one after the other, the first of them tried twice under one id."""
    path = _orders(spark, sf)
    order = ["o_custkey", "o_orderkey"]
    year = F.year("add_date")
    for _ in range(2):
        mutable.update_table(spark, path, year == 1995, {"o_custkey": "o_custkey * 2 + 1"}, order=order, change_id="double")
    mutable.update_table(spark, path, (year >= 1995) & (F.col("o_custkey") % 3 == 0), {"o_orderstatus": "'X'"}, order=order)
    return _shown_orders(spark, path)


def partitioned_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Read one platform and time range back; the filters reach the files."""
    stored = spark.read.parquet(_stored(spark, sf))
    at = F.unix_timestamp("req_time")
    stored = stored.filter((F.col("add_month") >= "2024-01-01") & (F.col("plat") == 1) & at.between(1704412800, 1705276800))
    return stored.groupBy(F.date_format("add_month", "yyyy-MM-dd").alias("month"), F.col("plat").cast("int").alias("plat")).agg(
        F.count("*").alias("n"), F.sum("loading_time").alias("loading")
    )


def stamped_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Stamp, store and read back; ids and times are counted, not shown."""
    path = new_path(spark, "stamped")
    rows = cs.traffic(spark, sf).drop("ip")
    files.write_stamped(rows, path, batch_id=0)
    back = spark.read.parquet(path)
    stamped = F.col("id").isNotNull() & (F.length("id") == 36) & (F.col("add_time") == F.col("update_time"))
    return back.select("event_id", "req_time", "website", "visit_id", stamped.cast("int").alias("stamped"))


def stat_table(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly summary in the shape of the summary table."""
    rows = aggregate.stat_traffic(aggregate.traffic_by_hour(pages(spark, sf)))
    path = new_path(spark, "stat")
    rows.write.parquet(path)
    return spark.read.parquet(path).drop("id", "update_time", "add_time")


def kv_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches of visits into a keyed table: those of the first half month, then the others."""
    path = new_path(spark, "keyed")
    rows = cs.traffic(spark, sf).select("visit_id", "website", "event_id", "req_time", "channel")
    early = F.col("req_time") < 1705276800
    keys, order = ["visit_id", "website"], ["req_time", "event_id"]
    keyed.upsert(rows.filter(early), path, 0, keys, order)
    keyed.upsert(rows.filter(~early), path, 1, keys, order)
    return keyed.read_latest(spark, path, keys)


def kv_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Last status per customer in three batches by order key; two are folded, the last is not."""
    path = new_path(spark, "keyed")
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    for batch in range(3):
        last = F.least(F.floor(F.col("o_orderkey") / 2000), F.lit(2)) == batch
        keyed.upsert(rows.filter(last), path, batch, ["o_custkey"], ["o_orderkey"])
    keyed.compact(spark, path, ["o_custkey"], 1)
    return keyed.read_latest(spark, path, ["o_custkey"])


def _flaky(payload: str) -> str:
    """A stand-in transport: visitors whose id ends in 7 are always refused."""
    sign = json.loads(payload).get("sign") or ""
    return json.dumps({"success": not sign.endswith("7")})


def deliver_with_retry(spark: SparkSession, sf: str) -> DataFrame:
    sent = delivery.deliver(decode.route_divert(batches(spark, sf), cs.BATCH_TOPICS), _flaky)
    path = new_path(spark, "delivered")
    sent.write.parquet(path)
    results = spark.read.parquet(path)
    sign = F.get_json_object("payload", "$.sign")
    return results.groupBy(sign.alias("sign"), "attempts", F.col("ok").cast("int").alias("ok")).agg(F.count("*").alias("n"))


def stamped_columns(spark: SparkSession, sf: str) -> DataFrame:
    stamped = stamp(cs.traffic(spark, sf).select("event_id"))
    return stamped.select(
        "event_id",
        F.length("id").alias("id_length"),
        (F.col("add_date") == F.to_date("add_time")).cast("int").alias("same_day"),
        (F.col("update_time") == F.col("add_time")).cast("int").alias("same_time"),
    )


_DETAILS = f"""with {TRAFFIC}, details as (
  select event_id, req_time, plat, agent_type, website, 'https://site/' || website as url, 'site' as host, visit_id,
         cast(k as bigint) as loading_time, case when website = 'error' then 2 else 1 end as req_status,
         coalesce(req_date >= '2024-01-05' and req_date <= '2024-01-16' and (plat = 1 or website = 'error'), false) as hit
  from traffic)"""
_DELETED = f"{_DETAILS} select * exclude (hit) from details where not hit"
_UPDATED = f"""{_DETAILS} select event_id, req_time, plat, agent_type, website, url,
  case when hit then '123' else host end as host, visit_id,
  case when hit then loading_time * 2 + 1 else loading_time end as loading_time,
  case when hit then 2 else req_status end as req_status from details"""

_ORDERS = """with months as (
  select o_orderkey, o_custkey, o_orderstatus, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as month from orders)"""

PLANS = [
    Plan("delete_where", "MU-1 DEC-16", delete_where_rows, _DELETED),
    Plan("update_where", "MU-2 DEC-16", update_where_rows, _UPDATED),
    Plan("delete_stored", "MU-1 SNK-5 SNK-6", delete_stored, _DELETED),
    Plan("update_stored", "MU-2 SNK-5 SNK-6", update_stored, _UPDATED),
    Plan("delete_months", "MU-1 SNK-6", delete_months, f"""{_ORDERS} select * from months
where not ((month like '1996%' and o_orderstatus <> 'O' or o_orderkey % 1000 = 7) and month >= '1996-01-01')"""),
    Plan("update_months", "MU-2 SNK-6", update_months, f"""{_ORDERS}, doubled as (
  select * replace (case when month like '1995%' then o_custkey * 2 + 1 else o_custkey end as o_custkey) from months)
select * replace (case when month >= '1995-01-01' and o_custkey % 3 = 0 then 'X' else o_orderstatus end as o_orderstatus)
from doubled"""),
    Plan("partitioned_layout", "SNK-6", partitioned_layout, f"""
with {TRAFFIC} select left(req_date, 8) || '01' as month, plat, count(*) as n, cast(sum(k) as bigint) as loading
from traffic where plat = 1 and req_time between 1704412800 and 1705276800 group by all"""),
    Plan("stamped_sink", "SNK-3 SNK-5 F-18", stamped_sink, f"""
with {TRAFFIC} select event_id, req_time, website, visit_id, 1 as stamped from traffic"""),
    Plan("stamped_columns", "F-18", stamped_columns, """
select event_id, 36 as id_length, 1 as same_day, 1 as same_time from events"""),
    Plan("stat_table", "AG-5 (stored)", stat_table, f"""
with {TRAFFIC}
select plat, agent_type, website, cast(count(*) as integer) as pv_count,
       cast(count(distinct visit_id) as integer) as uv_count, cast(count(distinct ip) as integer) as ip_count,
       cast(min(req_time) // 86400 * 86400 as integer) as stat_date, cast(req_hour as integer) as stat_hour,
       cast(min(req_time) // 3600 * 3600 as integer) as stat_time
from traffic where website in ('view', 'click', 'purchase')
group by plat, agent_type, website, req_date, req_hour"""),
    Plan("kv_upsert", "SNK-7", kv_upsert, f"""
with {TRAFFIC}, ranked as (
  select *, row_number() over (partition by visit_id, website order by req_time desc, event_id desc) as rn from traffic)
select visit_id, website, event_id, req_time, channel from ranked where rn = 1"""),
    Plan("kv_compacted", "SNK-7", kv_compacted, """
select o_custkey, arg_max(o_orderstatus, o_orderkey) as o_orderstatus, max(o_orderkey) as o_orderkey
from orders group by o_custkey"""),
    Plan("deliver_with_retry", "SNK-8 DEC-8 UDF-1", deliver_with_retry, f"""
with {TRAFFIC}
select visit_id as sign, case when visit_id like '%7' then 3 else 1 end as attempts,
       case when visit_id like '%7' then 0 else 1 end as ok, count(*) as n
from traffic where website in ('signup', 'purchase') and k >= 10 group by all"""),
]
