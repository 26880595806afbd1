"""The streaming forms, run until their input is drained and read back."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import strict_from_json
from tidemark.operators import decode
from tidemark.operators.iterate import pair_start, pair_steps
from tidemark.operators.shape import parse_pair
from tidemark.operators.aggregate import TRAFFIC_KEYS, tokenize, traffic_by_hour, with_request_date
from tidemark.plans.base import TRAFFIC, Plan
from tidemark.plans.counting import _count_sql, pairs
from tidemark.plans.decoding import SENT
from tidemark.plans.dwelling import _rows_sql
from tidemark.schemas import TRAFFIC as TRAFFIC_SCHEMA
from tidemark.session import new_path
from tidemark.sinks import mutable, partials
from tidemark.sinks.keyed import read_latest
from tidemark.sources import clickstream as cs
from tidemark.sources import batch_queue
from tidemark.sources.files import table
from tidemark.streaming import jobs, loops, state, windows

ARRIVALS = 2


def _in_steps(
    spark: SparkSession, df: DataFrame, spec: jobs.JobSpec, order: str, text: bool = False, after: Callable[[int], object] | None = None
) -> None:
    """Let the rows arrive in steps of their order and drain the job after each, then call ``after``.

    Every step starts the job anew, so it resumes from its checkpoint.
    """
    spec = replace(spec, checkpoint=new_path(spark, "checkpoint"), until_drained=True, topic=f"{spec.topic}/step-*")
    low, high = df.agg(F.min(order), F.max(order)).first()
    width = (high - low) // ARRIVALS + 1
    for i in range(ARRIVALS):
        first = low + i * width
        arrived = df.filter((F.col(order) >= first) & (F.col(order) < first + width))
        writer = arrived.select("value").write.text if text else arrived.write.json
        writer(spec.topic.replace("step-*", f"step-{i}"))
        jobs.drain(jobs.start_job(spark, spec))
        if after:
            after(i)


def stream_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """Running counts in update mode, kept per word in a keyed table."""
    path = new_path(spark, "words")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    spec = jobs.JobSpec(
        name="words", topic=new_path(spark, "docs"), source="json", source_options={"schema": "doc_id BIGINT, text STRING"},
        operator=lambda df: state.running_counts(tokenize(df, "text"), "word"),
        sink="keyed", sink_options={"path": path, "keys": ["word"], "order": ["n"]}, output_mode="update",
    )
    _in_steps(spark, docs, spec, "doc_id")
    return read_latest(spark, path, ["word"])


def _traffic_job(spark: SparkSession, name: str, operator: jobs.Operator, path: str) -> jobs.JobSpec:
    return jobs.JobSpec(
        name=name, topic=new_path(spark, "traffic"), source="json", source_options={"schema": TRAFFIC_SCHEMA},
        operator=operator, sink="parquet", sink_options={"path": path},
    )


def stream_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["date", "plat", "agent_type", "website"]

    def operator(df: DataFrame) -> DataFrame:
        ts = F.timestamp_seconds("req_time")
        dated = df.withColumns({"ts": ts, "date": F.date_format(ts, "yyyy-MM-dd")})
        return state.first_seen_stream(dated.select(*keys, "visit_id", "event_id", "ts"), keys)

    path = new_path(spark, "first-seen")
    _in_steps(spark, cs.traffic(spark, sf), _traffic_job(spark, "first-seen", operator, path), "event_id")
    return spark.read.parquet(path).select(*keys, "visit_id")


def stream_dwell(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "dwell")
    spec = _traffic_job(spark, "dwell", state.dwell_stream, path)
    _in_steps(spark, cs.traffic(spark, sf), spec, "event_id")
    return spark.read.parquet(path).drop("batch_id")


def stream_dwell_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Dwell where a third of the visits have no platform: NULL is a key like any other."""
    path = new_path(spark, "dwell")
    rows = cs.traffic(spark, sf).withColumn("plat", F.when(F.col("visit_id").cast("int") % 3 != 0, F.col("plat")))
    _in_steps(spark, rows, _traffic_job(spark, "dwell-nulls", state.dwell_stream, path), "event_id")
    return spark.read.parquet(path).drop("batch_id")


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Dwell of a stream of which a fifth arrives after the rest of its half: what comes too late goes to a table of its own."""
    path = new_path(spark, "dwell")
    branches = {
        "taken": jobs.Branch("NOT late", "parquet", {"path": f"{path}/taken"}),
        "late": jobs.Branch("late", "parquet", {"path": f"{path}/late"}),
    }
    spec = jobs.JobSpec(
        name="late", topic=new_path(spark, "traffic"), source="json", source_options={"schema": TRAFFIC_SCHEMA},
        operator=lambda df: state.dwell_stream(df, outcomes=True), branches=branches,
    )
    rows = cs.traffic(spark, sf)
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    early = (F.col("event_id") < low + (high - low) // 2) & (F.col("event_id") % 5 != 0)
    _in_steps(spark, rows.withColumn("step", F.when(early, 0).otherwise(1)), spec, "step")
    shown = [spark.read.parquet(f"{path}/{name}").withColumn("outcome", F.lit(name)) for name in branches]
    slot = F.date_format(F.timestamp_seconds("slot"), "yyyy-MM-dd")
    return reduce(DataFrame.unionByName, shown).groupBy("outcome", "visit_id", slot.alias("date")).agg(F.sum("n").alias("n"))


def stream_iterate(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs that arrive in steps and iterate on over the batches, three steps in each; the rest is finished at the end."""
    path, loop = new_path(spark, "iterated"), pair_steps()
    spec = jobs.JobSpec(
        name="iterate", topic=new_path(spark, "pairs"), source="messages",
        operator=lambda df: pair_start(parse_pair(df)), sink="iterate",
        sink_options={"path": path, "steps_per_batch": 3, "timeout_ms": 3_600_000, **loop},
    )
    _in_steps(spark, pairs(spark, sf), spec, "event_id", text=True)
    loops.finish_pending(spark, path, timeout_ms=3_600_000, **loop)
    return loops.read_iterated(spark, path).groupBy("a", "b", "n", F.col("expired").cast("int").alias("expired")).agg(F.count("*").alias("rows"))


def stream_hourly_partials(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts and sketches per micro-batch, past days folded after each of them, merged on read."""
    path = new_path(spark, "partials")
    keys, distinct = [*TRAFFIC_KEYS, "req_hour"], {"uv_count": "visit_id", "ip_count": "ip"}
    spec = jobs.JobSpec(
        name="partials", topic=new_path(spark, "traffic"), source="json", source_options={"schema": TRAFFIC_SCHEMA},
        operator=with_request_date, sink="partials", sink_options={"path": path, "keys": keys, "distinct": distinct},
    )
    rows = cs.traffic(spark, sf)
    # A tenth of the rows arrives in the second step, when its days are folded already.
    late = F.when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    _in_steps(spark, rows.withColumn("step", late), spec, "step", after=lambda step: partials.fold_days(spark, path, step, keys, list(distinct)))
    merged = partials.read_partials(spark, path, [*TRAFFIC_KEYS, "req_date", "req_hour"], list(distinct))
    return merged.withColumnRenamed("n_rows", "pv_count").withColumn("req_date", F.date_format("req_date", "yyyy-MM-dd"))


def _summed(key: tuple, window: tuple, values) -> list[tuple]:
    """User code: rows, their sum and the first and last page of a window, a part at a time."""
    n, total, first, last = 0, 0, None, None
    for part in values:
        for row in part:
            n, total = n + 1, total + row.k
            at = row.req_time, row.event_id, row.website
            first, last = min(first or at, at), max(last or at, at)
    return [(n, total, first[2], last[2])]


_SUMMED = "n BIGINT, total BIGINT, first_page STRING, last_page STRING"


def stream_window_apply(spark: SparkSession, sf: str) -> DataFrame:
    """User code over each platform's six hours, by event time."""
    path = new_path(spark, "windows")

    def operator(df: DataFrame) -> DataFrame:
        rows = df.select("plat", "req_time", "event_id", "website", "k", F.timestamp_seconds("req_time").alias("ts"))
        return windows.apply_tumbling(rows, ["plat"], "ts", 6 * 3600, _summed, _SUMMED, delay="1 hour", part_rows=50)

    _in_steps(spark, cs.traffic(spark, sf), _traffic_job(spark, "windows", operator, path), "event_id")
    return spark.read.parquet(path).drop("batch_id")


def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """User code over each visitor's sessions, which a day without views ends."""
    path = new_path(spark, "sessions")

    def operator(df: DataFrame) -> DataFrame:
        rows = df.select("visit_id", "req_time", "event_id", "website", "k", F.timestamp_seconds("req_time").alias("ts"))
        return windows.apply_sessions(rows, ["visit_id"], "ts", 86400, _summed, _SUMMED, delay="1 hour")

    _in_steps(spark, cs.traffic(spark, sf), _traffic_job(spark, "sessions", operator, path), "event_id")
    return spark.read.parquet(path).drop("batch_id")


def _refused(payload: str) -> str:
    return json.dumps({"success": not payload.endswith("7")})


def _unsent(payload: str) -> str:
    return json.dumps({"success": not json.loads(payload)["sign"].endswith("7")})


def stream_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """A job that delivers visitors with an injected sender and stores the outcomes."""
    path = new_path(spark, "delivered")
    spec = jobs.JobSpec(
        name="delivery", topic=new_path(spark, "visits"), source="json", source_options={"schema": TRAFFIC_SCHEMA},
        operator=lambda df: df.filter("website = 'purchase'").select(F.col("visit_id").alias("payload")),
        sink="deliver", sink_options={"path": path, "send": _refused},
    )
    _in_steps(spark, cs.traffic(spark, sf), spec, "event_id")
    sent = spark.read.parquet(path)
    return sent.groupBy(F.col("payload").alias("sign"), "attempts", F.col("ok").cast("int").alias("ok")).agg(F.count("*").alias("n"))


def stream_delete_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Delete from and update a table that a stamped stream of JSON rows has filled; then its first batch is stored again, as by a retry."""
    path = new_path(spark, "streamed")
    spec = jobs.JobSpec(
        name="streamed", topic=new_path(spark, "rows"), source="messages",
        operator=lambda df: df, sink="stamped", sink_options={"path": path, "schema": TRAFFIC_SCHEMA},
    )
    rows = cs.traffic(spark, sf)
    _in_steps(spark, rows.select("event_id", F.to_json(F.struct(*rows.columns)).alias("value")), spec, "event_id", text=True)
    mutable.delete_from(spark, path, F.col("website") == "click")
    mutable.update_table(spark, path, F.col("plat") == 2, {"k": "k * 2 + 1"})
    jobs.SINKS[spec.sink](spark.read.text(f"{spec.topic}/step-0"), 0, **spec.sink_options)
    return mutable.read_table(spark, path).select("event_id", "plat", "website", "k")


def stream_merge_stored(spark: SparkSession, sf: str) -> DataFrame:
    """A streamed table with its first batch merged into the clustered layout, then changed."""
    path = new_path(spark, "merged")
    spec = jobs.JobSpec(
        name="merged", topic=new_path(spark, "rows"), source="messages",
        operator=lambda df: df, sink="stamped", sink_options={"path": path, "schema": TRAFFIC_SCHEMA},
    )
    rows = cs.traffic(spark, sf)
    _in_steps(spark, rows.select("event_id", F.to_json(F.struct(*rows.columns)).alias("value")), spec, "event_id", text=True)
    mutable.merge_batches(spark, path, 0)
    mutable.update_table(spark, path, F.col("website") == "view", {"k": "k + 1000"})
    return mutable.read_table(spark, path).select("event_id", "plat", "website", "k")


def stream_job_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Messages to a stamped table by a declared job, then the hourly summary."""
    path = new_path(spark, "facts")

    def operator(df: DataFrame) -> DataFrame:
        return decode.decode_elements(df, cs.TOPICS, cs.ELEMENT)

    messages = cs.request_envelopes(cs.traffic(spark, sf)).withColumn(
        "at", F.get_json_object("value", "$.ReceiveTime").cast("bigint")
    )
    spec = jobs.JobSpec(
        name="hourly", topic=new_path(spark, "messages"), source="messages",
        operator=operator, sink="stamped", sink_options={"path": path}, parallelism=8,
    )
    _in_steps(spark, messages, spec, "at", text=True)
    rows = with_request_date(spark.read.parquet(path).withColumnRenamed("topic", "website"))
    return traffic_by_hour(rows).withColumn("req_date", F.date_format("req_date", "yyyy-MM-dd"))


QUEUED = 3


def stream_two_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Two jobs of one list side by side on the same rows, each with a parallelism, sink and checkpoint of its own."""
    path, topic = new_path(spark, "two"), new_path(spark, "traffic")
    cs.traffic(spark, sf).write.json(f"{topic}/step-0")
    source = {"source": "json", "source_options": {"schema": TRAFFIC_SCHEMA}, "topic": f"{topic}/step-*", "until_drained": True}
    specs = [
        jobs.JobSpec(
            name="pages", operator=lambda df: state.running_counts(df, "website"), sink="keyed",
            sink_options={"path": f"{path}/pages", "keys": ["website"], "order": ["n"]}, output_mode="update", parallelism=2, **source,
        ),
        jobs.JobSpec(
            name="channels", operator=lambda df: df.filter("channel <> ''").select("website", "channel"), sink="parquet",
            sink_options={"path": f"{path}/channels"}, parallelism=3, **source,
        ),
    ]
    for query in jobs.start_jobs(spark, specs):
        jobs.drain(query)
    pages = read_latest(spark, f"{path}/pages", ["website"]).select("website", F.lit(None).cast("string").alias("channel"), "n")
    channels = spark.read.parquet(f"{path}/channels").groupBy("website", "channel").agg(F.count("*").alias("n"))
    return pages.unionByName(channels)


def stream_queue_positions(spark: SparkSession, sf: str) -> DataFrame:
    """A queue read batch by batch, set back by one batch, then read on with one more.

    Every quarter of the events is a batch; the one that was read last before the set-back
    is read twice.
    """
    queue, path = new_path(spark, "queue"), new_path(spark, "queued")
    rows = cs.traffic(spark, sf)
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    width = (high - low) // (QUEUED + 1) + 1
    messages = rows.select("event_id", F.to_json(F.struct(*rows.columns)).alias("value"))

    def arrive(quarter: int) -> None:
        first = low + quarter * width
        batch_queue.enqueue(messages.filter((F.col("event_id") >= first) & (F.col("event_id") < first + width)), queue, f"quarter-{quarter}")

    spec = jobs.JobSpec(
        name="queued", topic=queue, source="queue", source_options={"consumer": "facts"},
        operator=lambda df: df.select("batch_key", strict_from_json("value", f"STRUCT<{TRAFFIC_SCHEMA}>").alias("row")).select("batch_key", "row.*"),
        sink="parquet", sink_options={"path": path}, until_drained=True,
    )
    for quarter in range(QUEUED):
        arrive(quarter)
    jobs.drain_queue(spark, spec)
    batch_queue.set_position(spark, queue, "facts", batch_queue.get_position(spark, queue, "facts") - 1)
    arrive(QUEUED)
    jobs.drain_queue(spark, spec)
    return spark.read.parquet(path).groupBy("batch_key", "website").agg(
        F.countDistinct("event_id").alias("n_events"), F.count("*").alias("n_reads"), F.countDistinct("batch_id").alias("n_batches")
    )


def stream_route_branches(spark: SparkSession, sf: str) -> DataFrame:
    """One parse of event batches, split to a table, a delivery and a table of rejects."""
    path = new_path(spark, "routed")
    branches = {
        "pass": jobs.Branch("branch = 'pass'", "parquet", {"path": f"{path}/pass"}),
        "divert": jobs.Branch("branch = 'divert'", "deliver", {"path": f"{path}/divert", "send": _unsent}),
        "reject": jobs.Branch("branch = 'reject'", "parquet", {"path": f"{path}/reject"}),
    }

    def operator(df: DataFrame) -> DataFrame:
        envelopes = decode.decode_envelopes(df, args_type="STRUCT<events: VARIANT>")
        return decode.route_events(envelopes, cs.ROUTES, cs.BATCH_TOPICS)

    messages = cs.event_envelopes(cs.traffic(spark, sf)).withColumn("at", F.get_json_object("value", "$.ReceiveTime").cast("bigint"))
    spec = jobs.JobSpec(name="routed", topic=new_path(spark, "messages"), source="messages", operator=operator, branches=branches)
    _in_steps(spark, messages, spec, "at", text=True)
    none = F.lit(None)
    sent = F.from_json("payload", "event_file STRING, sign STRING")
    parts = [
        spark.read.parquet(f"{path}/pass").select("topic", "uri", "sign", none.cast("string").alias("reason"), none.cast("int").alias("attempts")),
        spark.read.parquet(f"{path}/divert").select(sent["event_file"].alias("topic"), none.cast("string").alias("uri"), sent["sign"].alias("sign"), none.cast("string").alias("reason"), "attempts"),
        spark.read.parquet(f"{path}/reject").select("topic", none.cast("string").alias("uri"), "sign", "reason", none.cast("int").alias("attempts")),
    ]
    stored = [part.withColumn("branch", F.lit(name)) for part, name in zip(parts, branches, strict=True)]
    return reduce(DataFrame.unionByName, stored).groupBy("branch", "topic", "uri", "sign", "reason", "attempts").agg(F.count("*").alias("n"))


PLANS = [
    Plan("stream_word_count", "AG-2 ST-3 SRC-7 SNK-7", stream_word_count, _count_sql("documents")),
    Plan("stream_first_seen", "UV-4 UV-5 ST-2", stream_first_seen, f"""
with {TRAFFIC} select distinct req_date as date, plat, agent_type, website, visit_id from traffic"""),
    Plan("stream_dwell", "DW-8 DW-9 ST-2 ST-3", stream_dwell, _rows_sql(1800)),
    Plan("stream_dwell_nulls", "DW-9", stream_dwell_nulls, _rows_sql(1800).replace(
        "cast(1 + user_id % 2 as integer) as plat", "case when user_id % 3 <> 0 then cast(1 + user_id % 2 as integer) end as plat")),
    Plan("stream_iterate", "ST-6 IT-1 IT-2 SNK-10", stream_iterate, """
with recursive pairs as (select event_id, user_id % 49 + 1 as a, event_id % 49 + 1 as b from events),
steps as (
  select event_id, a, b, a as x, b as y, cast(0 as bigint) as n from pairs
  union all
  select event_id, a, b, y, x + y, n + 1 from steps where n = 0 or (x < 100 and y < 100)),
counted as (select event_id, a, b, max(n) as n from steps group by all)
select a, b, n, 0 as expired, count(*) as rows from counted group by all"""),
    Plan("stream_hourly_partials", "AG-5 UV-4 SNK-10", stream_hourly_partials, f"""
with {TRAFFIC} select plat, agent_type, website, req_date, req_hour, count(*) as pv_count,
  count(distinct visit_id) as uv_count, count(distinct ip) as ip_count from traffic group by all"""),
    Plan("stream_window_apply", "ST-1 UDF-6 RT-4", stream_window_apply, f"""
with {TRAFFIC}, placed as (select *, req_time // 21600 * 21600 as window_start from traffic)
select plat, window_start, window_start + 21600 as window_end, count(*) as n, cast(sum(k) as bigint) as total,
  arg_min(website, (req_time, event_id)) as first_page, arg_max(website, (req_time, event_id)) as last_page
from placed where window_start + 21600 <= (select max(req_time) - 3600 from traffic) group by plat, window_start"""),
    Plan("stream_sessions", "ST-1 UDF-6", stream_sessions, f"""
with {TRAFFIC}, stepped as (
  select *, case when req_time - lag(req_time) over (partition by visit_id order by req_time, event_id) <= 86400 then 0 else 1 end as opens
  from traffic),
numbered as (select *, sum(opens) over (partition by visit_id order by req_time, event_id) as session from stepped)
select visit_id, min(req_time) as window_start, max(req_time) + 86400 as window_end, count(*) as n, cast(sum(k) as bigint) as total,
  arg_min(website, (req_time, event_id)) as first_page, arg_max(website, (req_time, event_id)) as last_page
from numbered group by visit_id, session having max(req_time) + 86400 <= (select max(req_time) - 3600 from traffic)"""),
    Plan("stream_late_rows", "ST-2 DW-8 RT-1", stream_late_rows, f"""
with {TRAFFIC}, bounds as (select min(event_id) as low, max(event_id) as high from traffic),
stepped as (select *, event_id < low + (high - low) // 2 and event_id % 5 <> 0 as early from traffic, bounds),
watermark as (select max(req_time) - 3600 as w from stepped where early)
select case when not early and req_time // 1800 * 1800 + 5400 <= w then 'late' else 'taken' end as outcome,
  visit_id, req_date as date, count(*) as n from stepped, watermark group by all"""),
    Plan("stream_delivery", "SNK-8 SNK-10", stream_delivery, f"""
with {TRAFFIC} select visit_id as sign, case when visit_id like '%7' then 3 else 1 end as attempts,
  case when visit_id like '%7' then 0 else 1 end as ok, count(*) as n from traffic where website = 'purchase' group by all"""),
    Plan("stream_delete_stored", "MU-1 MU-2 SNK-3 SNK-10 SRC-5", stream_delete_stored, f"""
with {TRAFFIC} select event_id, plat, website, case when plat = 2 then k * 2 + 1 else k end as k
from traffic where website <> 'click'"""),
    Plan("stream_merge_stored", "SNK-3 SNK-6 MU-2", stream_merge_stored, f"""
with {TRAFFIC} select event_id, plat, website, case when website = 'view' then k + 1000 else k end as k from traffic"""),
    Plan("stream_job_hourly", "SRC-4 SRC-5 SRC-6 SRC-7 ST-1 ST-4 SNK-3 SNK-10 PL-1 PL-2", stream_job_hourly, f"""
with {TRAFFIC}
select plat, agent_type, website, req_date, req_hour, count(*) as pv_count,
       count(distinct visit_id) as uv_count, count(distinct ip) as ip_count
from traffic where website in ('view', 'click', 'purchase') group by all"""),
    Plan("stream_queue_positions", "SRC-4 SRC-7 UDF-7", stream_queue_positions, f"""
with {TRAFFIC}, bounds as (select min(event_id) as low, (max(event_id) - min(event_id)) // {QUEUED + 1} + 1 as width from traffic),
placed as (select *, (event_id - low) // width as quarter from traffic, bounds)
select 'quarter-' || quarter as batch_key, website, count(*) as n_events,
  count(*) * any_value(case when quarter = {QUEUED - 1} then 2 else 1 end) as n_reads,
  any_value(case when quarter = {QUEUED - 1} then 2 else 1 end) as n_batches from placed group by quarter, website"""),
    Plan("stream_two_jobs", "ST-5 ST-4 PL-2", stream_two_jobs, f"""
with {TRAFFIC} select website, cast(null as varchar) as channel, count(*) as n from traffic group by all
union all select website, channel, count(*) from traffic where channel <> '' group by all"""),
    Plan("stream_route_branches", "RT-1 RT-2 SNK-8 SNK-10 DEC-7 DEC-8 DEC-11", stream_route_branches, f"""
{SENT}, reasoned as (
  select *, case when topic = 'unknown' then 'error topic' when topic in ('view', 'click') and broken = 'bad data' then null
    else broken end as reason from sent),
branched as (
  select *, case when reason is not null then 'reject' when topic in ('view', 'click') then 'pass' else 'divert' end as branch from reasoned)
select branch, topic,
  case when branch = 'pass' and topic = 'view' then '/view' end as uri, visit_id as sign, reason,
  case when branch = 'divert' then case when visit_id like '%7' then 3 else 1 end end as attempts, count(*) as n
from (select * replace (case when topic = 'app_vip_open' and branch = 'divert' then 'vip_open' else topic end as topic) from branched)
group by all"""),
]
