"""Clickstream views of the ``events`` table.

``traffic`` is the decoded form. ``request_envelopes`` and ``event_envelopes`` pack
the same events into the JSON messages that the decoders take. A message holds the
events of one type within a block of ``block`` consecutive event ids, so its size is
bounded whatever the data looks like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import table

TOPICS = ("view", "click", "purchase")
ELEMENT = "event_id BIGINT, req_time BIGINT, plat INT, agent_type INT, visit_id STRING, ip STRING, channel STRING, k INT"

# The topics of the event-batch messages, by event type.
BATCH_TOPIC = {
    "signup": "app_open",
    "purchase": "app_vip_open",
    "error": "unknown",
    "view": "view",
    "click": "click",
}
BATCH_TOPICS = ("view", "click", "app_open", "vip_open", "app_vip_open")
ROUTES = {"view": "/view", "app_open": "/open"}


def traffic(spark: SparkSession, directory: str) -> DataFrame:
    """Events as page requests; the epoch second is that of the UTC wall clock."""
    events = table(spark, directory, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    user, channel = F.col("user_id"), F.col("k") % 3
    return events.select(
        "event_id",
        F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts")).alias("req_time"),
        user.cast("string").alias("visit_id"),
        (1 + user % 2).cast("int").alias("plat"),
        (1 + user % 5).cast("int").alias("agent_type"),
        F.col("event_type").alias("website"),
        F.concat(F.lit("10.0.0."), (user % 100).cast("string")).alias("ip"),
        F.when(channel == 0, "").otherwise(F.concat(F.lit("ch"), channel.cast("string"))).alias("channel"),
        "k",
    )


def _message(method: Column, host: Column, args: Column) -> Column:
    return F.to_json(
        F.struct(
            method.alias("Method"),
            F.struct(host.alias("host")).alias("Headers"),
            args.alias("Args"),
            F.lit("/collect").alias("Uri"),
            F.col("receive_time").alias("ReceiveTime"),
        )
    )


def request_envelopes(df: DataFrame, block: int = 100) -> DataFrame:
    """Normal-form messages of ``traffic`` rows: ``value``, one JSON text each.

    Pages named ``error`` arrive with the method GET.
    """
    element = F.struct(
        "event_id", "req_time", "plat", "agent_type", "visit_id", "ip", "channel", "k"
    )
    packed = df.groupBy("website", F.floor(F.col("event_id") / block).alias("block")).agg(
        F.sort_array(F.collect_list(element)).alias("data"),
        F.max("req_time").alias("receive_time"),
    )
    method = F.when(F.col("website") == "error", "GET").otherwise("POST")
    args = F.struct(F.col("website").alias("topic"), "data")
    return packed.select(_message(method, _host("block"), args).alias("value"))


def event_envelopes(df: DataFrame, block: int = 100) -> DataFrame:
    """Event-batch messages of ``traffic`` rows.

    Some of the inner texts are empty (``k`` below 5) or cut short (``k`` below 10).
    """
    body = F.to_json(F.struct("event_id", "visit_id", "k"))
    data = (
        F.when(F.col("k") < 5, "")
        .when(F.col("k") < 10, F.expr("left(body, length(body) - 1)"))
        .otherwise(F.col("body"))
    )
    topic = F.create_map(*[F.lit(x) for pair in BATCH_TOPIC.items() for x in pair])
    segmentation = F.struct(
        topic[F.col("website")].alias("topic"), data.alias("data"), F.col("visit_id").alias("sign")
    )
    event = F.struct("event_id", F.struct(segmentation.alias("segmentation")).alias("event"))
    packed = (
        df.withColumn("body", body)
        .groupBy(F.floor(F.col("event_id") / block).alias("block"))
        .agg(F.sort_array(F.collect_list(event)).alias("listed"), F.max("req_time").alias("receive_time"))
    )
    events = F.to_json(F.transform("listed", lambda e: e.event))
    args = F.struct(events.alias("events"))
    return packed.select(_message(F.lit("POST"), _host("block"), args).alias("value"))


def _host(block: str) -> Column:
    return F.concat(F.lit("10.1.0."), (F.col(block) % 100).cast("string"))
