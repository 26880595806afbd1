"""Decoding of request envelopes.

Every ``parse_*`` function keeps all its input and adds ``reason``, which is NULL
for good rows. The ``decode_*`` functions return the good rows, the ``*_rejects``
functions the others, so accepted and rejected rows add up to the input.

An envelope is parsed once. Its ``args`` come out as VARIANT, or in the type that the
next step wants, such as ``NORMAL_ARGS``, which spares the second pass over them. Text
is accepted wherever a parsed column is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import is_json, strict_from_json, strict_json

# The defaults and the reject reasons of the decoders.
DEFAULT_IP = "0.0.0.0"
NOT_JSON = "not json"
NOT_POST = "not post"
NO_DATA = "cannot get data"
BAD_TOPIC = "error topic"
BAD_EVENTS = "cannot get events"
NO_SEGMENTATION = "no segmentation"
EMPTY_DATA = "empty data"
BAD_DATA = "bad data"

PIECE = 10

# Topics that are diverted, the one that is renamed, and their uri.
DIVERT_TOPICS = ("app_open", "vip_open", "app_vip_open")
DIVERT_RENAMES = {"app_vip_open": "vip_open"}
DIVERT_URI = "/base"

NORMAL_ARGS = "STRUCT<topic: VARIANT, data: ARRAY<VARIANT>>"


def _struct(schema: str) -> str:
    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema))
    return f"STRUCT<{fields}>"


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once.

    Filters on an ordinary column are pushed below it with a copy of its expression;
    for a parse that means parsing twice. They stay above a generated column.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _text_of(v: Column) -> Column:
    """The text of a VARIANT that holds a JSON string, else NULL."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


# --- envelopes -----------------------------------------------------------------


def parse_envelopes(
    df: DataFrame, value: str = "value", post_only: bool = True, args_type: str = "VARIANT"
) -> DataFrame:
    """DEC-1..3: one row per envelope with its fields and a ``reason``."""
    envelope = (
        f"STRUCT<Method: STRING, Headers: VARIANT, Args: {args_type}, Uri: STRING, ReceiveTime: BIGINT>"
    )
    env = F.col("_env")
    reason = F.when(env.isNull(), NOT_JSON)
    if post_only:
        reason = reason.when(F.coalesce(env["Method"], F.lit("")) != "POST", NOT_POST)
    host = F.try_variant_get(env["Headers"], "$.host", "string")
    parsed = _once(df.select(F.col(value).alias("raw")), "_env", strict_from_json("raw", envelope))
    return parsed.select(
        "raw",
        env["Method"].alias("method"),
        env["Headers"].alias("headers"),
        F.coalesce(host, F.lit(DEFAULT_IP)).alias("ip"),
        env["Args"].alias("args"),
        F.coalesce(env["Uri"], F.lit("")).alias("gateway_uri"),
        F.coalesce(env["ReceiveTime"], F.lit(0)).alias("receive_time"),
        reason.alias("reason"),
    )


def decode_envelopes(
    df: DataFrame,
    value: str = "value",
    keep_headers: bool = False,
    post_only: bool = True,
    args_type: str = "VARIANT",
    as_text: bool = False,
    keep_raw: bool = False,
) -> DataFrame:
    """DEC-1..3: the good envelopes.

    ``as_text`` gives ``args`` and ``headers`` as JSON text, the form a sink wants;
    leave it off when another decoder follows. ``keep_raw`` keeps the message for the
    dead letters of that decoder.
    """
    good = parse_envelopes(df, value, post_only, args_type).filter(F.col("reason").isNull())
    if as_text:
        good = good.withColumns(
            {
                "args": F.coalesce(F.to_json("args"), F.lit("null")),
                "headers": F.to_json("headers"),
            }
        )
    kept = [*(["raw"] if keep_raw else []), "method", *(["headers"] if keep_headers else []), "ip", "args"]
    return good.select(*kept, "gateway_uri", "receive_time")


def envelope_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """DEC-11: envelopes that are not JSON objects."""
    return (
        parse_envelopes(df, value, post_only=False)
        .filter(F.col("reason").isNotNull())
        .select(F.col("raw").alias("args"), "reason")
    )


# --- normal form ---------------------------------------------------------------


def topic_allowed(topic: Column | str, topics: Sequence[str]) -> Column:
    """DEC-9: whether the topic is in the allow-list; NULL counts as not allowed."""
    topic = F.col(topic) if isinstance(topic, str) else topic
    return F.coalesce(topic.isin(list(topics)), F.lit(False))


def _mark_allowed(df: DataFrame, topics: Sequence[str] | DataFrame) -> DataFrame:
    """DEC-9: add ``_allowed``; a table of topics is joined by its first column."""
    if not isinstance(topics, DataFrame):
        return df.withColumn("_allowed", topic_allowed("topic", topics))
    table = topics.select(F.col(topics.columns[0]).alias("_listed_topic")).distinct().withColumn("_found", F.lit(True))
    marked = df.join(table, F.col("topic") == F.col("_listed_topic"), "left")
    return marked.withColumn("_allowed", F.coalesce("_found", F.lit(False))).drop("_listed_topic", "_found")


def chunks(data: Column | str, size: int = PIECE) -> Column:
    """DEC-5: split an array into arrays of at most ``size``; empty gives none."""
    data = F.col(data) if isinstance(data, str) else data
    starts = F.when(F.size(data) > 0, F.sequence(F.lit(1), F.size(data), F.lit(size)))
    return F.transform(starts, lambda i: F.slice(data, i, size))


def _parsed(df: DataFrame, name: str, kind: str) -> tuple[DataFrame, str]:
    """The column as a parsed value: itself, or a new one when it holds JSON text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return _once(df, "_args", strict_from_json(name, kind)), "_args"
    return df, name


def parse_normal(df: DataFrame, topics: Sequence[str] | DataFrame, args: str = "args") -> DataFrame:
    """DEC-4: add ``topic``, ``data`` (an array) and ``reason``."""
    return _parse_normal(df, topics, args).drop("_allowed")


def _parse_normal(df: DataFrame, topics: Sequence[str] | DataFrame, args: str) -> DataFrame:
    rows, parsed = _parsed(df, args, NORMAL_ARGS)
    a = F.col(parsed)
    if isinstance(rows.schema[parsed].dataType, T.VariantType):
        topic, data = _field(a, "$.topic"), F.try_variant_get(a, "$.data", "array<variant>")
    else:
        topic, data = a["topic"], a["data"]
    out = _mark_allowed(rows.withColumns({"topic": _text_of(topic), "data": data}), topics)
    reason = F.when(F.col("data").isNull(), NO_DATA).when(~F.col("_allowed"), BAD_TOPIC)
    return out.withColumn("reason", reason).drop("_args")


def decode_normal(
    df: DataFrame, topics: Sequence[str] | DataFrame, args: str = "args", size: int = PIECE
) -> DataFrame:
    """DEC-4 and DEC-5: ``(topic, ip, data)`` with ``data`` a JSON array of <= ``size``."""
    pieces = _listed(df, topics, args).select("topic", "ip", F.explode(chunks("data", size)).alias("_piece"))
    return pieces.select("topic", "ip", F.to_json("_piece").alias("data"))


def decode_elements(df: DataFrame, topics: Sequence[str] | DataFrame, schema: str, value: str = "value") -> DataFrame:
    """DEC-1, DEC-2 and DEC-4 for jobs that want typed elements.

    From raw envelopes to ``(topic, host, <schema columns>)`` in one parse, without
    the JSON text of the pieces in between.
    """
    element = _struct(schema)
    parsed = parse_envelopes(df, value, args_type=f"STRUCT<topic: VARIANT, data: ARRAY<{element}>>")
    # One element of another kind makes a typed array NULL. Such arrays, which are rare,
    # are taken apart element by element; the odd ones become rows of NULLs.
    anyway = F.transform(
        F.try_variant_get(strict_json("raw"), "$.Args.data", "array<variant>"),
        lambda e: F.from_json(F.to_json(e), element),
    )
    requests = parsed.filter(F.col("reason").isNull())
    listed = _listed(requests, topics, "args").withColumn("data", F.coalesce("data", anyway))
    elements = listed.select("topic", F.col("ip").alias("host"), F.explode("data").alias("_element"))
    return elements.select("topic", "host", "_element.*")


def _listed(df: DataFrame, topics: Sequence[str] | DataFrame, args: str) -> DataFrame:
    # Rows without an array need no filter: they explode to nothing.
    return _parse_normal(df, topics, args).filter("_allowed").drop("_allowed")


def normal_rejects(df: DataFrame, topics: Sequence[str] | DataFrame, args: str = "args") -> DataFrame:
    """DEC-11: dead-letter rows ``(args, reason)`` of the normal form."""
    return (
        parse_normal(df, topics, args)
        .filter(F.col("reason").isNotNull())
        .select(_text(df, args).alias("args"), "reason")
    )


def _text(df: DataFrame, name: str) -> Column:
    """The rejected text: the column, or the whole message where there is none."""
    text = F.col(name) if isinstance(df.schema[name].dataType, T.StringType) else F.to_json(name)
    return F.coalesce(text, F.col("raw")) if "raw" in df.columns else text


# --- event batches -------------------------------------------------------------


def parse_event_batch(
    df: DataFrame, topics: Sequence[str] | DataFrame, args: str = "args", check_data: bool | Sequence[str] = True
) -> DataFrame:
    """DEC-6 and DEC-7: one row per event, or one per message without an event list.

    Adds ``topic``, ``sign``, ``data`` (text as received), ``body`` (its parsed form),
    ``event`` (the event's own JSON) and ``reason``. Without ``check_data`` the text of
    ``data`` is not parsed; with a list of topics it is for these only.
    """
    rows, parsed = _parsed(df, args, "STRUCT<events: VARIANT>")
    a = F.col(parsed)
    if isinstance(rows.schema[parsed].dataType, T.VariantType):
        events = _field(a, "$.events")
    else:
        events = a["events"]
    listed = _once(rows, "_list", strict_from_json(_text_of(events), "ARRAY<VARIANT>"))
    # A message without a list keeps one row, which carries its reason.
    event = F.when(F.col("_list").isNull(), F.array(F.lit(None))).otherwise(F.col("_list"))
    out = listed.select(
        *df.columns, F.col("_list").isNotNull().alias("_listed"), F.explode(event).alias("_event")
    ).withColumns(
        {"_seg": _field(F.col("_event"), "$.segmentation"), "_data": _field(F.col("_event"), "$.segmentation.data")}
    )
    seg, text = F.col("_seg"), F.col("_text")
    out = out.withColumns(
        {
            "topic": _text_of(_field(seg, "$.topic")),
            "sign": F.try_variant_get(seg, "$.sign", "string"),
            "_text": _text_of(F.col("_data")),
        }
    ).withColumn("data", F.coalesce(text, F.to_json("_data")))
    out = _mark_allowed(out.withColumn("event", F.to_json("_event")), topics)
    allowed = F.col("_allowed")
    # What counts as empty is "" or one of these JSON values.
    empty = F.col("data").isNull() | F.when(text.isNull(), F.col("data")).otherwise(
        F.when(text == "", "null")
    ).isin("null", "false", "0", "[]", "{}")
    is_object = F.col("topic").isNotNull() | F.schema_of_variant(seg).startswith("OBJECT")
    reason = (
        F.when(~F.col("_listed"), BAD_EVENTS)
        .when(~F.coalesce(is_object, F.lit(False)), NO_SEGMENTATION)
        .when(~allowed, BAD_TOPIC)
        .when(F.coalesce(empty, F.lit(False)), EMPTY_DATA)
    )
    if check_data:
        checked = F.lit(True) if check_data is True else topic_allowed("topic", check_data)
        out = _once(out, "body", strict_json(F.when(allowed & checked, text)))
        reason = reason.when(checked & F.col("body").isNull(), BAD_DATA)
    else:
        out = out.withColumn("body", F.lit(None).cast("variant"))
    return _once(out, "reason", reason).drop("_event", "_seg", "_data", "_text", "_listed", "_allowed")


def decode_event_batch(df: DataFrame, topics: Sequence[str] | DataFrame, args: str = "args") -> DataFrame:
    """DEC-6: ``(topic, ip, data)``, one row per valid event.

    ``data`` is the JSON text as received, now known to be valid.
    """
    return parse_event_batch(df, topics, args).filter(F.col("reason").isNull()).select("topic", "ip", "data")


def event_batch_rejects(
    df: DataFrame, topics: Sequence[str] | DataFrame, args: str = "args", digest: bool = False
) -> DataFrame:
    """DEC-11: dead-letter rows ``(args, topic, reason)`` of the event-batch form.

    A bad event keeps its own JSON, a message without events the whole message, so n bad
    events do not store their message n times. With ``digest`` the MD5 of the message
    (``message_md5``) tells which events came together.
    """
    parsed = parse_event_batch(df, topics, args).filter(F.col("reason").isNotNull())
    whole = _text(df, args)
    return parsed.select(
        F.coalesce("event", whole).alias("args"), "topic", "reason", *([F.md5(whole).alias("message_md5")] if digest else [])
    )


def route_events(
    df: DataFrame,
    routes: Mapping[str, str] | DataFrame,
    topics: Sequence[str] | DataFrame,
    args: str = "args",
    divert_topics: Sequence[str] = DIVERT_TOPICS,
    renames: Mapping[str, str] = DIVERT_RENAMES,
    uri: str = DIVERT_URI,
) -> DataFrame:
    """DEC-7, DEC-8, DEC-10 and DEC-11 in one parse: every event with its ``branch``.

    ``pass`` rows hold the text as received and the uri of their topic, ``divert`` rows
    the renamed topic and the ``payload`` to deliver, ``reject`` rows the event's JSON (or
    the message, where there are no events) as ``data``, and a ``reason``. Write the rows
    once, partitioned by branch; a filter on the frame itself would parse again.
    """
    parsed = parse_event_batch(df, topics, args, check_data=divert_topics)
    branch = F.when(F.col("reason").isNotNull(), "reject").when(topic_allowed("topic", divert_topics), "divert").otherwise("pass")
    renamed = reduce(lambda c, r: F.when(F.col("topic") == r[0], r[1]).otherwise(c), renames.items(), F.col("topic"))
    event_file = renamed.alias("event_file")
    payload = F.to_json(F.struct(event_file, "sign", F.col("body").alias("datalist")), {"ignoreNullFields": "false"})
    rows = with_uri(parsed, routes, uri="_uri").withColumn("branch", branch)
    diverted = F.col("branch") == "divert"
    return rows.select(
        "branch",
        F.when(diverted, uri).when(F.col("branch") == "pass", F.col("_uri")).alias("uri"),
        F.when(diverted, renamed).otherwise(F.col("topic")).alias("topic"),
        "sign",
        "ip",
        F.when(F.col("branch") == "reject", F.coalesce("event", _text(df, args))).otherwise(F.col("data")).alias("data"),
        F.when(diverted, payload).alias("payload"),
        "reason",
    )


def route_passthrough(
    df: DataFrame,
    routes: Mapping[str, str] | DataFrame,
    topics: Sequence[str] | DataFrame,
    args: str = "args",
    divert_topics: Sequence[str] = DIVERT_TOPICS,
) -> DataFrame:
    """DEC-7 and DEC-10: ``(uri, topic, ip, data)`` of the topics that are not diverted.

    ``data`` is the text as received. A topic without a route has a NULL uri.
    """
    kept = parse_event_batch(df, topics, args, check_data=False).filter(
        F.col("reason").isNull() & ~F.col("topic").isin(list(divert_topics))
    )
    return with_uri(kept, routes).select("uri", "topic", "ip", "data")


def route_divert(
    df: DataFrame,
    topics: Sequence[str] | DataFrame,
    args: str = "args",
    divert_topics: Sequence[str] = DIVERT_TOPICS,
    renames: Mapping[str, str] = DIVERT_RENAMES,
    uri: str = DIVERT_URI,
) -> DataFrame:
    """DEC-8: ``(uri, event_file, sign, datalist)`` of the diverted topics.

    ``datalist`` is a VARIANT; rows whose data is not JSON are left out.
    ``payload`` is the JSON text to deliver.
    """
    diverted = parse_event_batch(df, topics, args).filter(
        F.col("reason").isNull() & F.col("topic").isin(list(divert_topics))
    )
    event_file = F.col("topic")
    for old, new in renames.items():
        event_file = F.when(F.col("topic") == old, new).otherwise(event_file)
    rows = diverted.select(
        F.lit(uri).alias("uri"), event_file.alias("event_file"), "sign", F.col("body").alias("datalist")
    )
    return rows.withColumn(
        "payload", F.to_json(F.struct("event_file", "sign", "datalist"), {"ignoreNullFields": "false"})
    )


def with_uri(
    df: DataFrame, routes: Mapping[str, str] | DataFrame, topic: str = "topic", uri: str = "uri"
) -> DataFrame:
    """DEC-10: look the topic up; a missing route gives NULL.

    A mapping is a literal of the plan. A table is joined, and Spark broadcasts it
    only when its size is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    if isinstance(routes, DataFrame):
        table = routes.select(F.col(routes.columns[0]).alias(topic), F.col(routes.columns[1]).alias(uri))
        return df.join(table.dropDuplicates([topic]), topic, "left")
    if not routes:
        return df.withColumn(uri, F.lit(None).cast("string"))
    pairs = F.create_map(*[F.lit(x) for pair in routes.items() for x in pair])
    return df.withColumn(uri, F.try_element_at(pairs, F.col(topic)))


def valid_json(df: DataFrame, column: str = "data") -> DataFrame:
    """Keep the rows whose column is exactly one JSON value."""
    return df.filter(is_json(column))
