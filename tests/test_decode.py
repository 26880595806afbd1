"""Decoders on hand-written messages and on damaged ones."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import decode, routing, shape

TOPICS = ["a", "b"]


def lines(spark, messages):
    return spark.createDataFrame([(m if isinstance(m, str) else json.dumps(m),) for m in messages], "value string")


def envelope(args, method="POST", **more):
    return {"Method": method, "Headers": {"host": "h"}, "Args": args, "Uri": "/u", "ReceiveTime": 7, **more}


def test_envelope_defaults(spark):
    messages = [
        {"Method": "POST"},
        {"Method": "POST", "Headers": None, "Args": None, "Uri": None, "ReceiveTime": None},
        {"Method": "POST", "Headers": {}, "Args": [1]},
        envelope({"x": 1}),
    ]
    rows = decode.decode_envelopes(lines(spark, messages), as_text=True).collect()
    assert [tuple(r) for r in rows] == [
        ("POST", "0.0.0.0", "null", "", 0),
        ("POST", "0.0.0.0", "null", "", 0),
        ("POST", "0.0.0.0", "[1]", "", 0),
        ("POST", "h", '{"x":1}', "/u", 7),
    ]


def test_method_filter_and_headers(spark):
    messages = lines(spark, [envelope({}), envelope({}, "GET"), envelope({}, None), "junk", "[]", '{"Method":"POST"} x'])
    assert decode.decode_envelopes(messages).count() == 1
    kept = decode.decode_envelopes(messages, keep_headers=True, post_only=False, as_text=True).collect()
    assert [r.headers for r in kept] == ['{"host":"h"}'] * 3
    assert decode.envelope_rejects(messages).count() == 3
    assert decode.parse_envelopes(messages).groupBy("reason").count().count() == 3


NORMAL = [
    None, [1], {"topic": "a", "data": {"x": 1}}, {"topic": "a", "data": []}, {"topic": "z", "data": [1]},
    {"data": [1]}, {"topic": 1, "data": [1]}, "text", '{"topic": "a", "data": [1]}',
    {"topic": "a", "data": [{"x": i, "y": ["é", None, 1.5, "q\"]"]} for i in range(23)]},
    {"topic": "b", "data": ["s", 1, None, True, [1], {"k": "]"}]},
]


@pytest.mark.parametrize("args_type", ["VARIANT", decode.NORMAL_ARGS])
def test_normal_form(spark, args_type):
    requests = decode.decode_envelopes(lines(spark, [envelope(a) for a in NORMAL]), args_type=args_type)
    rows = decode.decode_normal(requests, TOPICS).collect()
    got = sorted((r.topic, r.ip, r.data) for r in rows)
    want = []
    for a in NORMAL:
        if isinstance(a, dict) and isinstance(a.get("data"), list) and a.get("topic") in TOPICS:
            want += [(a["topic"], "h", a["data"][i : i + 10]) for i in range(0, len(a["data"]), 10)]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(((t, i, json.loads(d)) for t, i, d in got), key=key) == sorted(want, key=key)
    parsed = decode.parse_normal(requests, TOPICS)
    reasons = {r.reason: r["count"] for r in parsed.groupBy("reason").count().collect()}
    assert reasons == {None: 3, decode.NO_DATA: 5, decode.BAD_TOPIC: 3}
    assert decode.normal_rejects(requests, TOPICS).count() == 8


def test_normal_form_from_text(spark):
    args = spark.createDataFrame([("h", json.dumps(a)) for a in NORMAL] + [("h", "oops"), ("h", None)], "ip string, args string")
    assert decode.decode_normal(args, TOPICS).count() == 3 + 1
    rejects = decode.normal_rejects(args, TOPICS)
    assert rejects.count() + 3 == args.count()
    assert rejects.filter("args = 'oops'").first().reason == decode.NO_DATA


def test_dead_letters_keep_the_message(spark):
    text = '{"Method":"POST","Args":{"topic":"a","data":[{"x":1,"x":2}]}}'
    requests = decode.decode_envelopes(lines(spark, [text]), keep_raw=True)
    assert [tuple(r) for r in decode.normal_rejects(requests, TOPICS).collect()] == [(text, decode.NO_DATA)]
    assert [tuple(r) for r in decode.event_batch_rejects(requests, TOPICS).collect()] == [(text, None, decode.BAD_EVENTS)]


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 20, 101])
def test_chunks_flatten_back(spark, n):
    row = spark.range(1).select(F.array(*[F.lit(i) for i in range(n)]).cast("array<int>").alias("d")).select(decode.chunks("d").alias("c")).first()
    pieces = row.c or []
    assert [x for p in pieces for x in p] == list(range(n))
    assert all(0 < len(p) <= 10 for p in pieces)


def events(*segments):
    return {"events": json.dumps(segments)}


def seg(topic, data, sign="s"):
    return {"segmentation": {"topic": topic, "data": data, "sign": sign}}


BATCHES = [
    events(seg("a", '{"x":1}'), seg("a", ""), seg("a", "{bad"), seg("z", "1"), {}, {"segmentation": 5}, 7),
    events(),
    {"events": "nope"},
    {"events": [1]},
    {"events": '{"a":1}'},
    {},
    events(seg("app_open", "[1, 2]"), seg("app_vip_open", '{"v":2}', None), seg("vip_open", "{bad"), seg("b", "raw")),
    events(seg("a", {"k": 1}), seg("a", None), seg("a", "0"), seg("a", 0), seg("a", "{} x")),
]
ALLOWED = ["a", "b", "app_open", "vip_open", "app_vip_open"]


@pytest.mark.parametrize("args_type", ["VARIANT", "STRUCT<events: VARIANT>"])
def test_event_batches(spark, args_type):
    requests = decode.decode_envelopes(lines(spark, [envelope(b) for b in BATCHES]), args_type=args_type)
    good = sorted((r.topic, r.data) for r in decode.decode_event_batch(requests, ALLOWED).collect())
    assert good == [("a", "0"), ("a", '{"x":1}'), ("app_open", "[1, 2]"), ("app_vip_open", '{"v":2}')]
    reasons = {r.reason: r["count"] for r in decode.event_batch_rejects(requests, ALLOWED).groupBy("reason").count().collect()}
    assert reasons == {
        decode.EMPTY_DATA: 3, decode.BAD_DATA: 5, decode.BAD_TOPIC: 1, decode.NO_SEGMENTATION: 3, decode.BAD_EVENTS: 4,
    }


def test_routes(spark):
    requests = decode.decode_envelopes(lines(spark, [envelope(b) for b in BATCHES]))
    passed = decode.route_passthrough(requests, {"a": "/a"}, ALLOWED).collect()
    assert sorted((r.uri or "", r.topic, r.data) for r in passed) == [
        ("", "b", "raw"), ("/a", "a", "0"), ("/a", "a", '{"k":1}'), ("/a", "a", '{"x":1}'), ("/a", "a", "{bad"), ("/a", "a", "{} x"),
    ]
    diverted = decode.route_divert(requests, ALLOWED).collect()
    assert sorted((r.uri, r.event_file) for r in diverted) == [("/base", "app_open"), ("/base", "vip_open")]
    assert sorted(json.loads(r.payload)["event_file"] for r in diverted) == ["app_open", "vip_open"]
    assert {json.dumps(json.loads(r.payload)["datalist"]) for r in diverted} == {"[1, 2]", '{"v": 2}'}
    assert any(json.loads(r.payload)["sign"] is None for r in diverted)


def test_one_parse_for_all_branches(spark):
    requests = decode.decode_envelopes(lines(spark, [envelope(b) for b in BATCHES]))
    routes = {"a": "/a"}
    for topics in (ALLOWED, spark.createDataFrame([(t,) for t in [*ALLOWED, "a", None]], "name string")):
        rows = decode.route_events(requests, routes, topics).collect()
        passed = decode.route_passthrough(requests, routes, ALLOWED).collect()
        assert sorted((r.uri or "", r.topic, r.data) for r in rows if r.branch == "pass") == sorted((r.uri or "", r.topic, r.data) for r in passed)
        diverted = decode.route_divert(requests, ALLOWED).collect()
        assert sorted((r.uri, r.topic, r.payload) for r in rows if r.branch == "divert") == sorted((r.uri, r.event_file, r.payload) for r in diverted)
        rejects = Counter(r.reason for r in rows if r.branch == "reject")
        assert rejects == {decode.EMPTY_DATA: 3, decode.BAD_DATA: 1, decode.BAD_TOPIC: 1, decode.NO_SEGMENTATION: 3, decode.BAD_EVENTS: 4}


def test_bad_events_keep_their_own_text(spark):
    message = envelope(events(seg("a", "{bad"), seg("z", "1"), seg("a", "1")))
    requests = decode.decode_envelopes(lines(spark, [message]), keep_raw=True)
    rows = decode.event_batch_rejects(requests, ALLOWED, digest=True).collect()
    assert sorted(json.loads(r.args)["segmentation"]["topic"] for r in rows) == ["a", "z"]
    assert len({r.message_md5 for r in rows}) == 1
    normal = decode.decode_envelopes(lines(spark, [envelope({"topic": t, "data": [1]}) for t in ("a", "z")]))
    table = spark.createDataFrame([("a",), ("a",)], "t string")
    assert [r.topic for r in decode.decode_normal(normal, table).collect()] == ["a"]
    assert [r.reason for r in decode.normal_rejects(normal, table).collect()] == [decode.BAD_TOPIC]


def test_typed_elements_equal_the_general_form_on_damaged_messages(spark):
    rng = random.Random(5)
    messages = []
    for i in range(600):
        a = {"topic": rng.choice(["a", "b", "z"]), "data": [rng.choice([{"x": 3}, {"x": 4}, {"x": 5}, {"x": "t"}, 7, [1], None]) if rng.random() < 0.2 else {"x": rng.randrange(9)} for _ in range(rng.randrange(4))]}
        text = json.dumps(envelope(a, rng.choice(["POST", "POST", "GET"])))
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(text) + 1)
            text = rng.choice([text[:at], text[:at] + rng.choice("]}[{,:\"1 x") + text[at:]])
        messages.append(text)
    df = lines(spark, messages)
    typed = decode.decode_elements(df, TOPICS, "x INT").groupBy("topic", "x").count()
    want = {}
    for text in messages:
        try:
            m = json.loads(text)
        except ValueError:
            continue
        a = m.get("Args") if isinstance(m, dict) else None
        if not isinstance(a, dict) or m.get("Method") != "POST":
            continue
        if a.get("topic") in TOPICS and isinstance(a.get("data"), list):
            for e in a["data"]:
                x = e.get("x") if isinstance(e, dict) else None
                x = x if isinstance(x, int) else None
                want[a["topic"], x] = want.get((a["topic"], x), 0) + 1
    assert {(r.topic, r.x): r["count"] for r in typed.collect()} == want


def test_routing_partitions_the_input(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, topic string")
    yes, no = routing.split_in_two(df, F.col("topic") == "a")
    assert yes.count() + no.count() == 3
    assert {t: d.count() for t, d in routing.split_by_value(df, ["a", "b", "c"]).items()} == {"a": 1, "b": 1, "c": 0}
    named = routing.split_by_predicate(df, {"low": F.col("n") < 3, "a": F.col("topic") == "a"})
    assert named["low"].count() == 2 and named["a"].count() == 1
    tagged = routing.tag_branches(df, {"low": F.col("n") < 3, "a": F.col("topic") == "a"})
    assert tagged.count() == 3


def test_pairs_and_predicates(spark):
    df = spark.createDataFrame([("3, 4",), (" 5,6 ",), ("x, 1",), ("7",), ("1,2,3",)], "value string")
    assert [tuple(r) for r in shape.parse_pair(df).collect()] == [(3, 4), (5, 6), (None, 1), (None, None), (None, None)]
    pairs = shape.parse_pair(df).filter(shape.all_of([("a", ">=", 3), shape.any_of([("b", "=", 4), ("b", "=", 9)])]))
    assert [tuple(r) for r in pairs.collect()] == [(3, 4)]
