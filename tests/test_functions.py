"""Scalar functions against Python's own, on edge values."""

import calendar
import datetime as dt
import json
import re
import urllib.parse
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.functions import text as words_of

JSON_EDGES = [
    "1", "null", "", "01", "[1,2", '{"a":1} x', "1,2", "{'a':1}", "1],[2", '1,"b":2', '"x"', " 1 ",
    '{"a":[1,{"b":null}]}', "tru", "true", "-", "1.", "1.5e3", "[]", "{}", '"\\u00e9"', '{"a":1}}',
    '{"a":1}{', "[1]]", " ", '"a', "1] ", '\t{"a":1}\n', '{"a":1,}', "[1,]", "nul", "1}", '1,"v":1',
    "-1", "+1", ".5", "1e", '"\\q"', '"a\nb"', '{"a":1}],[{"b":2}', "[[]", "[],[]", '"é"',
]


# The answers, by hand: a whole JSON value with nothing but white space around it.
JSON_WHOLE = {
    "1", "null", "[1,2]", '"x"', " 1 ", '{"a":[1,{"b":null}]}', "true", "1.5e3", "[]", "{}", '"\\u00e9"',
    '\t{"a":1}\n', "-1", '"é"',
}


SCALAR = re.compile(
    r'(?P<s>"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|'
    r"(?P<v>-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)|(?P<w>[ \t\n\r]+)|(?P<p>[][{},:])|(?P<x>.)",
    re.DOTALL,
)


def collapses(text):
    """Whether a text is one JSON value: scalars become letters, then lists and objects of letters, inside out."""
    letters = "".join({"s": "s", "v": "v", "w": "", "x": "?"}.get(m.lastgroup, m.group()) for m in SCALAR.finditer(text))
    before = None
    while before != letters:
        before, letters = letters, re.sub(r"\[(?:[sv](?:,[sv])*)?\]|\{(?:s:[sv](?:,s:[sv])*)?\}", "v", letters)
    return letters in ("s", "v")


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_is_json(spark):
    got = values(spark, [(v,) for v in JSON_EDGES], "v string", "v", fn.is_json("v"))
    assert {v for v, ok in got if ok} == JSON_WHOLE & set(JSON_EDGES)


def test_strict_from_json_takes_whole_objects_only(spark):
    texts = ['{"a":1}', ' {"a":1}\n', '{"a":1} x', '{"a":1}],[{"a":2}', "{'a':1}", "[1]", "1", "", '{"a":1}}', '{"a":"x"}']
    got = values(spark, [(v,) for v in texts], "v string", fn.strict_from_json("v", "STRUCT<a: INT>"))
    kept = [None if r is None else r.a for (r,) in got]
    assert kept == [1, 1, None, None, None, None, None, None, None, None]
    assert got[-1][0] is not None and got[5][0] is None


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text("ab\"\\]}[{,:é", max_size=4),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("ab", max_size=2), x, max_size=3),
    max_leaves=6,
)


@st.composite
def damaged(draw):
    text = json.dumps(draw(json_values))
    for _ in range(draw(st.integers(0, 2))):
        at = draw(st.integers(0, len(text)))
        text = draw(st.sampled_from([text[:at], text[:at] + draw(st.sampled_from("]}[{,:\"1 x")) + text[at:]]))
    return text


@settings(max_examples=5, deadline=None)
@given(st.lists(damaged(), min_size=150, max_size=150))
def test_is_json_on_damaged_text(spark, texts):
    got = values(spark, [(v,) for v in texts], "v string", "v", fn.is_json("v"))
    assert [v for v, ok in got if bool(ok) != collapses(v)] == []


URLS = [
    "http://A.com/x;p=1/y;q?a=b#f", "HTTP://h/p;a;b", "foo:bar;x", "mailto:a;b", "//h/p", "1a:b", "a", "",
    "?q", "#f", "http://h", "http://h?x#y?z", "https://u:p@h:80/a/b;c/d?e=;f", "x;y/z", "http://h/a;b?c;d#e;f",
]


def test_url_parts(spark):
    got = values(spark, [(u,) for u in URLS], "u string", "u", fn.url_parts("u"))
    assert {u: tuple(p) for u, p in got} == {u: tuple(urllib.parse.urlparse(u)) for u in URLS}


def test_camel_case(spark):
    got = values(spark, [("queue_source",), ("",), ("_",), ("__a_bC_",)], "v string", fn.camel_case("v"))
    assert [r[0] for r in got] == ["QueueSource", "", "", "ABc"]


def test_words_split_like_python(spark):
    text = " Ab  c　d e\x1cf G\u0085h\x0bi\n"
    got = values(spark, [(text,)], "v string", F.array_remove(fn.words("v"), ""))
    assert got[0][0] == text.lower().split()


def test_date_labels(spark):
    rows = [("2024-02-27", "2024-03-02"), ("2024-01-05", "2024-01-05"), ("2024-01-05", "2024-01-03")]
    got = values(spark, rows, "a string, b string", fn.date_labels("a", "b"), fn.date_labels("a", "b", stamps=True))
    assert got[0][0] == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02"]
    assert got[1][0] == [f"2024-01-05 {h:02d}" for h in range(24)]
    assert got[1][1] == [1704412800 + 3600 * h for h in range(24)]
    assert got[2] == ([], [])


def test_half_month(spark):
    days = [dt.date(2023, 12, 1) + dt.timedelta(d) for d in range(120)]
    got = values(spark, [(d,) for d in days], "d date", "d", fn.half_month("d"))
    for d, h in got:
        last = calendar.monthrange(d.year, d.month)[1]
        want = (1, 15) if d.day <= 15 else (16, last)
        assert (h.start.day, h.end.day) == want and h.start.month == h.end.month == d.month


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "Asia/Kolkata", "Asia/Kathmandu"])
def test_slots_and_midnights_follow_the_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = [1704067200 + 977 * i for i in range(200)]
        got = values(
            spark, [(t,) for t in times], "t long", "t", fn.slot_start("t"), fn.midnight_after("t", 2, zone), fn.epoch_to_text("t"),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for t, slot, midnight, text in got:
        local = dt.datetime.fromtimestamp(t, ZoneInfo(zone))
        assert slot == t - (local.minute % 30) * 60 - local.second
        day = local.replace(hour=0, minute=0, second=0) + dt.timedelta(days=2)
        assert midnight == int(day.timestamp())
        assert text == local.strftime("%Y-%m-%d %H:%M:%S")


def test_epochs(spark):
    got = values(
        spark, [(1704067200.9, 0)], "x double, z int", fn.epoch_seconds("x"), fn.epoch_millis(F.lit(0.0025)),
        fn.epoch_seconds("z") > 1704067200, fn.text_to_epoch(F.lit("not a time")), fn.midnight_after(F.lit(1704124800 + 3600), 1, raw=True),
    )
    assert got == [(1704067200, 2, True, None, 1704067200 + 86400 - 8 * 3600)]


def test_nulls(spark):
    got = values(
        spark, [("",), (None,), ("x",)], "v string", fn.or_default("v"), fn.encode_null("v"), fn.decode_null(fn.encode_null("v")),
    )
    assert got == [("(not set)", "", ""), ("(not set)", "1970-01-01 00:00:00", None), ("x", "x", "x")]


def test_stamp_gives_each_row_its_own_id(spark):
    rows = fn.stamp(spark.range(1000)).collect()
    assert len({r.id for r in rows}) == 1000


def test_joined_words_are_the_words(spark):
    texts = [None, "", " ", "a", " A b", "a\u00a0\u2003B\n\n\x85c ", "\u3000\u0130x\ty\x1cz\r\n", "\x00 \x01 a\u200bb", "\u00e9\U0001f600 \u00df"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(F.array_remove(words_of.words("t"), "").alias("want"), words_of.split_joined(words_of.joined_words("t")).alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows] and rows[5].got == ["a", "b", "c"]
