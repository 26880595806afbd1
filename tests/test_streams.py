"""Streams equal their batch forms, resume from their checkpoint, and jobs are checked."""

import json
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import decode, dwell
from tidemark.schemas import TRAFFIC
from tidemark.streaming import jobs, packing, state

BASE = 1704067200


def write_json(df, path, step):
    df.write.json(f"{path}/step-{step}")


def events(spark, rows):
    full = [(i, BASE + t, "u", 1, 1, page, "ip", "", 0) for i, page, t in rows]
    return spark.createDataFrame(full, TRAFFIC)


def dwell_job(tmp_path):
    return jobs.JobSpec(
        name="dwell-test", topic=str(tmp_path / "in" / "step-*"), source="json", source_options={"schema": TRAFFIC},
        operator=lambda df: state.dwell_stream(df, buckets=4), sink="parquet", sink_options={"path": str(tmp_path / "out")},
        checkpoint=str(tmp_path / "checkpoint"), until_drained=True, parallelism=2,
    )


def test_late_events_extend_the_nearest_view(spark, tmp_path):
    spec = dwell_job(tmp_path)
    source = str(tmp_path / "in")
    arrivals = [
        [(0, "A", 100), (1, "B", 200)],
        [(2, "A", 90), (3, "C", 150), (4, "B", 260)],
        [(5, "A", 210), (6, "D", 300)],
    ]
    for step, rows in enumerate(arrivals):
        write_json(events(spark, rows), source, step)
        jobs.drain(jobs.start_job(spark, spec))
    # Nothing new: a restart adds nothing.
    jobs.drain(jobs.start_job(spark, spec))
    got = sorted((r.event_id, r.website, r.sign - BASE, r.view_time) for r in spark.read.parquet(spec.sink_options["path"]).collect())
    # 2 reaches back from A's start, 3 opens C and 5 a second A silently, and 6 closes that one.
    assert got == [(1, "A", 100, 100), (2, "A", 100, 10), (4, "B", 200, 60), (6, "A", 210, 90)]


def test_state_goes_when_the_watermark_has_passed(spark, tmp_path):
    spec = dwell_job(tmp_path)
    source = str(tmp_path / "in")
    write_json(events(spark, [(0, "A", 0), (1, "A", 60)]), source, 0)
    jobs.drain(jobs.start_job(spark, spec))
    write_json(events(spark, [(2, "A", 40000)]), source, 1)
    query = jobs.start_job(spark, spec)
    jobs.drain(query)
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert rows[-1] == 1


def test_merge_repeats_keeps_the_ends(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 99)], "k string, i long").coalesce(1)
    assert sorted(tuple(r) for r in state.merge_repeats(df, ["k"], "i").collect()) == [("a", 0), ("b", 99)]
    assert sorted(tuple(r) for r in state.merge_repeats(df, ["k"], "i", ends=True).collect()) == [("a", 0), ("a", 49), ("b", 99)]


def test_message_job_resumes_and_stores_once(spark, tmp_path):
    source, out = tmp_path / "messages", str(tmp_path / "out")
    source.mkdir()

    def put(name, *args):
        text = "\n".join(json.dumps({"Method": "POST", "Args": a}) for a in args)
        (source / name).write_text(text)

    spec = jobs.JobSpec(
        name="messages-test", topic=str(source), operator=lambda df: decode.decode_normal(decode.decode_envelopes(df), ["a"]),
        source_options={"files_per_trigger": 1},
        sink="parquet", sink_options={"path": out}, checkpoint=str(tmp_path / "checkpoint"), until_drained=True,
    )
    put("1.txt", {"topic": "a", "data": list(range(15))}, {"topic": "b", "data": [1]})
    put("2.txt", {"topic": "a", "data": [1]})
    query = jobs.start_job(spark, spec)
    jobs.drain(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2  # a file is a batch
    assert spark.read.parquet(out).count() == 3
    jobs.drain(jobs.start_job(spark, spec))
    assert spark.read.parquet(out).count() == 3
    put("3.txt", {"topic": "a", "data": [7]})
    jobs.drain(jobs.start_job(spark, spec))
    assert spark.read.parquet(out).count() == 4


def test_jobs_are_checked_before_any_starts(spark):
    good = jobs.JobSpec(name="x", topic="/nowhere", operator=lambda df: df)
    for bad in (replace(good, topic=""), replace(good, source="tape"), replace(good, sink="tape")):
        with pytest.raises(ValueError):
            jobs.start_jobs(spark, [good, bad])
    assert not spark.streams.active


def test_two_jobs_run_side_by_side(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("to be\nor not to be")
    specs = [
        jobs.JobSpec(
            name=f"side-{i}", topic=str(source), operator=lambda df: state.running_counts(df.select(F.explode(F.split("value", " ")).alias("word")), "word"),
            sink="keyed", sink_options={"path": str(tmp_path / f"out-{i}"), "keys": ["word"], "order": ["n"]},
            output_mode="update", until_drained=True, parallelism=i + 1,
        )
        for i in range(2)
    ]
    for query in jobs.start_jobs(spark, specs):
        jobs.drain(query)
    for i in range(2):
        assert {r.word: r.n for r in spark.read.parquet(str(tmp_path / f"out-{i}")).collect()} == {"to": 2, "be": 2, "or": 1, "not": 1}


def test_a_job_without_a_sink_prints(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("hello")
    spec = jobs.JobSpec(name="print", topic=str(source), operator=lambda df: df, until_drained=True)
    jobs.drain(jobs.start_job(spark, spec))


def test_stream_dwell_equals_batch_on_ordered_input(spark, tmp_path):
    rows = [(i, "ABC"[(i // 3) % 3], i * 7 - i % 2) for i in range(200)]
    df = events(spark, sorted(rows, key=lambda r: r[2])).cache()
    spec = dwell_job(tmp_path)
    for step in range(2):
        part = df.filter((F.col("event_id") >= 100 * step) & (F.col("event_id") < 100 * (step + 1)))
        write_json(part, str(tmp_path / "in"), step)
        jobs.drain(jobs.start_job(spark, spec))
    columns = ["event_id", "website", "sign", "view_time", "slot"]
    got = spark.read.parquet(spec.sink_options["path"]).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, dwell.dwell_rows(df).select(*columns).collect()))


def test_a_restart_without_a_checkpoint_of_its_own_keeps_stored_rows(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    spec = jobs.JobSpec(name="again", topic=str(source), operator=lambda df: df, sink="parquet", sink_options={"path": out}, until_drained=True)
    for word in ("one", "two"):
        (source / f"{word}.txt").write_text(word)
        jobs.drain(jobs.start_job(spark, spec))
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["one", "two"]


def test_a_backlog_drains_without_pauses(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(6):
        (source / f"{i}.txt").write_text(str(i))
    spec = jobs.JobSpec(name="backlog", topic=str(source), operator=lambda df: df, source_options={"files_per_trigger": 1}, sink="text", sink_options={"path": out}, poll_seconds=60)
    began = time.time()
    query = jobs.start_job(spark, spec)
    try:
        while sum(p["numInputRows"] for p in query.recentProgress) < 6 and time.time() - began < 50:
            time.sleep(0.2)
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == 6
    finally:
        query.stop()
    assert sorted(r.value for r in spark.read.text(out).collect()) == list("012345")


def test_dwell_state_keeps_null_keys_apart(spark, tmp_path):
    spec = dwell_job(tmp_path)
    rows = [(i, BASE + 10 * i, "u", None if i % 2 else 1, 1, "AB"[i // 2 % 2], "ip", "", 0) for i in range(12)]
    df = spark.createDataFrame(rows, TRAFFIC)
    for step in range(2):
        write_json(df.filter(F.floor(F.col("event_id") / 6) == step), str(tmp_path / "in"), step)
        jobs.drain(jobs.start_job(spark, spec))
    columns = ["event_id", "plat", "website", "sign", "view_time"]
    got = spark.read.parquet(spec.sink_options["path"]).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, dwell.dwell_rows(df).select(*columns).collect()))
    assert got.filter("plat IS NULL").count() == 5


def test_first_seen_comes_from_the_first_batch_that_has_it(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    schema = "k string, visit_id string, event_id long, ts timestamp"
    spec = jobs.JobSpec(
        name="first", topic=f"{source}/step-*", source="json", source_options={"schema": schema},
        operator=lambda df: state.first_seen_stream(df, ["k"]), sink="parquet", sink_options={"path": out}, until_drained=True,
    )
    for step, rows in enumerate([[(5, 900), (9, 100)], [(1, 50), (2, 60)]]):
        df = spark.createDataFrame([("a", "u", i, t) for i, t in rows], "k string, visit_id string, event_id long, t long")
        write_json(df.select("k", "visit_id", "event_id", F.timestamp_seconds("t").alias("ts")).coalesce(1), str(source), step)
        jobs.drain(jobs.start_job(spark, spec))
    assert [r.event_id for r in spark.read.parquet(out).collect()] == [9]


def test_late_rows_come_out_apart(spark, tmp_path):
    """A slot takes rows until the watermark is an hour past it; what comes after is late, and nothing is lost."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    branches = {name: jobs.Branch(where, "parquet", {"path": f"{out}/{name}"}) for name, where in (("taken", "NOT late"), ("late", "late"))}
    spec = replace(
        dwell_job(tmp_path), operator=lambda df: state.dwell_stream(df, delay="10 minutes", buckets=3, outcomes=True),
        sink=None, sink_options={}, branches=branches,
    )
    # BASE begins a slot: it takes rows until the watermark is 5400 seconds after it.
    arrivals = [
        [(0, "A", 0), (1, "B", 100), (2, "B", 100), (3, "B", 100)],
        [(4, "A", 5400 + 599)],  # watermark 5399 from here on
        [(5, "B", 160), (6, "A", 5400 + 600)],  # still taken; watermark 5400
        [(7, "B", 200), (8, "B", 1799), (9, "C", 1800), (10, "C", 6100)],
    ]
    for step, rows in enumerate(arrivals):
        write_json(events(spark, rows).coalesce(1), source, step)
        jobs.drain(jobs.start_job(spark, spec))
    late = spark.read.parquet(f"{out}/late")
    assert sorted((r.event_id, r.sign - BASE, r.view_time, r.n) for r in late.collect()) == [(7, 200, None, 1), (8, 1799, None, 1)]
    taken = {r.event_id: (r.website, r.view_time, r.n) for r in spark.read.parquet(f"{out}/taken").collect()}
    # 1 stands for 2 also, as 3 is the last of the three rows of that second.
    assert taken == {0: ("A", 0, 1), 1: ("A", 100, 2), 3: ("B", 0, 1), 4: ("A", 0, 1), 5: ("B", 60, 1), 6: ("A", 1, 1), 9: ("C", 0, 1), 10: ("A", 100, 1)}
    assert sum(n for *_, n in taken.values()) + late.count() == sum(map(len, arrivals))


def test_merged_rows_are_counted(spark):
    df = spark.createDataFrame([("a", i, 1) for i in range(50)] + [("b", 99, 1)], "k string, i long, n long").coalesce(1)
    assert sorted(tuple(r) for r in state.merge_repeats(df, ["k"], "i", count="n").collect()) == [("a", 0, 50), ("b", 99, 1)]
    assert sorted(tuple(r) for r in state.merge_repeats(df, ["k"], "i", ends=True, count="n").collect()) == [("a", 0, 49), ("a", 49, 1), ("b", 99, 1)]


def state_rows(query):
    return max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])


def test_many_visits_share_a_page_of_state(spark, tmp_path):
    """State does not grow by one value a visit, and views come back from it."""
    spec = replace(dwell_job(tmp_path), operator=lambda df: state.dwell_stream(df, buckets=1))
    rows = [(1000 * step + i, BASE + 60 * step + i // 100, f"u{i}", 1, 1, "AB"[step], "ip", "", 0) for step in range(2) for i in range(300)]
    df = spark.createDataFrame(rows, TRAFFIC)
    for step in range(2):
        write_json(df.filter(F.floor(F.col("event_id") / 1000) == step), str(tmp_path / "in"), step)
        query = jobs.start_job(spark, spec)
        jobs.drain(query)
        assert 0 < state_rows(query) <= state.PAGES
    columns = ["event_id", "visit_id", "website", "sign", "view_time"]
    got = spark.read.parquet(spec.sink_options["path"]).select(*columns)
    assert got.count() == 300
    assert sorted(map(str, got.collect())) == sorted(map(str, dwell.dwell_rows(df).select(*columns).collect()))


def test_packed_rows_keep_keys_and_values(spark, monkeypatch):
    monkeypatch.setattr(packing, "PACK_ROWS", 4)
    rows = [("a", 1, "x"), (None, 2, None), ("a", 3, None), ("b", None, "y"), (None, 5, "z"), ("a", 6, "w")]
    df = spark.createDataFrame(rows, "k string, v long, s string").coalesce(1)
    packed = packing.pack_rows(df, ["k"]).collect()
    back = [(row.k, *values) for row in packed for values in packing.unpacked([row], 1)]
    assert sorted(back, key=str) == sorted(rows, key=str)
    assert max(len(row.v) for row in packed) > 1
    assert [v for k, v, _ in back if k == "a"] == [1, 3, 6]
