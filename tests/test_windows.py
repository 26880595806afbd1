"""User code over key and window, mergeable partial rows, and iteration over a stream."""

import random
import sys
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.operators.iterate import pair_start, pair_steps
from tidemark.sinks import partials
from tidemark.storage import names
from tidemark.streaming import jobs, loops, windows

# The functions below run in the workers, which do not know this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS = "k string, t long, v long"


def feed(spark, tmp_path, spec, steps, schema=ROWS):
    for step, rows in enumerate(steps):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{tmp_path}/in/step-{step}")
        jobs.drain(jobs.start_job(spark, spec))


def window_job(tmp_path, operator):
    return jobs.JobSpec(
        name="windows", topic=str(tmp_path / "in" / "step-*"), source="json", source_options={"schema": ROWS},
        operator=lambda df: operator(df.withColumn("ts", F.timestamp_seconds("t"))), sink="parquet", sink_options={"path": str(tmp_path / "out")},
        until_drained=True, parallelism=2,
    )


def told(key, window, values):
    """Every value, and the greatest number of rows handed over at once."""
    parts = [[(row.t, row.v) for row in part] for part in values]
    return [(str(sorted(x for part in parts for x in part)), max(map(len, parts)))]


TOLD = "seen string, largest int"


def results(spark, tmp_path):
    return spark.read.parquet(str(tmp_path / "out")).collect()


def test_tumbling_windows_of_a_hot_key(spark, tmp_path):
    """Two thirds of the rows have one key; its windows come in parts of bounded size, and nothing is lost."""
    rng = random.Random(8)
    rows = [("hot" if i % 3 else rng.choice(["a", None]), i // 10, i) for i in range(3000)]
    spec = window_job(tmp_path, lambda df: windows.apply_tumbling(df, ["k"], "ts", 100, told, TOLD, delay="20 seconds", part_rows=64))
    late = [("hot", 5, -1), ("a", 250, -2)]  # the watermark is 299 - 20: the first window is gone, the last is open
    feed(spark, tmp_path, spec, [rows[:1000], rows[1000:], late, [("end", 1000, 0)]])
    want = defaultdict(list)
    for k, t, v in [*rows, late[1]]:
        want[k, t // 100 * 100].append((t, v))
    got = {(r.k, r.window_start): r for r in results(spark, tmp_path)}
    assert {key: r.seen for key, r in got.items()} == {key: str(sorted(values)) for key, values in want.items()}
    assert all(r.window_end == r.window_start + 100 and r.largest <= 64 for r in got.values())
    assert max(r.largest for r in got.values()) == 64


def test_a_window_can_be_dealt_into_parts(spark, tmp_path):
    rows = [("hot", i % 100, i) for i in range(2000)]
    spec = window_job(tmp_path, lambda df: windows.apply_tumbling(df, ["k"], "ts", 100, told, TOLD, parts=4))
    feed(spark, tmp_path, spec, [rows, [("end", 2000, 0)]])
    seen = [eval(r.seen) for r in results(spark, tmp_path) if r.k == "hot"]
    assert len(seen) == 4 and min(map(len, seen)) > 300
    assert sorted(x for part in seen for x in part) == sorted((t, v) for _, t, v in rows)


def test_sessions_join_and_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(windows, "STATE_ROWS", 3)
    spec = window_job(tmp_path, lambda df: windows.apply_sessions(df, ["k"], "ts", 10, told, TOLD, delay="30 seconds", part_rows=7))
    steps = [
        [("a", 0, 1), ("a", 9, 2), ("a", 30, 3), ("b", 5, 4), (None, 7, 5)],
        [("a", 20, 6), ("a", 19, 7), ("hot", 40, 0)],  # 19 joins 9, and 20 joins that to 30
        [("hot", 40 + i // 40, i) for i in range(1, 200)] + [("a", 90, 8)],
        [("a", 1, 9), ("a", 88, 10)],  # watermark 60: the first would make a session that is past
        [("end", 500, 0)],
    ]
    feed(spark, tmp_path, spec, steps)
    got = {(r.k, r.window_start): (r.window_end, eval(r.seen), r.largest) for r in results(spark, tmp_path)}
    assert got.pop(("hot", 40))[:2] == (54, [(40 + i // 40, i) for i in range(200)])
    assert got == {
        ("a", 0): (40, [(0, 1), (9, 2), (19, 7), (20, 6), (30, 3)], 5),
        ("a", 88): (100, [(88, 10), (90, 8)], 2),
        ("b", 5): (15, [(5, 4)], 1),
        (None, 7): (17, [(7, 5)], 1),
    }


def state_rows(query):
    return max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])


def test_the_rows_of_a_window_are_kept_in_chunks(spark, tmp_path):
    spec = window_job(tmp_path, lambda df: windows.apply_tumbling(df, ["k"], "ts", 100, told, TOLD))
    rows = [("hot", i % 100, i) for i in range(1000)]
    spark.createDataFrame(rows, ROWS).coalesce(1).write.json(f"{tmp_path}/in/step-0")
    query = jobs.start_job(spark, spec)
    jobs.drain(query)
    assert state_rows(query) <= 5  # two chunks, their number and the timer, not 1,000 rows
    spark.createDataFrame([("end", 5000, 0)], ROWS).write.json(f"{tmp_path}/in/step-1")
    jobs.drain(jobs.start_job(spark, spec))
    (row,) = [r for r in results(spark, tmp_path) if r.k == "hot"]
    assert eval(row.seen) == sorted((t, v) for _, t, v in rows)


def test_many_keys_share_the_state_of_their_sessions(spark, tmp_path):
    """One state and one timer for all keys; null and equal-looking keys stay apart."""
    rows = [(f"u{i % 100}", i // 100 * 5 + (500 if i >= 200 else 0), i) for i in range(400)] + [(None, 0, 1000), ("", 0, 1001), ("null", 0, 1002)]
    spec = window_job(tmp_path, lambda df: windows.apply_sessions(df, ["k"], "ts", 10, told, TOLD, delay="30 seconds", buckets=1))
    spark.createDataFrame(rows, ROWS).coalesce(1).write.json(f"{tmp_path}/in/step-0")
    query = jobs.start_job(spark, spec)
    jobs.drain(query)
    timers = [p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress if p["stateOperators"]]
    assert max(timers) == 1
    spark.createDataFrame([("end", 5000, 0)], ROWS).write.json(f"{tmp_path}/in/step-1")
    jobs.drain(jobs.start_job(spark, spec))
    want = defaultdict(list)
    for k, t, v in rows:
        want[k, t >= 500].append((t, v))
    got = [(r.k, r.window_start >= 500, r.seen) for r in results(spark, tmp_path) if r.k != "end"]
    assert sorted(got, key=str) == sorted(((k, late, str(sorted(x))) for (k, late), x in want.items()), key=str)


# --- partial rows -------------------------------------------------------------------------


def days_of(spark, rows):
    return spark.createDataFrame(rows, "day string, page string, user long").withColumn("day", F.to_date("day"))


def test_partial_rows_merge_on_read(spark, tmp_path):
    path, keys = str(tmp_path / "partials"), ["page"]
    write = lambda rows, batch: partials.write_partials(days_of(spark, rows), path, batch, keys, {"users": "user"}, day="day")
    read = lambda *by: {tuple(r[c] for c in by): (r.n_rows, r.users) for r in partials.read_partials(spark, path, by, ["users"], day="day").withColumn("day", F.lit(None) if "day" not in by else F.col("day").cast("string")).collect()}
    rows = [(f"2024-01-0{1 + i % 5}", "ab"[i % 2], i % 30) for i in range(300)]
    write(rows[:150], 0)
    write(rows[150:], 1)
    write(rows[150:], 1)  # a retry
    want = defaultdict(list)
    for day, page, user in rows:
        want[day, page].append(user)
    exact = {key: (len(users), len(set(users))) for key, users in want.items()}
    assert read("day", "page") == exact
    # Coarser keys are a read of the same rows.
    assert read("page") == {(p,): (150, len({u for (_, q), us in want.items() if q == p for u in us})) for p in "ab"}
    assert partials.fold_days(spark, path, 1, keys, ["users"], day="day") == "2024-01-03"
    assert read("day", "page") == exact
    # Late rows of a folded day are added; a second fold takes them up, and removes what the first holds.
    write([("2024-01-01", "a", 999), ("2024-01-07", "c", 1)], 2)
    exact["2024-01-01", "a"] = (exact["2024-01-01", "a"][0] + 1, exact["2024-01-01", "a"][1] + 1)
    exact["2024-01-07", "c"] = (1, 1)
    assert read("day", "page") == exact
    assert partials.fold_days(spark, path, 2, keys, ["users"], day="day") == "2024-01-05"
    assert read("day", "page") == exact
    assert [d for d in names(spark, f"{path}/batch_id=0") if d.startswith("day=")] == ["day=2024-01-04", "day=2024-01-05"]
    assert partials.fold_days(spark, path, 2, keys, ["users"], day="day") == "2024-01-05"  # nothing new
    assert len(partials._folds(spark, path)) == 2


def test_sketches_stay_within_their_error(spark, tmp_path):
    path = str(tmp_path / "partials")
    for batch in range(4):
        rows = spark.range(batch * 40_000, batch * 40_000 + 60_000).select(F.lit("2024-01-01").cast("date").alias("day"), F.lit("a").alias("page"), F.col("id").alias("user"))
        partials.write_partials(rows, path, batch, ["page"], {"users": "user"}, day="day")
    (r,) = partials.read_partials(spark, path, ["page"], ["users"], day="day").collect()
    assert r.n_rows == 240_000 and abs(r.users - 180_000) < 4 * 0.8 / 2 ** (partials.LG_K / 2) * 180_000


# --- iteration ----------------------------------------------------------------------------


def plain_steps(a, b):
    x, y, n = a, b, 0
    while n == 0 or (x < 100 and y < 100):
        x, y, n = y, x + y, n + 1
    return n


def iterate_job(tmp_path, **options):
    return jobs.JobSpec(
        name="iterate", topic=str(tmp_path / "in" / "step-*"), source="json", source_options={"schema": "a long, b long"},
        operator=pair_start, sink="iterate", sink_options={"path": str(tmp_path / "out"), **pair_steps(), **options}, until_drained=True,
    )


PAIRS = [(a, b) for a in range(1, 8) for b in range(1, 8)] + [(99, 1), (100, 100), (None, 3)]


def test_pairs_iterate_over_batches(spark, tmp_path):
    path = str(tmp_path / "out")
    spec = iterate_job(tmp_path, steps_per_batch=2, timeout_ms=3_600_000)
    feed(spark, tmp_path, spec, [PAIRS[:20], PAIRS[20:], [(1, 1)]], "a long, b long")
    assert loops.pending_rows(spark, path) > 0
    came = loops.read_iterated(spark, path).count()
    loops.finish_pending(spark, path, timeout_ms=3_600_000, steps_per_round=3, **pair_steps())
    loops.finish_pending(spark, path, timeout_ms=3_600_000, steps_per_round=3, **pair_steps())
    assert loops.pending_rows(spark, path) == 0
    rows = loops.read_iterated(spark, path).collect()
    assert len(rows) > came
    want = sorted((a or 0, b, 1 if a is None else plain_steps(a, b)) for a, b in [*PAIRS, (1, 1)])
    assert sorted((r.a or 0, r.b, r.n) for r in rows) == want and not any(r.expired for r in rows)
    # The stream goes on: what was finished apart does not come again.
    feed(spark, tmp_path, replace(spec, topic=str(tmp_path / "more" / "in" / "step-*"), checkpoint=None), [], "a long, b long")
    spark.createDataFrame([(5, 5)], "a long, b long").write.json(f"{tmp_path}/in/step-9")
    jobs.drain(jobs.start_job(spark, spec))
    assert loops.read_iterated(spark, path).count() + loops.pending_rows(spark, path) == len(rows) + 1


def test_rows_out_of_time_come_out_marked(spark, tmp_path):
    path = str(tmp_path / "out")
    spec = iterate_job(tmp_path, steps_per_batch=4, timeout_ms=0)
    feed(spark, tmp_path, spec, [PAIRS], "a long, b long")
    rows = loops.read_iterated(spark, path).collect()
    assert loops.pending_rows(spark, path) == 0 and len(rows) == len(PAIRS)
    for r in rows:
        n = 1 if r.a is None else plain_steps(r.a, r.b)
        assert (r.n, r.expired) == ((n, False) if n <= 4 else (4, True))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        loops.read_iterated(spark, str(tmp_path / "nothing"))
    loops.finish_pending(spark, str(tmp_path / "nothing"), **pair_steps())


def test_a_retried_batch_repeats_itself(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = pair_start(spark.createDataFrame(PAIRS[:30], "a long, b long"))
    some = lambda lo, hi: rows.filter((F.col("a") >= lo) & (F.col("a") < hi))
    for batch, part in ((0, some(1, 3)), (1, some(3, 4)), (1, some(3, 4)), (2, some(4, 6)), (2, some(4, 6))):
        loops.iterate_batch(part, batch, path, steps_per_batch=3, timeout_ms=3_600_000, **pair_steps())
    loops.finish_pending(spark, path, timeout_ms=3_600_000, **pair_steps())
    got = sorted((r.a, r.b, r.n) for r in loops.read_iterated(spark, path).collect())
    assert got == sorted((a, b, plain_steps(a, b)) for a, b in PAIRS[:30] if a < 6)
