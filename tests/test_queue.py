"""The queue of batches: order, positions, restarts, and what is missing."""

import json
import os
import shutil
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException

from tidemark.sources import batch_queue as bq
from tidemark.streaming import jobs


def put(spark, path, key, values, files=1):
    return bq.enqueue(spark.createDataFrame([(v,) for v in values], "value string").repartition(files), path, key)


def queue_job(tmp_path, **options):
    return jobs.JobSpec(
        name="queue-test", topic=str(tmp_path / "queue"), source="queue", source_options={"consumer": "test", **options},
        operator=lambda df: df, sink="parquet", sink_options={"path": str(tmp_path / "out")}, until_drained=True,
    )


def stored(spark, spec):
    """(micro-batch, key, value) of what the job has stored."""
    rows = spark.read.schema("value string, batch_key string, batch_number long, batch_id long").parquet(spec.sink_options["path"])
    return sorted((r.batch_id, r.batch_key, r.value) for r in rows.collect())


def test_batches_come_whole_and_in_the_order_of_the_index(spark, tmp_path):
    spec = queue_job(tmp_path)
    assert [put(spark, spec.topic, key, [f"{key}{i}" for i in range(4)], files=3) for key in ("z", "a", "m")] == [0, 1, 2]
    index = {r.number: (r.key, len(r.files)) for r in bq.queue_index(spark, spec.topic).collect()}
    assert {n: key for n, (key, _) in index.items()} == {0: "z", 1: "a", 2: "m"} and all(files > 1 for _, files in index.values())
    jobs.drain_queue(spark, spec)
    assert stored(spark, spec) == [(n, key, f"{key}{i}") for n, key in enumerate("zam") for i in range(4)]
    assert (bq.get_position(spark, spec.topic, "test"), bq.pending(spark, spec.topic, "test"), bq.pending(spark, spec.topic, "other")) == (3, 0, 3)
    # Nothing new: a restart hands out nothing.
    jobs.drain_queue(spark, spec)
    assert len(stored(spark, spec)) == 12


def test_a_consumer_is_set_back_and_on(spark, tmp_path):
    spec = queue_job(tmp_path)
    for key in "abcde":
        put(spark, spec.topic, key, [key])
    jobs.drain(jobs.start_job(spark, spec))
    jobs.drain(jobs.start_job(spark, spec))
    assert bq.get_position(spark, spec.topic, "test") == 2
    bq.set_position(spark, spec.topic, "test", 1)
    assert bq.get_position(spark, spec.topic, "test") == 1
    jobs.drain(jobs.start_job(spark, spec))
    bq.set_position(spark, spec.topic, "test", 4)
    jobs.drain_queue(spark, spec)
    assert [key for _, key, _ in stored(spark, spec)] == ["a", "b", "b", "e"]
    # Behind the end, it waits for the batch of that number.
    bq.set_position(spark, spec.topic, "test", 6)
    for key in "fg":
        put(spark, spec.topic, key, [key])
    jobs.drain_queue(spark, spec)
    assert [key for _, key, _ in stored(spark, spec)] == ["a", "b", "b", "e", "g"]
    with pytest.raises(ValueError):
        bq.set_position(spark, spec.topic, "test", -1)


def test_a_micro_batch_that_failed_is_repeated_before_a_new_position(spark, tmp_path):
    spec = queue_job(tmp_path)
    for key in "abc":
        put(spark, spec.topic, key, [key])
    jobs.drain(jobs.start_job(spark, spec))

    def fail(df):
        from pyspark.sql import functions as F

        return df.withColumn("value", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(StreamingQueryException):
        jobs.drain(jobs.start_job(spark, replace(spec, operator=fail)))
    # Batch b was handed out and not stored, so it comes before what is asked for.
    bq.set_position(spark, spec.topic, "test", 0)
    for _ in range(3):
        jobs.drain(jobs.start_job(spark, spec))
    assert [key for _, key, _ in stored(spark, spec)][:3] == ["a", "b", "a"]


def test_two_consumers_keep_their_own_positions(spark, tmp_path):
    one, other = queue_job(tmp_path / "1", batches_per_trigger=0), queue_job(tmp_path / "2", batches_per_trigger=2)
    one, other = (replace(s, topic=str(tmp_path / "queue"), source_options={**s.source_options, "consumer": c}) for s, c in ((one, "one"), (other, "other")))
    for key in "abc":
        put(spark, one.topic, key, [key])
    jobs.drain(jobs.start_job(spark, one))
    jobs.drain(jobs.start_job(spark, other))
    assert [n for n, *_ in stored(spark, one)] == [0, 0, 0] and [key for _, key, _ in stored(spark, other)] == ["a", "b"]
    assert (bq.get_position(spark, one.topic, "one"), bq.get_position(spark, one.topic, "other")) == (3, 2)
    assert bq.get_position(spark, one.topic, "other", committed=True) <= 2


def test_empty_index_and_empty_batches(spark, tmp_path):
    spec = queue_job(tmp_path)
    os.makedirs(spec.topic)
    jobs.drain_queue(spark, spec)
    assert stored(spark, spec) == []
    assert bq.queue_length(spark, spec.topic) == 0
    put(spark, spec.topic, "none", [])
    put(spark, spec.topic, "some", ["x"])
    jobs.drain_queue(spark, spec)
    assert [key for _, key, _ in stored(spark, spec)] == ["some"]


def test_a_vanished_batch_fails_or_is_passed_over(spark, tmp_path):
    spec = queue_job(tmp_path)
    for key in "abc":
        put(spark, spec.topic, key, [key])
    shutil.rmtree(os.path.join(spec.topic, "batches", "b"))
    jobs.drain(jobs.start_job(spark, spec))
    with pytest.raises(StreamingQueryException, match="is gone"):
        jobs.drain(jobs.start_job(spark, spec))
    jobs.drain_queue(spark, replace(spec, source_options={**spec.source_options, "missing": "skip"}))
    assert [key for _, key, _ in stored(spark, spec)] == ["a", "c"]
    with pytest.raises(ValueError):
        bq.queue_batches(spark, spec.topic, "test", missing="no")


def test_keys_and_entries(spark, tmp_path):
    path = str(tmp_path / "queue")
    put(spark, path, "a", ["1"])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        put(spark, path, "a", ["2"])
    # Entries lie in folders of a bounded number, and their numbers go on over them.
    files = bq.QueueFiles(path)
    for number in range(1, 2 * bq.FOLDER_ENTRIES):
        name = bq._entry_path(number)
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        with open(f"{path}/{name}", "w") as file:
            json.dump({"number": number, "key": f"k{number}", "files": []}, file)
    assert files.length() == 2 * bq.FOLDER_ENTRIES and len(files.names("index")) == 2
    assert put(spark, path, "last", ["3"]) == 2 * bq.FOLDER_ENTRIES
    with pytest.raises(ValueError):
        bq.Consumer(files, "a/b")
