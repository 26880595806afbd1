"""One stream to several sinks."""

import json
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.streaming import jobs


def write(spark, path, step, values):
    spark.createDataFrame([(v,) for v in values], "n long").write.json(f"{path}/step-{step}")


def branch_job(tmp_path, log, operator=lambda df: df):
    out = str(tmp_path / "out")

    def send(payload):
        with open(log, "a") as file:
            file.write(payload + "\n")
        return json.dumps({"success": True})

    branches = {
        "low": jobs.Branch("n < 10", "parquet", {"path": f"{out}/low"}),
        "even": jobs.Branch(F.col("n") % 2 == 0, "parquet", {"path": f"{out}/even"}),
        "sent": jobs.Branch("n >= 100", "deliver", {"path": f"{out}/sent", "send": send, "payload": "branch"}),
    }
    return jobs.JobSpec(
        name="branches", topic=str(tmp_path / "in" / "step-*"), source="json", source_options={"schema": "n long"},
        operator=lambda df: operator(df).withColumn("branch", F.col("n").cast("string")), branches=branches, until_drained=True,
    )


def numbers(spark, path):
    return sorted(r.n for r in spark.read.parquet(path).collect())


def test_rows_go_to_every_branch_they_belong_to(spark, tmp_path):
    log = str(tmp_path / "log")
    spec = branch_job(tmp_path, log)
    for step, values in enumerate([[1, 2, 101, None], [4, 11, 12, 100]]):
        write(spark, str(tmp_path / "in"), step, values)
        jobs.drain(jobs.start_job(spark, spec))
    out = str(tmp_path / "out")
    assert (numbers(spark, f"{out}/low"), numbers(spark, f"{out}/even")) == ([1, 2, 4], [2, 4, 12, 100])
    # Columns come to the sinks as they are, also one that is called as the tag is.
    assert {r.branch for r in spark.read.parquet(f"{out}/low").collect()} == {"1", "2", "4"}
    assert sorted(open(log).read().split()) == ["100", "101"]


def test_a_retry_repeats_only_the_branches_that_miss_their_part(spark, tmp_path, monkeypatch):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    # Drawn anew, the numbers would differ between a branch and its retry.
    spec = branch_job(tmp_path, log, lambda df: df.withColumn("draw", F.uuid()))
    write(spark, str(tmp_path / "in"), 0, [2, 4, 100])
    calls = []
    parquet = jobs.SINKS["parquet"]

    def flaky(rows, batch_id, path):
        calls.append(path.rpartition("/")[2])
        if path.endswith("even") and calls.count("even") == 1:
            raise OSError("no space")
        parquet(rows, batch_id, path)

    monkeypatch.setitem(jobs.SINKS, "parquet", flaky)
    with pytest.raises(StreamingQueryException, match="even"):
        jobs.drain(jobs.start_job(spark, spec))
    # The other branches have had their rows all the same.
    assert numbers(spark, f"{out}/low") == [2, 4] and open(log).read().split() == ["100"]
    jobs.drain(jobs.start_job(spark, spec))
    assert calls == ["even", "low", "even"] and open(log).read().split() == ["100"]
    assert numbers(spark, f"{out}/even") == [2, 4, 100]
    drawn = {path: {r.n: r.draw for r in spark.read.parquet(f"{out}/{path}").collect()} for path in ("low", "even")}
    assert all(drawn["even"][n] == draw for n, draw in drawn["low"].items())


def test_branches_are_checked(spark, tmp_path):
    spec = branch_job(tmp_path, "")
    one = spec.branches["low"]
    for bad in (replace(spec, sink="text"), replace(spec, branches={"x": replace(one, sink="tape")}), replace(spec, branches={"a/b": one})):
        with pytest.raises(ValueError):
            jobs.validate(bad)
    jobs.validate(spec)
