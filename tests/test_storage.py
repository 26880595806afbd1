"""Sinks, stored tables and delivery."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.plans.storing import details
from tidemark.sinks import changelog, delivery, files, keyed, mutable


def test_fact_table_layout(spark, sf, tmp_path):
    path = str(tmp_path / "facts")
    files.write_fact_table(details(spark, sf), path)
    back = spark.read.parquet(path)
    assert back.count() == details(spark, sf).count()
    assert {d for d in os.listdir(path) if d.startswith("add_month=")} == {"add_month=2024-01-01"}
    found = back.filter((F.col("add_month") == "2024-01-01") & (F.col("plat") == 1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(add_month" in plan and "EqualTo(plat,1)" in plan


def test_rows_per_file(spark, sf, tmp_path):
    path = str(tmp_path / "pieces")
    files.write_fact_table(details(spark, sf), path, rows_per_file=files.INSERT_ROWS)
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    assert sizes.agg(F.max("count")).first()[0] <= 50


def test_a_retried_batch_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "stamped")
    rows = spark.range(10).select("id", F.lit(1).alias("plat"), F.col("id").alias("req_time"), F.lit(1).alias("agent_type")).withColumnRenamed("id", "n")
    for batch in (0, 1, 1):
        assert files.write_stamped(rows, path, batch) is rows
    assert spark.read.parquet(path).count() == 20


def test_mutations_rewrite_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(40).select("id", F.concat(F.lit("m"), F.col("id") % 4).alias("add_month"))
    df.write.partitionBy("add_month").parquet(path)
    whole = len(os.listdir(f"{path}/add_month=m0"))
    assert 2 * mutable.delete_from(spark, path, F.col("add_month") == "m0") == whole  # each file has a checksum file
    assert mutable.delete_from(spark, path, F.col("id") == 1) == 1
    assert mutable.update_table(spark, path, F.col("id") == 2, {"id": "id + 100"}) == 1
    assert mutable.delete_from(spark, path, F.col("id") == 12345) == 0
    rows = {r.id for r in mutable.read_table(spark, path).collect()}
    assert rows == {i for i in range(40) if i % 4 and i != 1 and i != 2} | {102}
    assert len(changelog.changes_of(spark, path)) == 3
    with pytest.raises(ValueError):
        mutable.update_table(spark, path, F.lit(True), {"add_month": "'x'"})


def test_keyed_table_keeps_the_newest_row(spark, tmp_path):
    path = str(tmp_path / "keyed")
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, o int, v string")
    second = spark.createDataFrame([("a", 0, "new")], "k string, o int, v string")
    for batch, df in ((0, first), (1, second), (1, second)):
        keyed.upsert(df, path, batch, ["k"], ["o"])
    assert sorted(tuple(r) for r in keyed.read_latest(spark, path, ["k"]).collect()) == [("a", 0, "new"), ("b", 1, "z")]
    third = spark.createDataFrame([("b", 5, "later")], "k string, o int, v string")
    keyed.upsert(third, path, 2, ["k"], ["o"])
    keyed.compact(spark, path, ["k"], 1)
    assert sorted(tuple(r) for r in keyed.read_latest(spark, path, ["k"], 1).collect()) == [("a", 0, "new"), ("b", 1, "z")]
    assert sorted(tuple(r) for r in keyed.read_latest(spark, path, ["k"]).collect()) == [("a", 0, "new"), ("b", 5, "later")]
    files_read = keyed.read_latest(spark, path, ["k"]).inputFiles()
    assert files_read and not any("batch_id=0" in f or "batch_id=1" in f for f in files_read)  # folded batches are not listed


def test_text_and_print(spark, tmp_path, capsys):
    path = str(tmp_path / "text")
    files.write_text(spark.range(3), path, "id")
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["0", "1", "2"]
    assert files.print_rows(spark.range(1)) is None
    assert "id" in capsys.readouterr().out


def test_jdbc_options():
    assert files.jdbc_options("jdbc:x", "t", user="u") == {"url": "jdbc:x", "dbtable": "t", "batchsize": "50", "user": "u"}


@pytest.mark.parametrize(
    "reply, ok", [('{"success": 1}', True), ('{"success": 0}', False), ("[1]", False), ("oops", False), (None, False), ("{}", False)]
)
def test_success_reply(reply, ok):
    assert delivery.is_success(reply, "success") is ok


def test_delivery_attempts(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def send(payload):
        calls = log / payload
        n = len(calls.read_text()) if calls.exists() else 0
        calls.write_text("x" * (n + 1))
        if payload == "broken":
            raise OSError("no route")
        return json.dumps({"res": payload == "good" or (payload == "slow" and n == 1)})

    df = spark.createDataFrame([("good",), ("slow",), ("never",), ("broken",)], "payload string")
    out = str(tmp_path / "out")
    delivery.deliver(df, send, field=delivery.ANALYSIS_FIELD).write.parquet(out)
    got = {r.payload: (r.attempts, r.ok) for r in spark.read.parquet(out).collect()}
    assert got == {"good": (1, True), "slow": (2, True), "never": (3, False), "broken": (3, False)}
    assert {p.name: len(p.read_text()) for p in log.iterdir()} == {"good": 1, "slow": 2, "never": 3, "broken": 3}
    assert delivery.dead_letters(spark.read.parquet(out)).count() == 2


def test_working_area_is_the_configured_one(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert session.new_path(spark, "x").startswith(base.rstrip("/"))
    assert session.new_path(spark, "x") != session.new_path(spark, "x")


def test_mutations_reach_every_partition(spark, tmp_path):
    """NULL partitions, and names that a path must escape."""
    path = str(tmp_path / "odd")
    rows = [(i, m) for i, m in enumerate([None, "a/b", "x:y", "p=q", " ", "%"] * 3)]
    spark.createDataFrame(rows, "id long, add_month string").write.partitionBy("add_month").parquet(path)
    for i in (0, 1, 2, 3):
        assert mutable.delete_from(spark, path, F.col("id") == i) == 1
    mutable.delete_from(spark, path, F.col("add_month").isin("a/b", "x:y") | F.col("add_month").isNull())
    mutable.update_table(spark, path, F.col("add_month") == "p=q", {"id": "id + 100"})
    got = {(r.id, r.add_month) for r in mutable.read_table(spark, path).collect()}
    assert got == {(i + 100 * (m == "p=q"), m) for i, m in rows if m in ("p=q", " ", "%") and i > 3}
    mutable.delete_from(spark, path, F.lit(True))
    assert mutable.read_table(spark, path).count() == 0


def test_a_streamed_table_takes_changes_and_more_batches(spark, tmp_path):
    path = str(tmp_path / "streamed")
    rows = spark.range(10).select(F.col("id").alias("n"), F.lit(1).alias("plat"), F.col("id").alias("req_time"), F.lit(1).alias("agent_type"))
    for batch in (0, 1):
        files.write_stamped(rows, path, batch)
    mutable.delete_from(spark, path, F.col("n") == 3)
    mutable.update_table(spark, path, F.col("n") == 4, {"req_time": "req_time * 2 + 1"})
    files.write_stamped(rows, path, 2)
    got = sorted((r.n, r.req_time) for r in mutable.read_table(spark, path).collect())
    assert got == sorted([(n, n) for n in range(10)] + 2 * [(n, 9 if n == 4 else n) for n in range(10) if n != 3])


def test_a_change_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    spark.range(40).select("id", (F.col("id") % 2).alias("add_month")).write.partitionBy("add_month").parquet(path)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(changelog, "take_effect", fail)
        with pytest.raises(OSError):
            mutable.update_table(spark, path, F.col("id") < 5, {"id": "id * 2 + 100"}, change_id="once")
    assert sorted(r.id for r in mutable.read_table(spark, path).collect()) == list(range(40))
    for _ in range(3):  # tries after the first that took effect do nothing
        mutable.update_table(spark, path, F.col("id") < 5, {"id": "id * 2 + 100"}, change_id="once")
    assert sorted(r.id for r in mutable.read_table(spark, path).collect()) == [*range(5, 40), 100, 102, 104, 106, 108]


def test_changed_files_keep_the_storage_order(spark, sf, tmp_path):
    path = str(tmp_path / "facts")
    files.write_fact_table(details(spark, sf), path)
    mutable.update_table(spark, path, F.col("plat") == 1, {"req_time": "req_time - interval 5 days"})
    data = changelog.changes_of(spark, path)[0]["data"]
    order = ("plat", "req_time", "agent_type")
    for f in spark.read.parquet(data).inputFiles():
        keys = [tuple(r) for r in spark.read.parquet(f).select(*order).collect()]
        assert keys == sorted(keys)


def test_merged_batches_keep_their_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(4):
        rows = spark.range(batch * 10, batch * 10 + 10).selectExpr("id n", "cast(id % 2 as int) plat", "-id req_time", "1 agent_type")
        files.write_stamped(rows, path, batch)
    mutable.delete_from(spark, path, F.col("n") == 3)
    want = sorted(set(range(40)) - {3})
    stored = lambda: mutable.read_table(spark, path)
    assert mutable.merge_batches(spark, path, 2, change_id="night") > 0
    assert mutable.merge_batches(spark, path, 2, change_id="night") == 0
    assert sorted(r.n for r in stored().collect()) == want
    assert {r.batch_id for r in stored().collect()} == {None, 3}
    assert mutable.merge_batches(spark, path, 2) == 0  # nothing of these batches is left
    folded = next(c["data"] for c in changelog.changes_of(spark, path) if c["id"] == "night")
    merged = spark.read.parquet(folded).select("plat", "req_time", F.col("_metadata.file_path").alias("file")).collect()
    assert len(merged) == 29
    for name in {r.file for r in merged}:
        keys = [(r.plat, r.req_time) for r in merged if r.file == name]
        assert keys == sorted(keys)
    mutable.update_table(spark, path, F.col("n") >= 25, {"agent_type": "7"})
    mutable.merge_batches(spark, path, 3)
    assert sorted((r.n, r.agent_type) for r in stored().collect()) == [(i, 7 if i >= 25 else 1) for i in want]


def test_a_retried_batch_does_not_undo_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n long, v string")
    for batch in (0, 1):
        files.write_stamped(rows.withColumn("n", F.col("n") + 10 * batch), path, batch)
    mutable.delete_from(spark, path, F.col("n") == 1)
    mutable.update_table(spark, path, F.col("n") == 2, {"v": "'z'"})
    stored = lambda: sorted((r.n, r.v) for r in mutable.read_table(spark, path).collect())
    want = [(2, "z"), (3, "c"), (11, "a"), (12, "b"), (13, "c")]
    assert stored() == want
    # The retry has new file names, and other rows even.
    files.write_stamped(rows, path, 0)
    files.write_stamped(rows.withColumn("n", F.col("n") + 10), path, 1)  # not touched by a change: stored anew
    assert stored() == want
    assert changelog.settled(spark, path, 0) and not changelog.settled(spark, path, 1)
    mutable.merge_batches(spark, path, 1)
    files.write_stamped(rows, path, 1)
    assert stored() == want
    # A batch whose writer has not ended cannot be changed.
    files.write_stamped(rows, path, 2)
    os.remove(f"{path}/batch_id=2/_SUCCESS")
    with pytest.raises(RuntimeError, match="not complete"):
        mutable.delete_from(spark, path, F.col("n") == 3)
    assert stored() == sorted([*want, (1, "a"), (2, "b"), (3, "c")])


def test_many_changes_leave_reading_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(changelog, "FOLD", 5)
    spark.range(400).select("id", (F.col("id") % 4).alias("add_month")).repartition(4).write.partitionBy("add_month").parquet(path)
    plans, rows = [], {i: i for i in range(400)}
    for i in range(23):
        if i % 2:
            mutable.delete_from(spark, path, F.col("id") == 7 * i, change_id=f"c{i}")
            rows.pop(7 * i)
        else:
            mutable.update_table(spark, path, F.col("id") == 5 * i, {"id": "id + 1000"}, change_id=f"c{i}")
            rows[5 * i] += 1000
        plans.append(len(mutable.read_table(spark, path)._jdf.queryExecution().toString()))
    assert sorted(r.id for r in mutable.read_table(spark, path).collect()) == sorted(rows.values())
    assert max(plans) < 1.2 * plans[0]
    # The log is short, and knows all changes.
    assert len(changelog._entries(spark, path)) <= 2 * 5 and len(changelog._folds(spark, path)) <= 2
    assert changelog.manifest_of(spark, path).ids == {f"c{i}" for i in range(23)}
    assert mutable.delete_from(spark, path, F.lit(True), change_id="c0") == 0
    kinds = {r["kind"] for r in changelog.manifest_rows(spark, path).collect()}
    assert {"change", "replaced", "added"} <= kinds


def test_two_changes_at_once(spark, tmp_path, monkeypatch):
    """The later one of two that read the same state fails and changes nothing."""
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit(1).alias("add_month")).write.partitionBy("add_month").parquet(path)
    manifest = changelog.manifest_of(spark, path)
    mutable.delete_from(spark, path, F.col("id") == 1)
    with monkeypatch.context() as patched:
        patched.setattr(changelog, "manifest_of", lambda *_: manifest)
        with pytest.raises(RuntimeError, match="came first"):
            mutable.delete_from(spark, path, F.col("id") == 2)
    assert sorted(r.id for r in mutable.read_table(spark, path).collect()) == [0, *range(2, 10)]


def test_stamped_rows_may_have_any_columns(spark, tmp_path):
    path = str(tmp_path / "any")
    rows = spark.range(5).select((5 - F.col("id")).alias("n"), F.lit("x").alias("a column"))
    files.write_stamped(rows, path, 0)
    files.write_stamped(rows.coalesce(1), path, 1, order=["n"])
    back = spark.read.parquet(path)
    assert back.count() == 10 and {"n", "a column", "id", "add_date", "add_time", "update_time"} <= set(back.columns)
    assert [r.n for r in back.filter("batch_id = 1").collect()] == [1, 2, 3, 4, 5]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_and_folds_shuffle_the_batches_only(spark, tmp_path, monkeypatch):
    """With broadcasts off, the fold is joined by its buckets; NULL is a key like any other."""
    path, keys = str(tmp_path / "keyed"), ["k", "part"]
    schema = "k string, part int, o int, v string"
    batches = [
        [("a", 1, 1, "a0"), ("b", 1, 1, "b0"), (None, 1, 1, "n0"), ("c", None, 1, "c0"), (None, None, 1, "nn0")],
        [("a", 1, 0, "a1"), (None, 1, 0, "n1"), ("d", 1, 0, "d1")],
        [("b", 1, 5, "b2"), ("c", None, 5, "c2"), ("e", 2, 5, "e2")],
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for batch, rows in enumerate(batches):
            keyed.upsert(spark.createDataFrame(rows, schema), path, batch, keys, ["o"])
            if batch < 2:
                keyed.compact(spark, path, keys, batch, buckets=5)
        latest = keyed.read_latest(spark, path, keys)
        want = {("a", 1): "a1", ("b", 1): "b2", (None, 1): "n1", ("c", None): "c2", (None, None): "nn0", ("d", 1): "d1", ("e", 2): "e2"}
        assert {(r.k, r.part): r.v for r in latest.collect()} == want and latest.count() == len(want)
        before = keyed.read_latest(spark, path, keys, 1)
        assert {(r.k, r.part): r.v for r in before.collect()} == {**{key: v for key, v in want.items() if v[-1] != "2"}, ("b", 1): "b0", ("c", None): "c0"}
        assert "Exchange" not in plan_of(before)
        # The joined side of the fold has its buckets and no exchange above them.
        plain = spark.createDataFrame([(f"k{i}", i, 1, "x") for i in range(200)], schema)
        other = str(tmp_path / "it's plain")
        keyed.upsert(plain, other, 0, keys, ["o"])
        keyed.compact(spark, other, keys, 0, buckets=5)
        keyed.upsert(plain.limit(3), other, 1, keys, ["o"])
        plan = plan_of(keyed.read_latest(spark, other, keys))
        fold = plan.index("SelectedBucketsCount: 5 out of 5")
        above = plan[: fold].rsplit("FullOuter", 1)[1]
        assert "Exchange" not in above
        assert keyed.remove_folded(spark, path) == 2 and sorted(keyed.folds(spark, path)) == [1]
        assert {(r.k, r.part): r.v for r in keyed.read_latest(spark, path, keys).collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        keyed.read_latest(spark, str(tmp_path / "none"), keys)


def footers(spark, path):
    """(rows, pages of the first column, whether visit_id has a Bloom filter) of every row group."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in spark.read.parquet(path).inputFiles():
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(name), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        for block in reader.getFooter().getBlocks():
            columns = {c.getPath().toDotString(): c for c in block.getColumns()}
            index = reader.readOffsetIndex(columns["req_time"])
            firsts = [index.getFirstRowIndex(i) for i in range(index.getPageCount())]
            assert reader.readColumnIndex(columns["req_time"]) is not None
            yield block.getRowCount(), firsts, columns["visit_id"].getBloomFilterOffset() >= 0
        reader.close()


def rows_scanned(df):
    """Rows that the scans of a query give to the steps above them."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans, nodes = 0, [plan]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan parquet"):
            scans += node.metrics().get("numOutputRows").get().value()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
    return scans


def test_pages_and_filters_of_the_fact_table(spark, tmp_path):
    path = str(tmp_path / "facts")
    n = 100_000
    rows = spark.range(n).select(
        F.col("id").alias("req_time"), F.lit(1).alias("plat"), F.lit(1).alias("agent_type"), F.concat(F.lit("visit-"), F.xxhash64("id").cast("string")).alias("visit_id"),
        F.lit("2024-01-05").cast("date").alias("add_date"), F.rand(1).alias("x"),
    ).coalesce(1)
    files.write_fact_table(rows, path, cluster=False)
    found = list(footers(spark, path))
    assert sum(rows for rows, *_ in found) == n
    for rows_in_group, firsts, bloom in found:
        assert bloom and max(b - a for a, b in zip(firsts, [*firsts[1:], rows_in_group], strict=True)) <= files.PAGE_ROWS
    table = spark.read.parquet(path)
    assert rows_scanned(table) == n
    # A value of the order opens the page that holds it; a value of no row group opens none.
    assert rows_scanned(table.filter("req_time = 50000")) <= 2 * files.PAGE_ROWS
    assert rows_scanned(table.filter("visit_id = 'visit-x'")) == 0
    small = str(tmp_path / "small")
    files.write_fact_table(rows.limit(100), small, cluster=False)
    assert sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(small) for f in fs) < 40_000
