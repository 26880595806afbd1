"""A queue of message batches with positions.

Producers store the messages of a batch below ``batches`` and then add its key to the
index, a table of numbered entries.  The stream ``batch_queue`` hands out the batches in
the order of the index, by default one at a time, each whole; a batch of many files is
read by as many tasks.

A job reads as a named consumer.  Its offsets in Spark's checkpoint count the batches
that were handed out and only grow; where the consumer was set to another position, that
is kept beside the index as the offset from which on the numbers differ.  So a job that is
set back goes on from its own checkpoint: the batches come again, as new micro-batches,
and one that Spark had to repeat is repeated as it was.

Producers and jobs need nothing in common but the folder.  The reader's planning runs in
a Python process beside the driver and its reads in the tasks; both open files through
pyarrow, which knows local, HDFS and object storage.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.storage import filesystem, publish, qualified

FORMAT = "batch_queue"
SCHEMA = "value STRING, batch_key STRING, batch_number BIGINT"
ENTRY = "number BIGINT, key STRING, files ARRAY<STRING>"
#: Entries of the index that share a folder, so that finding the last one lists few names.
FOLDER_ENTRIES = 1000
#: Messages that a task holds at once.
READ_ROWS = 1024


def _entry_path(number: int) -> str:
    return f"index/{number // FOLDER_ENTRIES:09d}/{number:012d}.json"


class QueueFiles:
    """The folder of a queue as any process sees it."""

    def __init__(self, path: str):
        from pyarrow import fs

        # A local path is not a URI, as it may hold any character.
        local = path.removeprefix("file:").removeprefix("//") if path.startswith(("file:", "/")) else None
        # Hadoop's name of an object store and the common one differ.
        self.fs, self.root = (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))

    def names(self, folder: str) -> list[str]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found if not f.base_name.startswith("."))

    def exists(self, name: str) -> bool:
        from pyarrow import fs

        return self.fs.get_file_info(f"{self.root}/{name}").type != fs.FileType.NotFound

    def load(self, name: str, default=None):
        """A JSON value, or the default where there is no such file."""
        if not self.exists(name):
            return default
        with self.fs.open_input_stream(f"{self.root}/{name}") as file:
            return json.loads(file.read())

    def save(self, name: str, value) -> None:
        """Replace a JSON value at once, so that readers see the old one or the new one."""
        folder, _, base = f"{self.root}/{name}".rpartition("/")
        self.fs.create_dir(folder)
        staged = f"{folder}/.{base}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(staged) as file:
            file.write(json.dumps(value).encode())
        self.fs.move(staged, f"{folder}/{base}")

    def length(self) -> int:
        """Entries of the index; their numbers have no gaps."""
        folders = self.names("index")
        if not folders:
            return 0
        last = [n for n in self.names(f"index/{folders[-1]}") if n.endswith(".json")]
        return int(last[-1].removesuffix(".json")) + 1 if last else int(folders[-1]) * FOLDER_ENTRIES


class Consumer:
    """What a consumer was handed, and where it was set."""

    def __init__(self, files: QueueFiles, name: str):
        if not name or "/" in name:
            raise ValueError(f"not a name of a consumer: {name!r}")
        self.files, self.folder = files, f"consumers/{name}"

    def seeks(self) -> list[list[int]]:
        """(offset, number): from this offset on the numbers count from that one."""
        return self.files.load(f"{self.folder}/seeks.json", [[0, 0]])

    def offset(self, kind: str) -> int:
        return self.files.load(f"{self.folder}/{kind}.json", 0)

    def raise_offset(self, kind: str, offset: int) -> None:
        if offset > self.offset(kind):
            self.files.save(f"{self.folder}/{kind}.json", offset)

    def seek(self, number: int) -> None:
        """Let the next batch handed out be that one.  What was handed out before stays as it was."""
        at, done = self.offset("planned"), self.offset("committed")
        seeks = [s for s in self.seeks() if s[0] < at]
        # Only offsets that are not committed can be asked for again.
        needed = [s for i, s in enumerate(seeks) if i + 1 == len(seeks) or seeks[i + 1][0] > done]
        self.files.save(f"{self.folder}/seeks.json", [*needed, [at, number]])


def number_at(seeks: Sequence[Sequence[int]], offset: int) -> int:
    """The number of the batch at an offset."""
    at, number = max((s for s in seeks if s[0] <= offset), key=lambda s: s[0])
    return number + offset - at


class QueueReader(DataSourceStreamReader):
    """Offsets count the batches handed out to the consumer."""

    def __init__(self, options: Mapping[str, str]):
        self.path, self.consumer = options["path"], options["consumer"]
        limit = int(options.get("batches_per_trigger", "1"))
        self.limit = limit if limit > 0 else None
        self.skip_missing = options.get("missing", "fail") == "skip"

    def _state(self) -> Consumer:
        return Consumer(QueueFiles(self.path), self.consumer)

    def initialOffset(self) -> dict:
        return {"offset": 0}

    def latestOffset(self) -> dict:
        state = self._state()
        planned, (at, number) = state.offset("planned"), state.seeks()[-1]
        end = max(planned, at + max(0, state.files.length() - number))
        return {"offset": end if self.limit is None else min(end, planned + self.limit)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        state = self._state()
        first, last = start["offset"], end["offset"]
        if last < first:
            raise ValueError(f"consumer {self.consumer!r} was handed fewer batches than its checkpoint says: {last} < {first}")
        # From here on these offsets keep their batches, whatever position is set later.
        state.raise_offset("planned", last)
        seeks, parts = state.seeks(), []
        for offset in range(first, last):
            number = number_at(seeks, offset)
            entry = state.files.load(_entry_path(number))
            if entry is None:
                raise FileNotFoundError(f"batch {number} is not in the index of {self.path}")
            for name in entry["files"]:
                file = f"batches/{entry['key']}/{name}"
                if state.files.exists(file):
                    parts.append(InputPartition((file, entry["key"], number)))
                elif not self.skip_missing:
                    raise FileNotFoundError(f"{file} of batch {number} is gone; set the position behind it, or read with missing=skip")
        return parts

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        name, key, number = partition.value
        files = QueueFiles(self.path)
        with files.fs.open_input_file(f"{files.root}/{name}") as source:
            for batch in pq.ParquetFile(source).iter_batches(READ_ROWS, columns=["value"]):
                n = batch.num_rows
                columns = [batch.column(0).cast(pa.string()), pa.array([key] * n, pa.string()), pa.array([number] * n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["value", "batch_key", "batch_number"])

    def commit(self, end: dict) -> None:
        self._state().raise_offset("committed", end["offset"])


class BatchQueue(DataSource):
    """The stream of a queue. Options: path, consumer, batches_per_trigger (0: all), missing (fail or skip)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> QueueReader:
        return QueueReader(self.options)


def queue_batches(spark: SparkSession, path: str, consumer: str, batches_per_trigger: int = 1, missing: str = "fail") -> DataFrame:
    """SRC-4: a stream of the messages of a queue, as ``value``, with the key and number of their batch.

    A micro-batch holds ``batches_per_trigger`` whole batches, or with 0 all that are there.
    A batch whose messages are gone fails the job; with ``missing="skip"`` it counts as empty.
    One job at a time may read as a consumer.
    """
    if missing not in ("fail", "skip"):
        raise ValueError(f"missing is fail or skip, not {missing!r}")
    spark.dataSource.register(BatchQueue)
    options = {"path": qualified(spark, path), "consumer": consumer, "batches_per_trigger": str(batches_per_trigger), "missing": missing}
    return spark.readStream.format(FORMAT).options(**options).load()


def enqueue(messages: DataFrame, path: str, key: str | None = None, column: str = "value") -> int:
    """Store the messages of a batch and add it to the index; returns its number.

    The batch is as many files as the frame has partitions with rows.  It is in the queue
    once its entry is, which appears at once and whole; producers that come at the same
    time take the next number.  A key that is queued already fails.
    """
    spark = messages.sparkSession
    key = key or uuid.uuid4().hex
    folder = f"{path}/batches/{key}"
    messages.select(messages[column].cast("string").alias("value")).write.parquet(folder)
    fs, target = filesystem(spark, folder)
    files = sorted(s.getPath().getName() for s in fs.listStatus(target) if not s.getPath().getName().startswith(("_", ".")))
    seen = QueueFiles(qualified(spark, path))
    while True:
        number = seen.length()
        parent, _, name = _entry_path(number).rpartition("/")
        if publish(spark, f"{path}/{parent}", name, json.dumps({"number": number, "key": key, "files": files})):
            return number


def queue_index(spark: SparkSession, path: str) -> DataFrame:
    """The index as a table: number, key and files of every batch."""
    return spark.read.schema(ENTRY).option("recursiveFileLookup", "true").json(f"{path}/index")


def queue_length(spark: SparkSession, path: str) -> int:
    """Batches that were ever queued; the number of the next one."""
    return QueueFiles(qualified(spark, path)).length()


def get_position(spark: SparkSession, path: str, consumer: str, committed: bool = False) -> int:
    """SRC-7: number of the batch that the consumer is handed next; with ``committed``, of the first that Spark may repeat."""
    state = Consumer(QueueFiles(qualified(spark, path)), consumer)
    return number_at(state.seeks(), state.offset("committed" if committed else "planned"))


def set_position(spark: SparkSession, path: str, consumer: str, number: int) -> None:
    """SRC-7: let the consumer go on at a batch, earlier or later than where it is.

    Call it while no job reads as this consumer; the next start of the job, from its own
    checkpoint, first ends what it had begun and then goes on there.  Batches that were
    handed out before come again in new micro-batches, so a sink that must hold them once
    has to key its rows, by ``batch_key`` for one.
    """
    if number < 0:
        raise ValueError(f"not a number of a batch: {number}")
    Consumer(QueueFiles(qualified(spark, path)), consumer).seek(number)


def pending(spark: SparkSession, path: str, consumer: str) -> int:
    """Batches that the consumer has still to be handed."""
    return max(0, queue_length(spark, path) - get_position(spark, path, consumer))
