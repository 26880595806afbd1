"""Language-model scores from a hashed maximum-entropy model with class-factored softmax.

The probability of a word is that of its class in its context times that of the word in
its class.  The class model is a softmax over sums of weight rows: one row each for the
hashes of the word before, the one before that (a skip), both together, and the class
before.  It is trained over all training texts, a share of them each round, by gradient
steps of the tasks whose models are then averaged by their tokens.  In a class a word has
its smoothed share of the training tokens.

A word's class follows from its ending: endings are hashed into keys, the keys' neighbour
counts over all training texts are clustered.  The end of a text is a word of its own
class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, giving_back, stored, words_of

#: Hashed weight rows, classes (the last is the end of a text), keys of endings, and
#: hashed neighbours that describe a key.
ROWS, CLASSES, KEYS, NEIGHBOURS = 1 << 16, 16, 1 << 12, 64
END = CLASSES - 1
#: The weight row of all contexts.
ANY = 0
#: Blocks of weight rows in which changes are put together, and of how many tasks at a time.
BLOCKS, FAN = 64, 32
#: Tokens of a gradient step, rounds over shares of the training texts.
STEP_TOKENS, ROUNDS, RATE = 1 << 15, 3, 0.3
#: Bytes of texts that are encoded together, which take some ten times as much while that
#: is done, in every worker of an executor; and words whose codes a worker remembers.
ENCODED_BYTES, CODED_WORDS = 1 << 21, 1 << 18
#: Words whose counts travel to the tasks, in a table of so many places; a word whose
#: place a more frequent one has, and all others, are joined to their counts.
KNOWN_LIMIT, PLACES = 1 << 18, 1 << 20
#: The end of a text among the words: no word has it but by chance.
END_CODE = 0x656E64206F662074

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63)]


class Coder(WordHashes):
    """Codes of words, remembered up to a limit: 52 bits of the word's hash above the 12
    bits of its key, which hashes its last three bytes."""

    def __init__(self):
        super().__init__(limit=CODED_WORDS)

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word) & ~(KEYS - 1) | xxhash.xxh64_intdigest(word[-3:], 1) % KEYS
        return code

    def encode(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words of the texts, one after the other, and the number of words of each text."""
        import pyarrow.compute as pc

        parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        words, owners = parts.flatten(), pc.list_parent_indices(parts)
        there = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty part
        lengths = np.bincount(owners.filter(there).to_numpy(), minlength=len(texts))
        found = words.filter(there).dictionary_encode()
        different = found.dictionary.cast(pa.binary()).to_pylist()
        codes = np.fromiter(map(self.__getitem__, different), np.uint64, len(different))
        return codes[found.indices.to_numpy()], lengths


def key_of(codes: np.ndarray) -> np.ndarray:
    return (codes & np.uint64(KEYS - 1)).astype(np.int64)


def place_of(codes: np.ndarray) -> np.ndarray:
    return ((codes >> np.uint64(12)) & np.uint64(PLACES - 1)).astype(np.int64)


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether a row is kept from training; a null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


#: Texts, their numbers and words: what training and scoring read.
ENCODED = "row long, doc_id long, held_out boolean, codes binary"


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A stored table of every row's words as codes, eight bytes a word, so that texts are taken apart once."""
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))

    # Stored, so that the numbers of the rows stay as they are.
    return stored(read.mapInArrow(giving_back(_encoded), ENCODED), "encoded")


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their words as codes, some texts at a time, as codes are larger than words."""
    coder = Coder()
    for batch in batches:
        size, first = 0, 0
        for i, n in enumerate(batch.column("text")):
            size += len(n.as_buffer() or b"") if n.is_valid else 0
            if size >= ENCODED_BYTES or i == batch.num_rows - 1:
                part = batch.slice(first, i + 1 - first)
                codes, lengths = coder.encode_all(part.column("text"))
                ends = np.append(0, np.cumsum(lengths) * 8).astype(np.int64)
                packed = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(codes)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), part.column("held_out"), packed], ["row", "doc_id", "held_out", "codes"])
                size, first = 0, i + 1


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and lengths of whole texts put together up to about ``most`` words."""
    codes, held = [], 0
    for batch in batches:
        for text in batch.column("codes"):
            codes.append(np.frombuffer(text.as_buffer(), np.uint64))
            held += len(codes[-1])
            if held >= most:
                yield np.concatenate(codes), np.array([len(c) for c in codes])
                codes, held = [], 0
    if codes:
        yield np.concatenate(codes), np.array([len(c) for c in codes])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts, by chunk (kind 0); neighbour counts of keys, by task.

    Of neighbour counts a row has the cell (key and hashed neighbour) as ``word`` and
    ``kind`` 1.
    """
    near = np.zeros(KEYS * NEIGHBOURS, np.int64)

    def table(kind: int, words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(words), kind, np.int32)), pa.array(words), pa.array(counts.astype(np.int64))], ["kind", "word", "count"])

    for codes, lengths in _chunks(batches, 1 << 20):
        words, counts = np.unique(codes, return_counts=True)
        yield table(0, np.append(words, np.uint64(END_CODE)).view(np.int64), np.append(counts, len(lengths)))
        keys, inside = key_of(codes), np.ones(len(codes), bool)
        inside[np.cumsum(lengths)[lengths > 0] - 1] = False
        at = np.flatnonzero(inside)
        for a, b in ((at, at + 1), (at + 1, at)):
            near += np.bincount(keys[a] * NEIGHBOURS + keys[b] % NEIGHBOURS, minlength=KEYS * NEIGHBOURS)
    cells = np.flatnonzero(near)
    yield table(1, cells, near[cells])


def cluster_keys(near: np.ndarray, seed: int = 5, rounds: int = 15) -> np.ndarray:
    """Classes of the keys, by which neighbours they have more often than all keys do."""
    totals = near.sum(1)
    used = totals > 0
    classes = np.zeros(KEYS, np.int64)
    if used.sum() <= END:
        classes[used] = np.arange(used.sum())
        return classes
    shares = (near[used] + 0.5 * near.sum(0) / near.sum()) / (totals[used] + 0.5)[:, None]
    points = np.sqrt(shares)
    weights = totals[used].astype(np.float64)
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), END, replace=False, p=weights / weights.sum())]
    for _ in range(rounds):
        own = ((centres * centres).sum(1) - 2 * points @ centres.T).argmin(1)
        mass = np.bincount(own, weights, END)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points * weights[:, None])
        centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-9)[:, None], centres)
    classes[used] = own
    return classes


def contexts(codes: np.ndarray, classes: np.ndarray, lengths: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Weight rows of each place's context, by template, and the class there; texts with their ends."""
    n = len(codes) + len(lengths)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    word = np.ones(n, bool)
    word[ends] = False
    h, c = np.zeros(n + 2, np.uint64), np.full(n + 2, END, np.int64)
    h[2:][word], c[2:][word] = codes, classes
    one, two, before = h[1:-1], h[:-2].copy(), c[1:-1]
    # Before a text stands an end, of code 0; the skipped words of its first two are ends too.
    two[starts] = 0
    top = np.uint64(48)
    rows = [
        (one * _MIX[0]) >> top,
        ((two + np.uint64(1)) * _MIX[1]) >> top,
        ((one * _MIX[2]) ^ (two * _MIX[3])) * _MIX[0] >> top,
        (before + 7) * 31,
    ]
    return [r.astype(np.uint16) for r in rows], c[2:]


def log_softmax(weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Natural logarithms of the class probabilities of each context."""
    logits = weights[rows[0]]
    logits += weights[ANY]
    for row in rows[1:]:
        logits += weights[row]
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


CHANGE = "block int, part int, used binary, met binary, change binary"


def _changes(block: int, part: int, used: np.ndarray, met: np.ndarray, change: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([part], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (used, met, change)]],
        ["block", "part", "used", "met", "change"],
    )


def _train_round(classes: np.ndarray, weights, squares):
    """Gradient steps over a task's texts; then its changes, in blocks of rows, with how often it met each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        w, g, met = weights.value.copy(), squares.value.copy(), np.zeros(ROWS, np.float32)

        def move(used, step, times) -> None:
            g[used] += step * step
            w[used] -= RATE * step / np.sqrt(g[used])
            met[used] += times

        for codes, lengths in _chunks(batches, STEP_TOKENS):
            rows, at = contexts(codes, classes[key_of(codes)], lengths)
            pull = np.exp(log_softmax(w, rows))
            pull[np.arange(len(at)), at] -= 1
            pull /= len(at)
            for row in rows:
                order = np.argsort(row, kind="stable")  # a radix sort, for this type
                sorted_rows = row[order]
                first = np.flatnonzero(np.append(True, sorted_rows[1:] != sorted_rows[:-1]))
                move(sorted_rows[first], np.add.reduceat(pull[order], first, axis=0), np.diff(np.append(first, len(row))))
            move(ANY, pull.sum(0), len(at))
        task = TaskContext.get().partitionId()
        for block in range(BLOCKS):
            rows = slice(block * ROWS // BLOCKS, (block + 1) * ROWS // BLOCKS)
            used = np.flatnonzero(met[rows])
            if len(used):
                # Half precision is enough for changes that are averaged; rows without any stay here.
                change = np.stack([w[rows][used] - weights.value[rows][used], np.sqrt(g[rows][used]) - np.sqrt(squares.value[rows][used])], axis=1)
                yield _changes(block, task, used.astype(np.uint16), met[rows][used], change.astype(np.float16))

    return run


def _averaged(table: pa.Table) -> pa.Table:
    """Changes of a block of rows, averaged over up to FAN tasks by how often each met the row."""
    total, times = np.zeros((ROWS // BLOCKS, 2, CLASSES), np.float32), np.zeros(ROWS // BLOCKS, np.float32)
    for used, met, change in zip(table.column("used"), table.column("met"), table.column("change"), strict=True):
        at, met = np.frombuffer(used.as_buffer(), np.uint16), np.frombuffer(met.as_buffer(), np.float32)
        total[at] += met[:, None, None] * np.frombuffer(change.as_buffer(), np.float16).reshape(-1, 2, CLASSES)
        times[at] += met
    used = np.flatnonzero(times)
    change = total[used] / times[used, None, None]
    return pa.Table.from_batches([_changes(table.column("block")[0].as_py(), table.column("part")[0].as_py(), used.astype(np.uint16), times[used], change.astype(np.float16))])


def _together(changes: DataFrame) -> DataFrame:
    """One row of changes for each block, put together FAN tasks at a time, level by level.

    Three levels are enough for a million tasks in each group of the last one to be 1,000 parts.
    """
    for fan in (FAN, FAN, None):
        grouped = changes.withColumn("part", (F.floor(F.col("part") / fan) if fan else F.lit(0)).cast("int"))
        changes = grouped.groupBy("block", "part").applyInArrow(_averaged, CHANGE)
    return changes


@dataclass
class Model:
    """Class weights, classes of keys, and the counts of training words.

    ``counts`` (word, count) is a stored table of all training words; ``known`` has the
    codes and counts of the most frequent ones at their places, 0 elsewhere.
    """

    weights: np.ndarray
    classes: np.ndarray
    counts: DataFrame
    known: tuple[np.ndarray, np.ndarray]
    n_tokens: int
    n_types: int
    class_tokens: np.ndarray
    class_types: np.ndarray


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Counts, classes and weights from every row that is not held out.

    Without such rows all counts are zero and the class model is uniform.
    """
    return fit_encoded(encode(docs, id_col, text_col))


def fit_encoded(encoded: DataFrame) -> Model:
    """``fit`` on texts that are encoded already."""
    spark = encoded.sparkSession
    read = encoded.where("NOT held_out").select("doc_id", "codes")
    parts = read.select("codes").mapInArrow(_count, "kind int, word long, count long")
    sums = stored(parts.groupBy("kind", "word").agg(F.sum("count").alias("count")), "counts")
    counts = sums.where("kind = 0").select("word", "count")
    near = np.zeros(KEYS * NEIGHBOURS)
    cells = sums.where("kind = 1").toArrow()  # KEYS * NEIGHBOURS rows at most
    near[cells.column("word").to_numpy()] = cells.column("count").to_numpy()
    classes = np.append(cluster_keys(near.reshape(KEYS, NEIGHBOURS)), END)
    key = F.when(F.col("word") == END_CODE, KEYS).otherwise(F.col("word").bitwiseAND(F.lit(KEYS - 1).cast("long"))).cast("int")
    by_key = counts.groupBy(key.alias("key")).agg(F.sum("count").alias("tokens"), F.count("*").alias("types")).toArrow()  # KEYS + 1 rows at most
    of = classes[by_key.column("key").to_numpy()]
    class_tokens = np.bincount(of, by_key.column("tokens").to_numpy(), CLASSES)
    class_types = np.bincount(of, by_key.column("types").to_numpy(), CLASSES)
    frequent = counts.where(F.col("word") != END_CODE).orderBy(F.desc("count"), "word").limit(KNOWN_LIMIT).toArrow()
    words, times = (frequent.column(c).to_numpy()[::-1] for c in ("word", "count"))
    known, known_times = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.int64)
    codes = np.ascontiguousarray(words).view(np.uint64)
    known[place_of(codes)], known_times[place_of(codes)] = codes, times  # the last to come, the most frequent, stays

    weights, squares = np.zeros((ROWS, CLASSES), np.float32), np.full((ROWS, CLASSES), 1e-6, np.float32)
    share = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(ROUNDS))
    for part in range(ROUNDS):
        sent = [spark.sparkContext.broadcast(x) for x in (weights, squares)]
        changes = read.where(share == part).select("codes").mapInArrow(_train_round(classes, *sent), CHANGE)
        for row in _together(changes).collect():  # as large as the model
            at = row["block"] * ROWS // BLOCKS + np.frombuffer(row["used"], np.uint16).astype(np.int64)
            change = np.frombuffer(row["change"], np.float16).reshape(-1, 2, CLASSES).astype(np.float32)
            weights[at] += change[:, 0]
            squares[at] = (np.sqrt(squares[at]) + change[:, 1]) ** 2
    return Model(weights, classes, counts, (known, known_times), int(class_tokens.sum()), int(class_types.sum()), class_tokens, class_types)


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, log_context double, rare array<long>"


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words between ASCII white space (A-Z in lower case) and one end of text.
    ``base_score`` is the log10 probability under smoothed unigram counts, ``score`` that
    of the model.  Null and empty texts are an end alone; a null id is held out; repeated
    rows are scored each; an empty table gives no rows.  Only the id and the text are read,
    so extra columns may have any name.
    """
    return score_encoded(encode(docs, id_col, text_col), model)


def score_encoded(encoded: DataFrame, model: Model) -> DataFrame:
    """``score`` of texts that are encoded already."""
    spark = encoded.sparkSession
    norm = np.log10(model.class_tokens + 0.5 * (model.class_types + 1))
    known, times = model.known
    shared = spark.sparkContext.broadcast((model.weights, model.classes, known, np.log10(times + 0.5), norm))

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """Rows of a batch with their codes, about as many words as one step takes."""
        coded, first, held = [], 0, 0
        for i, codes in enumerate(batch.column("codes")):
            coded.append(np.frombuffer(codes.as_buffer(), np.uint64))
            held += len(coded[-1])
            if held >= STEP_TOKENS or i == batch.num_rows - 1:
                yield batch.slice(first, i + 1 - first), np.concatenate(coded), np.array([len(c) for c in coded])
                coded, first, held = [], i + 1, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, classes, known, logs_of, norm = shared.value
        for batch in batches:
            for part, codes, lengths in pieces(batch):
                rows, at = contexts(codes, classes[key_of(codes)], lengths)
                total = log_softmax(weights, rows)[np.arange(len(at)), at].astype(np.float64) / np.log(10) - norm[at]
                context = np.add.reduceat(total, np.cumsum(lengths + 1) - lengths - 1)
                place = place_of(codes)
                found = known[place] == codes
                owner = np.repeat(np.arange(len(lengths)), lengths)
                logs = np.bincount(owner[found], logs_of[place[found]], len(lengths)).astype(np.float64)  # integers where nothing is found
                n_known = np.bincount(owner[found], minlength=len(lengths))
                ends = np.append(0, np.cumsum(lengths - n_known)).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(ends), pa.array(codes[~found].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(lengths + 1), pa.array(n_known), pa.array(logs), pa.array(context), rare],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "log_counts", "log_context", "rare"],
                )

    scored = stored(encoded.mapInArrow(run, SCORED), "scored")
    rare = scored.select("row", F.explode("rare").alias("word")).join(model.counts, "word", "left")
    counted = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("count", F.lit(0)) + 0.5)).alias("rare_logs"), F.count("count").alias("rare_known"))
    end = model.counts.where(F.col("word") == END_CODE).agg(F.sum("count")).head()[0] or 0
    logs = F.col("log_counts") + F.coalesce("rare_logs", F.lit(0.0)) + float(np.log10(end + 0.5))
    whole = float(np.log10(model.n_tokens + 0.5 * (model.n_types + 1)))
    return scored.join(counted, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + (1 if end else 0)).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * whole).alias("base_score"),
        (logs + F.col("log_context")).alias("score"),
    )
