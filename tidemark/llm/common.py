"""Helpers shared by the corpus operators."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_path

#: ASCII white space; a word is a longest run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str, session: SparkSession | None = None, **options: str) -> DataFrame:
    """Write to the shared folder, with options of the writer, and read back, in another session if one is given.

    Cuts the lineage at files that outlive lost executors, and gives the planner the
    true size of what follows.
    """
    path = new_path(df.sparkSession, f"llm-{label}")
    df.write.options(**options).parquet(path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path)


def free_name(name: str, taken: Iterable[str]) -> str:
    """The name, with as many underscores after it as make it differ from all that are taken."""
    have = {other.lower() for other in taken}
    while name.lower() in have:
        name += "_"
    return name


def slot_count(keys: int, most: int = 1 << 26) -> int:
    """Flags that thin ``keys`` out to about a thousandth of what is not among them."""
    n = 1 << 10
    while n < min(32 * keys, most):
        n *= 2
    return n


def slots_of_hash(hashed: Column, n_slots: int) -> tuple[Column, Column]:
    """The two places of a 64-bit hash among the flags."""
    last = F.lit(n_slots - 1).cast("long")
    return hashed.bitwiseAND(last).cast("int"), F.shiftright(hashed, 32).bitwiseAND(last).cast("int")


def slot_flags(hashes: DataFrame, n_slots: int) -> Column:
    """An array of flags as a scalar subquery: true at the places of the ``hashes`` (one column).

    For thinning out rows before an exact join.  Its size is ``n_slots`` bytes, whatever
    the tables hold.
    """
    both = F.array(*[slot.cast("long") for slot in slots_of_hash(F.col(hashes.columns[0]), n_slots)])
    taken = hashes.select(F.explode(both).alias("id")).distinct().withColumn("taken", F.lit(1))
    flags = hashes.sparkSession.range(n_slots).join(taken, "id", "left").select((F.col("id") * 2 + F.coalesce("taken", F.lit(0))).alias("x"))
    return flags.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x % 2 == 1).alias("slots")).scalar()


def giving_back(run: Callable) -> Callable:
    """``run`` over Arrow batches, or one or two tables of a group, which hands unused memory back.

    Arrow's pool keeps what it has once held, and a worker stays beside the executor's
    heap when its task is done.  Batches end with it, a group begins with it.
    """

    def give_back() -> None:
        import pyarrow as pa

        pa.default_memory_pool().release_unused()

    if inspect.isgeneratorfunction(run):

        @functools.wraps(run)
        def wrapped(batches):
            yield from run(batches)
            give_back()

    elif len(inspect.signature(run).parameters) == 1:  # Spark counts the arguments

        @functools.wraps(run)
        def wrapped(table):
            give_back()
            return run(table)

    else:

        @functools.wraps(run)
        def wrapped(left, right):
            give_back()
            return run(left, right)

    return wrapped


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z in lower case; none for a null text."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """64-bit hashes of words, remembered for up to ``limit`` words.

    A larger memory is no faster: frequent words come back at once, rare ones do not.
    """

    def __init__(self, limit: int = 1 << 16, seed: int = 0):
        super().__init__()
        self.limit, self.seed = limit, seed

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value
