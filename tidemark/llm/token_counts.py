"""Token counts of a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton of the pieces enumerates every match that ends at a place; the
Viterbi table keeps, for each place, the best score and the number of pieces on that
path.  Ties, unknown characters and byte fallback follow the unigram models of public
tokenizer libraries: starts are tried from the left and only a strictly better score
replaces one; where no piece is the single character, an unknown one of it is tried, ten
below the lowest score; an unknown run counts its UTF-8 bytes with byte fallback, else 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Characters after which a table of a long text loses its beginning.
KEPT = 1 << 12
#: What an unknown character scores below the lowest piece.
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores; ``byte_fallback`` needs a piece for each of the 256 bytes."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool

    @property
    def unknown_score(self) -> float:
        return min(score for _, score in self.pieces) - UNKNOWN_PENALTY


def read_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a public model file, read on the driver."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    model = model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return Vocabulary(tuple((p.piece, p.score) for p in model.pieces), model.trainer_spec.byte_fallback)


class Counter:
    """Counts pieces of texts; spaces become marks and one is put in front of each text.

    A text is cut where every path must have a border: between a character and a mark
    when no piece holds a mark after another character, and around characters that no
    piece holds.  The parts recur, so their counts are remembered, up to ``limit``.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = 1 << 19, longest: int = 64):
        import ahocorasick

        self.unknown, self.byte_fallback = vocabulary.unknown_score, vocabulary.byte_fallback
        self.automaton = ahocorasick.Automaton()
        self.longest_piece = max((len(piece) for piece, _ in vocabulary.pieces), default=1)
        for piece, score in vocabulary.pieces:
            if piece and not self.automaton.exists(piece):
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.known = {c for piece, _ in vocabulary.pieces for c in piece}
        self.splits_at_mark = not any(SPACE in piece.lstrip(SPACE) for piece, _ in vocabulary.pieces)
        self.seen: dict[str, int] = {}
        self.limit, self.longest = limit, longest
        self.whole_words = self.splits_at_mark and "\n" not in self.known
        self.line_break = self.viterbi("\n")

    def viterbi(self, text: str) -> int:
        """Pieces of the best path over ``text`` as it stands.

        The tables begin at ``base``: what no match can start from any more is dropped now and then.
        """
        unknown, longest, base = self.unknown, self.longest_piece, 0
        best, pieces, reached, unknown_run = [0.0], [0], [True], [False]
        matches = self.automaton.iter(text)
        at, found = next(matches, (-1, None))
        for end in range(1, len(text) + 1):
            total, count, there, single, run = 0.0, 0, False, False, False
            # The longest match starts furthest left; the automaton gives it first.
            while at == end - 1:
                length, score = found
                start = end - length - base
                single = single or length == 1
                if reached[start]:
                    new = best[start] + score
                    if not there or new > total:
                        total, count, there = new, pieces[start] + 1, True
                at, found = next(matches, (-1, None))
            if not single:
                new = best[-1] + unknown
                if not there or new > total:
                    if self.byte_fallback:
                        more = len(text[end - 1].encode("utf-8", "surrogatepass"))
                    else:
                        more = 0 if unknown_run[-1] else 1
                    total, count, there, run = new, pieces[-1] + more, True, True
            best.append(total)
            pieces.append(count)
            reached.append(there)
            unknown_run.append(run)
            if len(best) > longest + KEPT:
                for table in (best, pieces, reached, unknown_run):
                    del table[:KEPT]
                base += KEPT
        return pieces[-1]

    def part(self, text: str) -> int:
        """As ``viterbi``, remembered; long parts are counted anew each time."""
        count = self.seen.get(text)
        if count is None:
            count = self.viterbi(text)
            if len(text) <= self.longest:
                if len(self.seen) >= self.limit:
                    self.seen.clear()
                self.seen[text] = count
        return count

    def line_word(self, text: str) -> int:
        """A word with line breaks in it: they stand alone, as no piece holds them."""
        lines = text.split("\n")
        return sum(map(self.part, lines)) + self.line_break * (len(lines) - 1)

    def count(self, text: str | None) -> int:
        """Pieces of a text; none for null or empty ones."""
        if not text:
            return 0
        if not self.splits_at_mark:
            return self.viterbi(SPACE + text.replace(" ", SPACE))
        if not self.byte_fallback:
            # Runs of unknown characters may join across any cut but a mark's.
            return sum(map(self.viterbi, re.split(f"(?<=[^{SPACE}])(?={SPACE})", SPACE + text.replace(" ", SPACE))))
        marked = SPACE + text.replace(" ", SPACE)
        if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
            words = re.split(f"(?<=[^{SPACE}])(?={SPACE})", marked)
        else:
            words = [SPACE + word for word in text.split(" ")]
        if not self.whole_words:
            return sum(map(self.part, words))
        seen, total = self.seen, 0
        for word in words:
            count = seen.get(word)
            if count is None:
                count = self.line_word(word) if "\n" in word else self.part(word)
            total += count
        return total


def token_counts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and n_bytes (of the text) of every row, repeated rows each.

    Counts are those of a unigram tokenizer that puts one space mark before the text and
    replaces each space by one, over whole texts, however long: of a text the tables for the
    last characters alone are kept, as many as the longest piece has.  Paths of equal score
    are told apart as the module says.  Null and empty texts have no tokens, null ids stay,
    an empty table gives no rows, and extra columns, whatever their names, are not read.
    The vocabulary travels to the tasks; its size does not depend on the data.
    """
    # Plain tuples travel, so that workers need nothing of this package by name.
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.pieces, vocabulary.byte_fallback))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Vocabulary(*shared.value))
        for batch in batches:
            counts = pa.array([counter.count(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, batch.column("n_bytes")], ["doc_id", "n_tokens", "n_bytes"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return read.mapInArrow(run, "doc_id long, n_tokens long, n_bytes long")


def reference_tokenizer(vocabulary: Vocabulary, unknown_id: int = 0):
    """The public library's tokenizer of the same vocabulary, to compare with."""
    from tokenizers import Tokenizer, models, normalizers

    tokenizer = Tokenizer(models.Unigram(list(vocabulary.pieces), unknown_id, vocabulary.byte_fallback))
    tokenizer.normalizer = normalizers.Sequence([normalizers.Prepend(SPACE), normalizers.Replace(" ", SPACE)])
    return tokenizer


def library_counts(tokenizer, texts: Sequence[str | None]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
