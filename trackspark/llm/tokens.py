"""Token counts by a Viterbi pass that keeps counts only.

The tokenizer is the unigram model over the pieces and scores of a public SentencePiece file, as the ``tokenizers``
library runs it: spaces become ``▁``, one is put before the text, the text is cut before each ``▁``, and every part is
segmented into the pieces of the highest total score. An Aho-Corasick automaton enumerates all pieces in a part; the
dynamic programme carries, for each position, the best score and the number of tokens on the best path.

Tie rules of that tokenizer. Of equal scores the path whose last piece starts first wins. A character that is no piece
of its own may be an unknown token, ``UNKNOWN_BELOW`` under the lowest score; unknown tokens in a row are one token.

Defined results. A null or empty text has 0 tokens. Texts are counted whole, whatever their length. Repeated rows are
counted alike. An empty table gives an empty result. Parts seen before are looked up among a bounded number of
remembered ones. Other columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import slices, table
from trackspark.llm.langid import MODEL_FILE, SPACE

UNKNOWN_BELOW = 10.0
# Parts remembered, and the longest of them in characters.
REMEMBERED, LONGEST = 300_000, 64


def pieces_of(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the normal pieces of a SentencePiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte)
    ids = [i for i in range(model.get_piece_size()) if not any(f(i) for f in special)]
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids]


class Counter:
    """Counts the tokens of parts of texts; an automaton of all pieces is built once."""

    def __init__(self, pieces: list[tuple[str, float]], unknown_score: float | None = None):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        lowest = min(score for _, score in pieces)
        self.unknown = lowest - UNKNOWN_BELOW if unknown_score is None else unknown_score
        self.known: dict[str, int] = {}

    def part(self, part: str) -> int:
        """Tokens of one part: best[i] is (score, tokens, ends in an unknown) of the first i characters."""
        size = len(part)
        # Arrays of numbers: a part takes 14 bytes a character, whatever its length.
        score, tokens = array("d", [-inf]) * (size + 1), array("i", [0]) * (size + 1)
        open_end, single = bytearray(size + 1), bytearray(size)
        score[0] = 0.0

        def close(end: int) -> None:
            # The unknown token starts last of all that end here, so it must be strictly better.
            if not single[end - 1]:
                other = score[end - 1] + self.unknown
                if other > score[end]:
                    score[end], open_end[end] = other, True
                    tokens[end] = tokens[end - 1] + (not open_end[end - 1])

        done = 0
        # Matches come by their end, at one end the longest first: in the order of their starts.
        for last, (length, worth) in self.automaton.iter(part):
            end = last + 1
            while done < end - 1:
                done += 1
                close(done)
            start = end - length
            if length == 1:
                single[start] = True
            other = score[start] + worth
            if other > score[end]:
                score[end], tokens[end], open_end[end] = other, tokens[start] + 1, False
        while done < size:
            done += 1
            close(done)
        return tokens[size]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        marked = text.replace(" ", SPACE)
        if not marked.startswith(SPACE):
            marked = SPACE + marked
        for part in marked.split(SPACE)[1:]:
            count = known.get(part)
            if count is None:
                count = self.part(SPACE + part)
                if len(part) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = count
            total += count
        return total


def count_tokens(docs: DataFrame, path: str = MODEL_FILE) -> DataFrame:
    """(doc_id, n_tokens) of every row; the path must exist on every executor, as the library does."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces_of(path))
        for batch in slices(batches):
            counts = [counter.text(t and t.decode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
