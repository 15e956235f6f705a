"""Language identification by unigram pieces, summed over all segmentations.

Pieces come from a fixed public vocabulary (a SentencePiece model, by path). Per language, training counts how often
each piece occurs in the vocabulary's own segmentation of the training words; smoothed shares are the language's
piece probabilities. A text is a product of words; a word's probability in a language is the sum over all ways to cut
it into pieces, computed by a forward pass from left to right. The prediction is the language with the highest
posterior (prior: share of training documents).

Counts are whole numbers summed by Spark over all training documents, so a model does not depend on partitioning.
What reaches the driver and the tasks is one row of counts per language and piece: languages times the fixed size
of the vocabulary, whatever the corpus.

Defined results. ``und`` with score 0 for a null text and for a text without a letter, and for every text where no
language was learned. Rows without an id or without a language do not train. Texts are read whole; a word of any
length is one word. Repeated rows count repeatedly and are predicted alike. Of equal posteriors the first language by
name wins. An empty table gives an empty result. Columns ``lang`` and ``source`` are never inputs of a prediction.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import slices, table

MODEL_FILE = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")
SPACE = "▁"
UNDETERMINED = "und"
# Added to every piece count; also the count of an unknown character.
SMOOTHING = 0.5
# Longer words take a path of their own, position by position.
SHORT_WORD = 24
# Short words are computed with plain products, scaled by this per character; what still falls below LEAST is
# computed again in logarithms.
PER_CHARACTER, LEAST = 64.0, 1e-250
# Words whose probabilities a task remembers, short ones only, and positions of a long word looked up at once.
REMEMBERED = 200_000
LONGEST_REMEMBERED = 200
POSITIONS = 4096
# Texts whose distinct words are segmented together in training.
TRAINING_ROWS = 1024
LETTER = regex.compile(r"\p{L}")
BASE = np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0xD6E8FEB86659FD93)
TABLE_BITS, TABLE_SHIFTS = 20, (44, 34, 24, 14)


def held_out(doc_id: Column) -> Column:
    """The fold kept from training: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


class Vocabulary:
    """Normal pieces of a SentencePiece model, numbered, found by a rolling hash of their characters."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.processor.get_piece_size()
        skip = (self.processor.is_control, self.processor.is_unknown, self.processor.is_byte)
        pieces = [self.processor.id_to_piece(i) for i in range(size) if not any(f(i) for f in skip)]
        self.number = {p: n for n, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        special = [i for i in range(size) if any(f(i) for f in skip)]
        # Number of each id of the file; ids without a piece count as unknown, behind the last piece.
        self.number_of_id = np.full(size, len(pieces), dtype=np.int64)
        self.number_of_id[np.setdiff1d(np.arange(size), special)] = np.arange(len(pieces))
        hashes = np.array([self.hashed(p) for p in pieces], dtype=np.uint64)
        # Tables by different bits of the hash: a piece stands in the first in which its place is free.
        self.tables, left = [], np.arange(len(pieces))
        for shift in TABLE_SHIFTS:
            if not len(left):
                break
            table = np.full(1 << TABLE_BITS, -1, dtype=np.int32)
            place = self.place(hashes[left], shift)
            table[place[::-1]] = left[::-1]
            self.tables.append((shift, table))
            left = left[table[place] != left]
        assert not len(left), "two pieces share their places"
        self.hashes = np.append(hashes, ~hashes[:1])

    @staticmethod
    def place(hashes: np.ndarray, shift: int) -> np.ndarray:
        return ((hashes * ODD >> np.uint64(shift)) & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)

    @staticmethod
    def hashed(piece: str) -> int:
        value = 0
        for char in piece:
            value = (value * int(BASE) + ord(char) + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece number of each hash, -1 for none."""
        shift, table = self.tables[0]
        found = table[self.place(hashes, shift)]
        found[self.hashes[found] != hashes] = -1
        for shift, table in self.tables[1:]:
            other = table[self.place(hashes, shift)]
            at = np.flatnonzero(other >= 0)
            at = at[self.hashes[other[at]] == hashes[at]]
            found[at] = other[at]
        return found


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary, read once per Python worker. The path must exist on every executor, as the library does."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def counted(path: str):
    """Partial piece counts per language of one task's documents; piece -1 counts documents, -2 unknown characters."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        number = vocab.number
        counts: dict[str, np.ndarray] = {}
        for batch in slices(batches, TRAINING_ROWS):
            words: dict[str, dict[str, int]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if lang not in counts:
                    counts[lang] = np.zeros(len(number) + 2, dtype=np.int64)
                counts[lang][-1] += 1
                seen = words.setdefault(lang, {})
                for word in text.decode("utf-8", "replace").split():
                    seen[word] = seen.get(word, 0) + 1
            for lang, seen in words.items():
                ids = vocab.processor.encode(list(seen))
                lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
                flat = vocab.number_of_id[np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(lengths.sum()))]
                times = np.repeat(np.fromiter(seen.values(), dtype=np.int64, count=len(ids)), lengths)
                counts[lang][:-1] += np.bincount(flat, weights=times, minlength=len(number) + 1).astype(np.int64)
        for lang, into in counts.items():
            at = np.flatnonzero(into)
            piece = np.where(at >= len(number), at - len(into), at)
            yield pa.record_batch([pa.array([lang] * len(at)), piece, into[at]], names=["lang", "piece", "n"])

    return run


@dataclass
class Model:
    """Languages by name, log prior, and log probability of every piece (rows) in every language (columns)."""

    languages: list[str]
    prior: np.ndarray
    logs: np.ndarray
    path: str

    @cached_property
    def worth(self) -> np.ndarray:
        return np.exp(self.logs)


def fit(docs: DataFrame, train: Column, path: str = MODEL_FILE) -> Model:
    """Count pieces over all rows with ``train`` true, a text and a language."""
    rows = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    partial = rows.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(
        counted(path), "lang string, piece long, n long"
    )
    totals = partial.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(totals.column("lang").to_pylist()))
    size = len(vocabulary(path).number)
    counts = np.zeros((size + 2, len(languages)))
    if languages:
        column = np.searchsorted(languages, totals.column("lang").to_pylist())
        counts[totals.column("piece").to_numpy(), column] = totals.column("n").to_numpy()
    documents = counts[-1]
    shares = counts[:-1] + SMOOTHING
    return Model(languages, np.log(np.maximum(documents, 1) / max(1.0, documents.sum())), np.log(shares / shares.sum(axis=0)), path)


def short_words(words: list[str], model: Model, vocab: Vocabulary) -> np.ndarray:
    """Log probability of each short word (rows) in each language, all words advancing together."""
    count, kinds = len(words), len(model.languages)
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    codes = np.zeros((count, width), dtype=np.uint64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    codes[np.arange(width) < lengths[:, None]] = flat.astype(np.uint64) + np.uint64(1)
    forward = np.zeros((width + 1, count, kinds))
    forward[0] = 1.0
    unknown = model.worth[-1] * PER_CHARACTER
    running: list[np.ndarray] = []  # hash of the last n + 1 characters
    order = np.argsort(lengths, kind="stable")
    for end in range(1, width + 1):
        alive = order[np.searchsorted(lengths, end, sorter=order) :]
        char = codes[:, end - 1]
        running = [char, *(before * BASE + char for before in running[: vocab.longest - 1])]
        total = forward[end, alive]
        for back, hashes in enumerate(running[:end], start=1):
            piece = vocab.find(hashes[alive])
            if back == 1:
                step = np.where((piece >= 0)[:, None], model.worth[piece] * PER_CHARACTER, unknown)
                total = forward[end - 1, alive] * step
            else:
                hit = np.flatnonzero(piece >= 0)
                if len(hit):
                    scaled = model.worth[piece[hit]] * PER_CHARACTER**back
                    total[hit] += forward[end - back, alive[hit]] * scaled
        forward[end, alive] = total
    last = forward[lengths, np.arange(count)]
    found = np.log(np.maximum(last, LEAST)) - lengths[:, None] * np.log(PER_CHARACTER)
    for row in np.flatnonzero((last <= LEAST).any(axis=1)):
        found[row] = long_word(words[row], model, vocab)
    return found


def long_word(word: str, model: Model, vocab: Vocabulary) -> np.ndarray:
    """The same forward pass over one word of any length: pieces of all lengths are looked up for many positions at once.

    Only the sums of the last positions, as many as a piece is long, are kept, so a word takes memory for its letters alone.
    """
    codes = np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32)
    reach = vocab.longest
    ring = {0: np.zeros(len(model.languages))}
    for begin in range(0, len(codes), POSITIONS):
        # Ends of pieces: begin + 1 up to stop; they start at most ``reach`` before.
        stop, base = min(begin + POSITIONS, len(codes)), max(0, begin - reach)
        part = codes[base:stop].astype(np.uint64) + np.uint64(1)
        matches: list[list[tuple[int, int]]] = [[] for _ in range(stop - begin)]
        hashes = part.copy()
        for length in range(1, min(reach, len(part)) + 1):
            if length > 1:
                hashes = hashes[:-1] * BASE + part[length - 1 :]
            first = max(0, begin - base - length + 1)
            found = vocab.find(hashes[first:])
            for at in np.flatnonzero(found >= 0).tolist():
                matches[base + first + at + length - begin - 1].append((base + first + at, int(found[at])))
        for end in range(begin + 1, stop + 1):
            ending = matches[end - begin - 1]
            total = None if any(start == end - 1 for start, _ in ending) else ring[end - 1] + model.logs[-1]
            for start, piece in ending:
                value = ring[start] + model.logs[piece]
                total = value if total is None else np.logaddexp(total, value)
            ring[end] = total
            ring.pop(end - reach - 1, None)
    return ring[len(codes)]


class Judge:
    """Predictions of one task; remembers the probabilities of a bounded number of words."""

    def __init__(self, model: Model):
        self.model, self.vocab = model, vocabulary(model.path)
        self.row_of: dict[str, int] = {}
        self.logs = np.zeros((1 << 12, len(model.languages)))  # grows; the first len(row_of) rows count

    def learn(self, words: Iterable[str]) -> None:
        """Compute the words not yet remembered."""
        known = self.row_of
        new = {w: None for w in words if w not in known}
        short = sorted((w for w in new if len(w) <= SHORT_WORD), key=len)
        step = max(64, 16_384 // max(1, len(self.model.languages)))
        for start in range(0, len(short), step):
            part = short[start : start + step]
            self.store(part, short_words(part, self.model, self.vocab))
        for word in new:
            if SHORT_WORD < len(word) <= LONGEST_REMEMBERED:
                self.store([word], long_word(word, self.model, self.vocab)[None, :])

    def store(self, words: list[str], logs: np.ndarray) -> None:
        start, end = len(self.row_of), len(self.row_of) + len(words)
        if end > len(self.logs):
            grown = np.zeros((2 * end, self.logs.shape[1]))
            grown[:start] = self.logs[:start]
            self.logs = grown
        self.logs[start:end] = logs
        self.row_of.update(zip(words, range(start, end), strict=True))

    def judge(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        """Language and posterior of each text."""
        plain = [t and t.decode("utf-8", "replace") for t in texts]
        voiced = [bool(t) and bool(self.model.languages) and LETTER.search(t) is not None for t in plain]
        cut = [[SPACE + w for w in t.split()] if v else [] for t, v in zip(plain, voiced, strict=True)]
        if len(self.row_of) > REMEMBERED:
            self.row_of = {}
        self.learn(chain.from_iterable(cut))
        labels, scores = [], []
        for words, v in zip(cut, voiced, strict=True):
            if not v:
                labels.append(UNDETERMINED)
                scores.append(0.0)
                continue
            known = [self.row_of[w] for w in words if len(w) <= LONGEST_REMEMBERED]
            total = self.model.prior + self.logs[np.array(known, dtype=np.int64)].sum(axis=0)
            for word in words:
                if len(word) > LONGEST_REMEMBERED:
                    total = total + long_word(word, self.model, self.vocab)
            best = int(total.argmax())
            labels.append(self.model.languages[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
        return labels, scores


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in slices(batches):
            labels, scores = judge.judge(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(columns, names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, ~held_out(F.col("doc_id")))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame, path: str = MODEL_FILE) -> DataFrame:
    """The documents that have a language, all columns as they were.

    Learns as the query does, from the fold that is not held out. Only texts that the query calls undetermined go: null
    ones and those without a letter. Without any learned language letters decide as well. Null ids are kept by the same rule.
    """
    model = fit(docs, ~held_out(F.col("doc_id")), path)
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            if model.languages:
                keep = [label != UNDETERMINED for label in judge.judge(texts)[0]]
            else:
                keep = [t is not None and LETTER.search(t.decode("utf-8", "replace")) is not None for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    # Plain names meanwhile: a dot in a name would be read as a field of it.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
