"""Quality rules: fixed base rules and a calibrated classifier of hashed word and character n-grams.

Features of a text are counts of its words, word pairs and byte 3- and 4-grams, hashed into ``DIMS`` cells, damped by
a logarithm and scaled to length one. A logistic regression learns the labelled quality from a bounded sample
(``LABELLED_ROWS``, the ids with the smallest hash, one text of each, so reruns agree); a fifth of the sample is kept apart
and turns margins into probabilities (Platt's two-parameter calibration). All texts are then scored in Arrow batches
against the fixed threshold ``KEEP_FROM``.

Defined results. A null or empty text has no words, fails the base rules and is not kept. Texts are processed whole.
Repeated rows are judged alike. A document labelled more than once counts as good only if all its labels say so;
labels that are null or neither 0 nor 1 do not count, nor do those of unknown documents. Without labels of both
kinds there is no verdict and the base rules decide alone (probability null). An empty table gives an empty result.
Words are compared by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import SPACES, mixed, rolled, slices, table, word_hashes

DIMS = 1 << 16
LABELLED_ROWS = 5_000
# One in so many sampled rows calibrates instead of training.
CALIBRATION_FOLD = 5
STEPS, PENALTY = 150, 1e-6
KEEP_FROM = 0.5
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, dtype=np.uint8))
OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, probability double"
)


def cells(text: bytes, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and counts of a text; words and pairs share one half of the cells, byte n-grams the other."""
    half = np.uint64(DIMS // 2 - 1)
    parts = [mixed(hashes) & half, rolled(hashes, 2) & half]
    codes = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    for width in (3, 4):
        parts.append((rolled(codes, width) & half) | np.uint64(DIMS // 2))
    ordered = np.sort(np.concatenate(parts).astype(np.uint16), kind="stable")  # a radix sort
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, dtype=np.int64)
    return ordered[at].astype(np.int64), np.diff(np.append(at, len(ordered)))


def weights_of(counts: np.ndarray) -> np.ndarray:
    """Damped counts, scaled to length one."""
    values = np.log1p(counts)
    return values / np.sqrt((values * values).sum())


def base_facts(text: bytes, hashes: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    codes = np.frombuffer(text, dtype=np.uint8)
    # Words hold all code points but the six spaces; a code point has one byte that continues none.
    chars = int(((codes & 0xC0) != 0x80).sum()) - int(SPACES[codes].sum())
    seen, repeated_lines = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated_lines += 1
        elif line.strip():
            seen.add(line)
    windows = rolled(hashes, 3)
    repeats = 0
    if len(windows) > 1:
        order = np.argsort(windows)
        same = windows[order[1:]] == windows[order[:-1]]
        if same.any():
            covered = np.zeros(len(hashes), dtype=bool)
            starts = np.concatenate([order[1:][same], order[:-1][same]])
            for step in range(3):
                covered[starts + step] = True
            repeats = int(covered.sum())
    return chars, int(IS_SYMBOL[codes].sum()), repeated_lines, repeats


@dataclass
class Model:
    weights: np.ndarray
    slope: float
    offset: float

    def probability(self, margin: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse features of the sampled texts: cell numbers of two bytes, counts of four."""
    for batch in slices(batches):
        found = []
        for text in batch.column("text").to_pylist():
            at, counts = cells(text, word_hashes(text))
            found.append((at.astype(np.uint16).tobytes(), counts.astype(np.uint32).tobytes()))
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("quality"),
                pa.array([f[0] for f in found], pa.binary()),
                pa.array([f[1] for f in found], pa.binary()),
            ],
            names=["doc_id", "quality", "cells", "counts"],
        )


def trained(cell_rows: list[np.ndarray], value_rows: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression (last: intercept) by accelerated gradient steps over sparse rows.

    Rows have length one, the intercept adds one, so the loss is smooth with constant 1/2 and steps of 2 are safe.
    """
    sizes = np.array([len(c) for c in cell_rows])
    at, values = np.concatenate(cell_rows), np.concatenate(value_rows)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    weights = np.zeros(DIMS + 1)
    ahead, pace = weights.copy(), 1.0
    # The classes weigh the same, however many labels each has.
    share = target.mean()
    worth = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)) / len(target)
    for _ in range(STEPS):
        margin = np.add.reduceat(ahead[at] * values, starts) + ahead[-1]
        slope = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - target) * worth
        gradient = np.append(np.bincount(at, weights=values * slope[row_of], minlength=DIMS), slope.sum())
        gradient[:-1] += PENALTY * ahead[:-1]
        new = ahead - 2.0 * gradient
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, weights, pace = new + (pace - 1) / next_pace * (new - weights), new, next_pace
    return weights


def calibrated(margins: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Platt's slope and offset by Newton steps, with his smoothed targets; the slope never turns negative."""
    good = target.sum()
    bad = len(target) - good
    wanted = np.where(target == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -500, 500)))
        gap, spread = p - wanted, p * (1 - p) + 1e-9
        g = np.array([(gap * margins).sum(), gap.sum()])
        h = np.array([[(spread * margins * margins).sum(), (spread * margins).sum()], [(spread * margins).sum(), spread.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        slope, offset = slope - np.clip(step[0], -2, 2), offset - np.clip(step[1], -2, 2)
    return max(slope, 0.0), offset


def fit(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> Model | None:
    """Learn from at most ``most`` labelled documents; None without labels of both kinds in both parts."""
    known = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("known"))
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    # The bound of the sample bounds the broadcast: two numbers for each of ``most`` rows.
    sample = known.orderBy(F.xxhash64("known"), "known").limit(most)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(
        F.broadcast(sample), F.col("doc_id") == F.col("known")
    )
    # One text of each id, the least by a hash: the sample is bounded in rows, whatever ids repeat.
    first = F.min_by("text", F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))).alias("text")
    each = rows.filter(F.col("text").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    shaped = each.agg(F.first("quality").alias("quality"), first).select("doc_id", "quality", "text")
    found = shaped.mapInArrow(featured, "doc_id long, quality int, cells binary, counts binary").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("cells", "ascending")])
    target = found.column("quality").to_numpy()
    at = [np.frombuffer(c.as_py(), dtype=np.uint16).astype(np.int64) for c in found.column("cells")]
    values = [weights_of(np.frombuffer(c.as_py(), dtype=np.uint32)) for c in found.column("counts")]
    use = np.array([len(c) > 0 for c in at], dtype=bool)
    fold = mixed(found.column("doc_id").to_numpy().astype(np.uint64)) % np.uint64(CALIBRATION_FOLD) == 0
    parts = [np.flatnonzero(use & ~fold), np.flatnonzero(use & fold)]
    if any(len(np.unique(target[p])) < 2 for p in parts):
        return None
    weights = trained([at[i] for i in parts[0]], [values[i] for i in parts[0]], target[parts[0]])
    margins = np.array([weights[at[i]] @ values[i] + weights[-1] for i in parts[1]])
    return Model(weights, *calibrated(margins, target[parts[1]]))


def judge(docs: DataFrame, model: Model | None) -> DataFrame:
    """Base facts, probability and verdict of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                text = text or b""
                hashes = word_hashes(text)
                facts = base_facts(text, hashes)
                failed = len(hashes) < LEAST_WORDS or 100 * facts[3] > MOST_REPEATED_PERCENT * len(hashes)
                chance = None
                if model is not None and len(hashes):
                    at, counts = cells(text, hashes)
                    chance = model.probability(model.weights[at] @ weights_of(counts) + model.weights[-1])
                rows.append((len(hashes), *facts, failed, not failed and (chance is None or chance >= KEEP_FROM), chance))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"]
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, OUT)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, model)
