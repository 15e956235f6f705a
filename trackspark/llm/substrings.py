"""Removal of repeated word sequences of a given length, found by winnowed blocks at the symbol starts of recompression.

Names. Round 0 names words, round 1 maximal runs of one word (three and more), round 2 pairs (a symbol of the left
half of a coin-tossed alphabet followed by one of the right half; only where they begin is kept), round 3 blocks of ``BLOCK`` words that begin where a
symbol begins and whose name is least among ``NEAR`` neighbours. Only blocks are
compared across texts: their names are content hashes, so all tasks agree on them without a dictionary, and equal passages get equal interior symbols: whether a symbol begins at a word depends on
at most three words on either side, unless a run lies there.

Reveal. Per bucket of names a task finds the block names that occur more than once. Any two equal windows of ``WINDOW``
words share one: of a window's words the middle ones from the 4th to the 18th have the same symbols wherever the
window stands, they hold at least ``NEAR`` symbol starts with a whole block inside the window, and the least of these
is chosen in both. Windows that touch a run of three and more are candidates without such a proof.

Verify. Only windows around revealed blocks are hashed whole (96 bits); per bucket of these hashes a task keeps the
earliest (document, start) and marks all others. Marked windows meet their texts again, whose covered words go.

Scale. Before a shuffle, equal names of one task's documents are reduced to their earliest place: a passage that a
third of all documents share sends one entry per task and not one per document. Entries travel as packed arrays.
Texts are shuffled once, by bucket of their id and text, and read from that shuffle twice. Buckets are as many as the input's
bytes demand (``BUCKET_BYTES`` of text each), so a task's memory does not grow with the input, whatever ids repeat; equal
rows are one bucket.

Defined results. A null or empty text has no words. Rows with one id and one text are one document and get one result
each; rows with one id and different texts count as one document in the order of starts, but words are removed from
the right one: texts of one id are told apart by 64 bits. A text without an id is a document of its own, known by 126 bits; such
texts come in the order of a hash of theirs, before all ids from -2^62 on. Texts are processed whole. An empty table gives an empty result.
Other columns are not read. Equality of words and windows is that of their 64- and 96-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import mixed, rolled, slices, table, word_hashes

WINDOW = 20
BLOCK, NEAR = 6, 6
LONG_RUN = 3
BUCKET_BYTES = 16 << 20
# Entries a task gathers before it reduces and sends them.
GATHERED = 1_000_000
# Texts without an id have numbers from here on, up to LAST_NO_ID.
NO_ID, LAST_NO_ID = -(2**63), -(2**62) - 1
SECOND_BASE = 0xC2B2AE3D27D4EB4F
PARTS = "kind int, bucket int, names binary, more binary, docs binary, prints binary, places binary"
PARTS_ARROW = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32())]
    + [(n, pa.binary()) for n in ("names", "more", "docs", "prints", "places")]
)
NAMED, SETTLED = 1, 0


def boundaries(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the symbols after the rounds of runs and pairs, and (start, length) rows of the long runs."""
    count = len(words)
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    lengths = np.diff(np.append(first, count))
    long = lengths >= LONG_RUN
    # Only long runs become one symbol; others stay single words.
    inside = np.zeros(count, dtype=bool)
    runs = np.stack([first[long], lengths[long]], axis=1)
    for start, length in runs:
        inside[start + 1 : start + length] = True
    starts = np.flatnonzero(~inside)
    names = words[starts]
    if len(runs):
        at = np.searchsorted(starts, runs[:, 0])
        names = names.copy()
        names[at] = mixed(names[at] + mixed(runs[:, 1].astype(np.uint64)))
    side = (mixed(names) & np.uint64(1)).astype(bool)
    paired = np.zeros(len(starts), dtype=bool)  # the second of a pair begins no symbol
    paired[1:] = ~side[:-1] & side[1:]
    return starts[~paired], runs


def blocks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, name) of the chosen blocks."""
    starts, _ = boundaries(words)
    names = rolled(words, BLOCK)
    starts = starts[starts < len(names)]
    if not len(starts):
        return starts, names[:0]
    names = names[starts]
    if len(starts) > NEAR:
        view = np.lib.stride_tricks.sliding_window_view(names, NEAR)
        chosen = np.unique(view.argmin(axis=1) + np.arange(len(view)))
        starts, names = starts[chosen], names[chosen]
    return starts, names


def near_runs(words: np.ndarray) -> list[int]:
    """Places that, taken as blocks, make every window touching a long run a candidate."""
    out = []
    reach = WINDOW - BLOCK
    for start, length in boundaries(words)[1].tolist():
        place = start + length - 1
        while place >= 0 and place + reach >= start - WINDOW + 1:
            out.append(place)
            place -= reach + 1
    return out


def candidate_starts(places: np.ndarray, count: int) -> np.ndarray:
    """Starts of all windows that hold a block at one of the places."""
    marks = np.zeros(count + 1, dtype=np.int32)
    lowest = np.clip(places - (WINDOW - BLOCK), 0, count)
    np.add.at(marks, lowest, 1)
    np.add.at(marks, np.clip(places + 1, 0, count), -1)
    starts = np.flatnonzero(np.cumsum(marks)[:count] > 0)
    return starts[starts <= count - WINDOW]


class Entries:
    """Growing columns of (name, second name, document, print, place), reduced and packed by bucket."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.held = buckets, [], 0

    def add(self, names: np.ndarray, more: np.ndarray, doc: int, fingerprint: int, places: np.ndarray) -> None:
        size = len(names)
        if size:
            self.parts.append((names, more, np.full(size, doc), np.full(size, fingerprint, dtype=np.uint64), places.astype(np.uint32)))
            self.held += size

    def reduced(self, all_of_repeated: bool) -> Iterator[pa.RecordBatch]:
        """Earliest entry of each name by hash bucket; the others, settled, by bucket of their document.

        ``all_of_repeated``: the earliest is settled too where there are others (revealing), else it is not (verifying).
        """
        if not self.parts:
            return
        names, more, docs, prints, places = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        order = np.lexsort((places, docs, more, names))
        names, more, docs, prints, places = (c[order] for c in (names, more, docs, prints, places))
        leads = np.concatenate([[True], (names[1:] != names[:-1]) | (more[1:] != more[:-1])])
        # One window met at one place of one document twice is the same window: rows of one id and one text.
        same_place = np.concatenate([[False], ~leads[1:] & (docs[1:] == docs[:-1]) & (places[1:] == places[:-1])])
        settled = ~leads
        if all_of_repeated:
            settled |= np.append(~leads[1:], False)
        elif same_place.any():
            group = np.cumsum(leads) - 1
            at = np.flatnonzero(leads)[group]
            settled &= (docs != docs[at]) | (places != places[at])
        bucket = (names[leads] % np.uint64(self.buckets)).astype(np.int64)
        yield from packed(NAMED, bucket, names[leads], more[leads], docs[leads], prints[leads], places[leads])
        if settled.any():
            yield from settled_rows(docs[settled], prints[settled], places[settled], self.buckets)


def doc_bucket(docs: np.ndarray, prints: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(docs.astype(np.int64).view(np.uint64) ^ mixed(prints)) % np.uint64(buckets)).astype(np.int64)


def packed(kind: int, bucket: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per bucket with the entries as arrays of bytes, by document and place."""
    names, more, docs, prints, places = columns
    order = np.lexsort((places, docs, bucket))
    bucket = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    kept = [c[order] if c is not None else None for c in (names, more, docs, prints, places)]
    rows = [
        (kind, int(bucket[a]), *(None if c is None else c[a:b].tobytes() for c in kept))
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    for start in range(0, len(rows), 64):
        yield pa.record_batch(list(map(list, zip(*rows[start : start + 64], strict=True))), schema=PARTS_ARROW)


def settled_rows(docs: np.ndarray, prints: np.ndarray, places: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    yield from packed(SETTLED, doc_bucket(docs, prints, buckets), None, None, docs, prints, places)


def unpacked(rows: pa.Table | pa.RecordBatch, named: bool) -> list[np.ndarray]:
    """The columns of packed rows, joined: (names, more,) docs, prints, places."""
    kinds = ([("names", np.uint64), ("more", np.uint32)] if named else []) + [
        ("docs", np.int64), ("prints", np.uint64), ("places", np.uint32),
    ]
    return [np.frombuffer(b"".join(x.as_py() for x in rows.column(n)), dtype=k) for n, k in kinds]


def fingerprint(text: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text)


def numbers_of(ids: list[int | None], texts: list[bytes]) -> np.ndarray:
    """The ids as numbers; a text without one has a number by another hash than its print."""
    import xxhash

    span = LAST_NO_ID - NO_ID + 1
    return np.array([NO_ID + xxhash.xxh64_intdigest(t, 1) % span if i is None else i for i, t in zip(ids, texts, strict=True)], dtype=np.int64)


def reveal(buckets: int):
    """Block names of each text, and the places settled at once: repeats within the task and long runs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = Entries(buckets)
        for batch in slices(batches):
            runs: list[tuple[int, int, int]] = []
            texts = batch.column("text").to_pylist()
            for doc, text in zip(numbers_of(batch.column("doc_id").to_pylist(), texts).tolist(), texts, strict=True):
                words = word_hashes(text)
                if len(words) < WINDOW:
                    continue
                mark = fingerprint(text)
                places, names = blocks(words)
                entries.add(names, np.zeros(len(names), dtype=np.uint32), doc, mark, places)
                runs += [(doc, mark, p) for p in near_runs(words)]
            if runs:
                docs, prints, places = (np.array(c, dtype=k) for c, k in zip(zip(*runs, strict=True), (np.int64, np.uint64, np.uint32), strict=True))
                yield from settled_rows(docs, prints, places, buckets)
            if entries.held >= GATHERED:
                yield from entries.reduced(True)
        yield from entries.reduced(True)

    return run


def judged(buckets: int, all_of_repeated: bool):
    """Settle the entries of one bucket; settled ones pass through."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key[0].as_py() == SETTLED:
            yield from batches
            return
        names, more, docs, prints, places = (
            np.concatenate(c) for c in zip(*(unpacked(b, True) for b in batches), strict=True)
        )
        order = np.lexsort((places, docs, more, names))
        names, more, docs, prints, places = (c[order] for c in (names, more, docs, prints, places))
        same = (names[1:] == names[:-1]) & (more[1:] == more[:-1])
        later = np.concatenate([[False], same])
        if all_of_repeated:
            chosen = later | np.append(same, False)
        else:
            at = np.flatnonzero(~later)[np.cumsum(~later) - 1]
            chosen = later & ((docs != docs[at]) | (places != places[at]))
        if chosen.any():
            yield from settled_rows(docs[chosen], prints[chosen], places[chosen], buckets)

    return run


def places_by_document(rows: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    docs, prints, places = unpacked(rows, False)
    if not len(docs):
        return {}
    order = np.lexsort((places, prints, docs))
    docs, prints, places = docs[order], prints[order], places[order].astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (prints[1:] != prints[:-1]), [True]]))
    return {(int(docs[a]), int(prints[a])): places[a:b] for a, b in zip(cuts, cuts[1:], strict=False)}


def verify(buckets: int):
    """Hash the candidate windows of a bucket's texts and reduce equal ones."""

    def run(revealed: pa.Table, own: pa.Table) -> pa.Table:
        found = places_by_document(revealed)
        entries, out = Entries(buckets), []
        if found:
            for batch in own.to_batches(max_chunksize=128):
                texts = batch.column("text").to_pylist()
                for doc, text in zip(numbers_of(batch.column("doc_id").to_pylist(), texts).tolist(), texts, strict=True):
                    mark = fingerprint(text)
                    places = found.get((doc, mark))
                    if places is None:
                        continue
                    words = word_hashes(text)
                    starts = candidate_starts(places, len(words))
                    names = rolled(words, WINDOW)[starts]
                    more = rolled(words, WINDOW, SECOND_BASE)[starts].astype(np.uint32)
                    entries.add(names, more, doc, mark, starts)
                if entries.held >= GATHERED:
                    out += entries.reduced(False)
            out += entries.reduced(False)
        return pa.Table.from_batches(out, schema=PARTS_ARROW)

    return run


KEPT = "doc_id long, n_words long, n_removed long, kept binary"
KEPT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def removed(digest: bool):
    """Drop the covered words of each text; what is left is joined by spaces, or its SHA-256."""

    def run(marked: pa.Table, own: pa.Table) -> pa.Table:
        found, rows = places_by_document(marked), []
        for batch in own.to_batches(max_chunksize=128):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for doc_id, doc, text in zip(ids, numbers_of(ids, texts).tolist(), texts, strict=True):
                words = text.split()
                starts, gone = found.get((doc, fingerprint(text))) if found else None, 0
                kept = words
                if starts is not None:
                    marks = np.zeros(len(words) + 1, dtype=np.int32)
                    np.add.at(marks, starts, 1)
                    np.add.at(marks, starts + WINDOW, -1)
                    covered = np.cumsum(marks)[: len(words)] > 0
                    gone = int(covered.sum())
                    kept = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                joined = b" ".join(kept)
                rows.append((doc_id, len(words), gone, hashlib.sha256(joined).hexdigest().encode() if digest else joined))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), KEPT_ARROW, strict=True)], schema=KEPT_ARROW) if rows else KEPT_ARROW.empty_table()

    return run


def remove_repeats(docs: DataFrame, digest: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept is the text left over as bytes, or its hexadecimal SHA-256."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )

    def bucket_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            prints = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
            own = doc_bucket(numbers_of(batch.column("doc_id").to_pylist(), texts), prints, buckets).astype(np.int32)
            yield pa.record_batch([pa.array(own), *batch.columns], names=["bucket", "doc_id", "text"])

    # The same grouped texts stand twice in the plan; Spark shuffles them once.
    texts = rows.mapInArrow(bucket_of, "bucket int, doc_id long, text binary").groupBy("bucket")
    blocks_found = rows.mapInArrow(reveal(buckets), PARTS)
    revealed = blocks_found.groupBy("kind", "bucket").applyInArrow(judged(buckets, True), PARTS)
    windows = revealed.groupBy("bucket").cogroup(texts).applyInArrow(verify(buckets), PARTS)
    marked = windows.groupBy("kind", "bucket").applyInArrow(judged(buckets, False), PARTS)
    return marked.groupBy("bucket").cogroup(texts).applyInArrow(removed(digest), KEPT)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_sha256"))


OP5_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM d WHERE len(w) >= {WINDOW})
), ranked AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY words ORDER BY doc_id, s) AS place FROM windows
), gone AS (
  SELECT DISTINCT doc_id, s + i AS p FROM ranked, range({WINDOW}) AS r(i) WHERE place > 1
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
