"""Byte-level BPE: pre-tokenisation by scans over code points, cached merging of pairs, decoding by kept offsets.

Pre-tokenisation uses no regular expression. Every code point gets a class by table, and with the classes of the next two
a symbol; a symbol is a function from the states of a small automaton to its states. Composition of functions is
associative, and all compositions together are a few dozen, so a scan over their numbers gives the state before every
code point with table look-ups on whole arrays: within blocks first, then over the blocks. State and symbol tell where a
piece starts. The cuts are those of ``public_tokenizers.PATTERN``. What a letter, a number and a space is, is read from the
tokenizer library once on the driver, so that both know the same Unicode version.

Encoding. The pieces are slices of the text's UTF-8 bytes. A piece that has a rank is one token; otherwise neighbours are
merged, lowest rank first and leftmost among equals; long pieces from a heap over a linked list, so that n bytes cost
n log n. Short pieces are remembered, a bounded number of them. With each token its first byte in the text is kept.

Decoding. The bytes of a document's tokens are laid at their kept offsets, many tokens at a time.

Defined results. A null or empty text has no tokens and decodes to no bytes. Bytes that are no UTF-8 are read as U+FFFD.
Texts are encoded whole, whatever their length; a very long one goes through the scan in chunks that hand on the state.
Names of special tokens are ordinary text. Repeated rows are encoded alike, a null id stays null. An empty table gives an
empty result. Other columns are not read. The rank file must exist on every executor.
"""

from __future__ import annotations

import heapq
import os
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import table

RANK_FILE = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")
# Pieces remembered, and the longest of them in bytes: about 70 MB as a rule, 150 MB at most.
REMEMBERED, LONGEST = 500_000, 64
# Code points of a chunk of the scan, and of the texts that are encoded together.
CHUNK = 1 << 20
# Tokens decoded at once.
TOKENS = 1 << 18
BLOCK = 64
# Greater than any rank.
NONE = 1 << 31

# Classes of code points. END stands behind a text.
OTHER, LETTER, NUMBER, SPACE, BLANK, END = range(6)
END_CODE = 0x110000
# Symbols: a class, told apart by what follows. JOINER is the blank before a visible character, EDGE another space there,
# SPACES a space before a space or the end; SHORT and LONG are apostrophes of contractions with one and two letters.
LETTERS, NUMBERS, OTHERS, JOINER, EDGE, SPACES, SHORT, LONG, STOP = range(9)
# States: what the piece that holds the code point before may still take. CLOSED takes nothing.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINED, IN_SPACES, ONE_MORE, TWO_MORE = range(8)
STATES = 8
# Letters after the apostrophe of a contraction.
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")


def step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a piece starts here)."""
    if symbol == STOP:
        return CLOSED, False
    if symbol == LETTERS and state in (ONE_MORE, TWO_MORE):
        return (ONE_MORE if state == TWO_MORE else CLOSED), False
    runs = {LETTERS: IN_LETTERS, NUMBERS: IN_NUMBERS, OTHERS: IN_OTHERS}
    if symbol in runs:
        return runs[symbol], state not in (runs[symbol], JOINED)
    if symbol in (SHORT, LONG):
        if state in (IN_OTHERS, JOINED):
            return IN_OTHERS, False
        return (ONE_MORE if symbol == SHORT else TWO_MORE), True
    if symbol == SPACES:
        return IN_SPACES, state != IN_SPACES
    return (JOINED if symbol == JOINER else CLOSED), True


class Scan:
    """The automaton's transition functions, closed under composition, as tables of numbers."""

    def __init__(self):
        functions = [tuple(step(state, symbol)[0] for state in range(STATES)) for symbol in range(STOP + 1)]
        identity = tuple(range(STATES))
        number = {f: i for i, f in enumerate(dict.fromkeys([identity, *functions]))}
        todo = list(number)
        while todo:
            first = todo.pop()
            for then in functions:
                both = tuple(then[s] for s in first)
                if both not in number:
                    number[both] = len(number)
                    todo.append(both)
        every = list(number)
        self.count = len(every)
        self.identity = np.uint16(number[identity])
        self.of_symbol = np.array([number[f] for f in functions], dtype=np.uint16)
        self.apply = np.array(every, dtype=np.uint8).reshape(-1)
        self.compose = np.array([number[tuple(b[s] for s in a)] for a in every for b in every], dtype=np.uint16)
        self.starts = np.array([step(state, symbol)[1] for symbol in range(STOP + 1) for state in range(STATES)])

    def before(self, functions: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """The state before each function is applied, and the state after all."""
        size = len(functions)
        if size <= BLOCK:
            states = np.empty(size, dtype=np.uint8)
            for i, f in enumerate(functions.tolist()):
                states[i] = state
                state = int(self.apply[f * STATES + state])
            return states, state
        rows = -(-size // BLOCK)
        padded = np.full(rows * BLOCK, self.identity, dtype=np.uint16)
        padded[:size] = functions
        laid = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
        done = np.empty_like(laid)
        done[0] = self.identity
        for i in range(1, BLOCK):
            done[i] = self.compose[done[i - 1] * np.uint16(self.count) + laid[i - 1]]
        totals = self.compose[done[-1] * np.uint16(self.count) + laid[-1]]
        at_block, state = self.before(totals, state)
        states = self.apply[done * np.uint16(STATES) + at_block]
        return states.T.reshape(-1)[:size], state


def class_ranges() -> tuple[list[int], list[int]]:
    """(first code points, classes) of the ranges of code points of one class, as the tokenizer library knows them."""
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, END_CODE))))
    classes = np.full(END_CODE + 1, OTHER, dtype=np.uint8)
    single = {bytes([i]): i for i in range(256)}
    for kind, members in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = tiktoken.Encoding("class", pat_str=members, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        classes[np.frombuffer(bytes(found).decode("utf-8").encode("utf-32-le"), dtype=np.uint32)] = kind
    classes[ord(" ")], classes[END_CODE] = BLANK, END
    first = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
    return first.tolist(), classes[first].tolist()


class PreTokenizer:
    """Finds where the pieces of texts start."""

    def __init__(self, ranges: tuple[list[int], list[int]]):
        first, kinds = ranges
        self.classes = np.repeat(np.array(kinds, dtype=np.uint8), np.diff([*first, END_CODE + 1]))
        self.scan = Scan()
        self.plain = np.array([OTHERS, LETTERS, NUMBERS, SPACES, SPACES, STOP], dtype=np.uint8)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of all codes but the last two, which only follow."""
        kinds = self.classes[codes]
        symbols = self.plain[kinds[:-2]]
        visible = kinds[1:-1] < SPACE
        symbols[(kinds[:-2] == BLANK) & visible] = JOINER
        symbols[(kinds[:-2] == SPACE) & visible] = EDGE
        quotes = np.flatnonzero(codes[:-2] == ord("'"))
        if len(quotes):
            one, two = codes[quotes + 1], codes[quotes + 2]
            symbols[quotes[np.isin(one, [ord(c) for c in ONE_LETTER])]] = SHORT
            for a, b in TWO_LETTERS:
                symbols[quotes[(one == ord(a)) & (two == ord(b))]] = LONG
        return symbols

    def starts(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first code of a chunk, codes of the chunk at which a piece or an end starts); ``codes`` ends in two END_CODE."""
        state, size = CLOSED, len(codes) - 2
        for at in range(0, size, CHUNK):
            part = codes[at : min(at + CHUNK, size) + 2]
            symbols = self.symbols(part)
            before, state = self.scan.before(self.scan.of_symbol[symbols], state)
            yield at, np.flatnonzero(self.scan.starts[symbols * np.uint8(STATES) + before] | (symbols == STOP))

    def pieces(self, texts: list[str]) -> Iterator[list[bytes]]:
        """The pieces of each text, as UTF-8."""
        # One more sign behind every text marks its end, and two follow the last.
        joined = "\n".join([*texts, "", "", ""])
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).copy()
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        codes[ends] = codes[-2:] = END_CODE
        data = joined.encode("utf-8")
        found, is_end, base = [], [], 0
        for at, starts in self.starts(codes):
            part = codes[at : at + CHUNK]
            wide = 1 + (part > 0x7F).astype(np.int64) + (part > 0x7FF) + (part > 0xFFFF)
            wide[part == END_CODE] = 1
            offsets = np.cumsum(wide) - wide + base
            found.append(offsets[starts])
            is_end.append(part[starts] == END_CODE)
            base = int(offsets[-1] + wide[-1])
        cuts, stops = np.concatenate(found), np.flatnonzero(np.concatenate(is_end))
        bounds = cuts.tolist()
        first = 0
        for stop in stops[: len(texts)].tolist():
            yield [data[a:b] for a, b in zip(bounds[first:stop], bounds[first + 1 : stop + 1], strict=True)]
            first = stop + 1


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merger(dict):
    """Token ids of pieces, as the bytes of 32-bit numbers; pairs are merged for pieces that are not remembered.

    Pieces are remembered in two halves: when the newer is full it becomes the older, and what is met again moves back.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def __missing__(self, piece: bytes) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            rank = self.ranks.get(piece)
            packed = np.array(self.merged(piece) if rank is None else (rank,), dtype=np.int32).tobytes()
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def ids(self, pieces: Iterable[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, pieces)), dtype=np.int32)

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """Merge pairs until none has a rank; ``pair[i]`` is the rank of part i with the next one, or NONE."""
        if len(piece) > LONGEST:
            return self.merged_long(piece)
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pair = [rank(piece[i : i + 2], NONE) for i in range(len(piece) - 1)]
        pair.append(NONE)
        while (least := min(pair)) != NONE:
            at = pair.index(least)
            parts[at] = here = parts[at] + parts.pop(at + 1)
            del pair[at]
            pair[at] = NONE if at + 1 == len(parts) else rank(here + parts[at + 1], NONE)
            if at:
                pair[at - 1] = rank(parts[at - 1] + here, NONE)
        return tuple([self.ranks[p] for p in parts])

    def merged_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a linked list and a heap; ``pair[i]`` is the rank of the token at byte i with the next one, or -1."""
        ranks, size = self.ranks, len(piece)
        after, before = array("i", range(1, size + 1)), array("i", range(-1, size - 1))
        pair = array("i", [ranks.get(piece[i : i + 2], -1) for i in range(size - 1)] + [-1])
        # A heap entry is rank and place in one number; one that no longer says what ``pair`` says is passed over.
        heap = [rank << 32 | i for i, rank in enumerate(pair) if rank >= 0]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            at = entry & 0xFFFFFFFF
            if pair[at] != entry >> 32:
                continue
            gone = after[at]
            pair[gone] = -1
            after[at] = follower = after[gone]
            if follower < size:
                before[follower] = at
            for left in (before[at], at):
                if left < 0:
                    continue
                right = after[left]
                rank = ranks.get(piece[left : after[right]], -1) if right < size else -1
                pair[left] = rank
                if rank >= 0:
                    heapq.heappush(heap, rank << 32 | left)
        ids, at = [], 0
        while at < size:
            ids.append(ranks[piece[at : after[at]]])
            at = after[at]
        return tuple(ids)


class Vocabulary:
    """The bytes of all tokens in one array."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> bytes:
        """The bytes of one document; token i is laid at ``starts[i]``."""
        if not len(ids):
            return b""
        out = np.empty(int(starts[-1]) + int(self.lengths[ids[-1]]), dtype=np.uint8)
        for at in range(0, len(ids), TOKENS):
            part, place = ids[at : at + TOKENS], starts[at : at + TOKENS].astype(np.int64)
            lengths = self.lengths[part]
            within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            out[np.repeat(place, lengths) + within] = self.data[np.repeat(self.first[part], lengths) + within]
        return out.tobytes()


def bundles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """(ids, texts) of rows whose texts hold about a chunk together, or of one longer text."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            ids.append(doc.as_py())
            texts.append((text.as_py() or b"").decode("utf-8", "replace"))
            held += len(texts[-1])
            if held >= CHUNK:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def encoded(docs: DataFrame, path: str = RANK_FILE) -> DataFrame:
    """(doc_id, ids, starts) of every row: token ids and the first byte of each token in the text's UTF-8."""
    ranges = class_ranges()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, ranks = PreTokenizer(ranges), read_ranks(path)
        merger, lengths = Merger(ranks), Vocabulary(ranks).lengths
        for doc_ids, texts in bundles(batches):
            found, starts, ends = [], [], [0]
            for pieces in cutter.pieces(texts):
                ids = merger.ids(pieces)
                sizes = lengths[ids]
                found.append(ids)
                starts.append((np.cumsum(sizes) - sizes).astype(np.int32))
                ends.append(ends[-1] + len(ids))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c), pa.int32())) for c in (found, starts)]
            yield pa.record_batch([pa.array(doc_ids, pa.int64()), *lists], names=["doc_id", "ids", "starts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, starts array<int>")


def decoded(tokens: DataFrame, path: str = RANK_FILE) -> DataFrame:
    """(doc_id, ids, bytes) of encoded rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(read_ranks(path))
        for batch in batches:
            ids, starts = batch.column("ids"), batch.column("starts")
            for row in range(batch.num_rows):
                pair = (ids[row].values.to_numpy(), starts[row].values.to_numpy())
                yield pa.record_batch([batch.column("doc_id").slice(row, 1), ids.slice(row, 1), pa.array([vocabulary.decode(*pair)], pa.binary())], names=["doc_id", "ids", "bytes"])

    return tokens.select("doc_id", "ids", "starts").mapInArrow(run, "doc_id long, ids array<int>, bytes binary")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decoded(encoded(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
