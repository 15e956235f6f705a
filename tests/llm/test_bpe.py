import hashlib
import random

import pytest

from trackspark.llm import bpe
from trackspark.llm.bpe import Merger, PreTokenizer, Vocabulary, class_ranges, decoded, encoded, op11_bpe, read_ranks

ALPHABET = "abrevlstmdé'' ''  \n\t\xa0　 1٣½中𝄞𞤀\x1c\x85.,#!-\x00A"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def cutter():
    return PreTokenizer(class_ranges())


@pytest.fixture(scope="module")
def merger():
    return Merger(read_ranks(bpe.RANK_FILE))


def drawn(count, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))) for _ in range(count)]


def ids_of(merger, pieces):
    return merger.ids(pieces).tolist()


def test_ids_equal_the_library_on_odd_texts(cutter, merger, library):
    texts = ["", " ", "  ", "'s", " 's", "''s", "'re'll", "x'Re", "\n a", " \n", "a  b", "\xa0'd", "<|endoftext|>", *drawn(5000, 40, 1)]
    for text, pieces in zip(texts, cutter.pieces(texts), strict=True):
        assert ids_of(merger, pieces) == library.encode_ordinary(text), repr(text)


def test_chunks_hand_on_the_state(cutter, merger, library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 7)
    texts = drawn(400, 60, 2)
    for text, pieces in zip(texts, cutter.pieces(texts), strict=True):
        assert ids_of(merger, pieces) == library.encode_ordinary(text), repr(text)


def test_pieces_without_a_cut(cutter, merger, library):
    rng = random.Random(5)
    for text in ("a" * 30_000, "".join(rng.choice("abc") for _ in range(50_000)), " " * 20_000, "中" * 5000, "-" * 9999):
        assert ids_of(merger, next(cutter.pieces([text]))) == library.encode_ordinary(text)


def test_both_ways_of_merging_agree(merger):
    rng = random.Random(11)
    for _ in range(2000):
        piece = "".join(rng.choice("etaoin sé'") for _ in range(rng.randrange(1, 30))).encode()
        assert merger.merged(piece) == merger.merged_long(piece)


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    small = Merger(read_ranks(bpe.RANK_FILE))
    for i in range(500):
        assert small.ids([b"word%d" % i, b"word%d" % (i // 2)]).tolist() == [*small.merged(b"word%d" % i), *small.merged(b"word%d" % (i // 2))]
        assert len(small) + len(small.older) <= 50


def test_tables_read_many_tokens_at_a_time(merger, monkeypatch):
    import numpy as np

    monkeypatch.setattr(bpe, "TOKENS", 3)
    text = "several words, one 𝄞 and more".encode()
    ids = np.array(merger.merged(text), dtype=np.int32)
    vocabulary = Vocabulary(read_ranks(bpe.RANK_FILE))
    sizes = vocabulary.lengths[ids]
    assert vocabulary.decode(ids, np.cumsum(sizes) - sizes) == text


def test_rows_of_all_kinds(spark, library):
    long = "word's  end\n" * 150_000
    rows = [(1, None, 3, "x"), (2, "", 3, "x"), (3, long, 3, "x"), (3, long, 3, "x"), (None, "the 𝄞 it's", None, None), (4, "the 𝄞 it's", 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long, starts string")
    out = decoded(encoded(docs)).collect()
    want = sorted(((d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t, _, _ in rows), key=str)
    assert sorted(((r.doc_id, r.ids, bytes(r.bytes)) for r in out), key=str) == want
    for r in encoded(docs.filter("doc_id = 4")).collect():
        assert [library.decode_single_token_bytes(i) for i in r.ids] == [
            "the 𝄞 it's".encode()[a:b] for a, b in zip(r.starts, [*r.starts[1:], None], strict=True)
        ]
    assert decoded(encoded(docs.limit(0))).count() == 0


def test_text_that_is_no_utf8(spark, library):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    row = decoded(encoded(docs)).first()
    assert bytes(row.bytes) == "a�b".encode() and row.ids == library.encode_ordinary("a�b")


def test_given_documents(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op11_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
