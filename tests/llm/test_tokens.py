import random

import pytest

from trackspark.llm.langid import MODEL_FILE
from trackspark.llm.tokens import Counter, count_tokens, op8_tokens, pieces_of


def library(pieces):
    """The same unigram model as the tokenizers library runs it."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False)
    made = Tokenizer(model)
    made.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return made


@pytest.fixture(scope="module")
def public():
    pieces = pieces_of(MODEL_FILE)
    return Counter(pieces), library(pieces)


def test_counts_equal_the_library_on_odd_texts(public):
    counter, made = public
    texts = ["", " ", "a", "  a  b ", "▁x", "a▁b", "tab\there\n\nnew", "中文字𝄞𝄞𝄞 x𝄞", "\x1c\x85", "été naïve ÀÉ", "x" * 300, "##$$ 123,45"]
    rng = random.Random(7)
    letters = "aeinstr  .é▁𝄞中\n1"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    for text in texts:
        assert counter.text(text) == len(made.encode(text, add_special_tokens=False).ids), repr(text)


def test_ties_equal_the_library():
    pieces = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("bb", -2.0), ("▁a", -2.0)]
    # The library's unknown score lies below the lowest score, that of <unk> not counted lower.
    counter, made = Counter(pieces), library(pieces)
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 14)))
        assert counter.text(text) == len(made.encode(text, add_special_tokens=False).ids), repr(text)


def test_rows_of_all_kinds(spark):
    rows = [(1, None, 3), (2, "", 3), (3, "word " * 30_000, 3), (3, "word " * 30_000, 3), (None, "the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    out = sorted(((r.doc_id, r.n_tokens) for r in count_tokens(docs).collect()), key=str)
    word = Counter(pieces_of(MODEL_FILE))
    assert out == sorted([(1, 0), (2, 0), (3, word.text(rows[2][1])), (3, word.text(rows[2][1])), (None, word.text("the"))], key=str)
    assert count_tokens(docs.limit(0)).count() == 0


def test_given_documents(spark, public):
    folder = "/root/testdata/sf0.001"
    _, made = public
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op8_tokens(spark, folder).collect()
    assert len(rows) == len(texts)
    assert all(r.n_tokens == len(made.encode(texts[r.doc_id], add_special_tokens=False).ids) for r in rows)


def test_a_very_long_part_takes_little_memory(public):
    import tracemalloc

    counter, made = public
    text = "nation" * 30_000
    tracemalloc.start()
    count = counter.text(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(text) and text not in counter.known
    short = "nation" * 400
    assert counter.text(short) == len(made.encode(short, add_special_tokens=False).ids) and count >= 30_000
