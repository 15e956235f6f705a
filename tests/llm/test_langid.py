import math
import zlib

import numpy as np

from trackspark.llm import langid
from trackspark.llm.langid import Judge, Model, fit, held_out, identified, long_word, op7_langid, predict, vocabulary

FOLDER = "/root/testdata/sf0.01"


def small_model(kinds=2):
    vocab = vocabulary(langid.MODEL_FILE)
    rng = np.random.default_rng(3)
    shares = rng.random((len(vocab.number) + 1, kinds))
    return Model([f"l{i}" for i in range(kinds)], np.zeros(kinds), np.log(shares / shares.sum(axis=0)), langid.MODEL_FILE)


def brute(word, model, vocab, kind):
    """Sum over every segmentation, by recursion on the first piece."""
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        piece = vocab.number.get(word[:n])
        if piece is None and n == 1:
            piece = -1
        if piece is not None:
            total += math.exp(model.logs[piece, kind]) * brute(word[n:], model, vocab, kind)
    return total


def test_forward_pass_sums_all_segmentations():
    model = small_model()
    judge = Judge(model)
    words = ["▁the", "▁nation", "▁été", "▁x", "▁一a", "▁aaaaaaa", "▁"]
    judge.learn(words)
    for word in words:
        expected = [math.log(brute(word, model, judge.vocab, k)) for k in (0, 1)]
        np.testing.assert_allclose(judge.logs[judge.row_of[word]], expected, rtol=1e-9)
        np.testing.assert_allclose(long_word(word, model, judge.vocab), expected, rtol=1e-9)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = op7_langid(spark, FOLDER).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    long = "the " * 20_000 + "e" * 50_000
    rows = [(i, t, "en" if i % 2 else "fr", "clash") for i, t in enumerate(["the of and", "le la de"] * 6)]
    rows = [(i, rows[(i + 1) % 2][1] if lang == "fr" else "the of and", lang, c) for i, _, lang, c in rows]
    odd = [(50, None, "en", None), (51, "", None, None), (52, "123 --", "en", None), (53, long, None, None), (53, long, None, None), (None, "of the", None, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = fit(docs, ~held_out(docs.doc_id))
    out = {r.doc_id: r for r in predict(docs, model).collect()}
    assert [out[i].lang_pred for i in (50, 51, 52, 53)] == ["und", "und", "und", "en"] and out[50].score == 0.0
    kept = identified(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([str(i) for i in range(12)] + ["53", "53", "None"])
    assert predict(docs.limit(0), fit(docs.limit(0), ~held_out(docs.doc_id))).count() == 0


def test_long_words_in_parts(monkeypatch):
    model = small_model()
    vocab = vocabulary(langid.MODEL_FILE)
    words = ["▁the" * 9, "▁" + "nation" * 40, "▁" + "一aé" * 30, "▁" + "e" * 300]
    whole = [long_word(w, model, vocab) for w in words]
    for positions in (1, 5, 16, 33):
        monkeypatch.setattr(langid, "POSITIONS", positions)
        for word, want in zip(words, whole, strict=True):
            np.testing.assert_allclose(long_word(word, model, vocab), want, rtol=1e-12)


def test_a_very_long_word_takes_little_memory():
    import tracemalloc

    model = small_model()
    judge = Judge(model)
    text = ("the" * 70_000).encode()
    tracemalloc.start()
    labels, _ = judge.judge([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert labels[0] in model.languages and peak < 20_000_000 and not judge.row_of


def test_undecided_texts_stay(spark):
    """Two languages with the same words: posteriors near one half are no reason to go."""
    rows = [(i, "same words here", lang) for i, lang in enumerate(["aa", "bb", "cc", "dd"] * 6)] + [(100, "12 34", None), (101, "words", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    scores = {r.doc_id: r.score for r in predict(docs, fit(docs, ~held_out(docs.doc_id))).collect()}
    assert scores[101] < 0.5
    assert {r.doc_id for r in identified(docs).collect()} == set(range(24)) | {101}
