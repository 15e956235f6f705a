import re
import zlib

import pytest

from trackspark.llm.quality import fit, judge, op2_quality

FOLDER = "/root/testdata/sf0.01"
WORDS = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORDS, text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(WORDS, line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else None
    if often is None:
        counts = {}
        for w in windows:
            counts[w] = counts.get(w, 0) + 1
        often = {w for w, n in counts.items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def facts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_facts_equal_brute_force(spark):
    texts = [
        None, "", " \n\t", "a b c a b c x a b c", "é ü# 中文|\x1c x\n\né ü# 中文|\x1c x\n \n \nb\r\nb\r\n", "w " * 60,
        " ".join(f"u{i}" for i in range(60)), " ".join(f"u{i % 300}" for i in range(30_000)), "a a a a", "q\x0bq\x0cq $$$",
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] * 2, "doc_id long, text string, kept string")
    rows = judge(docs, None).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        assert facts(r) == brute(texts[r.doc_id]), r.doc_id
        assert r.kept == (not r.base_failed) and r.probability is None
    assert judge(docs.limit(0), None).count() == 0


@pytest.fixture(scope="module")
def judged(spark):
    return op2_quality(spark, FOLDER).collect()


def test_given_documents(spark, judged):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(judged) == len(texts)
    for r in judged:
        assert facts(r) == brute(texts[r.doc_id])


def test_accuracy_on_labels_that_did_not_train(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen = {r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 2}
    model = fit(docs, labels.filter(labels.doc_id.isin(list(seen))))
    unseen = {r.doc_id: r.quality for r in labels.collect() if r.doc_id not in seen}
    rows = [r for r in judge(docs, model).collect() if r.doc_id in unseen and not r.base_failed]
    good = [r.kept for r in rows if unseen[r.doc_id] == 1]
    bad = [r.kept for r in rows if unseen[r.doc_id] == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_labels_of_one_kind_give_no_verdict(spark):
    docs = spark.createDataFrame([(i, "some words here") for i in range(20)], "doc_id long, text string")
    for value in (1, None, 7):
        labels = spark.createDataFrame([(i, value) for i in range(20)] + [(None, 1), (99, 0)], "doc_id long, quality int")
        assert fit(docs, labels) is None
    assert fit(docs.limit(0), labels.limit(0)) is None
