import hashlib
import random
import re

import numpy as np

from trackspark.llm.substrings import BLOCK, WINDOW, blocks, boundaries, op5_substrings, remove_repeats

WORDS = r"[^\x20\x09-\x0D]+"


def brute(rows):
    """Windows in the order of (id, start); those of one id and start are the same place."""
    seen, out = {}, []
    texts = sorted({(i if i is not None else -1, t or "") for i, t in rows})
    for i, t in texts:
        words = re.findall(WORDS, t)
        for s in range(len(words) - 19):
            seen.setdefault(tuple(words[s : s + 20]), (i, s))
    for i, t in rows:
        key = i if i is not None else -1
        words = re.findall(WORDS, t or "")
        gone = set()
        for s in range(len(words) - 19):
            if seen[tuple(words[s : s + 20])] < (key, s):
                gone |= set(range(s, s + 20))
        kept = [w for n, w in enumerate(words) if n not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, bucket_bytes=2000):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    found = remove_repeats(df, digest=True, bucket_bytes=bucket_bytes)
    return sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode()) for r in found.collect()), key=str)


def test_equal_windows_share_a_chosen_block():
    rng = np.random.default_rng(4)
    for vocabulary in (2, 3, 10, 10_000):
        for _ in range(60):
            middle = rng.integers(0, vocabulary, WINDOW)
            places = []
            for _ in range(2):
                before, after = (rng.integers(0, vocabulary, rng.integers(0, 30)) for _ in range(2))
                words = np.concatenate([before, middle, after]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                at, names = blocks(words)
                inside = (at >= len(before)) & (at + BLOCK <= len(before) + WINDOW)
                runs = boundaries(words)[1]
                touched = any(s < len(before) + WINDOW and s + n > len(before) for s, n in runs.tolist())
                places.append((set(names[inside].tolist()), touched))
            (a, ta), (b, tb) = places
            assert a & b or (ta and tb)


def test_small_vocabularies_runs_and_copies_equal_brute_force(spark):
    rng = random.Random(11)
    word = lambda v: f"w{rng.randrange(v)}"
    passage = [word(500) for _ in range(70)]
    rows = [(i, " ".join(word(3) for _ in range(rng.randrange(60)))) for i in range(25)]
    rows += [(30 + i, " ".join(["a"] * rng.randrange(70) + [word(2)] * 5 + ["a"] * rng.randrange(40))) for i in range(12)]
    for i in range(25):
        a, b = rng.randrange(40), rng.randrange(40, 70)
        rows.append((60 + i, " \n".join([word(900) for _ in range(rng.randrange(30))] + passage[a:b] + [word(900) for _ in range(30)])))
    rows += [(90, rows[-1][1]), (91, rows[-1][1]), (91, rows[-1][1])]
    rows += [(100, None), (101, ""), (102, "short"), (None, rows[40][1]), (103, "ü\x1cé x " * 30), (104, "ü\x1cé x " * 30)]
    rows += [(105, " ".join(str(n % 977) for n in range(30_000)))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, 1 << 24) == brute(rows)
    assert run(spark, []) == []


def test_texts_of_one_id_lose_their_own_words(spark):
    long = " ".join(f"a{i}" for i in range(30))
    rows = [(1, long), (2, "x y z " + long), (2, "other " * 3 + "end")]
    assert [r[:3] for r in run(spark, rows)] == [(1, 30, 0), (2, 33, 30), (2, 4, 0)]


def test_texts_without_an_id_are_documents_of_their_own(spark):
    shared = " ".join(f"s{i}" for i in range(25))
    texts = [f"{' '.join(f'{n}x{i}' for i in range(n + 5))} {shared}" for n in range(40)]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (7, texts[1]), (8, "y " + shared)]
    out = run(spark, rows)
    removed = {(i, n): gone for i, n, gone, _ in out}
    # One text keeps the passage; its copy without an id is the same document. Texts with an id come after those without.
    kept = [n for (i, n), gone in removed.items() if i is None and not gone]
    assert len(kept) == 1 and all(gone == 25 for (i, n), gone in removed.items() if i is None and n != kept[0])
    assert removed[(7, 31)] == 31 and removed[(8, 26)] == 25 and len(out) == 43
    assert out == run(spark, rows[::-1], 1 << 24)


def test_many_texts_of_one_id_are_spread_over_buckets():
    from trackspark.llm.substrings import doc_bucket, fingerprint, numbers_of

    texts = [f"text {i}".encode() for i in range(1000)]
    prints = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
    for ids in ([None] * 1000, [5] * 1000):
        counts = np.bincount(doc_bucket(numbers_of(ids, texts), prints, 10), minlength=10)
        assert counts.max() < 150


def test_query_on_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op5_substrings(spark, folder).collect()), key=str) == brute(rows)
