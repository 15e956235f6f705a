import itertools
import random
import zlib

import pytest

from trackspark.llm.variants import counted_words, gram_counts, meeting_keys, near_pairs, op13_variants, pivots, prefix, roots, variants

WORDS = "word string, n long"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    out = {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def of(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def drawn(count, letters, lengths, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(count)}
    return {w: rng.choice((3, 3, 4, 6, 8, 20, 50)) for w in words}


@pytest.mark.parametrize(("letters", "lengths"), [("ab", (5, 6, 7)), ("abcé", (5, 6)), ("aé", range(5, 12))])
def test_dense_words_equal_brute_force(spark, letters, lengths):
    counts = drawn(250, letters, lengths, len(letters))
    assert of(variants(spark.createDataFrame(list(counts.items()), WORDS))) == brute(counts)


def test_every_edit_of_a_word_is_found(spark):
    word = "straße"
    edits = {word[:i] + x + word[i + 1 :] for i in range(6) for x in "aßz"} | {word[:i] + x + word[i:] for i in range(7) for x in "sßz"}
    edits |= {word[:i] + word[i + 1 :] for i in range(6)} | {word}
    counts = {w: 3 for w in edits} | {word: 9, "unlike": 3}
    assert of(variants(spark.createDataFrame(list(counts.items()), WORDS))) == brute(counts)


def test_one_shared_beginning_meets_in_few_keys():
    rng = random.Random(8)
    words = sorted({"inter" + "".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(2000)})
    counts = {}
    for w in words:
        for p in range(len(w) - 1):
            counts[w[p : p + 2]] = counts.get(w[p : p + 2], 0) + 1
    held = {}
    for w in words:
        for p in prefix(w, counts):
            for key in meeting_keys(w, p):
                held.setdefault(key, set()).add(w)
    # Words that share their first five letters are no group: few of them share a key.
    assert max(map(len, held.values())) < 0.05 * len(words)


def test_pivots_do_not_overlap_and_cost_least():
    rng = random.Random(6)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(5, 12)))
        counts = {a + b: rng.randrange(1, 9) for a in "abc" for b in "abc"}
        positions = prefix(word, counts)
        cost = {p: counts[word[p : p + 2]] for p in positions}
        best = min(cost[p] + cost[q] for p, q in itertools.combinations(positions, 2) if q - p >= 2)
        p, q = pivots(word, positions, counts)
        assert q - p >= 2 and cost[p] + cost[q] == best


def test_long_chains_reach_the_last_form(spark):
    chain = [("a" * i + "b" * (12 - i), "a" * (i + 1) + "b" * (11 - i)) for i in range(12)]
    found = {r.word: r.root for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {w: "a" * 12 for w, _ in chain}
    counts = {"a" * i + "b" * (8 - i): 3 * 2**i for i in range(9)}
    assert of(variants(spark.createDataFrame(list(counts.items()), WORDS))) == brute(counts)


def test_runs_are_counted_as_stated(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("Reservoir", "élan×vital", "ÉTUDES", "abcd1efghi", "naïveté", "Zürich's")) for _ in range(200)) for _ in range(12)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x"), (20, None, None), (21, "", ""), (22, "12 34", ""), (3, texts[3], "x")]
    rows.append((30, "lengthy " * 200_000 + "lengthy", "y"))
    want = {}
    for doc, text, _ in rows:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            h = zlib.crc32(f"{doc}:{run}".encode()) if run and doc is not None else 1
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                want[run] = want.get(run, 0) + 1
            run = ""
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert {r.word: r.n for r in counted_words(docs).collect()} == {w: n for w, n in want.items() if n >= 3}


def test_damaged_runs_are_planted(spark):
    docs = spark.createDataFrame([(i, "documented " * 3) for i in range(600)], "doc_id long, text string")
    found = {r.word: r.n for r in counted_words(docs).collect()}
    hits = [i for i in range(600) if zlib.crc32(f"{i}:documented".encode()) % 97 == 0]
    assert hits and found["documented"] == 3 * (600 - len(hits)) and sum(found.values()) == 1800


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert variants(counted_words(docs)).count() == 0
    assert near_pairs(spark.createDataFrame([("alone", 3)], WORDS)).count() == 0
    assert gram_counts(spark.createDataFrame([("aaaaa", 3)], WORDS)) == {"aa": 4}


def test_a_word_of_one_letter_repeated(spark):
    counts = {"a" * i: 3 * i for i in range(5, 40)} | {"é" * 7: 3}
    assert of(variants(spark.createDataFrame(list(counts.items()), WORDS))) == brute(counts)


def test_given_documents_hold_variants(spark):
    rows = op13_variants(spark, "/root/testdata/sf0.001").collect()
    assert any(r.form for r in rows) and all((r.form is None) == (r.root == r.word) for r in rows)
