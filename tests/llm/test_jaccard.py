import random
import re

import numpy as np
import pytest

from trackspark.llm.jaccard import Postings, Trie, band_starts, components, linked_components, one_of_each, op1_jaccard, part_keys, shingles

WORDS = r"[^\x20\x09-\x0D]+"


def brute(rows, words, percent):
    def gram(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(WORDS, lower)
        if 0 < len(found) < words:
            return {tuple(found)}
        return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}

    sets = [gram(t) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_gram = {}
    for n, s in enumerate(sets):
        for g in s:
            by_gram.setdefault(g, []).append(n)
    for n, s in enumerate(sets):
        for m in {m for g in s for m in by_gram[g] if m < n}:
            both = len(s & sets[m])
            if rows[n][0] is not None and rows[m][0] is not None and 100 * both >= percent * len(s | sets[m]):
                a, b = sorted((root(rows[n][0]), root(rows[m][0])))
                parent[b] = a
    return sorted(((i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def family(rng, first, count, size, edits):
    base = [f"v{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for i in range(count):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(len(text))] = f"v{rng.randrange(5000)}"
        if rng.random() < 0.3:
            text += [f"v{rng.randrange(5000)}" for _ in range(rng.randrange(3))]
        out.append((first + i, " ".join(text)))
    return out


def run(spark, rows, words, percent):
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, component_id long")
    return sorted(map(tuple, linked_components(df, words, percent).collect()), key=str)


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, words, percent):
    rng = random.Random(words)
    rows = []
    for size, edits in ((8, 1), (20, 1), (60, 3), (200, 10), (200, 4), (600, 20)):
        rows += family(rng, len(rows) * 3, 40, size, edits)
    rows += [(9000, None), (9001, ""), (9002, "one two"), (9003, "ONE  two"), (9004, "Éa b"), (9005, "éa b"), (9006, " \n")]
    rows += [(None, rows[0][1]), (9010, rows[0][1]), (9010, rows[0][1]), (9011, rows[50][1]), (9011, rows[120][1])]
    rows += [(9020, " ".join(f"u{i}" for i in range(20_000))), (9021, " ".join(f"u{i}" for i in range(20_300)))]
    expected = brute(rows, words, percent)
    assert run(spark, rows, words, percent) == expected
    assert run(spark, [], words, percent) == []


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(6)
    for percent in (80, 90):
        for size in (3, 5, 9, 10, 12, 19, 20, 35, 60, 150, 700):
            starts = band_starts(percent, 4 * size)
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
                drop, add = rng.integers(0, size // 5 + 1), rng.integers(0, size // 5 + 1)
                b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if len(b) and both * 100 >= percent * (len(a) + len(b) - both) and len(a) + len(b) > 2 * both:
                    sides = [{n: (need, keys) for n, need, keys in part_keys(s, percent, starts)} for s in (a, b)]
                    assert any(
                        len(np.intersect1d(sides[0][n][1], sides[1][n][1])) >= sides[0][n][0] for n in sides[0].keys() & sides[1].keys()
                    )


def test_trie_finds_all_linked_sets():
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 2**63, 120, dtype=np.uint64))
    sets = [np.sort(rng.permutation(base)[: rng.integers(80, 121)]) for _ in range(60)] + [base, base[:1], base[60:]]
    trie = Trie(sets, list(range(len(sets))))
    for probe in [*sets, base[:100]]:
        share = [len(np.intersect1d(probe, s)) / len(np.union1d(probe, s)) for s in sets]
        for percent in (80, 90):
            assert sorted(trie.linked(probe, percent, lambda c: False)) == [i for i, x in enumerate(share) if 100 * x >= percent - 1e-9]


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150), (150, 200)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 150: 150, 200: 150}


def test_one_document_of_each_component_stays(spark):
    rows = family(random.Random(1), 10, 6, 300, 2)
    copy = rows[0][1]
    rows += [(1, None), (2, "alone here"), (None, "no id"), (2, "alone here"), (2, "x"), (None, copy), (None, copy), (7, copy), (None, "no id")]
    rows += [(None, None), (None, " "), (1, None), (3, "Alone  here")]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, `lost` string, `node.of` int")
    out = one_of_each(docs)
    # The family and its copies have one row left, that of the least id; rows of one id with different texts stay.
    left = sorted((str(r.doc_id), r.text) for r in out.collect() if (r.text or "").strip())
    assert left == sorted([("2", "alone here"), ("2", "x"), ("7", copy), ("None", "no id")])
    assert out.filter("coalesce(trim(text), '') = ''").count() == 4
    assert out.columns == docs.columns
    assert one_of_each(docs.limit(0)).count() == 0


def test_colliding_nodes_get_another_salt(spark, monkeypatch):
    from pyspark.sql import functions as F

    from trackspark.llm import jaccard

    whole, salts = jaccard.hashed_node, []

    def colliding(salt):
        salts.append(salt)
        return F.pmod(whole(salt), F.lit(4 if salt < 2 else 2**40)) + 2**41

    monkeypatch.setattr(jaccard, "hashed_node", colliding)
    rows = [(None if i % 2 else 5, f"text number {i} stands alone") for i in range(12)] + [(9, "an id of one text"), (9, "an id of one text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked, nodes = jaccard.with_nodes(docs)
    assert max(salts) == 2 and nodes.count() == 13
    assert [r[jaccard.NODE] for r in marked.filter("doc_id = 9").collect()] == [9, 9]
    assert one_of_each(docs).count() == 13


def test_many_ids_with_several_texts(spark, monkeypatch):
    """Where the ids of several texts are not broadcast, all nodes are hashes; the result is the same."""
    from trackspark.llm import jaccard

    rows = family(random.Random(3), 10, 6, 200, 2) + [(10, "other text"), (None, "no id"), (11, "third of eleven")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, one_of_each(docs).collect()))
    monkeypatch.setattr(jaccard, "broadcast_if_small", lambda df: df)
    assert sorted(map(str, one_of_each(docs).collect())) == want and len(want) == 4


def test_no_key_is_held_by_a_share_of_all_sets():
    rng = np.random.default_rng(4)
    for size in (10, 16, 25, 40, 80, 150):
        held = {}
        for _ in range(800):
            tokens = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            for _, _, keys in part_keys(tokens, 80, band_starts(80, 4 * size)):
                for key in keys.tolist():
                    held[key] = held.get(key, 0) + 1
        assert max(held.values()) <= 2


def test_sets_that_share_no_key_are_left_out():
    rng = np.random.default_rng(9)
    base = np.unique(rng.integers(0, 2**63, 50, dtype=np.uint64))
    sets = [base, base[:49], base[:48], base[1:]]
    trie = Trie(sets, [0, 1, 2, 3])
    for among in ([1, 0, 1, 0], [0, 0, 0, 1], [1, 1, 1, 1], [0, 0, 0, 0]):
        found = sorted(trie.linked(base, 80, lambda c: False, np.array(among, dtype=bool)))
        assert found == [i for i, a in enumerate(among) if a]
    postings = Postings([np.array([1, 5]), np.array([2]), np.array([5, 9, 2])])
    assert postings.sharing(np.array([5, 7])).tolist() == [True, False, True]


def test_short_sequences():
    assert len(shingles(b"a b", 3)) == 1 and len(shingles(b"", 3)) == 0 and len(shingles(None, 3)) == 0
    assert shingles(b"A B c", 3) == shingles(b"a b C", 3)


def test_query_on_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op1_jaccard(spark, folder).collect()), key=str) == brute(rows, 3, 90)
