import hashlib

import numpy as np
import pytest

from trackspark.llm import vectorcodes
from trackspark.llm.vectorcodes import Gnat, codebooks, coded, compressed, digest, integers, nearest_of_any, op12_vectorcodes, stored

KINDS = "vec_id long, embedding array<float>, label int, extra string"


def brute(rows, parts=4, entries=256, rounds=4):
    """The contract in plain Python: {(vec_id, vector): (code, error)} and the digest of the codebooks."""
    import math

    kept = []
    for vec_id, vector, *_ in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in vector]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v in kept]
    books = [[cut[i][p] for i in range(min(entries, len(kept)))] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), i) for i, y in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for vector in cut:
                members.setdefault(near(vector[p], books[p])[1], []).append(vector[p])
            for e, inside in members.items():
                books[p][e] = [sum(c) // len(inside) for c in zip(*inside, strict=True)]
    out = []
    for (vec_id, _), vector in zip(kept, cut, strict=True):
        found = [near(vector[p], books[p]) for p in range(parts)]
        out.append((vec_id, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    return sorted(out, key=str), hashlib.sha256(text.encode()).hexdigest()


def of(spark, rows, kinds=KINDS):
    made, books = compressed(spark.createDataFrame(rows, kinds), keep=["label"])
    return sorted(((r.vec_id, r.code.hex() if r.code is not None else None, r.error) for r in made.collect()), key=str), digest(books)


@pytest.mark.parametrize(("dims", "spread"), [(16, 1024), (3, 4), (1, 300), (8, 30)])
def test_tree_finds_the_nearest_of_lowest_number(dims, spread):
    rng = np.random.default_rng(dims)
    values, queries = (np.floor(rng.normal(size=(n, dims)) * spread) for n in (256, 2000))
    values[100:120] = values[:20]
    tree = Gnat(values)
    number, error = tree.nearest(queries)
    distance = ((queries[:, None] - values[None]) ** 2).sum(-1)
    assert (number == distance.argmin(1)).all() and (error == distance.min(1)).all()


def test_tree_leaves_out_far_subtrees():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16)) * 1024
    values, queries = (np.floor(centres[rng.integers(0, 20, n)] + rng.normal(size=(n, 16)) * 50) for n in (256, 3000))
    tree = Gnat(values)
    number, _ = tree.nearest(queries)
    assert tree.visited < 0.3 * 256 * 3000
    assert (number == ((queries[:, None] - values[None]) ** 2).sum(-1).argmin(1)).all()


def test_tree_of_equal_entries():
    tree = Gnat(np.zeros((256, 4)))
    number, error = tree.nearest(np.ones((5, 4)))
    assert number.tolist() == [0] * 5 and error.tolist() == [4.0] * 5


def test_large_integers_are_compared_exactly():
    big = 2**60
    values = np.array([[big, 0], [big + 1, 0], [-big, 0], [big + 1, 0]], dtype=np.int64)
    queries = np.array([[big, 0], [big + 1, 0], [big + 2, 0], [0, 0], [-(2**63), 2**63 - 1]], dtype=np.int64)
    numbers, errors = nearest_of_any(values, queries)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(q, v, strict=True)), i) for i, v in enumerate(values)) for q in queries]
    assert list(zip(errors, numbers, strict=True)) == want


def test_rounds_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i * 3 % 1009, [float(x) for x in rng.normal(size=8) * 0.01], i % 3, None) for i in range(500)]
    assert of(spark, rows) == brute(rows)


def test_few_vectors_ties_nulls_and_huge_components(spark):
    rows = [
        (5, [0.5] * 8, 1, "a"),
        (5, [0.5] * 8, 1, "a"),
        (1, [-0.001] * 8, None, None),
        (None, [0.25] * 8, None, "x"),
        (2, None, 1, None),
        (3, [1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0], 1, None),
        (4, [float("nan")] * 8, 1, None),
        (6, [float("inf")] * 8, 1, None),
        (7, [1e12] * 4 + [-1e12] * 4, 2, None),
        (8, [5e6] * 8, 2, None),
    ]
    assert of(spark, rows) == brute(rows)
    clipped = [(1, [3e38] * 4, 1, None), (2, [-3e38] * 4, 1, None), (3, [0.0] * 4, 1, None)]
    found, _ = of(spark, clipped)
    assert [r[:2] for r in found] == [(1, "00000000"), (2, "01010101"), (3, "02020202")]


def test_errors_are_clipped(spark):
    books = [np.zeros((1, 1), dtype=np.int64)] * 4
    ints = spark.createDataFrame([(1, [2**62] * 4)], "vec_id long, ints array<long>")
    assert coded(ints, books, []).first().error == 2**63 - 1


def test_vectors_of_another_length(spark):
    rows = [(2, [1.0] * 5, 1, None), (1, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 1, None), (3, [], None, None), (4, [0.0] * 6, 1, None)]
    found, _ = of(spark, rows)
    assert [(i, code) for i, code, _ in found] == [(1, "00000000"), (2, None), (3, None), (4, "01010101")]
    # Six components make parts of 2, 2, 1 and 1.
    ints = stored(integers(spark.createDataFrame(rows, KINDS), [])).filter("size(ints) = 6")
    assert [b.shape for b in codebooks(ints)] == [(2, 2), (2, 2), (2, 1), (2, 1)]
    assert of(spark, [(1, [], None, None)])[0] == [(1, "00000000", 0)]


def test_long_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=3000)], 0, None) for i in range(12)]
    assert of(spark, rows) == brute(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], KINDS)
    assert of(spark, [])[0] == [] and compressed(empty)[0].columns == ["vec_id", "code", "error"]
    assert of(spark, [(1, None, 1, None)])[0] == []


def test_sums_in_halves_hold_negative_numbers(spark, monkeypatch):
    monkeypatch.setattr(vectorcodes, "ENTRIES", 1)
    monkeypatch.setattr(vectorcodes, "ROWS", 2)
    rows = [(i, [x] * 4, None, None) for i, x in enumerate([-4e9, 3e9, -1e-3, 2.5, -1e9])]
    found, entries = brute(rows, entries=1)
    assert of(spark, rows) == ([(i, code, min(error, 2**63 - 1)) for i, code, error in found], entries)


def test_labels_are_summed_with_nulls_together(spark, tmp_path):
    rows = [(1, [0.0] * 4, 1, "a"), (2, [1.0] * 4, None, "b"), (3, [2.0] * 4, None, "c"), (4, [3.0] * 4, 1, "d"), (5, [0.5] * 4, 2, "e")]
    spark.createDataFrame(rows, KINDS).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op12_vectorcodes(spark, str(tmp_path)).collect()
    assert len(found) == 5 and {r.label_error for r in found} == {0}
