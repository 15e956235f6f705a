import itertools
import random
from collections import defaultdict

from pyspark.sql import functions as F

from trackspark.llm.mixing import mixed_documents
from trackspark.llm.packing import LENGTHS, cost, op3_packing, pack, pack_documents, pack_in_order


def checked(rows, lengths):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for inside in bins.values():
        at = 0
        for r in sorted(inside, key=lambda r: r.position):
            assert r.position == at
            at += r.length
        assert at == inside[0].bin_used and inside[0].bin_length == min(x for x in lengths if x >= at)
    return bins


def test_bins_hold_their_pieces_and_shrink():
    rng = random.Random(3)
    for _ in range(50):
        pieces = sorted((rng.randrange(1, 101) for _ in range(rng.randrange(1, 80))), reverse=True)
        placed, bins = pack(pieces, (20, 50, 100))
        used = defaultdict(int)
        for size, (which, at) in zip(pieces, placed, strict=True):
            assert at == used[which]
            used[which] += size
        assert [b[1] for b in bins] == [used[i] for i in range(len(bins))]
        assert all(b[0] == min(x for x in (20, 50, 100) if x >= b[1]) for b in bins)


def least_cost(pieces, lengths):
    """The cheapest packing over all partitions of the pieces."""
    best = float("inf")
    for labels in itertools.product(range(len(pieces)), repeat=len(pieces)):
        if any(x > max(labels[:i], default=-1) + 1 for i, x in enumerate(labels)):
            continue
        used = defaultdict(int)
        for size, label in zip(pieces, labels, strict=True):
            used[label] += size
        if max(used.values()) <= max(lengths):
            best = min(best, sum(cost(min(x for x in lengths if x >= u)) for u in used.values()))
    return best


def test_cost_is_close_to_the_best_of_all_partitions():
    rng = random.Random(9)
    ours = best = 0.0
    for _ in range(25):
        pieces = sorted((rng.randrange(200, 4000) for _ in range(6)), reverse=True)
        _, bins = pack(pieces, (1024, 2048, 4096))
        mine, least = sum(cost(b[0]) for b in bins), least_cost(pieces, (1024, 2048, 4096))
        assert least <= mine + 1e-9
        ours, best = ours + mine, best + least
    assert ours / best < 1.2


def test_best_fit_takes_the_fullest_bin():
    placed, bins = pack([6, 5, 4, 3, 2], (10,))
    assert placed == [(0, 0), (1, 0), (0, 6), (1, 5), (1, 8)] and bins == [[10, 10], [10, 10]]


def test_documents_of_all_kinds(spark):
    rows = [(1, "w " * 25, "a"), (1, "w " * 25, "a"), (1, "x " * 3, "b"), (2, None, None), (3, "", "c"), (None, "y " * 10, "d"), (4, "z " * 1000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bin_id string")
    out = pack_documents(docs, (5, 10), group_pieces=20).collect()
    checked(out, (5, 10))
    total = defaultdict(list)
    for r in out:
        total[(r.doc_id, r.copy)].append((r.piece, r.length))
    assert {k: sum(n for _, n in v) for k, v in total.items()} == {(1, 0): 3, (1, 1): 25, (1, 2): 25, (None, 0): 10, (4, 0): 1000}
    assert all([p for p, _ in sorted(v)] == list(range(len(v))) for v in total.values())
    assert pack_documents(docs.limit(0)).count() == 0
    assert sorted(map(str, out)) == sorted(map(str, pack_documents(docs.repartition(5), (5, 10), group_pieces=20).collect()))


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: len(r.text.encode().split()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op3_packing(spark, folder).collect()
    bins = checked(rows, LENGTHS)
    words = defaultdict(int)
    for r in rows:
        words[r.doc_id] += r.length
    assert dict(words) == {i: n for i, n in docs.items() if n}
    assert sum(docs.values()) / sum(b[0].bin_length for b in bins.values()) > 0.9


def test_bins_follow_the_training_order(spark, tmp_path):
    rng = random.Random(4)
    rows = [(None if i % 50 == 0 else i, f"w{i} " * rng.randrange(1, 35) if i % 9 else None, rng.choice(["a", "b", "b", "c", None])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixed_documents(docs)
    mixed.write.parquet(f"{tmp_path}/mixed")
    in_order = [r for r in mixed.collect() if r.text]
    layouts = [spark.read.parquet(f"{tmp_path}/mixed"), mixed.repartition(5), mixed.orderBy(F.rand(3)).coalesce(1)]
    results = [sorted(map(str, pack_in_order(d, (5, 10), group_pieces=20).collect())) for d in layouts]
    # Neither files nor partitions matter.
    assert results[0] == results[1] == results[2]
    out = pack_in_order(layouts[1], (5, 10), group_pieces=20).collect()
    bins = checked(out, (5, 10))
    assert sum(r.length for r in out) == sum(len(r.text.split()) for r in in_order)
    sizes = defaultdict(int)
    for r in out:
        sizes[int(r.bin_id.split("-")[0])] += 1
    assert all(n == 20 for g, n in sizes.items() if g < max(sizes))
    # Along the groups, the copies of a source come in the order of the mixture.
    source = {r.doc_id: r.source for r in in_order if r.doc_id is not None}
    group = {(r.doc_id, r.copy): int(r.bin_id.split("-")[0]) for r in out if r.piece == 0}
    seen, last = defaultdict(int), defaultdict(int)
    for r in in_order:
        if r.doc_id is None:
            continue
        g = group[(r.doc_id, seen[r.doc_id])]
        seen[r.doc_id] += 1
        assert g >= last[source[r.doc_id]]
        last[source[r.doc_id]] = g
    orders = [b[0].bin_order for b in bins.values()]
    assert len(set(orders)) == len(orders) and all(len({r.bin_order for r in b}) == 1 for b in bins.values())
    assert all(b[0].bin_order // 20 == int(i.split("-")[0]) for i, b in bins.items())
    copies = defaultdict(set)
    for r in out:
        copies[r.doc_id].add(r.copy)
    assert all(c == set(range(len(c))) for c in copies.values())
    assert pack_in_order(docs.limit(0)).count() == 0
    assert len(pack_in_order(docs.drop("source"), (5, 10)).collect()) == sum(-(-len((t or "").split()) // 10) for _, t, _ in rows)
