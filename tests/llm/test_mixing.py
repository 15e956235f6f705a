from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from trackspark.llm.mixing import SCHEDULES, mix, mixed_documents, op6_mixing, ordered_mix, time_of, training_order

FOLDER = "/root/testdata/sf0.01"


def shared_out(sizes):
    """Targets by the stated rule: share by weight, clamp, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    demand, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = demand - sum(2 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / open_weight for s in names}
        above = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not above:
            return target
        full |= above


def documents(spark):
    rows, n = [], 0
    for source, count, words in (("a", 40, 9), ("é", 3, 700), ("b", 1, 5), (None, 30, 20), ("Z", 25, 60), ("c", 2, 0)):
        for i in range(count):
            rows.append((n, " ".join(["w"] * (words + (i % 3 if words else 0))), source, "x"))
            n += 1
    rows += [(900, None, "a", None), (900, None, "a", None), (None, "no id here", "b", "y"), (901, "twice", "b", "z"), (901, "twice", "b", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target string")


@pytest.mark.parametrize("given", [True, False])
def test_targets_and_taken(spark, given):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet") if given else documents(spark)
    rows = mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, seen = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        seen[r.source] = (r.source_size, r.target)
        assert 0 <= r.taken <= 2 * r.size
    expected = shared_out(sizes)
    for source, (size, target) in seen.items():
        assert size == sizes[source] and target == pytest.approx(expected[source], abs=1e-6)
        assert abs(taken[source] - target) <= 1
    assert sorted(map(str, rows)) == sorted(map(str, mix(docs.repartition(7)).collect()))


def test_positions_follow_the_schedules(spark):
    at = [i / 50 for i in range(51)]
    for place, knots in enumerate(SCHEDULES):
        df = spark.createDataFrame([(x,) for x in at], "x double").select("x", time_of(F.col("x"), F.lit(place)).alias("t"))
        steps = len(knots) - 1
        total = sum((a + b) / 2 for a, b in zip(knots, knots[1:], strict=False))
        for x, t in df.collect():
            i = min(int(t * steps), steps - 1)
            part = t * steps - i
            used = sum((knots[j] + knots[j + 1]) / 2 for j in range(i)) + knots[i] * part + (knots[i + 1] - knots[i]) * part**2 / 2
            assert used / total == pytest.approx(x, abs=1e-9)


def test_training_order_and_documents(spark):
    docs = documents(spark)
    order = training_order(mix(docs)).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    per = defaultdict(int)
    for r in order:
        per[r.source] += r.words
    taken = defaultdict(int)
    for r in mix(docs).collect():
        taken[r.source] += r.taken
    assert {s: w for s, w in taken.items() if w} == dict(per)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    known = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in known for r in mixed.collect())
    words = sum(len((r.text or "").split()) for r in mixed.collect())
    assert abs(words - sum(taken.values())) <= 4 * 702
    assert mix(docs.limit(0)).count() == 0 and mixed_documents(docs.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.doc_id, r.target, r.taken) for r in mix(empty).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_query_comes_in_training_order(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = {}
    for r in training_order(mix(docs)).collect():
        first.setdefault(r.doc_id, (r.position, r.place))
    got = [r.doc_id for r in op6_mixing(spark, folder).collect()]
    assert got[: len(first)] == sorted(first, key=lambda i: (*first[i], i))
    assert sorted(got) == sorted(r.doc_id for r in docs.collect())


def test_ordered_mix_keeps_every_row(spark):
    docs = documents(spark)
    rows = ordered_mix(docs).collect()
    plain = ["doc_id", "source", "size", "place", "source_size", "target", "offset", "taken"]
    assert sorted(str([r[c] for c in plain]) for r in rows) == sorted(str([r[c] for c in plain]) for r in mix(docs).collect())
    assert all((r.position is None) == (r.taken == 0) for r in rows)
    per = defaultdict(list)
    for r in training_order(mix(docs)).collect():
        per[r.place, r.offset].append(r.position)
    assert all(r.position == min(per[r.place, r.offset]) for r in rows if r.taken)
    assert ordered_mix(docs.limit(0)).count() == 0
