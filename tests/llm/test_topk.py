import math

import numpy as np
from pyspark.sql import types as T

from trackspark.llm.topk import best_by_threshold, top_k


def brute(rows, k, every):
    good = [
        (i, [math.floor(256.0 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, asked = [], {}
    for q, a in sorted(good, reverse=True):
        if q % every == 0:
            asked[q] = a
    for q, a in asked.items():
        found = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())]
)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    return sorted(map(tuple, top_k(df, **options).collect()))


def test_ties_odd_vectors_and_repeats(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(120)]
    rows += [(200 + i, [1.0] * 6) for i in range(40)] + [(10, [1.0] * 6), (20, [0.0] * 6)]
    rows += [(300, None), (310, []), (320, [1.0, None, 2.0]), (330, [float("nan")] * 6), (340, [float("inf")] + [0.0] * 5)]
    rows += [(350, [1.0, 2.0]), (360, [3.0, 4.0]), (None, [1.0] * 6), (370, [1e9] * 6)]
    assert run(spark, rows, k=3, every=10, per_block=16, per_query=4) == brute(rows, 3, 10)


def test_fewer_candidates_than_k_and_empty(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])], k=5, every=50) == [(0, 1, 1, 256 * 512)]
    assert run(spark, [], k=5, every=50) == []


def test_threshold_stops_early():
    rng = np.random.default_rng(1)
    rows = rng.integers(-5, 5, size=(4000, 3)).astype(np.int64)
    rows[7] = 100
    lists = np.argsort(rows, axis=0, kind="stable")
    scores, best, depth = best_by_threshold(np.arange(4000), rows, lists, np.array([3, 2, 1]), -1, 1)
    assert best.tolist() == [7] and scores.tolist() == [600] and depth < 100
