"""Vector compression to codes of codebook entries, found by geometric near-neighbour access trees (GNAT).

Vectors become integers (``floor(1024 * x)``) and are cut into equal consecutive parts. Every part position has a codebook
of at most 256 entries, first taken from the vectors of the smallest ids. A round assigns every part to the nearest
entry and replaces entries by the mean of their parts; after the rounds parts are assigned again.

The tree. A node holds a few split points, entries far from each other; every other entry goes to the child of its
nearest split point. For each split point and child the range of their distances is kept, the lower end rounded down, the
upper end up. A batch of queries goes down together: distances to the split points are exact; a child is left out
for a query when, for any split point, no point at a distance within the child's range can be as near as the best found so
far. The comparison is strict and rounded against leaving out, so an entry at an equal distance is always met,
and equal distances, compared as integers, go to the lower index. The child of the nearest split point comes first, which makes
the radius small for the others.

Exactness. Squared distances come from products of float64 matrices where all sums stay below 2^53, which makes them
exact integers. Other vectors (components beyond some millions) are compared with bounds of the rounding error, and all
entries that the bounds leave are compared as Python integers.

Spark. A round is one pass over the stored integers: a task adds up its parts per entry, Spark adds up the
tasks, and the codebooks, at most 256 vectors in all, go through the driver. Sums are of 64-bit halves, so none overflows.

Defined results. Vectors that are null or hold null or non-finite components are dropped. The vector of the smallest id
(nulls last, then by components) fixes the number of components; vectors of another length have a null code and error
and take part in nothing else. A length that parts do not divide gives its first parts one component more. With equal ids
the order by components decides which vectors start the codebooks; fewer vectors make smaller codebooks. A component
beyond the range of a long counts as its end, and so does an error. A null id is a vector like others. Equal
labels have one sum, null labels together, and vectors without a code add nothing. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import cut, stored, table
from trackspark.operators.sizes import broadcast_if_small

SCALE, PARTS, ENTRIES, ROUNDS = 1024.0, 4, 256, 4
# Split points of a node; sets up to LEAF entries are not split further.
SPLITS, LEAF = 16, 40
# Vectors compared at once.
ROWS = 4096
LONG = 2**63 - 1
EXACT = 2.0**53
# Wider than the rounding of a square root and of the sums it enters.
DOWN, UP = 1 - 2.0**-48, 1 + 2.0**-48


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a and b, floats holding exact integers (see ``exact``)."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)


class Node(NamedTuple):
    """Split points (numbers of entries, ascending), children, and distance ranges [split point, child]."""

    points: np.ndarray
    children: list[Node]
    low: np.ndarray
    high: np.ndarray


def split_points(values: np.ndarray, count: int) -> list[int]:
    """Rows far from each other: the first, then always the one farthest from those chosen."""
    chosen = [0]
    nearest = squared(values, values[:1])[:, 0]
    while len(chosen) < count:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, squared(values, values[chosen[-1] :][:1])[:, 0])
        # A chosen row is never chosen again, not even among equal rows.
        nearest[chosen] = -1
    return chosen


class Gnat:
    """The tree over one codebook of float64 rows that hold integers."""

    def __init__(self, values: np.ndarray):
        self.values, self.doubled, self.norms = values, -2 * values, (values * values).sum(1)
        self.visited = 0
        self.root = self.grown(np.arange(len(values)))

    def grown(self, inside: np.ndarray) -> Node:
        if len(inside) <= LEAF:
            return Node(inside, [], np.empty((0, 0)), np.empty((0, 0)))
        chosen = np.zeros(len(inside), dtype=bool)
        chosen[split_points(self.values[inside], SPLITS)] = True
        points, rest = inside[chosen], inside[~chosen]
        distance = squared(self.values[points], self.values[rest])
        owner = distance.argmin(0)
        distance = np.sqrt(distance)
        kept = [c for c in range(len(points)) if (owner == c).any()]
        low = np.stack([distance[:, owner == c].min(1) for c in kept], 1) * DOWN
        high = np.stack([distance[:, owner == c].max(1) for c in kept], 1) * UP
        # A child's place among the kept ones is looked up by its split point's place.
        children = [self.grown(rest[owner == c]) for c in kept]
        return Node(points, children, low, high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest entry, squared distance) of each query; of equal distances the lower number."""
        best = np.full(len(queries), np.inf)
        entry = np.full(len(queries), len(self.values))
        self.search(self.root, queries, (queries * queries).sum(1), np.arange(len(queries)), best, entry)
        return entry, best

    def search(self, node: Node, queries: np.ndarray, norms: np.ndarray, active: np.ndarray, best: np.ndarray, entry: np.ndarray) -> None:
        distance = queries[active] @ self.doubled[node.points].T
        distance += norms[active][:, None]
        distance += self.norms[node.points]
        self.visited += distance.size
        place = distance.argmin(1)
        least, number = distance[np.arange(len(active)), place], node.points[place]
        better = (least < best[active]) | ((least == best[active]) & (number < entry[active]))
        best[active[better]], entry[active[better]] = least[better], number[better]
        if not node.children:
            return
        distance = np.sqrt(distance)
        nearer, farther = distance * DOWN, distance * UP
        # The child whose range lies nearest around the query's distances is the most promising.
        outside = np.maximum(node.low[None] - distance[:, :, None], distance[:, :, None] - node.high[None]).max(1)
        promising = outside.argmin(1)
        for first in (True, False):
            for c, child in enumerate(node.children):
                mine = np.flatnonzero((promising == c) == first)
                radius = np.sqrt(best[active[mine]])[:, None] * UP
                out = (nearer[mine] - radius > node.high[:, c]) | (farther[mine] + radius < node.low[:, c])
                mine = mine[~out.any(1)]
                if len(mine):
                    self.search(child, queries, norms, active[mine], best, entry)


def bounds_of(dims: int) -> list[int]:
    """Ends of the parts: equal, or the first ones one longer."""
    return [0, *np.cumsum([len(p) for p in np.array_split(np.arange(dims), PARTS)]).tolist()]


def exact(values: np.ndarray) -> bool | np.ndarray:
    """Per row: small enough that squared distances between such rows are exact in float64."""
    limit = np.sqrt(EXACT / (4 * max(1, values.shape[1])))
    return (np.abs(values.astype(np.float64)) < limit).all(1)


def nearest_of_any(values: np.ndarray, queries: np.ndarray) -> tuple[list[int], list[int]]:
    """Like ``Gnat.nearest`` for integers of any size: bounds leave few entries, which integers decide."""
    numbers, errors = [], []
    floats, entries = queries.astype(np.float64), values.astype(np.float64)
    for row, query in zip(floats, queries, strict=True):
        distance = ((entries - row) ** 2).sum(1)
        # Every cell may be off by a rounding of its two numbers.
        slack = ((np.abs(entries) + np.abs(row)) ** 2).sum(1) * len(row) * 2.0**-48
        left = np.flatnonzero(distance - slack <= (distance + slack).min())
        found = [(sum((int(a) - int(b)) ** 2 for a, b in zip(values[i], query, strict=True)), int(i)) for i in left]
        errors.append(min(found)[0])
        numbers.append(min(found)[1])
    return numbers, errors


class Coder:
    """Assigns parts to the entries of codebooks; ``books[p]`` holds the entries of part p as int64 rows."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books
        self.trees = [Gnat(b.astype(np.float64)) if exact(b).all() else None for b in books]
        self.bounds = [0, *np.cumsum([b.shape[1] for b in books]).tolist()]

    def parts(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[int] | np.ndarray]]:
        """(part position, the parts, their entries, their squared distances)."""
        for p, (book, tree) in enumerate(zip(self.books, self.trees, strict=True)):
            part = vectors[:, self.bounds[p] : self.bounds[p + 1]]
            small = exact(part) if tree else np.zeros(len(part), dtype=bool)
            if small.all():
                number, error = tree.nearest(part.astype(np.float64))
                yield p, part, number, error.astype(np.int64)
                continue
            number, error = np.zeros(len(part), dtype=np.int64), np.zeros(len(part), dtype=object)
            if small.any():
                number[small], near = tree.nearest(part[small].astype(np.float64))
                error[small] = near.astype(np.int64).astype(object)
            number[~small], error[~small] = nearest_of_any(book, part[~small])
            yield p, part, number, error


def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            yield rows, rows.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)


def summed(books: list[np.ndarray]):
    """(slot, n, hi, lo) per task: slot numbers (entry, component), the sum is hi * 2^32 + lo over n parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, dims, size = Coder(books), sum(b.shape[1] for b in books), len(books[0])
        count, high, low = (np.zeros((size, dims), dtype=np.int64) for _ in range(3))
        for _, vectors in matrices(batches):
            for p, part, number, _ in coder.parts(vectors):
                order = np.argsort(number, kind="stable")
                entries, first, members = np.unique(number[order], return_index=True, return_counts=True)
                place = slice(coder.bounds[p], coder.bounds[p + 1])
                if part.shape[1]:
                    count[entries, place] += members[:, None]
                    high[entries, place] += np.add.reduceat(part[order] >> 32, first)
                    low[entries, place] += np.add.reduceat(part[order] & 0xFFFFFFFF, first)
        slot = np.flatnonzero(count)
        columns = [slot, *(c.reshape(-1)[slot] for c in (count, high, low))]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["slot", "n", "hi", "lo"])

    return run


def improved(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round. At most 256 vectors' components come to the driver."""
    sums = vectors.select("ints").mapInArrow(summed(books), "slot long, n long, hi long, lo long")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "hi", "lo")]
    found = sums.groupBy("slot").agg(*wide).toArrow().to_pydict()
    joined = np.concatenate(books, axis=1)
    flat = joined.reshape(-1)
    for slot, n, hi, lo in zip(*found.values(), strict=True):
        flat[slot] = (int(hi) * 2**32 + int(lo)) // int(n)
    ends = bounds_of(joined.shape[1])
    return [joined[:, a:b] for a, b in zip(ends, ends[1:], strict=False)]


def integers(vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(vec_id, the kept columns, ints) of the sound vectors."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    # A null component makes forall null.
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= F.lit(1.7976931348623157e308)))
    ints = F.transform(x, lambda v: F.floor(F.lit(SCALE) * v))
    return vectors.filter(F.coalesce(finite, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), *keep, ints.alias("ints"))


def codebooks(vectors: DataFrame) -> list[np.ndarray]:
    """The final entries of every part position, from (vec_id, ints) rows of one length."""
    order = [F.col("vec_id").asc_nulls_last(), "ints"]
    first = vectors.orderBy(*order).limit(ENTRIES).select("ints").toArrow().column("ints").to_pylist()
    start = np.array(first, dtype=np.int64)
    ends = bounds_of(start.shape[1])
    books = [start[:, a:b] for a, b in zip(ends, ends[1:], strict=False)]
    for _ in range(ROUNDS):
        books = improved(vectors, books)
    return books


def coded(vectors: DataFrame, books: list[np.ndarray], keep: Sequence[str]) -> DataFrame:
    """(vec_id, the kept columns, code, error): one byte per part, and the squared distances summed."""
    names = ["vec_id", *keep]
    dims = sum(b.shape[1] for b in books)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        for rows, values in matrices(batches):
            code, error = np.zeros((len(values), PARTS), dtype=np.uint8), np.zeros(len(values), dtype=object)
            for p, _, number, part in coder.parts(values):
                code[:, p] = number
                error += part
            codes = pa.array([c.tobytes() for c in code], pa.binary())
            errors = pa.array([min(int(e), LONG) for e in error], pa.int64())
            yield pa.record_batch([*(rows.column(n) for n in names), codes, errors], names=[*names, "code", "error"])

    kinds = ", ".join(f"`{n}` {vectors.schema[n].dataType.simpleString()}" for n in names)
    found = vectors.filter(F.size("ints") == dims).mapInArrow(run, f"{kinds}, code binary, error long")
    other = vectors.filter(F.size("ints") != dims).select(*names, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    return found.union(other)


def compressed(vectors: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, list[np.ndarray]]:
    """The coded rows and the codebooks; the integers are written once, and so are the rows."""
    every = stored(integers(vectors, keep))
    least = every.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select(F.size("ints")).first()
    dims = least[0] if least else 0
    same = every.filter(F.size("ints") == dims)
    books = codebooks(same) if dims else [np.zeros((1, 0), dtype=np.int64)] * PARTS
    return stored(coded(every, books, keep)), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()


def op12_vectorcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = compressed(table(spark, sf_dir, "embeddings"), keep=["label"])
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = cut(rows.groupBy("label").agg(F.least(total, F.lit(LONG)).cast("long").alias("label_error")))
    labels = broadcast_if_small(labels.withColumnRenamed("label", "of_label"))
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _sql() -> str:
    """SQL for vectors of one length that four divides and whose sums a double holds."""
    distance = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min({{'d': {distance}::BIGINT, 'e': e}}) AS near FROM parts JOIN c{r} USING (p) GROUP BY r, p
)""")
        if r < ROUNDS:
            steps.append(f"""m{r} AS (
  SELECT p, e, list(floor(total / n)::BIGINT ORDER BY i) AS mean FROM (
    SELECT p, near.e AS e, i, sum(x[i]) AS total, count(*) AS n FROM a{r}, range(1, len(x) + 1) t(i) GROUP BY ALL
  ) GROUP BY p, e
), c{r + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(mean, y) AS y FROM c{r} LEFT JOIN m{r} USING (p, e)
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), parts AS MATERIALIZED (
  SELECT r, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS x FROM kept, range(4) t(p)
), c0 AS MATERIALIZED (
  SELECT p, r AS e, x AS y FROM parts WHERE r < {ENTRIES}
), {", ".join(steps)}, coded AS (
  SELECT r, string_agg(lower(printf('%02x', near.e::INTEGER)), '' ORDER BY p) AS code, sum(near.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY r
), book AS (
  SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), book
"""


OP12_SQL = _sql()
