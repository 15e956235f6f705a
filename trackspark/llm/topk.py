"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Vectors become integers (``floor(256 * x)``). Candidates are packed into blocks of bounded size; queries too. A task
takes one block of candidates and one of queries, sorts each dimension of the candidates once, and answers every
query: it walks all lists in parallel, best end first, scores what it meets in full, and stops when the sum of
weight times list position, the bound of anything unseen, is below the k-th score. Each pair of blocks returns at
most k rows per query; a window keeps the k best of these. The queries are a stated part of the rows (one in 50), so
blocks of candidates meet blocks of queries, never rows rows.

Defined results. Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without
an id. Only vectors of the same length are compared. Of equal scores the smaller id ranks first. Rows with one id
twice are two candidates but one query, that of the smaller vector; a query excludes all rows of its own id. Sums beyond 63 bits are computed exactly and
clipped to the range of a long. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.llm.common import table

TOP = 5
EVERY = 50
# Vectors of a block. 64 dimensions of 8 bytes make 4 MB of candidates; the sorted lists take as much again.
CANDIDATES, QUERIES = 8192, 1024
LONG = 2**63 - 1
FOUND = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, ints, dims) of the vectors that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    # isnan and the comparison reject NaN and infinities; a null component makes forall null.
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= F.lit(1.7976931348623157e308)))
    sound = F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0) & F.col("vec_id").isNotNull()
    return (
        vectors.filter(sound)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform(x, lambda v: F.floor(F.lit(256.0) * v).cast("double")).alias("ints"),
            F.size("embedding").alias("dims"),
        )
    )


def packed(vectors: DataFrame, rows: int, total: int) -> DataFrame:
    """One row per block: dims, block, ids and components as bytes. Blocks are dealt by a hash of the id.

    A block holds ``rows`` vectors on average; the hash spreads repeated ids' neighbours, and an id repeated so often
    that its block grows is cut again by Arrow's batches in ``pack``.
    """
    blocks = max(1, -(-total // rows))
    spread = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))

    def pack(key: tuple[pa.Scalar, ...], tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values = [], []

        def out() -> pa.RecordBatch:
            data = np.concatenate(values).tobytes()
            return pa.record_batch(
                [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), [np.concatenate(ids).tobytes()], [data]],
                names=["dims", "block", "ids", "data"],
            )

        held = 0
        for batch in tables:
            ids.append(batch.column("vec_id").to_numpy())
            values.append(batch.column("ints").flatten().to_numpy(zero_copy_only=False))
            held += batch.num_rows
            if held >= 2 * rows:
                yield out()
                ids, values, held = [], [], 0
        if held:
            yield out()

    schema = "dims int, block int, ids binary, data binary"
    return spread.groupBy("dims", "block").applyInArrow(pack, schema)


def exact_ints(data: bytes, dims: int) -> np.ndarray:
    """Components as 64-bit integers; as Python integers where products could leave 63 bits."""
    values = np.frombuffer(data, dtype=np.float64).reshape(-1, dims)
    if values.size and np.abs(values).max() >= 2.0 ** (30 - dims.bit_length() / 2):
        return np.array([[int(v) for v in row] for row in values], dtype=object)
    return values.astype(np.int64)


def best_by_threshold(ids: np.ndarray, rows: np.ndarray, lists: np.ndarray, query: np.ndarray, own: int, k: int):
    """The k best (score, id) of a block by Fagin's threshold algorithm, and the depth at which it stopped."""
    count, dims = rows.shape
    down, up = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    seen = np.zeros(count, dtype=bool)
    scores, held, depth, step = np.empty(0, dtype=rows.dtype), np.empty(0, dtype=np.int64), 0, max(8, 2 * k)
    while depth < count:
        until = min(count, depth + step)
        met = np.concatenate([lists[count - until : count - depth, down].ravel(), lists[depth:until, up].ravel()])
        if not len(met):  # an all-zero query: every candidate scores 0
            met, until = np.arange(count), count
        fresh = np.unique(met[~seen[met]])
        seen[fresh] = True
        fresh = fresh[ids[fresh] != own]
        scores = np.concatenate([scores, rows[fresh] @ query])
        held = np.concatenate([held, fresh])
        if len(held) > k:
            keep = np.lexsort((ids[held], -scores))[:k]
            scores, held = scores[keep], held[keep]
        depth, step = until, step * 2
        if len(held) == k and depth < count:
            at_down, at_up = lists[count - depth, down], lists[depth - 1, up]
            bound = (rows[at_down, down] * query[down]).sum() + (rows[at_up, up] * query[up]).sum()
            if bound < scores[-1]:
                break
    order = np.lexsort((ids[held], -scores))[:k]
    return scores[order], ids[held[order]], depth


def answers(k: int):
    """Top k of each query in one pair of blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, lists, rows, ids = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                cell = lambda name: batch.column(name)[i].as_py()  # noqa: B023, E731
                dims, content = cell("dims"), cell("data")
                if content != last:
                    last, rows, ids = content, exact_ints(content, dims), np.frombuffer(cell("ids"), dtype=np.int64)
                    lists = np.argsort(rows, axis=0, kind="stable").astype(np.int32)
                asked, owners = exact_ints(cell("q_data"), dims), np.frombuffer(cell("q_ids"), dtype=np.int64)
                use = rows.astype(object) if asked.dtype == object and rows.dtype != object else rows
                asked = asked.astype(object) if use.dtype == object else asked
                out_q, out_v, out_s = [], [], []
                for query, owner in zip(asked, owners, strict=True):
                    scores, best, _ = best_by_threshold(ids, use, lists, query, owner, k)
                    out_q += [owner] * len(best)
                    out_v += best.tolist()
                    out_s += [max(-LONG - 1, min(LONG, int(s))) for s in scores]
                if out_q:
                    kinds = pa.int64()
                    yield pa.record_batch(
                        [pa.array(out_q, kinds), pa.array(out_v, kinds), pa.array(out_s, kinds)],
                        names=["query_id", "vec_id", "score"],
                    )

    return run


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, per_block: int = CANDIDATES, per_query: int = QUERIES) -> DataFrame:
    """The k best candidates of every query: query_id, rank, vec_id, score."""
    ready = whole_vectors(vectors)
    asked = ready.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("ints").alias("ints"))
    asked = asked.withColumn("dims", F.size("ints"))
    total, n_asked = ready.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    q_blocks = max(1, -(-n_asked // per_query))
    queries = packed(asked, per_query, n_asked).select(
        F.col("dims").alias("q_dims"), F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")
    )
    blocks = packed(ready, per_block, total).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    pairs = blocks.join(
        queries, (blocks["dims"] == queries["q_dims"]) & (blocks["q_block"] == queries["q_block"])
    ).select("dims", "ids", "data", "q_ids", "q_data")
    found = pairs.repartition(F.xxhash64("ids"), F.xxhash64("q_ids")).mapInArrow(answers(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP10_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {TOP}
"""
