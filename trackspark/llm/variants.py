"""Spelling variants: words one edit apart, found by pivotal grams, and the most frequent form of each.

Words. Runs of letters of all whole texts, A-Z lowered, are counted; words with enough code points and occurrences stay. (By
the contract a run of one document in 97 loses a code point first, which plants variants.)

Pivotal grams. The bigrams of a word are ordered by (words that hold them, gram). Its prefix is the three first, and all
that equal the third. Of the prefix, dynamic programming over positions chooses two bigrams that do not overlap and are
rarest together: the pivots. One edit touches at most one of them. So of two words one edit apart, the one whose
prefix ends first in the order has a pivot that stands in the other word's prefix. The pivots are joined with the prefixes of
other words.

Position limits. The edit lies before the gram or after it. If before, what follows is equal and the gram is shifted by the
difference in length; if after, what precedes is equal and the gram is not shifted. Where gram and equal side are shorter than
the side that holds the edit, the first or the last half of that side is equal too. A join key holds the gram,
the equal side and, where needed, the half and both lengths, for every such case: only words meet that agree on half
of their letters, and no gram is a group of its own. What meets is verified by edit distance.

Forms. A word's form is its near word of largest count (of equal ones the smallest) if that is at least twice its own.
Counts double along a chain of forms, so it has no cycle and at most 63 links; pointers are doubled until none moves.

Defined results. A null or empty text has no runs. A run of a document without an id loses nothing. Repeated rows count
again. Texts are read whole, whatever their length. An empty table gives an empty result. Other columns are not read.
Bigrams of this alphabet are at most 90 * 90, so their counts go to every task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.llm.common import cut, stored, table
from trackspark.operators.sizes import broadcast_if_small

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_CHARS, LEAST_COUNT = 5, 3
# One run in so many, by its document and spelling, loses a code point.
DAMAGED = 97
# A form has so many times the word's occurrences.
FORM_TIMES = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bigrams of a prefix: two that do not overlap are always among three.
PREFIX = 3


def damaged(word: Column, doc_id: Column) -> Column:
    """The run without one code point where its checksum says so."""
    check = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), word).cast("binary"))
    at = F.pmod(check, F.length(word)).cast("int")
    less = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(check % DAMAGED == 0, less).otherwise(word)


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that are compared."""
    runs = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1)))
    words = docs.select("doc_id", runs.alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    words = words.select(damaged(F.col("run"), F.col("doc_id")).alias("word")).filter(F.length("word") >= LEAST_CHARS)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """Occurrences of each bigram in the words; no more entries than pairs of letters."""
    grams = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2))))
    return {r.gram: r.n for r in words.select(grams.alias("gram")).groupBy("gram").agg(F.count("*").alias("n")).collect()}


def prefix(word: str, counts: dict[str, int]) -> list[int]:
    """Positions of the rarest bigrams, ascending."""
    order = sorted(((counts[word[p : p + 2]], word[p : p + 2]), p) for p in range(len(word) - 1))
    last = order[min(PREFIX, len(order)) - 1][0]
    return sorted(p for rank, p in order if rank <= last)


def pivots(word: str, positions: list[int], counts: dict[str, int]) -> tuple[int, int]:
    """The two positions of least summed counts that do not overlap."""
    best = least = None
    passed = 0
    for p in positions:
        # least: the cheapest of the positions that do not overlap this one.
        while positions[passed] <= p - 2:
            one = counts[word[positions[passed] : positions[passed] + 2]], positions[passed]
            least = one if least is None else min(least, one)
            passed += 1
        cost = counts[word[p : p + 2]]
        if least is not None and (best is None or least[0] + cost < best[0]):
            best = (least[0] + cost, least[1], p)
    return best[1], best[2]


def meeting_keys(word: str, at: int) -> Iterator[str]:
    """What the word and any word one edit away that keeps the bigram at ``at`` have in common, one text per case."""
    size = len(word)
    for side, equal, other in (("<", word[at:], word[:at]), (">", word[: at + 2], word[at + 2 :])):
        enough = False
        for more in (-1, 0, 1):
            # Letters of the shorter one of the two sides that hold the edit.
            shared = min(len(other), len(other) + more)
            if shared < 0 or (more == 0 and shared == 0):
                continue
            if len(equal) >= shared:
                enough = True
                continue
            half = shared // 2
            both = f"{side}{2 * size + more}:{equal}"
            yield f"{both}:{other[:half]}*"
            yield f"{both}:*{other[len(other) - (shared - half):]}"
        if enough:
            yield side + equal


def listed(counts: dict[str, int]):
    """(key, word, pivot) of all cases of each bigram of a word's prefix."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            keys, rows, roles = [], [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                positions = prefix(word, counts)
                chosen = pivots(word, positions, counts)
                for p in positions:
                    found = [xxhash.xxh3_64_intdigest(k) for k in meeting_keys(word, p)]
                    keys += found
                    rows += [row] * len(found)
                    roles += [p in chosen] * len(found)
            words = batch.column("word").take(pa.array(rows, pa.int32()))
            signed = pa.array(keys, pa.uint64()).view(pa.int64())
            yield pa.record_batch([signed, words, pa.array(roles, pa.bool_())], names=["key", "word", "pivot"])

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near): every two words one edit apart, once in each direction."""
    rows = words.select("word").mapInArrow(listed(gram_counts(words)), "key long, word string, pivot boolean")
    # Keys of one word, or without a pivot, go first; both sides of the join then read the same shuffle.
    by_key = Window.partitionBy("key")
    shared = rows.withColumns({"_lo": F.min("word").over(by_key), "_hi": F.max("word").over(by_key), "_pivot": F.max("pivot").over(by_key)})
    shared = shared.filter("_lo < _hi and _pivot").select("key", "word", "pivot")
    left, right = shared.filter("pivot").select("key", "word"), shared.select("key", F.col("word").alias("near"))
    lengths = F.abs(F.length("word") - F.length("near")) <= 1
    met = left.join(right, "key").filter(lengths & (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1))
    ways = F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))
    return met.select(F.inline(ways)).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: pointers are doubled until none moves."""
    pointers = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        following = broadcast_if_small(pointers.select(F.col("word").alias("root"), F.col("root").alias("next")))
        moved = cut(pointers.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        pointers = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return pointers


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n) rows."""
    words = stored(words)
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("first")
    near = near_pairs(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    of_word = near.groupBy("word").agg(F.count("*").alias("n_near"), first)
    found = words.join(of_word, "word", "left").withColumn("form_n", -F.col("first.less"))
    frequent = F.col("form_n") >= FORM_TIMES * F.col("n")
    found = stored(
        found.select(
            "word",
            F.when(frequent, F.col("first.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("form_n")).alias("form_n"),
        )
    )
    last = broadcast_if_small(roots(found.filter("form is not null")))
    named = found.join(last, "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(counted_words(table(spark, sf_dir, "documents")))


OP13_SQL = rf"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i)
  )
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS run FROM documents
), each AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS h FROM runs GROUP BY ALL
), checked AS (
  SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(0, len(h), 2), lambda i: ('0x' || substr(h, i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM each, crc_table
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN crc % {DAMAGED} = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM checked
  ) WHERE length(word) >= {LEAST_CHARS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), less AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS d FROM words, range(1, length(word) + 1) t(i)
), near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.d = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.d = b.word
), best AS (
  SELECT word, count(*) AS n_near, min({{'a': -near_n, 'b': near}}) AS first FROM near GROUP BY word
), formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -first.a >= {FORM_TIMES} * n THEN first.b END AS form,
    CASE WHEN -first.a >= {FORM_TIMES} * n THEN -first.a END AS form_n
  FROM words LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS here, 0 AS steps FROM formed UNION ALL SELECT path.word, form, steps + 1 FROM path JOIN formed ON here = formed.word WHERE form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, max_by(here, steps) AS root FROM path GROUP BY word) USING (word)
"""
