"""Similarity join of word n-gram sets by prefix trees, and the components of its links.

A text's set holds the hashes of its distinct n-grams of words, ascending: the global order. Texts with equal sets
are one class. Different sets are linked when ``100 * intersection >= percent * union``.

Meeting. Two linked sets differ in at most k elements, k bound by their sizes. Elements are dealt by hash into
k + 1 + slack parts, so that linked sets agree on more than slack whole parts, of which a half is asked for; each part's content is a key. A set with many
empty parts is dealt again by another hash; one that still has many after the last gives keys for these too: the part's number
with one of its k + 1 least elements, of which linked sets have one in common. So no key is held by a fixed share of all sets. Sizes fall into bands as wide as linked sizes can differ, and a set gives keys for
its own band and the next. Keys of one document are a fixed share of its elements. Sets that only share a passage
agree on few parts: a set with fewer shared keys than a link needs leaves, and so do keys that then have one set only,
for ``PRUNING`` rounds.

Trees. What meets is compared in blocks: the sets of one side stand in a trie over the global order, equal beginnings
stored once; a set of the other side walks it with its overlap so far, and leaves a subtree when even all remaining
elements of either side could not reach the overlap that the shortest set below needs. Members of one component are
not compared again.

Groups of copies. A first round compares every set with the least id it shares a key with, a second with a
pseudo-random one: that ties groups of any size together with one comparison a set. Only keys on which different
components still meet go on; keys with the same least set are one group, whose sets are cut into blocks by size, and
every pair of blocks that sizes permit is joined. So no link between different components is lost, and no pairs within a group
are listed. What comes back from a block joins components; its number is below the block's sets.

Defined results. A null or empty text, or one without words, has an empty set and is linked with nothing. A text of
fewer words than ``words`` has one n-gram, the whole sequence. Texts are processed whole. Rows with one id are one
node: links of any of them count. A row without an id has no component. Repeated rows give repeated rows. An empty
table gives an empty result. Other columns are not read. N-grams and sets are compared by 64- and 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.llm.common import cut, discard, latest, made, mixed, rolled, slices, stored, table, word_hashes
from trackspark.operators.sizes import broadcast_if_small

WORDS, PERCENT = 5, 80
# Sets of a side of a block.
BLOCK_SETS = 256
# Elements of an edge compared before the bound is looked at again.
STRIDE = 64
STAR_ROUNDS = 2
# Ways to deal a set into parts, tried until few parts are empty.
DEALINGS = 4
PRUNING = 2
# Sides of a set in a block.
STORED, PROBES, BOTH = 0, 1, 2


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The ascending set of n-gram hashes; only A-Z are lowered."""
    hashes = word_hashes((text or b"").lower())
    if 0 < len(hashes) < words:
        return rolled(hashes, len(hashes))
    return np.unique(rolled(hashes, words))


def band_starts(percent: int, upto: int) -> list[int]:
    """Least size of each band: sizes that can be linked lie in one band or in neighbours."""
    starts = [1]
    while starts[-1] <= upto:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 100 // percent)))
    return starts


def scheme(number: int, starts: list[int], percent: int) -> tuple[int, int, int]:
    """(k, parts, keys that linked sets share at least) of the scheme that compares bands ``number - 1`` and ``number``."""
    most = starts[number + 1] - 1
    k = 2 * most * (100 - percent) // (100 + percent)
    slack = max(2, k // 4)
    return k, k + 1 + slack, 1 + slack // 2


def part_keys(tokens: np.ndarray, percent: int, starts: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(scheme, keys needed for a link, keys) of a set. Where k is 0 only equal sets are linked: one class already.

    Linked sets share parts - k parts at least; all but the empty parts of either set are full in both. So full parts
    suffice if either set has few empty ones. A set with more is dealt again by another hash, up to ``DEALINGS`` times, until it
    has few; of two linked sets either has few in a dealing that both have, or both are left at the last. There a set gives its
    empty parts too. An empty part says nothing of itself, so its key holds an element: of the k + 1 least elements
    of either of two linked sets, the least common one is among those of the other.
    """
    band = int(np.searchsorted(starts, len(tokens), side="right")) - 1
    worth = mixed(tokens + np.uint64(1))
    for number in (band, band + 1):
        k, parts, needed = scheme(number, starts, percent)
        if not k:
            continue
        for dealing in range(DEALINGS):
            own = number * DEALINGS + dealing
            part = (mixed(tokens ^ np.uint64(0x5851F42D4C957F2D + dealing)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part = part[order]
            at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            full = part[at]
            tag = mixed(np.uint64(own << 32) + np.arange(parts, dtype=np.uint64))
            keys = mixed(np.add.reduceat(worth[order], at) ^ tag[full])
            few = len(full) >= k + needed
            if not few and dealing == DEALINGS - 1:
                least = mixed(tokens[: k + 1] + np.uint64(2))
                keys = np.concatenate([keys, mixed(np.delete(tag, full)[:, None] ^ least).ravel()])
            yield own, needed, keys
            if few:
                break


def described(words: int):
    """(doc_id, n_shingles, s1, s2): the set's size and its 128-bit hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches):
            sizes, hashes = [], []
            for text in batch.column("text").to_pylist():
                tokens = shingles(text, words)
                sizes.append(len(tokens))
                hashes.append(xxhash.xxh3_128_digest(tokens.tobytes()))
            both = np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 2)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), both[:, 0].copy(), both[:, 1].copy()],
                names=["doc_id", "n_shingles", "s1", "s2"],
            )

    return run


def keyed(words: int, percent: int):
    """(key, doc_id, scheme) of each set, once per set and task; the scheme's lower half is the number of keys needed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        seen, starts = set(), band_starts(percent, 1 << 10)
        for batch in slices(batches):
            rows = [(np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                tokens = shingles(text, words)
                name = xxhash.xxh3_128_digest(tokens.tobytes())
                if not len(tokens) or name in seen:
                    continue
                seen.add(name)
                if starts[-3] <= len(tokens):
                    starts = band_starts(percent, 4 * len(tokens))
                for number, needed, keys in part_keys(tokens, percent, starts):
                    rows.append((keys, np.full(len(keys), doc), np.full(len(keys), number << 32 | needed, dtype=np.int64)))
            keys, docs, numbers = (np.concatenate(c) for c in zip(*rows, strict=True))
            yield pa.record_batch([keys.view(np.int64), docs, numbers], names=["key", "doc_id", "scheme"])

    return run


def gathered(words: int):
    """(rep, tokens) of the texts that are compared."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t, words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(sets, pa.binary())], names=["rep", "tokens"])

    return run


def packed_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of keys as bytes."""
    for batch in batches:
        keys = [np.asarray(k.values).tobytes() for k in batch.column("listed")]
        yield pa.record_batch([batch.column("rep"), pa.array(keys, pa.binary())], names=["rep", "keys"])


class Trie:
    """Ascending sets in a tree with joined edges.

    A node is (edge, depth after it, shortest and longest set below, number of the set ending here, children, the one
    component of all sets below or None, begin and end of the sets below in lexicographic order).
    """

    def __init__(self, sets: list[np.ndarray], components: list[int]):
        self.sets, self.components = sets, components
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.order = np.array(order, dtype=np.int64)
        self.roots = self.grown(order)

    def grown(self, order: list[int]) -> list[list]:
        """Nodes for sets in lexicographic order; grown from a list of open ranges, not by recursion."""
        roots: list[list] = []
        todo = [(order, 0, roots, 0)]
        while todo:
            inside, depth, into, base = todo.pop()
            start = 0
            while start < len(inside):
                first = self.sets[inside[start]]
                end = start + 1
                while end < len(inside) and self.sets[inside[end]][depth] == first[depth]:
                    end += 1
                last = self.sets[inside[end - 1]]
                # The first and last of a sorted range share what all share.
                common = min(len(first), len(last))
                differ = np.flatnonzero(first[depth:common] != last[depth:common])
                until = depth + int(differ[0]) if len(differ) else common
                group = inside[start:end]
                lengths = [len(self.sets[i]) for i in group]
                ends = [i for i in group if len(self.sets[i]) == until]
                below = [i for i in group if len(self.sets[i]) > until]
                kinds = {self.components[i] for i in group}
                children: list[list] = []
                one = kinds.pop() if len(kinds) == 1 else None
                into.append([first[depth:until], until, min(lengths), max(lengths), ends, children, one, base + start, base + end])
                if below:
                    # Sets that end here sort before those that go on.
                    todo.append((below, until, children, base + start + len(ends)))
                start = end
        return roots

    def linked(self, probe: np.ndarray, percent: int, skip, among: np.ndarray | None = None) -> Iterator[int]:
        """Numbers of the sets linked with the probe; ``skip(component)`` is true where no answer is wanted.

        ``among`` tells for each set whether it can be linked at all; subtrees without such a set are left out.
        """
        size = len(probe)
        upto = None if among is None else np.concatenate([[0], np.cumsum(among[self.order])])
        least = -(-percent * size // 100)
        todo = [(node, 0) for node in self.roots]
        while todo:
            (edge, depth, shortest, longest, ends, children, component, begin, end), overlap = todo.pop()
            if upto is not None and upto[begin] == upto[end]:
                continue
            if longest < least or shortest * percent > size * 100 or (component is not None and skip(component)):
                continue
            total = size + max(shortest, least)
            needed = -(-percent * total // (100 + percent))
            at, alive = depth - len(edge), True
            for start in range(0, len(edge), STRIDE):
                part = edge[start : start + STRIDE]
                place = np.searchsorted(probe, part)
                overlap += int((probe[np.minimum(place, size - 1)] == part).sum())
                at += len(part)
                passed = int(place[-1]) + (place[-1] < size and probe[place[-1]] == part[-1])
                if overlap + min(longest - at, size - passed) < needed:
                    alive = False
                    break
            if not alive:
                continue
            for i in ends:
                if 100 * overlap >= percent * (size + depth - overlap) and (among is None or among[i]) and not skip(self.components[i]):
                    yield i
            todo += [(child, overlap) for child in children]


class Postings:
    """Which of the stored sets share a key with another one."""

    def __init__(self, keys: list[np.ndarray]):
        self.count = len(keys)
        every, owners = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        order = np.argsort(every, kind="stable")
        self.keys, self.owners = every[order], owners[order]

    def sharing(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(self.count, dtype=bool)
        for a, b in zip(np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right"), strict=True):
            found[self.owners[a:b]] = True
        return found


def block_links(percent: int):
    """Join the two sides of a block; returns links that join different components. Sets with ``keys`` are compared only
    with those they share one with."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by([("rep", "ascending"), ("side", "ascending")])
        keys = [np.frombuffer(k, dtype=np.int64) if k else None for k in rows.column("keys").to_pylist()]
        cells = list(zip(*(rows.column(n).to_pylist() for n in ("side", "rep", "comp", "tokens")), keys, strict=True))
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        stored = [c for c in cells if c[0] != PROBES and c[3]]
        trie = Trie([np.frombuffer(c[3], dtype=np.uint64) for c in stored], [c[2] for c in stored])
        postings = Postings([c[4] for c in stored]) if stored and all(c[4] is not None for c in stored) else None
        found = []
        for side, _, comp, tokens, own in cells:
            if side == STORED or not tokens:
                continue
            among = postings.sharing(own) if postings and own is not None else None
            if among is not None and not among.any():
                continue
            skip = lambda other, comp=comp: root(other) == root(comp)
            for i in trie.linked(np.frombuffer(tokens, dtype=np.uint64), percent, skip, among):
                a, b = root(trie.components[i]), root(comp)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    found.append((trie.components[i], comp))
        yield pa.record_batch([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def joined_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components, from rows (block, side, rep, comp) and the sets (rep, tokens, keys)."""
    rows = broadcast_if_small(cut(members)).join(sets, "rep").select("block", "side", "rep", "comp", "tokens", "keys")
    return rows.groupBy("block").applyInArrow(block_links(percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of the links, comp the least node reachable: alternating large and small stars.

    Each step is written to the shared checkpoint folder. Nothing but counts reaches the driver.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    size = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while size[0]:
        both = edges.union(edges.select(F.col("b"), F.col("a")).toDF("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.filter("a > b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        near = down.join(least, "a")
        small = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(near.select("a", F.col("m").alias("b")))
        edges = cut(small.filter("a > b").distinct())
        before, size = size, edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if size == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(roots)


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, comp) with the components that links join made one."""
    new = broadcast_if_small(cut(components(links))).withColumnRenamed("comp", "new_comp")
    joined = labels.join(new, F.col("comp") == F.col("node"), "left")
    return cut(joined.select("rep", F.coalesce("new_comp", "comp").alias("comp")))


def needed_keys() -> Column:
    return F.col("scheme").bitwiseAND(0xFFFFFFFF)


def pruned(keys: DataFrame) -> DataFrame:
    """Without the keys of one set only, and then without the sets that share too few keys of a scheme for a link."""
    by_key, by_set = Window.partitionBy("key"), Window.partitionBy("rep", "scheme")
    several = keys.withColumns({"lo": F.min("rep").over(by_key), "hi": F.max("rep").over(by_key)}).filter("lo < hi")
    enough = several.withColumn("shared", F.count("*").over(by_set)).filter(F.col("shared") >= needed_keys())
    return enough.select("key", "rep", "scheme")


def prefixes(keys: DataFrame) -> DataFrame:
    """(key, rep): of a set's keys, from the rarest on, all but one less than a link needs.

    Two sets that share as many keys as needed share one of these, in the global order of (sets of a key, key); what
    stays away are each set's most frequent keys.
    """
    by_key = Window.partitionBy("key")
    order = Window.partitionBy("rep", "scheme").orderBy("sets", "key")
    ranked = keys.withColumn("sets", F.count("*").over(by_key)).withColumns(
        {"place": F.row_number().over(order), "shared": F.count("*").over(Window.partitionBy("rep", "scheme"))}
    )
    first = ranked.filter(F.col("place") <= F.col("shared") - needed_keys() + 1).select("key", "rep")
    several = first.withColumns({"lo": F.min("rep").over(by_key), "hi": F.max("rep").over(by_key)})
    return several.filter("lo < hi").select("key", "rep")


def star_blocks(meetings: DataFrame, number: int) -> DataFrame:
    """Blocks of one round: every set against one set it meets, in blocks of at most ``BLOCK_SETS`` sets a side.

    The first round takes the least id of a key, a later one the least by a hash; of its keys a set takes the least.
    """
    rank = F.col("rep") if number == 0 else F.xxhash64("rep", F.lit(number))
    by_key = Window.partitionBy("key")
    lead = F.min(F.struct(rank.alias("rank"), F.col("rep").alias("lead"), F.col("comp").alias("lead_comp"))).over(by_key)
    pairs = (
        meetings.withColumn("first", lead)
        .filter(F.col("first.lead_comp") != F.col("comp"))
        .groupBy("rep", "comp")
        .agg(F.min("first").alias("first"))
        .select("rep", "comp", "first.lead", "first.lead_comp")
    )
    per_lead = pairs.withColumn("all", F.count("*").over(Window.partitionBy("lead")))
    cell = F.pmod(F.xxhash64("rep"), F.ceil(F.col("all") / BLOCK_SETS))
    dealt = cut(per_lead.withColumn("block", F.concat_ws("-", "lead", cell)))
    stored = dealt.select("block", F.lit(STORED).alias("side"), "rep", "comp")
    probes = dealt.select("block", F.lit(PROBES).alias("side"), F.col("lead").alias("rep"), F.col("lead_comp").alias("comp"))
    return stored.union(probes.distinct())


def met(keys: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, rep, comp) of the keys on which different components meet."""
    found = keys.join(labels, "rep")
    by_key = Window.partitionBy("key")
    spread = found.withColumn("lo", F.min("comp").over(by_key)).withColumn("hi", F.max("comp").over(by_key))
    return spread.filter("lo < hi").select("key", "rep", "comp")


def group_blocks(meetings: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Blocks for every pair of sets of one group that sizes permit.

    A key belongs to the group of its least set, and a set to the groups of its keys: sets that share a key share a
    group, and the many keys of a family of texts make few groups.
    """
    by_key, by_group = Window.partitionBy("key"), Window.partitionBy("group")
    grouped = meetings.withColumn("group", F.min("rep").over(by_key)).select("group", "rep", "comp").distinct()
    mixed_groups = grouped.withColumns({"lo": F.min("comp").over(by_group), "hi": F.max("comp").over(by_group)}).filter("lo < hi")
    involved = mixed_groups.select("group", "rep", "comp").join(sizes, "rep")
    cell = F.floor((F.row_number().over(by_group.orderBy("n_shingles", "rep")) - 1) / BLOCK_SETS)
    cells = cut(involved.select("group", "rep", "comp", "n_shingles", cell.alias("cell")))
    spans = cells.groupBy("group", "cell").agg(F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"))
    # Most groups have one cell, which meets itself: its sets are stored and probe at once.
    alone = cells.select(F.concat_ws("-", "group", "cell").alias("block"), F.lit(BOTH).alias("side"), "rep", "comp")
    large = spans.join(spans.filter("cell > 0").select("group").distinct(), "group")
    other = large.toDF("group", "cell2", "lo2", "hi2")
    pairs = large.join(other, "group").filter((F.col("cell") < F.col("cell2")) & (F.col("lo2") * percent <= F.col("hi") * 100))
    named = pairs.select("group", "cell", "cell2", F.concat_ws("-", "group", "cell", "cell2").alias("block"))
    left = named.join(cells, ["group", "cell"]).select("block", F.lit(STORED).alias("side"), "rep", "comp")
    right = named.drop("cell").withColumnRenamed("cell2", "cell").join(cells, ["group", "cell"])
    return alone.union(left).union(right.select("block", F.lit(PROBES).alias("side"), "rep", "comp"))


def linked_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    base = cut(rows.mapInArrow(described(words), "doc_id long, n_shingles long, s1 long, s2 long"))
    usable = base.filter("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    member = usable.select("doc_id", "s1", "s2", "n_shingles").join(classes, ["s1", "s2"])
    own = cut(member.groupBy("doc_id", "rep").agg(F.max("n_shingles").alias("n_shingles")))

    # Keys that more than one document of different tasks holds, by class.
    keys = rows.filter("doc_id is not null").mapInArrow(keyed(words, percent), "key long, doc_id long, scheme long")
    by_key = Window.partitionBy("key")
    shared = keys.withColumn("lo", F.min("doc_id").over(by_key)).withColumn("hi", F.max("doc_id").over(by_key)).filter("lo < hi")
    # Looked up in place, classes leave the keys where the first shuffle put them.
    meeting_keys = shared.join(broadcast_if_small(own.select("doc_id", "rep")), "doc_id").select("key", "rep", "scheme").distinct()
    spark, before = docs.sparkSession, made()

    def kept(df: DataFrame) -> DataFrame:
        """``df`` written; what it was made of, since ``before``, is not needed any more."""
        out = stored(df)
        discard(spark, before, keep=[latest()])
        return out

    for _ in range(PRUNING):
        meeting_keys = kept(pruned(meeting_keys))
    meeting_keys = kept(prefixes(meeting_keys))
    active = cut(meeting_keys.select(F.col("rep").alias("active")).distinct())
    wanted = rows.join(broadcast_if_small(active), F.col("doc_id") == F.col("active")).select("doc_id", "text")
    sets = stored(wanted.mapInArrow(gathered(words), "rep long, tokens binary"))
    sizes = sets.select("rep", (F.octet_length("tokens") / 8).cast("long").alias("n_shingles")).groupBy("rep").agg(F.max("n_shingles").alias("n_shingles"))

    labels = active.select(F.col("active").alias("rep"), F.col("active").alias("comp"))
    # Rows of one id with different texts: their classes are one component.
    twice = own.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b")
    links = [own.join(twice, "doc_id").select("a", F.col("rep").alias("b"))]
    before = made()
    meetings = kept(met(meeting_keys, labels))
    for number in range(STAR_ROUNDS):
        found = cut(joined_blocks(star_blocks(meetings, number), sets.withColumn("keys", F.lit(None).cast("binary")), percent))
        links.append(found)
        labels = relabelled(labels, found)
        meetings = kept(met(meeting_keys, labels))
    # Within a group only sets that share a key can be linked.
    own_keys = meetings.select("rep", "key").distinct().groupBy("rep").agg(F.collect_list("key").alias("listed"))
    keyed_sets = sets.join(own_keys.mapInArrow(packed_keys, "rep long, keys binary"), "rep")
    links.append(joined_blocks(group_blocks(meetings, sizes, percent), keyed_sets, percent))
    every = links[0]
    for more in links[1:]:
        every = every.union(more)
    final = components(every).withColumnRenamed("comp", "found")
    of_class = own.join(final, F.col("rep") == F.col("node"), "left").select("doc_id", F.coalesce("found", "rep").alias("component_id"))
    of_id = of_class.groupBy(F.col("doc_id").alias("own_id")).agg(F.min("component_id").alias("component_id"))
    result = base.join(of_id, F.col("doc_id") == F.col("own_id"), "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(table(spark, sf_dir, "documents"), words=3, percent=90)


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d
), grams AS (
  SELECT doc_id, unnest(g) AS s FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id WHERE 100 * n >= 90 * (len(x.g) + len(y.g) - n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS seen FROM d UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON seen = a
)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""


# Columns that the stage adds for a while; no document table has such names.
NODE, FIRST, LOST, REPEATED = "node of the row", "place within the node", "node that goes", "node of several rows"


def text_prints() -> list[Column]:
    """128 bits of a text, as two numbers."""
    return [F.xxhash64(F.lit(1), "text").alias("t1"), F.xxhash64(F.lit(2), "text").alias("t2")]


def hashed_node(salt: int) -> Column:
    """A number for each (id, text); nulls are values."""
    return F.xxhash64(F.lit(salt), F.isnull("doc_id"), "doc_id", "t1", "t2")


def with_nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with ``NODE``, a number for each (id, text), and the table (node, doc_id, rows).

    An id that stands for one text is its node. Rows without an id, and those of an id with several texts, have a hash for one; where
    such ids are too many to be looked up in place, all rows have. Whether two nodes are one number is looked at,
    and then another salt is taken.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    rows = cut(docs.select(doc_id, *text_prints()).groupBy("doc_id", "t1", "t2").agg(F.count("*").alias("rows")))
    several = cut(rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(REPEATED)))
    # What is broadcast is bounded by its measured size.
    small = broadcast_if_small(several) is not several

    def noded(df: DataFrame, own_id: Column, salt: int) -> DataFrame:
        if not small:
            return df.withColumn(NODE, hashed_node(salt))
        looked = df.join(F.broadcast(several), own_id == F.col(REPEATED), "left")
        single = own_id.isNotNull() & F.col(REPEATED).isNull()
        return looked.withColumn(NODE, F.when(single, own_id).otherwise(hashed_node(salt))).drop(REPEATED)

    salt = 0
    while True:
        nodes = cut(noded(rows, F.col("doc_id"), salt).select(F.col(NODE).alias("node"), "doc_id", "rows"))
        if nodes.groupBy("node").count().filter("count > 1").isEmpty():
            break
        salt += 1
    # The hash reads plain names: they are put beside the columns of the table for a moment.
    names = docs.columns
    plain = docs.select(
        *(F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)), doc_id, *text_prints()
    )
    out = noded(plain, F.col("doc_id"), salt).select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)), NODE)
    return out, nodes


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents with one of each component, all columns as they were.

    Rows are told apart by id and text: rows of one id with different texts are documents of their own, and rows without
    an id take part. Of a component the row of the least id stays (a null id only where there is no other; of equal ids the
    least by a hash of the text); of rows equal in id and text the first by a hash of the row. Texts without a
    word are linked with nothing and all stay.
    """
    names = docs.columns
    marked, rows = with_nodes(docs)
    linked = linked_components(marked.select(F.col(NODE).alias("doc_id"), "text"), words, percent)
    found = linked.filter("n_shingles > 0").select(F.col("doc_id").alias("node"), F.col("component_id").alias("component")).distinct()
    found = cut(found.join(rows, "node"))
    order = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "node")
    winners = found.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first.node").alias("stays"))
    losers = found.join(winners, F.col("node") == F.col("stays"), "left_anti").select(F.col("node").alias(LOST))
    losers = broadcast_if_small(cut(losers))
    several = broadcast_if_small(cut(found.filter("rows > 1").select(F.col("node").alias(REPEATED))))
    kept = marked.join(losers, F.col(NODE) == F.col(LOST), "left_anti")
    once = kept.join(several, F.col(NODE) == F.col(REPEATED), "left_anti")
    more = kept.join(several, F.col(NODE) == F.col(REPEATED), "left_semi")
    by_row = Window.partitionBy(NODE).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in names)))
    first = more.withColumn(FIRST, F.row_number().over(by_row)).filter(F.col(FIRST) == 1).drop(FIRST)
    return once.union(first).select(*(F.col(f"`{c}`") for c in names))
