"""Near-duplicate documents by an LSH forest.

Each distinct shingle set gets TREES x DEPTH minhashes. In each tree the sets are sorted by that tree's minhashes, a
distributed sort by a key that is unique, so no region of like sets can load one task. Neighbours in this order share
the longest prefixes: where sets are sparse a short prefix makes two of them neighbours, in dense regions only a deep
one does. Neighbours whose minhashes mostly agree are candidates, links are confirmed on the full sets, and where a
candidate fails in a dense region, its best connected neighbour is tried as well. Equal sets are one node from the
start, so thousands of copies cost one row.

What the forest leaves open is settled exactly. In any one order of all shingles, two sets that are similar enough share
one of their first few (prefix filter); the order puts shingles that are common in a sample last. These first shingles
are shuffled once, and only those whose nodes lie in different components are kept: where a shingle has many nodes, some
rounds tie them to its best connected one, then all pairs of nodes in different components that sizes and places allow are
looked at, each where the two first meet.

Before any pair is confirmed, the parities of its sets, folded into BITS bits, must differ in no more bits than the sets
may differ in shingles; no link is lost by that, and few other pairs pass.

Defined results: null and empty texts have no shingles and are linked with nothing; copies, repeated rows and ties go
to the smallest doc_id; rows without a doc_id belong to the group of their text but never represent it (component_id
may be null then, kept is false); different texts under one doc_id are nodes of their own, so each row is judged by its
text, and `first` holds for the rows of one text of a group only; very long texts are large sets, taken whole; an empty
table gives an empty table; extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shingles import mixed, text_sets
from .store import MOST_KEYS, dropped, matching, row_key, settled, workers_find_library

TREES, DEPTH = 16, 8
NEIGHBOURS = 2
AGREEING = 5
SET_BATCH = 200_000
#: For the order of shingles one text in SHARE is read, or more, up to SAMPLED; how often a shingle stands in these to count as common, and how many of them count. Results do not depend on them.
SAMPLED, SHARE, COMMON, MOST_COMMON = 8_000, 8, 3, 100_000
HUB_ROUNDS = 3
#: Shingles of more nodes than this take part in these rounds; those of fewer have at most half as many pairs for each node.
DENSE = 64
#: A pair is looked at where it first meets: each node carries so many of its open shingles before the one at hand.
EARLIER = 4
SALTED = 500
#: Facts on up to this many nodes (at most some 1.2 KB each) may go through the driver to every executor.
MOST_FACTS = 5_000
#: Bits of the parities of a set, and of those of a set of more than SMALL shingles besides.
BITS, SMALL, WIDE_BITS = 512, 700, 8192
#: Longs that these are folded to where nodes meet at a shingle; the wide ones rule out unlike sets of some thousand shingles there.
FOLDED, WIDE_FOLDED = 4, 16
MULTIPLIERS = mixed(np.arange(1000, 1000 + TREES * DEPTH, dtype=np.uint64)) | np.uint64(1)


def minhashes(values: np.ndarray) -> bytes:
    """The upper 32 bits of the least a * x mod 2^64 for each multiplier a, big-endian, so that bytes sort as numbers."""
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max)
    for at in range(0, len(values), 2048):
        np.minimum(least, np.multiply.outer(MULTIPLIERS, values[at : at + 2048]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(">u4").tobytes()


def common_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are common in a sample of texts, in ascending order, and the rank of each by its frequency."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sample = docs.select(text.alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(max(1, min(SHARE, docs.count() // SAMPLED)))) == 0).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *text_sets(batch.column(0), width)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n, pa.int64())], names=["shingle", "n"])

    counted = sample.mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    values = counted.orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).toArrow()["shingle"].to_numpy().view(np.uint64)
    ranks = len(values) - np.arange(len(values))
    order = np.argsort(values)
    return values[order], ranks[order]


def prefix(values: np.ndarray, percent: int, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a set of which each similar enough set has one among its own: common ones come last."""
    known, ranks = common
    if len(known) and len(values):
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        values = values[np.lexsort((values, np.where(known[at] == values, ranks[at], 0)))]
    return values[: len(values) - -(-percent * len(values) // 100) + 1]


def parities(values: np.ndarray, width: int) -> np.ndarray:
    """Bit i of width says whether an odd number of shingles fall to i, as longs."""
    odd = np.bincount((values >> np.uint64(20)).astype(np.int64) % width, minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch(docs: DataFrame, width: int, percent: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, the key of the row, n_shingles, two keys of the whole set, its minhashes (null without shingles), its prefix and its parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, one, two, signs, heads, bits, wide = [], [], [], [], [], [], []
            for values in text_sets(batch.column(3), width):
                counts.append(len(values))
                one.append(int(mixed(values).sum().view(np.int64)) if len(values) else 0)
                two.append(int(mixed(values ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)) if len(values) else 0)
                signs.append(minhashes(values) if len(values) else None)
                heads.append(prefix(values, percent, common).view(np.int64))
                bits.append(parities(values, BITS))
                wide.append(parities(values, WIDE_BITS) if len(values) > SMALL else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(signs, pa.binary()), pa.array(heads, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.int64()))], names=["doc_id", "row1", "row2", "n_shingles", "key1", "key2", "signature", "head", "bits", "wide"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row1 bigint, row2 bigint, n_shingles bigint, key1 bigint, key2 bigint, signature binary, head array<bigint>, bits array<bigint>, wide array<bigint>"
    return docs.select("doc_id", row_key().alias("row"), F.col("text").cast("string").alias("text")).select("doc_id", "row.one", "row.two", "text").mapInArrow(run, schema)


def _pairs(keys: np.ndarray, trees: np.ndarray, ids: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of neighbours in one tree whose minhashes agree; the later of the two is at begin or after it.

    In a run of rows with one full prefix each row also meets the first of the run.
    """
    n, found = len(ids), []
    rows = np.arange(max(begin, 1), n)
    same = (keys[1:] == keys[:-1]).all(axis=1) & (trees[1:] == trees[:-1])
    head = np.maximum.accumulate(np.where(np.concatenate(([True], ~same)), np.arange(n), 0)) if n else rows
    for before in [*(np.maximum(rows - step, 0) for step in range(1, NEIGHBOURS + 1)), head[rows]]:
        near = (trees[before] == trees[rows]) & (keys[before, 0] == keys[rows, 0]) & (ids[before] != ids[rows])
        near[near] = (keys[before[near]] == keys[rows[near]]).sum(axis=1) >= AGREEING
        found.append((before[near], rows[near]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


NEIGHBOUR_SCHEMA = "a bigint, b bigint, tree int, key binary"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates (a, b) of a sorted partition, and the rows at its two edges (a, null, tree, key)."""
    names = ["a", "b", "tree", "key"]

    def edge(trees, keys, ids):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.nulls(len(ids), pa.int64()), pa.array(trees, pa.int32()), pa.array([k.tobytes() for k in keys], pa.binary())], names=names)

    held, top = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        trees, ids = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(len(ids), DEPTH)
        if held is None:
            yield edge(trees[:NEIGHBOURS], keys[:NEIGHBOURS], ids[:NEIGHBOURS])
            begin = 0
        else:
            # The head of the run that goes on stands before the rows held back, so that a long run keeps it.
            before = [np.concatenate((t, h)) for t, h in zip(top, held, strict=True)] if top is not None else held
            begin = len(before[2])
            trees, keys, ids = (np.concatenate((h, x)) for h, x in zip(before, (trees, keys, ids), strict=True))
        before, after = _pairs(keys, trees, ids, begin)
        low, high = np.minimum(ids[before], ids[after]), np.maximum(ids[before], ids[after])
        yield pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.nulls(len(low), pa.int32()), pa.nulls(len(low), pa.binary())], names=names)
        held = trees[-NEIGHBOURS:], keys[-NEIGHBOURS:], ids[-NEIGHBOURS:]
        run = np.flatnonzero(((keys != keys[-1]).any(axis=1)) | (trees != trees[-1]))
        first = run[-1] + 1 if len(run) else 0
        top = (trees[first : first + 1], keys[first : first + 1], ids[first : first + 1]) if first < len(ids) - NEIGHBOURS else None
    if held is not None:
        yield edge(*held)


def candidates(nodes: DataFrame) -> DataFrame:
    """Distinct pairs a < b of nodes (node, signature) that are neighbours in some tree."""
    trees = nodes.select(F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "signature", "node")
    trees = trees.select("tree", F.expr(f"substring(signature, tree * {4 * DEPTH} + 1, {4 * DEPTH})").alias("key"), "node")
    order = ("tree", "key", "node")
    found = settled(trees.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, NEIGHBOUR_SCHEMA), "neighbours")
    # A few rows for each partition: neighbours on both sides of its edges. They are filtered where they lie; what meets in one
    # task is 2 * NEIGHBOURS rows for each partition.
    edges = settled(found.where("b is null").select("tree", "key", F.col("a").alias("node")).repartition(1).sortWithinPartitions(*order).mapInArrow(_neighbours, NEIGHBOUR_SCHEMA), "edges")
    pairs = settled(found.union(edges).where("b is not null").select("a", "b").distinct(), "candidates")
    dropped(found, edges)
    return pairs


def similar(shared: Column, one: Column, two: Column, percent: int) -> Column:
    return 100 * shared >= percent * (one + two - shared)


def plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sizes and parities do not rule a link out."""
    facts = classes.select("node", F.col("n_shingles").alias("n"), "bits", "wide")
    if classes.count() <= MOST_FACTS:
        facts = F.broadcast(facts)
    side = lambda c: facts.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits{c}"), F.col("wide").alias(f"wide{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    differ = lambda one, two: F.aggregate(F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    apart = F.when(F.col("widea").isNotNull() & F.col("wideb").isNotNull(), differ("widea", "wideb")).otherwise(differ("bitsa", "bitsb"))
    shared = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    return both.where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (apart <= F.col("na") + F.col("nb") - 2 * shared)).select("a", "b")


def confirm(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """pairs (a, b) with linked, from the full sets of their texts, which are read once more.

    A node's text is that of its first row: found by doc_id, then told from other texts under that id by the row's key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sets = 0, []
            for values in text_sets(batch.column(1), width):
                sets.append(values.view(np.int64))
                if at + len(sets) == batch.num_rows or sum(map(len, sets)) > SET_BATCH:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"])
                    at, sets = at + len(sets), []

    nodes = settled(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "pair-nodes")
    ids = settled(matching(classes.select("node", "doc_id", "row1", "row2"), nodes, "node"), "pair-ids")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("doc_id").cast("bigint").alias("id"))
    found = matching(texts, ids.select(F.col("doc_id").alias("id")).distinct(), "id")
    found = found.select(row_key().alias("row"), "text").select(F.col("row.one").alias("row1"), F.col("row.two").alias("row2"), "text")
    texts = found.join(F.broadcast(ids) if ids.count() <= MOST_KEYS // 4 else ids, ["row1", "row2"]).select("node", "text").dropDuplicates(["node"])
    sets = settled(texts.mapInArrow(run, "node bigint, set array<bigint>"), "pair-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("one")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("two")), "b")
    found = settled(both.select("a", "b", similar(F.size(F.array_intersect("one", "two")), F.size("one"), F.size("two"), percent).alias("linked")), "confirmed")
    dropped(nodes, ids, sets)
    return found


def hubs_of_failed(tried: DataFrame) -> DataFrame:
    """Untried pairs: the ends of a failed candidate, each with the best connected neighbour of the other end."""
    links = tried.where("linked").select("a", "b")
    sides = links.union(links.select("b", "a"))
    degree = sides.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    hub = sides.join(degree.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.max(F.struct("d", "b")).alias("top")).select(F.col("a").alias("b"), F.col("top.b").alias("hub"))
    failed = tried.where("not linked").select("a", "b")
    proposed = failed.union(failed.select("b", "a")).join(hub, "b").where("a <> hub")
    return proposed.select(F.least("a", "hub").alias("a"), F.greatest("a", "hub").alias("b")).distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti")


def _open(rows: DataFrame, percent: int) -> DataFrame:
    """Rows (shingle, node, n_shingles, at, component, degree, n) of shingles whose n nodes lie in more than one component.

    Where these are two, their sizes and places say at once whether they can be similar.
    """
    keys = settled(rows.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("shingle"), "open-shingles")
    met = settled(matching(rows, keys, "shingle"), "open")
    least, most, behind = F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"), F.min(F.col("n_shingles") - F.col("at")).alias("behind")
    counted = met.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), least, most, behind)
    alike = (100 * F.col("least") >= percent * F.col("most")) & similar(F.col("behind"), F.col("least"), F.col("most"), percent)
    counted = settled(counted.where((F.col("n") > 2) | alike).select("shingle", "n"), "counted-shingles")
    left = settled(met.join(F.broadcast(counted) if counted.count() <= MOST_KEYS // 2 else counted, "shingle"), "open")
    dropped(keys, met, counted)
    return left


def _all_pairs(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(node, other) for the nodes of each shingle that lie in different components, as far as sizes, places and parities allow.

    Two nodes that met at one of the last shingles of both do not meet again: whatever allows the pair here allowed it there.

    A shingle of n nodes is dealt over n / SALTED tasks: a node stands once in its own one and as a guest in the others.
    Both sides of the join are the same rows, shuffled once.
    """
    fold = lambda c, longs, n: [reduce(Column.bitwiseXOR, [F.get(c, F.lit(i + k)) for k in range(0, longs, n)]) for i in range(n)]
    bits, wide = [f"p{i}" for i in range(FOLDED)], [f"w{i}" for i in range(WIDE_FOLDED)]
    folded = classes.select("node", *[c.alias(n) for n, c in zip(bits + wide, fold("bits", BITS // 64, FOLDED) + fold("wide", WIDE_BITS // 64, WIDE_FOLDED), strict=True)])
    nth = Window.partitionBy("node").orderBy("at")
    before = F.array_compact(F.array(*[F.lag("shingle", k).over(nth) for k in range(1, EARLIER + 1)])).alias("before")
    counted = rows.select("*", before).join(F.broadcast(folded) if classes.count() <= MOST_FACTS else folded, "node")
    salts = F.ceil(F.col("n") / SALTED).cast("int")
    dealt = counted.select("shingle", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.pmod(F.xxhash64("node"), salts).cast("int").alias("own"), "node", "n_shingles", "at", "component", "before", *folded.columns[1:])
    dealt = dealt.where("shingle is not null and salt is not null")
    x, y = dealt.alias("x"), dealt.alias("y")
    n1, n2 = F.col("x.n_shingles"), F.col("y.n_shingles")
    shared = F.ceil(percent * (n1 + n2) / (100 + percent))
    differ = lambda names: sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in names), F.lit(0))
    passes = (
        (F.col("x.own") == F.col("x.salt")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")) & (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
        & similar(F.least(n1 - F.col("x.at"), n2 - F.col("y.at")), n1, n2, percent) & (differ(bits) <= n1 + n2 - 2 * shared)
        & F.coalesce(differ(wide) <= n1 + n2 - 2 * shared, F.lit(True)) & ~F.arrays_overlap("x.before", "y.before")
    )
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.salt") == F.col("y.salt")) & F.coalesce(passes, F.lit(False)))
    return met.select(F.col("x.node").alias("node"), F.col("y.node").alias("other"))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (node, other) whose ends lie in different components of found."""
    of = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    placed = pairs.join(of("node"), "node", "left").join(of("other"), "other", "left")
    return placed.where(F.coalesce("of_node", "node") != F.coalesce("of_other", "other")).select("node", "other")


def completed(docs: DataFrame, classes: DataFrame, links: DataFrame, width: int, percent: int) -> DataFrame:
    """node, component of the links and of all those between different components that they lack."""

    def placed(rows: DataFrame, found: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        degree = links.union(links.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
        known = settled(found.join(degree, "node"), "placed")
        at = F.broadcast(known) if known.count() <= MOST_KEYS // 4 else known
        return rows.join(at, "node", "left").withColumns({"component": F.coalesce("component", "node"), "degree": F.coalesce("degree", F.lit(0))}), known

    def confirmed(met: DataFrame) -> DataFrame:
        pairs = settled(met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "met")
        likely = settled(plausible(pairs, classes, percent), "plausible")
        judged = confirm(docs, classes, likely, width, percent)
        more = settled(judged.where("linked").select("a", "b"), "more")
        dropped(pairs, likely, judged)
        return more

    found = components(links)
    nodes, known = placed(classes.select("node", "n_shingles", "head"), found, links)
    left = _open(nodes.select("node", "n_shingles", "component", "degree", F.posexplode("head").alias("at", "shingle")), percent)
    dropped(known)
    dense = settled(left.where(F.col("n") > DENSE), "dense")
    tied = False
    for _ in range(HUB_ROUNDS):
        if dense.isEmpty():
            break
        top = F.max(F.struct("degree", "node", "n_shingles", "component")).alias("hub")
        sizes = 100 * F.least("n_shingles", "hub.n_shingles") >= percent * F.greatest("n_shingles", "hub.n_shingles")
        met = dense.join(dense.groupBy("shingle").agg(top), "shingle").where((F.col("component") != F.col("hub.component")) & sizes)
        more = confirmed(met.select("node", F.col("hub.node").alias("other")))
        if more.isEmpty():
            dropped(more)
            break
        before, tied = (links, found, dense), True
        links = settled(links.union(more), "all-links")
        found = components(links)
        again, known = placed(dense.drop("component", "degree", "n"), found, links)
        dense = _open(again, percent)
        dropped(*before, known, more)
    # Where a shingle has few nodes, their components are those before the rounds: the pairs are few all the same.
    met = _all_pairs(left.where(F.col("n") <= DENSE).unionByName(dense), classes, percent)
    more = confirmed(_apart(met.distinct(), found) if tied else met)
    if not more.isEmpty():
        before = links, found
        links = settled(links.union(more), "all-links")
        found = components(links)
        dropped(*before)
    dropped(left, dense, links, more)
    return found


def groups(docs: DataFrame, width: int = 5, percent: int = 85, with_row: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id integer, text).

    with_row: also row1 and row2, the key of the row, and first, true for the one text that stands for its group.
    """
    workers_find_library(docs.sparkSession)
    sketches = settled(sketch(docs, width, percent, common_shingles(docs, width)), "sketches")
    carried = ("doc_id", "row1", "row2", "n_shingles", "signature", "head", "bits", "wide")
    by_set = sketches.where("n_shingles > 0 and doc_id is not null").groupBy("key1", "key2").agg(F.min(F.struct(*carried)).alias("first"))
    # Nodes are numbers of their own: one doc_id may stand over several texts.
    classes = settled(by_set.select("key1", "key2", F.monotonically_increasing_id().alias("node"), F.col("first.doc_id").cast("bigint").alias("doc_id"), *[f"first.{c}" for c in carried[1:]]), "classes")
    near = candidates(classes)
    likely = settled(plausible(near, classes, percent), "plausible")
    linked = confirm(docs, classes, likely, width, percent)
    dropped(likely)
    # Of a pair that is ruled out or fails, the best connected neighbours are tried.
    tried = settled(near.join(linked, ["a", "b"], "left").select("a", "b", F.coalesce("linked", F.lit(False)).alias("linked")), "tried")
    dropped(near, linked)
    more = settled(plausible(hubs_of_failed(tried), classes, percent), "hubs")
    hubs = confirm(docs, classes, more, width, percent)
    links = settled(tried.where("linked").union(hubs.where("linked")).select("a", "b"), "forest-links")
    dropped(tried, more, hubs)
    whole = completed(docs, classes, links, width, percent)
    met = settled(whole.join(classes.select("node", "doc_id"), "node"), "members")
    dropped(whole)
    firsts = settled(met.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("least")).select("component", F.col("least.doc_id").alias("least_id"), F.col("least.node").alias("least_node")), "firsts")
    led = settled(met.join(F.broadcast(firsts) if firsts.count() <= MOST_KEYS // 4 else firsts, "component").select("node", "least_id", "least_node"), "led")
    of_class = classes.select("key1", "key2", "node", "doc_id").join(led, "node", "left")
    of_class = of_class.select("key1", "key2", F.coalesce("least_id", "doc_id").alias("component"), F.coalesce(F.col("least_node") == F.col("node"), F.lit(True)).alias("leads"))
    rows = ("doc_id", "row1", "row2", "n_shingles")
    found = sketches.where("n_shingles > 0").select(*rows, "key1", "key2").join(of_class, ["key1", "key2"], "left").select(*rows, "component", "leads")
    empty = sketches.where("n_shingles = 0").select(*rows, F.col("doc_id").cast("bigint").alias("component"), F.lit(True).alias("leads"))
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False))
    more = ["row1", "row2", (kept & F.coalesce("leads", F.lit(False))).alias("first")] if with_row else []
    judged = found.unionByName(empty).select("doc_id", "n_shingles", F.col("component").cast(docs.schema["doc_id"].dataType).alias("component_id"), kept.alias("kept"), *more)
    judged = settled(judged, "groups")  # narrow; all tables behind it can go
    dropped(sketches, classes, met, firsts, led)
    return judged
