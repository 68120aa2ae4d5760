"""Line deduplication by an exact set-similarity join.

A line is the set of its words, split at spaces. Lines are ordered by (doc_id, row, line number); a line is removed if an
earlier line has the same set or one of Jaccard similarity >= percent / 100. Lines with equal sets are one class, so a
line that stands in a third of all documents costs one row of the join. The words of each set are sorted by rarity (count
of the word's bucket over all documents, then the word's hash: one order for all lines). Two sets can only be similar if
they share a word of their prefixes, with lengths and positions that leave room for the overlap needed, and if the
parities of their words, folded into 64 bits, differ in no more bits than the sets may differ in words. Pairs that pass
are verified on the full sets.

A set that passes the filters with the earliest set of like length of a prefix word is a candidate with that one alone,
which settles groups of like lines in linear time; other sets meet all earlier sets of the word, and so does, in a second
round, a set of which such a candidate failed. Words of very many lines are dealt by length. What is shuffled is a word,
a class number and a few small numbers for each prefix word; full sets are read again for candidates alone.

Defined results: null text counts as empty; lines without a word are never removed; of equal lines the first stays;
rows that repeat doc_id and text share one decision (they are not matched with each other); a null doc_id sorts first;
a very long text is a document of many lines, a very long line one large set, both taken whole; an empty table gives an
empty table; extra columns of any name are ignored or, by `deduplicated`, passed on.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import MOST_KEYS, dropped, free_names, matching, row_key, settled

BUCKETS = 1 << 18
PERCENT = 90
PLACE = ("doc_id", "row", "line_no")
MOST_LINES = 4_000_000
#: A word is common from this rank on: its bucket was counted 2 ** 18 times.
COMMON = 72
NONE = "array<bigint>"


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, " ", -1), "")


def _bucket(hash_: Column) -> Column:
    # hash() gives an int at once; a cast of a long, with its check for overflow, takes longer.
    return F.hash(hash_).bitwiseAND(F.lit(BUCKETS - 1))


def rarity(docs: DataFrame) -> Column:
    """An array literal with 4 log2(count) of each bucket of words, over all documents: BUCKETS bytes whatever the input.

    There are more buckets than frequent words, so that few rare words share one with a frequent word and look frequent.
    """
    lines = docs.select(F.explode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line"))
    words = lines.select(F.explode(F.split("line", " ", -1)).alias("w"))
    counts = words.groupBy(_bucket(F.xxhash64("w")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    ranks = ["0"] * BUCKETS
    rank = F.least(F.lit(127), F.floor(4 * F.log2(1 + F.col("n")))).cast("tinyint")
    found = counts.select("bucket", rank.alias("rank")).toArrow()
    for bucket, r in zip(found["bucket"].to_pylist(), found["rank"].to_pylist(), strict=True):
        ranks[bucket] = str(r)
    return F.split(F.lit(",".join(ranks)), ",").cast("array<tinyint>")


def _numbers(line: Column, ranks: Column) -> Column:
    """The distinct words of a line as longs, rarest first: the rank takes the upper bits, the hash the others."""
    hashes = F.transform(_words(line), lambda w: F.xxhash64(w))
    # Never null, which sort_array then knows: it sorts longs, not objects.
    rank = lambda h: F.coalesce(F.get(ranks, _bucket(h)), F.lit(0).cast("tinyint"))
    number = lambda h: F.shiftleft(rank(h).cast("long"), 56).bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1)))
    return F.sort_array(F.array_distinct(F.transform(hashes, number)))


def _parities(words: Column) -> Column:
    """Bit i of 64 says whether for an odd number of words the hash ends in i (a shift of a long takes the last six bits)."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.hash(w))))


def nodes(docs: DataFrame, ranks: Column, percent: int) -> DataFrame:
    """For each line with a word: its place, two keys of its set, the set's size, prefix and parities (no prefix where only an equal set can be similar)."""
    cut = docs.select("doc_id", row_key().alias("row"), F.split(F.col("text").cast("string"), "\n", -1).alias("lines"))
    lines = cut.select("doc_id", "row", F.posexplode("lines").alias("line_no", "line")).where(F.trim("line") != "")
    sets = lines.select(*PLACE, _numbers(F.col("line"), ranks).alias("words")).select("*", F.size("words").alias("n"))
    # The smallest set that can be similar to one with a word more or less.
    open_ = 100 * F.col("n") >= percent * (F.col("n") + 1)
    prefix = F.slice("words", F.lit(1), F.col("n") - F.ceil(percent * F.col("n") / 100).cast("int") + 1)
    return sets.select(
        *PLACE, F.xxhash64("words").alias("key1"), F.xxhash64(F.lit(1), "words").alias("key2"), "n",
        F.when(open_, prefix).otherwise(F.array().cast(NONE)).alias("prefix"), F.when(open_, _parities(F.col("words"))).alias("bits"),
    )


def _least_overlap(one: Column, two: Column, percent: int) -> Column:
    return F.ceil(percent * (one + two) / (100 + percent))


def _place(x: str) -> Column:
    """The position of the word of row x in its set; that of a guest is stored as -1 - position."""
    at = F.col(f"{x}.at")
    return F.when(at < 0, -1 - at).otherwise(at)


def _passes(x: str, y: str, percent: int) -> Column:
    """Length, positional and parity filters for sets x and y that share a prefix word at their positions."""
    nx, ny, ix, iy = F.col(f"{x}.n"), F.col(f"{y}.n"), _place(x), _place(y)
    needed = _least_overlap(nx, ny, percent)
    apart = F.bit_count(F.col(f"{x}.bits").bitwiseXOR(F.col(f"{y}.bits")))
    return (100 * ny >= percent * nx) & (100 * nx >= percent * ny) & (F.least(nx - ix, ny - iy) >= needed) & (apart <= nx + ny - 2 * needed)


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """c of the later one of each pair of classes (a, b) whose sets are similar."""
    ids = settled(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct(), "line-ids")
    places = settled(matching(classes, ids, "c").select("c", "place"), "line-places")
    by_row = places.groupBy("place.row").agg(F.collect_list(F.struct("place.line_no", "c", "place.doc_id")).alias("wanted"))
    keyed = docs.select(row_key().alias("row"), F.col("text").cast("string").alias("text"))
    rows = settled(by_row, "line-rows")
    texts = keyed.join(F.broadcast(rows) if places.count() <= MOST_KEYS else rows, "row").dropDuplicates(["row"])
    cut = texts.select(F.split("text", "\n", -1).alias("lines"), "wanted", "row").select("lines", "row", F.explode("wanted").alias("w"))
    sets = cut.select("w.c", F.struct("w.doc_id", "row", "w.line_no").alias("place"), F.array_distinct(F.transform(_words(F.get("lines", F.col("w.line_no"))), lambda w: F.xxhash64(w))).alias("words"))
    sets = settled(sets, "line-sets")
    side = lambda c, s: sets.select(F.col("c").alias(c), F.col("place").alias(f"p{s}"), F.col("words").alias(f"w{s}"))
    both = pairs.join(side("a", 1), "a").join(side("b", 2), "b")
    shared = F.size(F.array_intersect("w1", "w2"))
    like = both.where(100 * shared >= percent * (F.size("w1") + F.size("w2") - shared))
    found = settled(like.select(F.when(F.col("p1") > F.col("p2"), F.col("a")).otherwise(F.col("b")).alias("c")).distinct(), "line-matches")
    dropped(ids, places, rows, sets)
    return found


def _entries(classes: DataFrame, percent: int) -> DataFrame:
    """A row for each prefix word of each class: word, c, d and l (document and line of the class), n, at, bits.

    Words that stand in very many lines (their rank says so) are dealt by length: the word then also says a band of
    lengths, and the class is a guest (at < 0) in the next longer band: there it meets all longer sets that can be similar.
    """
    prefixes = classes.select("c", F.col("place.doc_id").alias("d"), F.col("place.line_no").alias("l"), "n", "bits", F.posexplode("prefix").alias("at", "word"))
    band = _band(F.col("n"), percent)
    common = F.shiftright("word", 56) >= COMMON
    # Null for the word itself, else the band.
    keys = F.when(common, F.array(band, band + 1)).otherwise(F.array(F.lit(None).cast("int")))
    dealt = prefixes.select("c", "d", "l", "n", "bits", "at", "word", F.posexplode(keys).alias("guest", "key"))
    word = F.when(F.col("key").isNull(), F.col("word")).otherwise(F.xxhash64("word", "key"))
    rows = dealt.select(word.alias("word"), "c", "d", "l", "n", F.when(F.col("guest") == 0, F.col("at")).otherwise(-1 - F.col("at")).alias("at"), "bits")
    return rows.where("word is not null")  # always so; it keeps the plans of all readers alike, and they share one shuffle


def _band(n: Column, percent: int) -> Column:
    """Lengths in one band or in two next to each other include all pairs of lengths that can be similar."""
    return F.floor(F.log(n.cast("double")) / math.log(100 / percent)).cast("int")


def _meets(x: DataFrame, y: DataFrame, percent: int) -> DataFrame:
    """(a, b, by_head): classes a < b of rows x and y with one word that pass the filters, y before x.

    A row x with a head meets that class alone, besides guests; by_head then is its own class. Two guests of a band meet in their own.
    """
    # Of two sets the shorter one shares a word of a prefix that is shorter still.
    short = lambda s: _place(s) <= F.col(f"{s}.n") - F.ceil(2 * percent * F.col(f"{s}.n") / (100 + percent))
    shorter = F.when(F.col("x.n") < F.col("y.n"), short("x")).when(F.col("x.n") > F.col("y.n"), short("y")).otherwise(short("x") & short("y"))
    # As structs of (d, l) compare, nulls first, without making two structs for each pair.
    same = F.col("y.d").eqNullSafe(F.col("x.d"))
    earlier = F.when(same, F.col("y.l") <= F.col("x.l")).otherwise(F.coalesce(F.col("y.d") < F.col("x.d"), F.col("y.d").isNull())) & (F.col("x.c") != F.col("y.c"))
    headed = F.col("x.head").isNotNull() & (F.col("y.at") >= 0)
    one_own = (F.col("x.at") >= 0) | (F.col("y.at") >= 0)
    passes = F.when(headed, F.col("x.head") == F.col("y.c")).otherwise(_passes("x", "y", percent) & one_own & earlier & shorter)
    # Lengths are looked at first: most rows of a word differ in them. Inside coalesce the conditions stay with the join: where x and y are the same rows, these are shuffled once.
    met = x.alias("x").join(y.alias("y"), (F.col("x.word") == F.col("y.word")) & F.coalesce(passes, F.lit(False)))
    return met.select(F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b"), F.when(headed, F.col("x.c")).alias("by_head"))


def similar_classes(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """c of each class of which an earlier one is similar."""
    entries = _entries(classes, percent).repartition("word")
    like = Window.partitionBy("word", _band(F.col("n"), percent))
    own = F.when(F.col("at") >= 0, F.struct("d", "l", "c", "n", "at", "bits"))
    headed = entries.withColumn("first", F.min(own).over(like)).alias("x")
    # What passes the filters with the first set of its word and length will most likely be similar to it, and meets no other set of this word.
    by_head = (F.struct("x.first.d", "x.first.l") < F.struct("x.d", "x.l")) & (F.col("x.at") >= 0) & _passes("x", "x.first", percent)
    headed = headed.withColumn("head", F.when(by_head, F.col("x.first.c"))).drop("first")
    tried = settled(_meets(headed, entries, percent).groupBy("a", "b").agg(F.max("by_head").alias("by_head")), "line-pairs")
    matched = _verified(docs, classes, tried.select("a", "b"), percent)
    # Where that was wrong, the set meets all earlier ones.
    wrong = settled(tried.where("by_head is not null").select(F.col("by_head").alias("c")).distinct().join(matched, "c", "left_anti"), "line-wrong")
    again = _entries(matching(classes, wrong, "c"), percent).withColumn("head", F.lit(None).cast("long"))
    few = wrong.count() <= MOST_KEYS // 100
    met = _meets(F.broadcast(again) if few else again, _entries(classes, percent), percent).select("a", "b")
    rest = settled(met.distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti"), "line-pairs")
    more = _verified(docs, classes, rest, percent)
    found = settled(matched.union(more).distinct(), "line-similar")
    dropped(tried, wrong, rest, matched, more)
    return found


def removed_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, row, line_no of each line that goes."""
    ranks = rarity(docs)
    lines = settled(nodes(docs, ranks, percent), "lines")
    first = lines.groupBy("key1", "key2").agg(F.min(F.struct(F.struct(*PLACE).alias("place"), "n", "prefix", "bits")).alias("f"), F.count(F.lit(1)).alias("lines"))
    # The numbers are unique, and fixed once the table is written.
    classes = settled(first.select("key1", "key2", "lines", "f.*", F.monotonically_increasing_id().alias("c")), "line-classes")
    similar = similar_classes(docs, classes, percent).withColumn("similar", F.lit(True))
    judged = classes.select("c", "key1", "key2", "place", "lines").join(F.broadcast(similar) if similar.count() <= MOST_KEYS else similar, "c", "left")
    verdicts = judged.where("lines > 1 or similar").select("key1", "key2", F.col("place").alias("first"), F.coalesce("similar", F.lit(False)).alias("similar"))
    gone = lines.select(*PLACE, "key1", "key2").join(verdicts, ["key1", "key2"]).where(F.col("similar") | (F.struct(*PLACE) != F.col("first")))
    found = settled(gone.select(*PLACE), "lines-gone")
    dropped(lines, classes, similar)
    return found


def gone_by_row(docs: DataFrame, percent: int) -> DataFrame:
    """row and the numbers of its lines that go, for rows that lose a line."""
    by_row = removed_lines(docs, percent).groupBy("row").agg(F.array_sort(F.collect_set("line_no")).alias("gone"))
    return settled(by_row, "removed-lines")


def _with_gone(docs: DataFrame, percent: int) -> tuple[DataFrame, str]:
    """docs with a column (of a name that docs does not have) that holds the numbers of the lines that go, or null."""
    gone = gone_by_row(docs, percent)
    few = (gone.agg(F.sum(1 + F.size("gone"))).first()[0] or 0) <= MOST_LINES
    row, lost = free_names(docs, "row", "gone")
    keys = gone.select(F.col("row").alias(row), F.col("gone").alias(lost))
    return docs.withColumn(row, row_key()).join(F.broadcast(keys) if few else keys, row, "left").drop(row), lost


def _worded(lines: Column) -> Column:
    return F.filter(lines, lambda line: F.trim(line) != "")


def report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """For each row of docs: doc_id, n_lines (with a word), n_removed, removed (line numbers, comma-joined)."""
    rows, gone = _with_gone(docs.select("doc_id", F.col("text").cast("string").alias("text")), percent)
    n_lines = F.coalesce(F.size(_worded(F.split("text", "\n", -1))), F.lit(0))
    removed = F.coalesce(F.array_join(F.transform(gone, lambda i: i.cast("string")), ","), F.lit(""))
    n_removed = F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone))
    return rows.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed"), removed.alias("removed"))


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with the removed lines cut out of text; a row that loses all its lines with a word goes."""
    rows, gone = _with_gone(docs, percent)
    left = F.filter(F.split(F.col("text").cast("string"), "\n", -1), lambda line, i: ~F.array_contains(gone, i))
    stays = F.col(gone).isNull() | F.exists(left, lambda line: F.trim(line) != "")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return rows.where(stays).select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])
