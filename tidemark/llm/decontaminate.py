"""Benchmark decontamination with spaced seeds.

A seed hashes the words that a fixed mask selects from SPAN consecutive words; the words under the mask's gaps may
differ, and the three masks have their gaps at different places. Seeds of all documents are joined with the seeds of
all benchmark items. Around each hit the document and the item are laid side by side, and the best stretch is scored:
+1 for each equal word, -MISMATCH for each substituted one. A document is contaminated if some item's stretch scores
at least `score`.

Only hits and the words under them are shuffled. Benchmark seeds are broadcast if a count shows that they are few;
otherwise both sides are dealt by seed, and items by a salt too.

Defined results: null text counts as empty; documents and items with fewer than SPAN words have no seed and are never
contaminated or contaminating; very long texts are read whole; of equally good stretches the one with more words counts;
repeated rows get the same verdict; items with a null id are left out, texts that share an id are one item; an empty
benchmark leaves all documents clean, an empty table gives an empty table; extra columns of any name are ignored, or
passed on by `clean`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_scan import words_of
from .store import MOST_KEYS, dropped, free_names, matching, row_key, settled

SPAN = 12
MASKS = ((0, 1, 2, 4, 5, 8, 10, 11), (0, 1, 3, 5, 6, 7, 9, 11), (0, 2, 3, 4, 7, 8, 9, 10))
MISMATCH = 3
SCORE = 9
SALTS = 16


def _seeds(df: DataFrame, *keep: str) -> DataFrame:
    """keep, seed, at: the seeds of column __h, an array of word hashes."""
    starts = F.when(F.size("__h") >= SPAN, F.sequence(F.lit(0), F.size("__h") - SPAN))
    each = F.transform(starts, lambda i: F.struct(*[F.xxhash64(F.lit(m), *[F.get("__h", i + o) for o in mask]).alias(f"s{m}") for m, mask in enumerate(MASKS)]))
    rows = df.select(*keep, F.posexplode(each).alias("at", "s"))
    return rows.select(*keep, "at", F.explode(F.array(*[F.col(f"s.s{m}") for m in range(len(MASKS))])).alias("seed"))


def _hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def _best_stretch(doc: Column, item: Column) -> Column:
    """(score, words) of the best stretch of two arrays of one length laid side by side."""
    same = F.zip_with(doc, item, lambda a, b: a == b)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("run"), F.lit(0).alias("words"))

    def step(a: Column, equal: Column) -> Column:
        now = F.greatest(F.lit(0), a["now"] + F.when(equal, 1).otherwise(-MISMATCH))
        run = F.when(now > 0, a["run"] + F.when(equal, 1).otherwise(0)).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(a["best"], now).alias("best"), run.alias("run"), F.when(now > a["best"], run).otherwise(a["words"]).alias("words"))

    return F.aggregate(same, start, step, lambda a: F.struct(a["best"].alias("score"), a["words"].alias("words")))


def overlaps(docs: DataFrame, items: DataFrame, score: int = SCORE) -> DataFrame:
    """row, item_id, score, words: the best stretch of each contaminating item in each contaminated row (key as in row_key)."""
    bench = settled(items.where("item_id is not null").select("item_id", words_of(F.col("text")).alias("item")), "bench")
    seeds_of = _seeds(bench.select("item_id", F.transform("item", lambda w: F.xxhash64(w)).alias("__h")), "item_id")
    known = settled(seeds_of.withColumnRenamed("at", "item_at").distinct(), "bench-seeds")
    texts = docs.select(row_key().alias("row"), F.col("text").cast("string").alias("text"))
    seeds = _seeds(texts.select("row", _hashes(F.col("text")).alias("__h")), "row")
    # The words of all items number at most as many as their seeds, and SPAN more for each item.
    few = known.count() + SPAN * bench.count() <= MOST_KEYS
    hits = seeds.join(F.broadcast(known) if few else known, "seed")
    laid = settled(hits.select("row", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "seed-hits")
    lengths = bench.select("item_id", F.size("item").alias("n"))
    placed = settled(laid.join(F.broadcast(lengths) if few else lengths, "item_id").distinct(), "seed-places")
    rows = settled(laid.select("row").distinct(), "hit-rows")
    words = matching(texts, rows, "row").select("row", words_of(F.col("text")).alias("doc"))
    met = words.join(F.broadcast(placed) if placed.count() <= MOST_KEYS else placed, "row")
    # Of a document only the words under the item go on; an item that many documents hold is dealt over SALTS tasks.
    begin = F.greatest(F.lit(0), -F.col("shift"))
    under = F.slice("doc", F.greatest(F.col("shift"), F.lit(0)) + 1, F.greatest(F.col("n") - begin, F.lit(0)))
    stretches = met.select("row", "item_id", "shift", under.alias("doc"))
    if few:
        side = stretches.join(F.broadcast(bench), "item_id")
    else:
        dealt = bench.select("item_id", "item", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        side = stretches.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(dealt, ["item_id", "salt"])
    scored = side.select("row", "item_id", _best_stretch(F.col("doc"), F.slice("item", begin + 1, F.size("doc"))).alias("s"))
    found = settled(scored.groupBy("row", "item_id").agg(F.max("s").alias("s")).select("row", "item_id", "s.score", "s.words").where(F.col("score") >= score), "overlaps")
    dropped(bench, known, laid, placed, rows)
    return found


def report(docs: DataFrame, items: DataFrame, score: int = SCORE) -> DataFrame:
    """For each row of docs: doc_id, n_items, items (ids, comma-joined), best_score, best_words, contaminated."""
    found = overlaps(docs, items, score)
    ids = F.concat_ws(",", F.transform(F.array_sort(F.collect_set("item_id")), lambda i: i.cast("string")))
    by_row = found.groupBy("row").agg(F.countDistinct("item_id").alias("n_items"), ids.alias("items"), F.max(F.struct("score", "words")).alias("best"))
    by_row = by_row.select("row", "n_items", "items", F.col("best.score").cast("long").alias("best_score"), F.col("best.words").cast("long").alias("best_words"))
    kept = docs.select("doc_id", row_key().alias("row")).join(by_row, "row", "left")
    return kept.select("doc_id", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"), F.coalesce("best_score", F.lit(0)).alias("best_score"), F.coalesce("best_words", F.lit(0)).alias("best_words"), F.col("n_items").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, score: int = SCORE) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    (key,) = free_names(docs, "row")
    bad = settled(overlaps(docs, items, score).select(F.col("row").alias(key)).distinct(), "contaminated")
    keyed = docs.withColumn(key, row_key())
    return keyed.join(F.broadcast(bad) if bad.count() <= MOST_KEYS else bad, key, "left_anti").select(*docs.columns)
