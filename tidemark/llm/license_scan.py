"""Licence scan with a positional index over rare template words.

A template is a short licence text with a label and a mandatory key phrase. The index maps each template word to its
postings (template, position). In each file the licence words with the highest IDF are looked up, and so are the two
rarest words of each key phrase of which all words are there, so that no template is lost to others; every place of such a
word and every posting of it vote for an alignment (template, place - position), so that votes of words that stand in
the right order meet in one alignment. An aligned template counts if its key phrase stands there word for word and
enough of its other words agree. The key phrases of the base list are looked up by their own rarest word in every file,
so that no place of a base phrase depends on the number of looked-up words.

The document frequencies behind the IDF come from all files. Both passes work row by row; no text is shuffled, and only
one count for each template word reaches the driver.

Defined results: null text counts as empty (no words, no labels, score 0); very long texts are scanned whole; repeated
rows are scanned row by row; words of equal IDF are ordered by themselves; an empty table gives an empty table; extra
columns of any name are ignored, columns named in keep are passed on.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import license_texts

#: The base phrases and their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str  # a stretch of text

    @property
    def words(self) -> list[str]:
        return re.findall("[0-9a-z]+", self.text.lower())

    @property
    def key_words(self) -> list[str]:
        return re.findall("[0-9a-z]+", self.key.lower())

    @property
    def key_at(self) -> int:
        key, words = self.key_words, self.words
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


TEMPLATES = tuple(Template(*entry) for entry in license_texts.NOTICES + license_texts.WHOLE)

#: Runs of these end a word: ASCII but for digits and letters.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOOKED_UP = 8
VOTES = 2
COVERAGE = 0.7


def ascii_lower(text: Column) -> Column:
    """A-Z only; lower() would also turn the Kelvin sign and the dotted I into ASCII letters."""
    return F.when(text.rlike("[Kİ]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), GAP, -1), "")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def word_weights(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """IDF of each template word over all rows of docs; as many numbers as the templates have words."""
    vocabulary = sorted({w for t in templates for w in t.words} | {w for p, _ in BASE for w in p.split()})
    seen = docs.select(F.explode(F.array_union(F.array_intersect(_strings(vocabulary), words_of(F.col("text"))), F.array(F.lit("")))).alias("word"))
    counts = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = counts.get("", 0)
    return {w: math.log((1 + rows) / (1 + counts.get(w, 0))) for w in vocabulary}


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), templates: tuple[Template, ...] = TEMPLATES, looked_up: int = LOOKED_UP, coverage: float = COVERAGE) -> DataFrame:
    """For each row: n_words, n_base, first_word, last_word, base_labels, labels, matches (label, start, coverage), score."""
    weights = word_weights(docs, templates)
    by_idf = sorted(weights, key=lambda w: (-weights[w], w))
    rarest = lambda words: min(words, key=lambda w: (-weights[w], w))
    phrases = [(p.split(), label, p.split().index(rarest(p.split()))) for p, label in BASE]
    anchors = sorted({words[at] for words, _, at in phrases})
    postings = {w: [(t, i) for t, x in enumerate(templates) for i, v in enumerate(x.words) if v == w] for w in by_idf}
    posting_map = F.create_map(*[c for w in by_idf for c in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("p")) for t, i in postings[w]]).cast("array<struct<t:int,p:int>>"))])
    shapes = F.array(*[F.struct(F.lit(x.label).alias("label"), _strings(x.words).alias("words"), _strings(x.key_words).alias("key"), F.lit(x.key_at).alias("key_at")) for x in templates])

    rarest_two = lambda words: sorted(set(words), key=lambda w: (-weights[w], w))[:VOTES]
    # A key phrase of a single word does not give two votes: all words of its template are looked up.
    needed = [(t.key_words, rarest_two(t.key_words) if len(set(t.key_words)) >= VOTES else t.words) for t in templates]

    cut = docs.select(*keep, words_of(F.col("text")).alias("__w"))
    cut = cut.select("*", F.array_intersect(_strings(by_idf), F.col("__w")).alias("__met"))
    rare = F.slice("__met", 1, looked_up)
    of_keys = F.flatten(F.array(*[F.when(F.size(F.array_except(_strings(key), F.col("__met"))) == 0, _strings(two)).otherwise(_strings([])) for key, two in needed]))
    present = F.array_union(F.array_union(rare, of_keys), F.array_intersect(_strings(anchors), F.col("__met")))
    looked = cut.select(*keep, "__w", F.size("__w").cast("long").alias("n_words"), present.alias("__present"))
    # Without a phrase's rarest word or two words of a template there is nothing to align.
    places = F.filter(F.transform("__w", lambda w, i: F.when(F.array_contains("__present", w), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())
    placed = looked.select(*keep, "__w", "n_words", F.when(F.arrays_overlap("__present", _strings(anchors)) | (F.size("__present") >= VOTES), places).alias("__places"))

    def stands(words: list[str], at: int) -> Column:
        hits = F.filter("__places", lambda x: (x["w"] == words[at]) & (x["i"] >= at) & (F.slice("__w", F.greatest(x["i"] - at + 1, F.lit(1)), len(words)) == _strings(words)))
        return F.transform(hits, lambda x: x["i"] - at)

    base = placed.select("*", *[stands(words, at).alias(f"__p{j}") for j, (words, _, at) in enumerate(phrases)])
    votes = F.flatten(F.transform("__places", lambda x: F.transform(F.element_at(posting_map, x["w"]), lambda q: F.struct(q["t"].alias("t"), (x["i"] - q["p"]).alias("at")))))
    voted = base.select("*", F.sort_array(votes).alias("__votes"))
    agreed = F.filter("__votes", lambda v, j: (v == F.get("__votes", j - 1)) & ~F.coalesce(v == F.get("__votes", j - VOTES), F.lit(False)))
    aligned = voted.select(*[c for c in voted.columns if c not in ("__votes", "__places")], agreed.alias("__agreed"))

    def verified(v: Column) -> Column:
        shape = F.get(shapes, v["t"])
        agree = F.size(F.filter(F.zip_with(shape["words"], F.slice("__w", F.greatest(v["at"] + 1, F.lit(1)), F.size(shape["words"])), lambda a, b: a == b), lambda same: F.coalesce(same, F.lit(False))))
        lawful = (v["at"] >= 0) & (F.slice("__w", F.greatest(v["at"] + shape["key_at"] + 1, F.lit(1)), F.size(shape["key"])) == shape["key"])
        return F.struct(shape["label"].alias("label"), v["at"].alias("start"), F.when(lawful, agree / F.size(shape["words"])).alias("coverage"))

    # A template cut off at the head of the file starts before word 0 and is left to its base phrase.
    checked = aligned.select("*", F.filter(F.transform("__agreed", verified), lambda m: m["coverage"] >= coverage).alias("__m"))
    none = F.array().cast("array<int>")
    starts = F.concat(*[F.coalesce(f"__p{j}", none) for j in range(len(phrases))])
    found = F.array_compact(F.array(*[F.when(F.size(F.coalesce(f"__p{j}", none)) > 0, F.lit(label)) for j, (_, label, _) in enumerate(phrases)]))
    matches = F.coalesce("__m", F.array().cast("array<struct<label:string,start:int,coverage:double>>"))
    out = checked.select(*keep, "n_words", starts.alias("__s"), F.array_sort(found).alias("__b"), matches.alias("matches"))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0))
    return out.select(
        *keep, "n_words",
        F.size("__s").cast("long").alias("n_base"),
        F.array_min("__s").cast("long").alias("first_word"),
        F.array_max("__s").cast("long").alias("last_word"),
        F.concat_ws(",", F.array_distinct("__b")).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.concat("__b", F.transform("matches", lambda m: m["label"]))))).alias("labels"),
        "matches",
        F.greatest(best, F.when(F.size("__b") > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"),
    )
