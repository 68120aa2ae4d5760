"""Quality rules whose cutoffs carry a guarantee on false rejections.

Every document gets a few text statistics. A rule rejects a document whose statistic lies beyond a cutoff. The cutoffs
are not tuned by hand: on labelled holdouts, the strictest cutoff of a fixed grid is taken for which an exact binomial
test still shows, in each stratum, that at most `alpha / rules` of the good documents are rejected. The tests of all
strata, rules and grid points share the error level `delta` (Bonferroni), so with probability 1 - delta every stratum
loses at most `alpha` of its good documents to all rules together. Where too few labels exist for a proof, the rule is
off in that stratum.

Defined results: null text counts as empty (no words, base_failed, not kept); a null or unlisted language belongs to
the stratum "other"; repeated rows are judged row by row; null labels are left out, and of repeated labels of one
doc_id the smallest counts; very long texts are read whole; a statistic equal to the cutoff does not reject; empty
tables give empty results; extra columns of either table, of any name, are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import settled

SPACE = r"[\x09-\x0D\x20]+"
WINDOW = 8
LANGUAGES = ("en", "fr", "de", "es")


@dataclass(frozen=True)
class Rule:
    """Rejects a document when `statistic` > cutoff; grid from lenient to strict."""

    name: str
    statistic: str
    grid: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / word_chars", (0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04)),
    Rule("duplicate_lines", "n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("capitals", "n_capitals / word_chars", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15)),
    Rule("long_words", "word_chars / n_words", (60.0, 40.0, 30.0, 25.0, 20.0, 15.0, 12.0)),
    Rule("short_words", "-word_chars / n_words", (-1.2, -1.5, -1.8, -2.0, -2.5, -3.0, -3.5)),
)


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Row by row, without a shuffle: the columns named in keep, and the counts that the rules read."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cut = docs.select(*keep, text.alias("__text"), F.array_remove(F.split(text, SPACE, -1), "").alias("__words"))
    lines = F.filter(F.split("__text", "\n", -1), lambda line: line.rlike(r"[^\x09-\x0D\x20]"))
    counted = cut.select(
        *keep,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("__text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.regexp_replace("__text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.length("__text") - F.length(F.regexp_replace("__text", r"\p{Lu}+", ""))).cast("long").alias("n_capitals"),
        lines.alias("__lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"),
    )
    starts = F.when(F.size("__hashes") >= WINDOW, F.sequence(F.lit(0), F.size("__hashes") - WINDOW))
    windowed = counted.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_capitals",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.transform(starts, lambda i: F.xxhash64(F.slice("__hashes", i + 1, WINDOW))), F.array().cast("array<bigint>")).alias("__windows"),
    )
    # Few documents repeat a window; only they are sorted.
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.when(repeats, F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ordered = windowed.select(*[c for c in windowed.columns if c != "__windows"], placed.alias("__placed"))
    hash_at = lambda j: F.get("__placed", j)["h"]  # noqa: E731  null beyond the ends
    twice = F.filter(
        F.sequence(F.lit(0), F.size("__placed") - 1),
        lambda j: F.coalesce(hash_at(j) == hash_at(j - 1), F.lit(False)) | F.coalesce(hash_at(j) == hash_at(j + 1), F.lit(False)),
    )
    found = ordered.select(
        *[c for c in ordered.columns if c != "__placed"],
        F.when(F.col("__placed").isNotNull(), F.sort_array(F.transform(twice, lambda j: F.get("__placed", j)["i"]))).alias("__twice"),
    )
    covered = F.aggregate(
        "__twice",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("words")),
        lambda a, i: F.struct(i.alias("last"), (a["words"] + F.least(F.lit(WINDOW), i - a["last"])).alias("words")),
        lambda a: a["words"],
    )
    return found.select(*[c for c in found.columns if c != "__twice"], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def stratum(lang: Column, languages: tuple[str, ...] = LANGUAGES) -> Column:
    """One of len(languages) + 1 values, so tables by stratum have a fixed size."""
    return F.when(lang.isin(*languages), lang).otherwise(F.lit("other"))


def _log_gamma(x: Column) -> Column:
    """Stirling's series after a shift by 8: double precision for x >= 1."""
    y = x + 8
    shift = x
    for j in range(1, 8):
        shift = shift * (x + j)
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    return series - F.log(shift)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), k < n p: the largest term times the sum of falling ratios.

    Terms further than about nine standard deviations below k are under the precision of a double.
    """
    kd, nd = k.cast("double"), n.cast("double")
    log_top = _log_gamma(nd + 1) - _log_gamma(kd + 1) - _log_gamma(nd - kd + 1) + kd * math.log(p) + (nd - kd) * math.log1p(-p)
    reach = F.least(kd, F.ceil(F.sqrt(nd * p) * 12) + 60).cast("long")
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), reach),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct(
            (a["term"] * (kd - j) * (1 - p) / ((nd - kd + j + 1) * p)).alias("term"),
            (a["sum"] + a["term"]).alias("sum"),
        ),
        lambda a: a["sum"],
    )
    return F.exp(log_top) * total


def cutoffs(stats: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, rules: tuple[Rule, ...] = RULES, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """stratum and one nullable column cut_<rule> for each rule; at most len(languages) + 1 rows."""
    good = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("__good")).where("__good = 1")
    held = stats.join(good, "doc_id", "left_semi").where("n_words > 0")
    share = alpha / len(rules)
    level = delta / ((len(languages) + 1) * sum(len(r.grid) for r in rules))
    counts = [F.sum((F.expr(r.statistic) > c).cast("long")).alias(f"{r.name}_{g}") for r in rules for g, c in enumerate(r.grid)]
    by = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *counts)
    tests = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(g).alias("grid"), F.lit(float(c)).alias("cutoff"), F.col(f"{r.name}_{g}").alias("k")) for r in rules for g, c in enumerate(r.grid)])
    tested = by.select("stratum", "n", F.explode(tests).alias("t")).select("stratum", "n", "t.*")
    proven = tested.where(F.col("k") < F.col("n") * share).where(binomial_tail(F.col("k"), F.col("n"), share) <= level)
    best = [F.max_by(F.when(F.col("rule") == r.name, F.col("cutoff")), F.when(F.col("rule") == r.name, F.col("grid"))).alias(f"cut_{r.name}") for r in rules]
    return proven.groupBy("stratum").agg(*best)


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, rules: tuple[Rule, ...] = RULES, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """Statistics, base_failed, kept and the names of the rules that reject, for each row of docs (doc_id, text, lang)."""
    stats = settled(statistics(docs.select("doc_id", "text", stratum(F.col("lang"), languages).alias("stratum")), "doc_id", "stratum"), "risk-stats")
    cuts = cutoffs(stats, labels, alpha, delta, rules, languages)
    judged = stats.join(F.broadcast(cuts), "stratum", "left")  # at most len(languages) + 1 rows
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rejecting = F.array_compact(F.array(*[F.when((F.col("n_words") > 0) & (F.expr(r.statistic.replace("/ ", "/ nullif(") + ", 0)") > F.col(f"cut_{r.name}")), F.lit(r.name)) for r in rules]))
    return judged.withColumns({"base_failed": base, "rejected_by": rejecting}).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
