"""Quality scores learned from preference pairs.

Bradley-Terry: the odds that document a is preferred to document b are exp(s(a) - s(b)), with s linear in a document's
features. All documents with a label that may be learned from take part. They are dealt to blocks of some BLOCK documents by
the hash of their id, and the weights minimise the logistic loss of the feature differences of all (good, bad) pairs of a
block, by Newton steps: each adds up the blocks' gradients and curvatures, and the driver sees these sums alone. A label that
is too rare for so many blocks has its documents in several. The cutoff is the quantile of the scores of all these documents
that matches their share of bad ones, and a score is the logistic of the distance to it.

Features are computed in the tasks, once for each row, from whole texts.

Defined results: null text counts as empty, and empty texts get the score of their (zero) features; very long texts are
read whole, in one chunk of their own; rows that repeat a doc_id are scored row by row and learned from once (from the greatest
features); of repeated labels the smallest counts, null labels and null ids are left out; equal scores fall on the same side of the cutoff; with no pair
to learn from all weights are zero and all scores 0.5; an empty table gives an empty table; extra columns of any name
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shingles import WEIGHTS, mixed, text_chunks, word_hashes
from .store import dropped, settled, workers_find_library

CLASSES = {name: np.isin(np.arange(256), list(chars)) for name, chars in {
    "upper": range(65, 91), "digit": range(48, 58), "stop": b".?", "comma": b",;:", "bang": b"!", "symbol": b"#*$%&|<>", "quote": b"\"'()", "join": b"@/=_+-", "line": b"\n", "high": range(128, 256),
}.items()}
KINDS = sum(((1 << i) * mask.astype(np.int64) for i, mask in enumerate(CLASSES.values())), np.zeros(256, np.int64))
N_FEATURES = len(CLASSES) + 7
#: No text of the training sample takes more than this part of the bound on its characters.
LONGEST_SHARE = 50
#: Documents of a block, how many of either label it has at least (as expected), and bins of a pass that looks for the cutoff.
BLOCK, LEAST, BINS = 500, 40, 1 << 16


def features(column: pa.Array) -> np.ndarray:
    """One row of N_FEATURES numbers for each text: shares of byte classes, lengths, and shares of repeated words and word runs."""
    rows = []
    with np.errstate(over="ignore"):
        for text, ends in text_chunks(column):
            starts = np.concatenate(([0], ends[:-1]))
            sizes = ends - starts
            kinds = KINDS[text]
            shares = [np.diff(np.concatenate(([0], np.cumsum((kinds >> i) & 1)))[np.concatenate(([0], ends))]) / np.maximum(sizes, 1) for i in range(len(CLASSES))]
            words, counts = word_hashes(text, ends)
            runs = mixed(words[:-2] * WEIGHTS[0] + words[1:-1] * WEIGHTS[1] + words[2:] * WEIGHTS[2]) if len(words) > 2 else words[:0]
            distinct, repeated, at = np.ones(len(ends)), np.zeros(len(ends)), 0
            for d, n in enumerate(counts.tolist()):
                if n:
                    distinct[d] = len(np.unique(words[at : at + n])) / n
                if n > 2:
                    repeated[d] = 1 - len(np.unique(runs[at : at + n - 2])) / (n - 2)
                at += n
            length = np.log1p(counts)
            per_word = sizes / np.maximum(counts, 1)
            rows.append(np.stack([*[np.sqrt(x) for x in shares], length / 8, length**2 / 64, (counts < 20).astype(float), np.minimum(per_word, 40) / 10, distinct, repeated, np.sqrt(repeated)], axis=1))
    return np.concatenate(rows) if rows else np.zeros((0, N_FEATURES))


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cutoff: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((x - self.mean) / self.scale @ self.weights - self.cutoff, -30, 30)))


def weighted_quantile(values: np.ndarray, weights: np.ndarray, q: float) -> float:
    """np.quantile where all weights are equal."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    middle = np.cumsum(weights) - weights / 2
    return float(np.interp(q * (middle[-1] - middle[0]) + middle[0], middle, values))


def block_sums(z: np.ndarray, good: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of all pairs of a good and a bad row: their number, the sum of their losses, its gradient and its curvature, end to end."""
    best, worst = z[good], z[~good]
    gaps = np.subtract.outer(best @ weights, worst @ weights)
    lost = 1 / (1 + np.exp(np.clip(gaps, -500, 500)))
    curve = lost * (1 - lost)
    slope = worst.T @ lost.sum(axis=0) - best.T @ lost.sum(axis=1)
    mixed_ = best.T @ curve @ worst
    bend = (best.T * curve.sum(axis=1)) @ best + (worst.T * curve.sum(axis=0)) @ worst - mixed_ - mixed_.T
    return np.concatenate(([gaps.size, np.logaddexp(0, -gaps).sum()], slope, bend.ravel()))


def minimised(sums: Callable[[np.ndarray], np.ndarray], rounds: int, ridge: float) -> np.ndarray:
    """Weights of the least mean loss, from sums over all blocks at given weights; a step that makes it greater is halved."""
    weights, step, least = np.zeros(N_FEATURES), np.zeros(N_FEATURES), np.inf
    for _ in range(rounds):
        found = sums(weights + step)
        pairs, (loss, slope, bend) = found[0], np.split(found[1:], [1, 1 + N_FEATURES])
        if not pairs:
            return weights
        at = weights + step
        now = loss[0] / pairs + ridge / 2 * (at @ at)
        if now > least:
            step = step / 2
        else:
            gained, weights, least = least - now, at, now
            if gained < 1e-9:
                break
            step = -np.linalg.solve(bend.reshape(N_FEATURES, N_FEATURES) / pairs + ridge * np.eye(N_FEATURES), slope / pairs + ridge * weights)
    return weights


def fit(x: np.ndarray, good: np.ndarray, share: float | None = None, rounds: int = 30, ridge: float = 1e-3) -> Ranking:
    """The ranking of rows that form one block. share: of good ones among all labels."""
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    z, n = (x - mean) / scale, int(good.sum())
    if n in (0, len(x)):
        return Ranking(mean, scale, np.zeros(N_FEATURES), 0.0)
    weights = minimised(lambda w: block_sums(z, good, w), rounds, ridge)
    share = n / len(x) if share is None else share
    return Ranking(mean, scale, weights, weighted_quantile(z @ weights, np.where(good, share / n, (1 - share) / (len(x) - n)), 1 - share))


def held_out(doc_id: Column, of: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == remainder, F.lit(False))


def learnable(docs: DataFrame, labels: DataFrame, label: str, of: int, remainder: int) -> DataFrame:
    """doc_id, __label and __chars (length of the text) of all documents that may be learned from."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("__label")).where(~held_out(F.col("doc_id"), of, remainder))
    there = docs.select("doc_id", F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("__chars"))
    return settled(there.join(known, "doc_id").groupBy("doc_id", "__label").agg(F.max("__chars").alias("__chars")), "labels")


def labelled(docs: DataFrame, known: DataFrame, most: dict[int, int], most_chars: int) -> DataFrame:
    """doc_id, text and __label of at most most[l] documents with each label l, and of at most most_chars characters in all, taken by the hash of their id.

    The ids are chosen first, from narrow columns, and are few by the bound; so no text is shuffled or sorted but those
    of the sample. Of rows that repeat a doc_id the greatest text counts. Texts of over a LONGEST_SHARE-th of most_chars are
    not chosen from, so that none can use up the bound alone.
    """
    by_hash = (F.xxhash64("doc_id"), F.col("doc_id"))
    known = known.where(F.col("__chars") <= most_chars // LONGEST_SHARE)
    parts = [known.where(F.col("__label") == value).orderBy(*by_hash).limit(n) for value, n in most.items()]
    few = reduce(DataFrame.unionByName, parts)
    # One window over a number of rows that the bounds fix.
    chosen = few.withColumn("__sum", F.sum("__chars").over(Window.orderBy(*by_hash))).where(F.col("__sum") <= most_chars)
    chosen = settled(chosen.select("doc_id", "__label"), "sample")
    met = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id", "__label").agg(F.max("text").alias("text"))


def measured(docs: DataFrame, of: int, remainder: int) -> DataFrame:
    """doc_id, held_out, x (its features) for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(features(batch.column(2))), pa.list_(pa.float64()))], names=["doc_id", "held_out", "x"])

    rows = docs.select("doc_id", held_out(F.col("doc_id"), of, remainder).alias("held_out"), F.col("text").cast("string").alias("text"))
    return settled(rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, x array<double>"), "features")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _summed(table: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of part over all batches of table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((part(batch) for batch in batches if batch.num_rows), np.zeros(1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.float64())], names=["i", "v"])

    rows = table.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").toArrow()
    return rows["v"].to_numpy()


def blocks_of(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """labels and x (end to end) of the rows (doc_id, label, x) of each block; all rows take part."""
    n_blocks = max(1, sum(counts.values()) // BLOCK)
    copies = {value: max(1, -(-LEAST * n_blocks // max(1, counts.get(value, 0)))) if n_blocks > 1 else 1 for value in (0, 1)}
    dealt = rows.select("*", F.explode(F.sequence(F.lit(1), F.when(F.col("label") == 1, copies[1]).otherwise(copies[0]))).alias("copy"))
    dealt = dealt.select(F.pmod(F.xxhash64("doc_id", "copy"), F.lit(n_blocks)).alias("block"), F.struct("doc_id", "label", "x").alias("r"))
    packed = dealt.groupBy("block").agg(F.sort_array(F.collect_list("r")).alias("r"))
    return settled(packed.select(F.col("r.label").alias("labels"), F.flatten("r.x").alias("x")), "blocks")


def cutoff_of(rows: DataFrame, ranking: Ranking, below: float) -> float:
    """Where a share `below` of the scores of all rows lies under it: all are counted in bins, then those of the bin it lies in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array((_matrix(batch.column(0)) - ranking.mean) / ranking.scale @ ranking.weights, pa.float64())], names=["s"])

    scores = settled(rows.select("x").mapInArrow(run, "s double"), "scores")
    first, last, n = scores.agg(F.min("s"), F.max("s"), F.count("s")).first()

    def ranked(k: int) -> float:
        low, high, under = first, last, 0
        for _ in range(2):
            if high <= low:
                break
            wide = (high - low) / BINS
            inside = scores.where((F.col("s") >= low) & (F.col("s") <= high))
            counted = inside.groupBy(F.least(F.floor((F.col("s") - low) / wide), F.lit(BINS - 1)).alias("bin")).count().orderBy("bin").toArrow()
            bins, sums = counted["bin"].to_numpy(), under + np.cumsum(counted["count"].to_numpy())
            at = min(int(np.searchsorted(sums, k, side="right")), len(bins) - 1)
            under = int(sums[at - 1]) if at else under
            low, high = low + float(bins[at]) * wide, low + float(bins[at] + 1) * wide
        return (low + high) / 2

    place = below * (n - 1)
    k = int(place)
    one = ranked(k)
    found = one + (place - k) * (ranked(min(k + 1, n - 1)) - one)
    dropped(scores)
    return found


def train(found: DataFrame, labels: DataFrame, most_labelled: int | None = None, of: int = 3, remainder: int = 1, rounds: int = 30, ridge: float = 1e-3) -> Ranking:
    """The ranking learned from all rows of found (doc_id, x) that may be learned from; most_labelled: weights from so many of either label only."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), of, remainder))
    rows = settled(found.select("doc_id", "x").join(known, "doc_id").groupBy("doc_id", "label").agg(F.max("x").alias("x")), "labelled")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        dropped(rows)
        return Ranking(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    share, learned = counts[1] / sum(counts.values()), rows
    if most_labelled is not None:
        learned = reduce(DataFrame.unionByName, [rows.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled) for value in (0, 1)])
        counts = {value: min(n, most_labelled) for value, n in counts.items()}
    n, sums, squares = np.split(_summed(rows.select("x"), lambda b: np.concatenate(([b.num_rows], _matrix(b.column(0)).sum(axis=0), (_matrix(b.column(0)) ** 2).sum(axis=0)))), [1, 1 + N_FEATURES])
    mean = sums / n
    scale = np.sqrt(np.maximum(squares / n - mean**2, 0)) + 1e-6
    blocks = blocks_of(learned, counts)

    def sums_at(weights: np.ndarray) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> np.ndarray:
            each = zip(batch.column(0), batch.column(1), strict=True)
            return sum(block_sums((x.values.to_numpy().reshape(-1, N_FEATURES) - mean) / scale, y.values.to_numpy() == 1, weights) for y, x in each)

        return _summed(blocks, part)

    ranking = Ranking(mean, scale, minimised(sums_at, rounds, ridge), 0.0)
    ranking = Ranking(mean, scale, ranking.weights, cutoff_of(rows, ranking, 1 - share))
    dropped(rows, blocks)
    return ranking


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, most_labelled: int | None = None, of: int = 3, remainder: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    workers_find_library(docs.sparkSession)
    found = measured(docs, of, remainder)
    model = train(found, labels, most_labelled, of, remainder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(_matrix(batch.column(2))), pa.float64())], names=["doc_id", "held_out", "score"])

    scored = found.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
