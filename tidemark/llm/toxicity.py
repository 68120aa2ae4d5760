"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A text is cut into words at white space and ASCII punctuation. A word enters the network as the embedding of the word
(a vocabulary of the frequent words of the training sample, else a shared unknown) next to the mean embedding of its
hashed character trigrams. Overlapping windows of WINDOW words, one every STRIDE, cover the whole text, so that every
passage of up to WINDOW - STRIDE + 1 words lies wholly in some window wherever it stands. In each window two gated
recurrent layers read forwards and backwards, attention weights their states, and the pooled state gives a logit. A
document scores as its worst window.

Training learns from document labels: in each round the windows that score highest in their document stand for it. The
sample is bounded (at most `most_toxic` + `most_clean` labelled documents of at most `most_chars` characters in all,
taken by the hash of their id, none of over a fiftieth of that); every text of the table is scored whole.

Defined results: null and empty texts, and texts without a word, score 0; very long texts are scored whole, in a chunk
of their own; repeated rows are scored row by row and learned from once; of repeated labels the smallest counts, null
labels and null ids are left out; equal texts get equal scores; with no toxic or no clean row to learn from all scores
are 0; an empty table gives an empty table; extra columns of any name are ignored, or passed on by `kept`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rank import held_out, labelled, learnable
from .shingles import LOWER, SPACE, text_chunks, word_hashes, word_places
from .store import workers_find_library

WINDOW, STRIDE = 32, 8
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 12, 4, 8, 8
GRAMS = 512
MOST_CHARS = 6_000_000
ROWS = 2048
GAPS = SPACE.copy()
GAPS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


class Network:
    """Weights by name, as float32. Windows are arrays (WINDOW, rows) of word numbers; number 0 is padding."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale=0.1: (rng.standard_normal(shape) * scale).astype(np.float32)
        width = WORD_DIM + CHAR_DIM
        self.vocabulary = vocabulary
        self.w = {
            "word": draw(len(vocabulary) + 1, WORD_DIM, scale=0.01), "gram": draw(GRAMS, CHAR_DIM),
            "into": draw(2, width, 3 * HIDDEN, scale=width**-0.5), "back": draw(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), "bias": draw(2, 1, 3 * HIDDEN, scale=0.01),
            "look": draw(2 * HIDDEN, ATTEND, scale=0.3), "weigh": draw(ATTEND, scale=0.3), "out": draw(2 * HIDDEN, scale=0.3), "shift": np.full(1, -2, np.float32),
        }

    def words(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a chunk of texts: vocabulary numbers (last: unknown), trigram numbers, first and last byte of each word, words of each text."""
        with np.errstate(over="ignore"):
            hashes, counts = word_hashes(text, ends, GAPS)
        first, last = word_places(text, ends, GAPS)
        at = np.searchsorted(self.vocabulary, hashes)
        known = np.where(at < len(self.vocabulary), self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == hashes, False) if len(self.vocabulary) else np.zeros(len(hashes), bool)
        low = np.where(GAPS[text], 0, LOWER[text]).astype(np.uint32)
        before, after = np.concatenate((low[:1] * 0, low[:-1])), np.concatenate((low[1:], low[:1] * 0))
        # Texts lie end to end; no trigram reaches into the next one.
        begins = np.concatenate(([0], ends[:-1]))
        before[begins[begins < len(text)]] = 0
        after[ends[ends > 0] - 1] = 0
        grams = ((before * np.uint32(961) + low * np.uint32(31) + after) * np.uint32(2654435761)) >> np.uint32(23)
        return np.where(known, at, len(self.vocabulary)), grams, first, last, counts

    def inputs(self, numbers, grams, first, last) -> np.ndarray:
        """The input of each word, (words, WORD_DIM + CHAR_DIM)."""
        if not len(first):
            return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
        # Sums of words and of the gaps behind them in turn; a row more, so that the last word has an end.
        rows = self.w["gram"][np.append(grams, 0)]
        spans = np.add.reduceat(rows, np.stack((first, last), axis=1).ravel())[::2]
        return np.concatenate((self.w["word"][numbers], spans / (last - first)[:, None].astype(np.float32)), axis=1)

    def states(self, gates: np.ndarray, keep: list | None = None) -> np.ndarray:
        """gates (WINDOW, 2, rows, 3 HIDDEN): what the inputs add. Direction 1 reads backwards. States (WINDOW, 2, rows, HIDDEN)."""
        h = np.zeros((2, gates.shape[2], HIDDEN), np.float32)
        out = np.empty((WINDOW, *h.shape), np.float32)
        for t in range(WINDOW):
            x = np.stack((gates[t, 0], gates[WINDOW - 1 - t, 1]))
            u = np.matmul(h, self.w["back"])
            zr = np.tanh((x[..., : 2 * HIDDEN] + u[..., : 2 * HIDDEN]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            n = np.tanh(x[..., 2 * HIDDEN :] + r * u[..., 2 * HIDDEN :])
            if keep is not None:
                keep.append((h, z, r, n, u[..., 2 * HIDDEN :]))
            h = n + z * (h - n)
            out[t, 0], out[WINDOW - 1 - t, 1] = h[0], h[1]
        return out

    def pooled(self, states: np.ndarray, real: np.ndarray):
        """Attention over the real places. real: (WINDOW, rows)."""
        both = np.concatenate((states[:, 0], states[:, 1]), axis=-1)
        seen = np.tanh(both @ self.w["look"])
        force = np.where(real, seen @ self.w["weigh"], np.float32(-30))
        share = np.exp(force - force.max(axis=0))
        share /= share.sum(axis=0)
        pool = np.einsum("tb,tbd->bd", share, both)
        return both, seen, share, pool, pool @ self.w["out"] + self.w["shift"][0]

    def logits(self, gates_of_words: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """gates_of_words: (words + 1, 2, 3 HIDDEN), row 0 for padding. windows: (rows, WINDOW)."""
        found = np.empty(len(windows), np.float32)
        for at in range(0, len(windows), ROWS):
            some = windows[at : at + ROWS].T
            gates = np.moveaxis(gates_of_words[some], 2, 1)
            found[at : at + ROWS] = self.pooled(self.states(gates), some > 0)[-1]
        return found

    def gates(self, inputs: np.ndarray) -> np.ndarray:
        with_padding = np.concatenate((np.zeros((1, inputs.shape[1]), np.float32), inputs))
        return np.stack([with_padding @ self.w["into"][d] + self.w["bias"][d] for d in (0, 1)], axis=1)

    def step(self, numbers: np.ndarray, gram_lists: tuple[np.ndarray, np.ndarray], windows: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the logistic loss. numbers: of the words in windows (row i is word i + 1); gram_lists: their trigrams end to end, and ends."""
        grams, ends = gram_lists
        first = np.concatenate(([0], ends[:-1]))
        inputs = self.inputs(numbers, grams, first, ends)
        table = self.gates(inputs)
        order, real, kept = windows.T, windows.T > 0, []
        states = self.states(np.moveaxis(table[order], 2, 1), kept)
        both, seen, share, pool, logit = self.pooled(states, real)
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        d_logit = ((1 / (1 + np.exp(-logit)) - wanted) / len(wanted)).astype(np.float32)
        g["shift"][0], g["out"] = d_logit.sum(), pool.T @ d_logit
        d_pool = d_logit[:, None] * self.w["out"]
        d_both = share[..., None] * d_pool
        d_share = np.einsum("tbd,bd->tb", both, d_pool)
        d_force = share * (d_share - (share * d_share).sum(axis=0)) * real
        g["weigh"] = np.einsum("tba,tb->a", seen, d_force)
        d_seen = d_force[..., None] * self.w["weigh"] * (1 - seen**2)
        g["look"] = np.einsum("tbd,tba->da", both, d_seen)
        d_both += d_seen @ self.w["look"].T
        d_table, d_h = np.zeros_like(table), np.zeros((2, len(windows), HIDDEN), np.float32)
        d_gates = np.empty((WINDOW, 2, len(windows), 3 * HIDDEN), np.float32)
        for t in reversed(range(WINDOW)):
            h, z, r, n, un = kept[t]
            d_h = d_h + np.stack((d_both[t, :, :HIDDEN], d_both[WINDOW - 1 - t, :, HIDDEN:]))
            d_n = d_h * (1 - z) * (1 - n**2)
            d_z = d_h * (h - n) * z * (1 - z)
            d_r = d_n * un * r * (1 - r)
            d_u = np.concatenate((d_z, d_r, d_n * r), axis=-1)
            d_x = np.concatenate((d_z, d_r, d_n), axis=-1)
            g["back"] += np.matmul(h.transpose(0, 2, 1), d_u)
            d_h = d_h * z + np.matmul(d_u, self.w["back"].transpose(0, 2, 1))
            d_gates[t, 0], d_gates[WINDOW - 1 - t, 1] = d_x[0], d_x[1]
        by_word = np.argsort(order, axis=None, kind="stable")
        met, begin = np.unique(order.ravel()[by_word], return_index=True)
        for d in (0, 1):
            d_table[met, d] = np.add.reduceat(d_gates[:, d].reshape(-1, 3 * HIDDEN)[by_word], begin)
        g["bias"] = d_table.sum(axis=0)[:, None]
        d_in = np.zeros_like(inputs)
        for d in (0, 1):
            g["into"][d] = inputs.T @ d_table[1:, d]
            d_in += d_table[1:, d] @ self.w["into"][d].T
        by_number = np.argsort(numbers, kind="stable")
        met, begin = np.unique(numbers[by_number], return_index=True)
        g["word"][met] = np.add.reduceat(d_in[by_number, :WORD_DIM], begin)
        sizes = ends - first
        per_byte = np.repeat(d_in[:, WORD_DIM:] / sizes[:, None], sizes, axis=0)
        g["gram"] = np.stack([np.bincount(grams, per_byte[:, k], GRAMS) for k in range(CHAR_DIM)], axis=1).astype(np.float32)
        return g

    def score(self, column: pa.Array) -> np.ndarray:
        """The score of each text of an Arrow string column."""
        found = []
        for text, ends in text_chunks(column):
            *words, counts = self.words(text, ends)
            windows, of = windows_of(counts)
            logit = self.logits(self.gates(self.inputs(*words)), windows)
            best = np.full(len(ends), -np.inf)
            np.maximum.at(best, of, logit)
            found.append(1 / (1 + np.exp(-np.clip(best, -60, 60))) * np.isfinite(best))
        return np.concatenate(found) if found else np.zeros(0)


def windows_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows (numbers of words from 1; 0 where the text has ended) of texts with so many words each, and their texts."""
    counts = np.asarray(counts).astype(np.int32)
    begin = np.cumsum(counts, dtype=np.int32) - counts
    each = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    of = np.repeat(np.arange(len(counts)), each)
    nth = (np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)).astype(np.int32)
    start = np.minimum(nth * STRIDE, np.maximum(counts[of] - WINDOW, 0))
    place = start[:, None] + np.arange(WINDOW, dtype=np.int32)
    inside = place < counts[of][:, None]
    place += begin[of][:, None] + 1
    place *= inside
    return place, of


def fit(texts: list[str] | pa.Array, toxic: np.ndarray, rounds: int = 6, least_steps: int = 80, batch: int = 96, least_texts: int = 8, forget: float = 0.2, decay: float = 0.02, seed: int = 3) -> Network | None:
    """Train on texts with their labels; None if one label is missing."""
    if not toxic.any() or toxic.all():
        return None
    column, rng = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), np.random.default_rng(seed)
    chunks = list(text_chunks(column))
    # In how many texts each word stands.
    seen = []
    with np.errstate(over="ignore"):
        for text, ends in chunks:
            hashes, counts = word_hashes(text, ends, GAPS)
            seen += [np.unique(part) for part in np.split(hashes, np.cumsum(counts)[:-1])]
    values, in_texts = np.unique(np.concatenate(seen), return_counts=True)
    net = Network(values[in_texts >= least_texts], seed)
    # The driver holds these while it trains: in small types, and once (a chunk is a slice).
    narrow = (np.int32, np.uint16, np.int32, np.int32, np.int32)
    read = [[x.astype(t) for x, t in zip(net.words(text, ends), narrow, strict=True)] for text, ends in chunks]
    del chunks, seen, values, in_texts, column, texts
    numbers, grams, counts = (np.concatenate([r[i] for r in read]) for i in (0, 1, 4))
    bytes_at, words_at = (np.cumsum([0, *[len(r[i]) for r in read]], dtype=np.int32) for i in (1, 0))
    first, last = (np.concatenate([r[i] + before for r, before in zip(read, bytes_at, strict=False)]) for i in (2, 3))
    chunk_counts = [r[4] for r in read]
    del read
    windows, of = windows_of(counts)

    def logits() -> np.ndarray:
        """Chunk by chunk, as `score` does."""
        found = []
        for i, counts in enumerate(chunk_counts):
            of_words, of_bytes = slice(*words_at[i : i + 2]), slice(*bytes_at[i : i + 2])
            inputs = net.inputs(numbers[of_words], grams[of_bytes], first[of_words] - bytes_at[i], last[of_words] - bytes_at[i])
            found.append(net.logits(net.gates(inputs), windows_of(counts)[0]))
        return np.concatenate(found)

    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    steps = 0
    for turn in range(rounds):
        if turn:
            logit = logits()
        else:
            logit = rng.random(len(windows))
        # The worst window stands for its text; a clean text adds two windows by chance.
        ranked = np.lexsort((-logit, of))
        worst = ranked[np.concatenate(([True], of[ranked][1:] != of[ranked][:-1]))]
        clean = np.flatnonzero(~toxic[of])
        chosen = np.concatenate((worst, rng.choice(clean, min(len(clean), len(worst) // 2))))
        passes = max(1, -(-least_steps * batch // len(chosen)))
        for at in (at for _ in range(passes) for at in np.array_split(rng.permutation(chosen), max(1, len(chosen) // batch))):
            used = np.unique(windows[at])
            used = used[used > 0]
            local = np.searchsorted(used, windows[at]) + 1
            local[windows[at] == 0] = 0
            spans = [grams[a:b] for a, b in zip(first[used - 1], last[used - 1], strict=True)]
            wanted = toxic[of[at]].astype(np.float32)
            # Some words are read by their characters alone, so that these carry meaning too.
            numbered = np.where(rng.random(len(used)) < forget, len(net.vocabulary), numbers[used - 1])
            g = net.step(numbered, (np.concatenate(spans), np.cumsum([len(x) for x in spans])), local, wanted)
            steps += 1
            for k, v in g.items():
                m, s = moment[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                if k in ("word", "gram"):
                    net.w[k] *= np.float32(1 - 0.01 * decay)
                net.w[k] -= (0.01 * (m / (1 - 0.9**steps)) / (np.sqrt(s / (1 - 0.99**steps)) + 1e-6)).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame, most_toxic: int = 700, most_clean: int = 3000, of: int = 4, remainder: int = 2, most_chars: int = MOST_CHARS) -> Network | None:
    known = learnable(docs, labels, "toxic", of, remainder)
    rows = labelled(docs, known, {1: most_toxic, 0: most_clean}, most_chars).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    texts, toxic = rows["text"].cast(pa.string()).combine_chunks(), rows["__label"].to_numpy() == 1
    del rows
    net = fit(texts, toxic)
    del texts
    pa.default_memory_pool().release_unused()
    return net


def _scored(docs: DataFrame, net: Network | None, keep: list[str], held: Column) -> DataFrame:
    """c0, c1, ... for the columns in keep, __held, __score."""
    weights = docs.sparkSession.sparkContext.broadcast(net)  # some hundred kilobytes
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], held.alias("__held"), F.col("text").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = own.score(texts) if own is not None else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], names=[*batch.schema.names[:-1], "__score"])

    schema = ", ".join([*[f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)], "__held boolean, __score double"])
    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most_toxic: int = 700, most_clean: int = 3000, of: int = 4, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    workers_find_library(docs.sparkSession)
    net = train(docs, labels, most_toxic, most_clean, of, remainder)
    scored = _scored(docs, net, ["doc_id"], held_out(F.col("doc_id"), of, remainder))
    return scored.select(F.col("c0").alias("doc_id"), F.col("__held").alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most_toxic: int = 700, most_clean: int = 3000, of: int = 4, remainder: int = 2) -> DataFrame:
    """The rows of docs that are not toxic, with all their columns."""
    workers_find_library(docs.sparkSession)
    net = train(docs, labels, most_toxic, most_clean, of, remainder)
    clean = _scored(docs, net, docs.columns, F.lit(False)).where(F.col("__score") < threshold)
    return clean.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
