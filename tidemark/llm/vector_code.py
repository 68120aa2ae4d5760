"""Product codes of vectors, whose nearest codebook entries are found by a VA-file.

A vector of integers is cut into equal parts; each part position has a codebook of a few entries. The entries' coordinates
are quantised to cells of a few bits. For a query part, one table per coordinate gives the least and the greatest squared
distance to each cell; looked up and added over the coordinates they bound the distance to each entry from both sides.
Only entries whose lower bound does not lie above the least upper bound are refined, by exact integer distances.

A round is one pass: tasks assign their parts and send one count and one sum per entry and coordinate, Spark adds them up,
and the driver, which holds only the codebooks (parts x entries x width integers), puts floor(sum / count) in place.
A lost executor costs its tasks' partial sums, nothing else.

Defined results: rows with a null vector, or with null, NaN or infinite components, are not returned; shorter vectors
count as filled up with zeros to the longest one's length and to a multiple of the parts; components beyond the bound
that keeps errors within a long (32,768 at 64 dimensions) count as that bound; equal ids are ordered by their vectors,
null ids come last; repeated rows are coded row by row; fewer rows than entries give codebooks of that many entries; an
empty table gives an empty table; extra columns of any name are ignored. error and label_error are longs; a label_error
past the range of a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import MOST_KEYS, dropped, settled, workers_find_library
from .vectors import whole_vectors, with_doubles

#: Bits of a coordinate's cell, and rows that are bounded at once.
BITS, ROWS_AT_ONCE = 4, 2048


class CellFile:
    """The entries of one codebook (entries x width, integers) as cells."""

    def __init__(self, entries: np.ndarray, bits: int = BITS):
        self.entries = entries
        low, high = entries.min(axis=0), entries.max(axis=0)
        step = (high - low) // (1 << bits) + 1
        self.cells = (entries - low) // step
        edges = low[:, None] + step[:, None] * np.arange(1 << bits)
        self.lower, self.upper = edges, edges + step[:, None] - 1  # least and greatest integer of each cell

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each part the index of the nearest entry (the first of equals), its squared distance; and how many distances were taken."""
        n, width = parts.shape
        if width == 0:
            return np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        x = parts[:, :, None]
        below, above = self.lower - x, x - self.upper
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(-below, -above) ** 2  # below and above swap signs at the far edge
        bounds = np.zeros((2, n, len(self.entries)), np.int64)
        for d in range(width):
            bounds[0] += least[:, d, self.cells[:, d]]
            bounds[1] += most[:, d, self.cells[:, d]]
        row, entry = np.nonzero(bounds[0] <= bounds[1].min(axis=1)[:, None])
        exact = np.full((n, len(self.entries)), np.iinfo(np.int64).max)
        exact[row, entry] = ((parts[row] - self.entries[entry]) ** 2).sum(axis=1)
        best = exact.argmin(axis=1)
        return best, exact[np.arange(n), best], len(row)


def _bound(width: int) -> float:
    """Components whose squared differences, scaled by 4096 and added over width dimensions, stay within a long."""
    return float(1 << max(0, (62 - max(width - 1, 1).bit_length()) // 2 - 13))


def _integers(vectors: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    limit = _bound(width)
    out[:, : vectors.shape[1]] = np.floor(4096 * np.clip(vectors, -limit, limit))
    return out


def _assigned(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batch, which rows are kept, and for these the parts (row, part, width), the entries' indices and squared distances (row, part)."""
    files = [CellFile(book) for book in codebooks]
    parts, _, size = codebooks.shape
    for batch in batches:
        good, vectors = whole_vectors(batch)
        x = _integers(vectors, parts * size).reshape(-1, parts, size)
        index, error = np.zeros(x.shape[:2], np.int64), np.zeros(x.shape[:2], np.int64)
        for at in range(0, len(x), ROWS_AT_ONCE):
            for p, cells in enumerate(files):
                index[at : at + ROWS_AT_ONCE, p], error[at : at + ROWS_AT_ONCE, p], _ = cells.nearest(x[at : at + ROWS_AT_ONCE, p])
        yield batch, good, x, index, error


def _first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The vectors of the smallest ids, cut into parts. A task sends its own smallest ones and the length of its longest vector."""
    id_type = rows.schema.fields[0].dataType

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        longest = 0
        for batch in batches:
            good, vectors = whole_vectors(batch)
            longest = max(longest, vectors.shape[1])
            ids = batch.column(0).filter(pa.array(good)).to_pylist()
            edge = held[-1][:2] if len(held) == entries else None
            held += [(i is None, i, v.tolist()) for i, v in zip(ids, vectors) if edge is None or (i is None, i) <= edge or i is None]
            held = sorted(held, key=lambda h: (h[0], 0 if h[0] else h[1], h[2]))[:entries]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([h[1] for h in held], batch.column(0).type), pa.array([h[2] for h in held], pa.list_(pa.float64())), pa.array([longest] * len(held), pa.int64())], names=["id", "vector", "longest"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("longest", T.LongType())])
    found = settled(rows.mapInArrow(smallest, schema), "first-vectors")
    most = found.agg(F.max("longest")).first()[0]
    got = found.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    dropped(found)
    if not got:
        return None
    width = -(-most // parts) * parts
    x = np.zeros((len(got), width), np.int64)
    for i, r in enumerate(got):
        x[i] = _integers(np.array([r["vector"]]).reshape(1, -1), width)
    return np.ascontiguousarray(x.reshape(len(got), parts, -1).transpose(1, 0, 2))


def _round(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks with each used entry moved to the floor of its parts' mean."""
    parts, entries, size = codebooks.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
        for _, _, x, index, _ in _assigned(batches, codebooks):
            for p in range(parts):
                count[p] += np.bincount(index[:, p], minlength=entries)
                for d in range(size):  # a batch's sums lie far below 2^53: doubles hold them exactly
                    total[p, :, d] += np.bincount(index[:, p], x[:, p, d], entries).astype(np.int64)
        used = np.nonzero(count)
        cell = np.repeat(used[0] * entries + used[1], size)
        place = np.tile(np.arange(size), len(used[0]))
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(place, pa.int32()), pa.array(np.repeat(count[used], size)), pa.array(total[used].ravel())], names=["cell", "place", "n", "total"])

    sums = rows.mapInArrow(totals, "cell int, place int, n long, total long").groupBy("cell", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    moved = codebooks.copy()
    for r in sums.collect():  # parts x entries x width rows
        moved[r["cell"] // entries, r["cell"] % entries, r["place"]] = int(r["total"]) // r["n"]
    return moved


def _digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def _with_label_error(coded: DataFrame, salts: int = 32) -> DataFrame:
    """coded (settled) with the errors summed over equal labels. Sums are small and broadcast, or else dealt with a salt, as one label may be most rows."""
    sums = settled(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total")).select(F.col("label").alias("__label"), F.expr("try_cast(total AS BIGINT)").alias("label_error")), "label-errors")
    same = coded["label"].eqNullSafe(sums["__label"])
    if sums.count() <= MOST_KEYS:
        return coded.join(F.broadcast(sums), same).drop("__label")
    dealt = coded.withColumn("__salt", F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(salts)).cast("int"))
    every = sums.withColumn("__salt_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(every, dealt["label"].eqNullSafe(every["__label"]) & (dealt["__salt"] == every["__salt_of"])).drop("__label", "__salt", "__salt_of")


def encode(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256, label. entries: up to 256."""
    workers_find_library(rows.sparkSession)
    whole = with_doubles(rows, vector, F.col(key).alias("vec_id"), F.col(label).alias("label"))
    fields = [whole.schema["vec_id"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), whole.schema["label"]]
    codebooks = _first_codebooks(whole, parts, entries)
    if codebooks is None:
        schema = T.StructType([*fields[:3], T.StructField("label_error", T.LongType()), T.StructField("codebooks_sha256", T.StringType()), fields[3]])
        return rows.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        codebooks = _round(whole, codebooks)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, good, _, index, error in _assigned(batches, codebooks):
            ids, labels = (batch.column(i).filter(pa.array(good)) for i in (0, 1))
            digits = [row.tobytes().hex() for row in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(digits, pa.string()), pa.array(error.sum(axis=1), pa.int64()), labels], names=["vec_id", "code", "error", "label"])

    coded = settled(whole.mapInArrow(code, T.StructType(fields)), "vector-codes")
    return _with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(_digest(codebooks)).alias("codebooks_sha256"), "label")
