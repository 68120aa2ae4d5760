"""Byte-level BPE by dynamic programming over byte prefixes.

Every byte prefix of a piece has one BPE encoding, so it has one valid last token. The table of these last tokens is
filled from left to right: the last token of a prefix is the one vocabulary entry that ends there and may follow the
last token of the prefix before it. Whether one token may follow another depends on the two tokens alone and is
remembered. The table encodes every prefix of the text, an appended text continues it, and after an edit it is refilled
only until it agrees with the old one again.

Spark deals the rows; each task fills one table for each distinct piece of its texts, remembers a bounded number of
bytes of short pieces and of pairs, and streams Arrow batches.

Defined results: null text counts as empty (no tokens, digests of nothing); very long texts and pieces are encoded whole;
there are no ties, as ranks differ; repeated rows are encoded row by row; an empty table gives an empty table; extra
columns of any name are ignored, those in keep are passed on.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import workers_find_library

#: Bytes of a worker's memo of pieces (and as many of the generation before), what an entry takes besides its text, and the longest text kept.
MEMO_BYTES, ENTRY, LONGEST_KEPT = 48_000_000, 160, 200
PAIRS_KEPT = 500_000


class PrefixCoder:
    """Exact BPE for a rank table whose merged tokens rank above their parts."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: text for text, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._edges: dict[int, tuple[list[tuple[int, float]], list[tuple[int, float]]] | None] = {}
        self._follows: dict[int, bool] = {}

    def _halves(self, text: bytes) -> tuple[bytes, bytes] | None:
        """The two parts that the last merge of this token joins; None if merging never arrives at the token."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 2:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], float("inf")), i) for i in range(len(parts) - 1))
            if rank == float("inf"):
                return None
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def edges(self, rank: int):
        """What stands at the token's left and right edge while it is merged, each with the rank of the merge that ends it."""
        if rank not in self._edges:
            text = self.token[rank]
            if len(text) == 1:
                self._edges[rank] = ([(rank, float("inf"))], [(rank, float("inf"))])
            elif (halves := self._halves(text)) is None or any(self.edges(self.ranks[h]) is None for h in halves):
                self._edges[rank] = None
            else:
                left, right = self.edges(self.ranks[halves[0]])[0], self.edges(self.ranks[halves[1]])[1]
                self._edges[rank] = ([*left[:-1], (left[-1][0], rank), (rank, float("inf"))], [*right[:-1], (right[-1][0], rank), (rank, float("inf"))])
        return self._edges[rank]

    def follows(self, first: int, second: int) -> bool:
        """True if merging first + second keeps the border between them.

        A merge across the border takes place if its rank is below the next merge at the border's left side (the left
        one goes first among equals) and not above the next one at its right side.
        """
        pair = first << 32 | second
        known = self._follows.get(pair)
        if known is None:
            known = True
            for a, a_ends in self.edges(first)[1]:
                for b, b_ends in self.edges(second)[0]:
                    across = self.ranks.get(self.token[a] + self.token[b])
                    if across is not None and across < a_ends and across <= b_ends:
                        known = False
            if len(self._follows) >= PAIRS_KEPT:
                self._follows.clear()
            self._follows[pair] = known
        return known

    def _last(self, text: bytes, end: int, table: list[int]) -> int:
        ranks = self.ranks
        for start in range(max(0, end - self.longest), end):
            rank = ranks.get(text[start:end])
            if rank is not None and self.edges(rank) is not None and (start == 0 or self.follows(table[start], rank)):
                return rank
        raise ValueError("the vocabulary has no token for some byte")

    def fill(self, text: bytes, table: list[int] | None = None) -> list[int]:
        """The table of text: entry i is the last token of its first i bytes. A given table of a shorter prefix is continued."""
        table = [-1] if table is None else list(table)
        for end in range(len(table), len(text) + 1):
            table.append(self._last(text, end, table))
        return table

    def edit(self, text: bytes, table: list[int], start: int, stop: int, put: bytes) -> tuple[bytes, list[int]]:
        """Replace text[start:stop] by put. Behind the edit, entries are taken over once as many as the longest token agree."""
        new = text[:start] + put + text[stop:]
        shift, filled, agree = len(put) - (stop - start), table[: start + 1], 0
        for end in range(start + 1, len(new) + 1):
            if agree >= self.longest:
                return new, filled + table[end - shift :]
            filled.append(self._last(new, end, filled))
            before = end - shift
            # Only a last token that lies wholly behind the edit says that both texts go on alike.
            same = before > stop and filled[end] == table[before] and end - len(self.token[filled[end]]) >= start + len(put)
            agree = agree + 1 if same else 0
        return new, filled

    def read(self, table: list[int], end: int | None = None) -> list[int]:
        """The encoding of the first end bytes."""
        end, ids = len(table) - 1 if end is None else end, []
        while end:
            ids.append(table[end])
            end -= len(self.token[table[end]])
        return ids[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.read(self.fill(piece))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=4)
def coder(path: str) -> PrefixCoder:
    with open(path, "rb") as lines:
        return PrefixCoder({base64.b64decode(text): int(rank) for text, rank in map(bytes.split, lines)})


class _Memo(dict):
    """Ids of a piece, written as decimals with commas. When its bytes run out, only pieces met again since are kept."""

    def __init__(self, own: PrefixCoder):
        super().__init__()
        self.own, self.before, self.held = own, {}, 0

    def __missing__(self, piece: str) -> str:
        ids = self.before.get(piece)
        if ids is None:
            ids = ",".join(map(str, self.own.encode(piece.encode())))
        if len(piece) <= LONGEST_KEPT:
            if self.held >= MEMO_BYTES:
                self.before, self.held = dict(self), 0
                self.clear()
            self.held += 2 * len(piece) + len(ids) + ENTRY
            self[piece] = ids
        return ids


class _Bytes(dict):
    """Bytes of ids written as decimals with commas."""

    def __init__(self, own: PrefixCoder):
        super().__init__()
        self.own, self.held = own, 0

    def __missing__(self, ids: str) -> bytes:
        text = self.own.decode([int(i) for i in ids.split(",")])
        if len(ids) <= LONGEST_KEPT:
            if self.held >= MEMO_BYTES:
                self.clear()
                self.held = 0
            self.held += len(ids) + len(text) + ENTRY
            self[ids] = text
        return text


@lru_cache(maxsize=4)
def _memos(path: str) -> tuple[_Memo, _Bytes]:
    return _Memo(coder(path)), _Bytes(coder(path))


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """keep, n_tokens, ids_sha256, decoded_sha256, and with with_ids the ids themselves. ranks_path: a file that each executor has."""
    fields = [docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, bytes_of = _memos(ranks_path)
        split = regex.compile(pattern).findall
        for batch in batches:
            counts, ids_digests, text_digests, all_ids = [], [], [], array("i")
            for text in batch.column(batch.num_columns - 1):
                ids = list(map(ids_of.__getitem__, split(text.as_py() or "")))
                joined = ",".join(ids)
                counts.append(joined.count(",") + 1 if joined else 0)
                ids_digests.append(hashlib.sha256(joined.encode()).hexdigest())
                text_digests.append(hashlib.sha256(b"".join(map(bytes_of.__getitem__, ids))).hexdigest())
                if with_ids:
                    all_ids.extend(map(int, joined.split(",")) if joined else ())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
            if with_ids:
                ends = pa.array(np.cumsum([0, *counts], dtype=np.int32), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.Array.from_buffers(pa.int32(), len(all_ids), [None, pa.py_buffer(all_ids)])))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    workers_find_library(docs.sparkSession)
    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)
