"""BPE of words with a word-end mark, merged by a queue of merge ranks.

A text is cut at the special tokens that stand in it; what lies between is brought to NFC and lower case and split into
words. A word's symbols form a doubly linked list. A heap holds every mergeable neighbouring pair as (rank, place); the
best one is merged into its left symbol, its right neighbour leaves the list, and the two pairs that the merge makes are
pushed. A heap entry is stale, and skipped, once its place holds another pair than the one it was pushed for. So a word
of n symbols takes n log n steps, whatever its length. Ids are decoded by putting their vocabulary strings together.

Words are found by regular expressions in texts of characters whose classes every version of Unicode agrees on (AGREED);
the few other texts are split by the vocabulary file's own normalizer and splitter, so that newly coded letters count as
they do there.

Spark deals the rows; a task streams Arrow batches and remembers a bounded number of bytes of short words.

Defined results: null text counts as empty (no tokens, digests of nothing); very long texts and words are encoded whole;
equal ranks merge from the left; repeated rows are encoded row by row; an empty table gives an empty table; extra columns
of any name are ignored, those in keep are passed on. Lone surrogates, which no text column of Spark can hold, are not
catered for.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import workers_find_library

#: Bytes of a worker's memo of words (and as many of the generation before), what an entry takes besides its text, and the longest text kept.
MEMO_BYTES, ENTRY, LONGEST_KEPT = 48_000_000, 160, 200

#: Characters that all versions of Unicode treat alike: Latin, Greek, Cyrillic, punctuation, currencies, kana, Han, Hangul, wide forms.
AGREED = r"[\x00-\u052f\u2000-\u2063\u20a0-\u20bf\u3000-\u303e\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uffbe]*"

#: The one shape of vocabulary file that this module reads: its fixed settings.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_MODEL = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}


def _shown_bytes() -> list[str]:
    """The printable character that stands for each byte: itself where Latin-1 prints it, else the next one from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class QueueCoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        assert spec["normalizer"]["normalizers"] == _NORMALIZER and all(model[k] == v for k, v in _MODEL.items()) and spec["decoder"] is None, "another kind of vocabulary"
        self.ids: dict[str, int] = model["vocab"]
        self.token = {i: t for t, i in self.ids.items()}
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        self._agreed = re.compile(AGREED).fullmatch
        self._path, self._splitter, self._byte = path, None, {c: b for b, c in enumerate(_shown_bytes())}
        self.end, self.shown = model["end_of_word_suffix"], _shown_bytes()
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        pattern = split["pattern"]["Regex"]
        self._words = regex.compile(pattern).findall
        self._plain_words = re.compile(pattern.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"[^\s\p{L}\p{N}]", "[^ \t-\ra-z0-9]")).findall

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens. White space is in no word, so its runs need no replacing."""
        if text.isascii():
            return self._plain_words(text.lower())
        if not self._agreed(text):
            return self._split_by_file(text)
        # Letters are lowered one by one: a capital sigma at the end of a word gives the common small one.
        return self._words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _split_by_file(self, text: str) -> list[str]:
        if self._splitter is None:
            from tokenizers import Tokenizer

            self._splitter = Tokenizer.from_file(self._path)
        shown = self._splitter.pre_tokenizer.pre_tokenize_str(self._splitter.normalizer.normalize_str(text))
        return [bytes(map(self._byte.__getitem__, word)).decode() for word, _ in shown]

    def encode(self, word: str) -> list[int]:
        """Ids of one word."""
        shown, ids, merges = self.shown, self.ids, self.merges
        symbols = [shown[b] for b in word.encode()]
        symbols[-1] += self.end
        at = [ids[s] for s in symbols]
        n = len(at)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(*found, i) for i in range(n - 1) if (found := merges.get((at[i], at[i + 1])))]
        queue = [(rank, i, into) for rank, into, i in queue]
        heapify(queue)
        while queue:
            rank, i, into = heappop(queue)
            j = after[i]
            if at[i] < 0 or j >= n or merges.get((at[i], at[j])) != (rank, into):
                continue  # stale: one of the two symbols has been merged meanwhile
            at[i], at[j] = into, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((into, at[k])):
                    heappush(queue, (found[0], i, found[1]))
            h = before[i]
            if h >= 0 and (found := merges.get((at[h], into))):
                heappush(queue, (found[0], h, found[1]))
        return [x for x in at if x >= 0]

    def encode_text(self, text: str) -> list[int]:
        found = []
        for i, part in enumerate(self.split_special(text)):
            found += [self.special[part]] if i % 2 else [x for w in self.words(part) for x in self.encode(w)]
        return found

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(path: str) -> QueueCoder:
    return QueueCoder(path)


class _Memo(dict):
    """What a function gives for short texts. When the bytes run out, only texts met again since are kept."""

    def __init__(self, of: Callable[[str], str]):
        super().__init__()
        self.of, self.before, self.held = of, {}, 0

    def __missing__(self, text: str) -> str:
        out = self.before.get(text)
        if out is None:
            out = self.of(text)
        if len(text) <= LONGEST_KEPT:
            if self.held >= MEMO_BYTES:
                self.before, self.held = dict(self), 0
                self.clear()
            self.held += len(text) + len(out) + ENTRY
            self[text] = out
        return out


@lru_cache(maxsize=2)
def _memos(path: str) -> tuple[_Memo, _Memo]:
    """Word to its ids, and such ids to their strings; ids are written as decimals with spaces."""
    own = coder(path)
    return _Memo(lambda word: " ".join(map(str, own.encode(word)))), _Memo(lambda ids: own.decode([int(i) for i in ids.split(" ")]))


def encode_texts(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """keep, n_tokens, ids_sha256, decoded_sha256, and with with_ids the ids themselves. vocabulary: a file that each executor has."""
    fields = [docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (ids_of, strings_of) = coder(vocabulary), _memos(vocabulary)
        for batch in batches:
            counts, ids_digests, text_digests, all_ids = [], [], [], []
            for text in batch.column(batch.num_columns - 1):
                ids = []
                for i, part in enumerate(own.split_special(text.as_py() or "")):
                    ids += [str(own.special[part])] if i % 2 else map(ids_of.__getitem__, own.words(part))
                joined = " ".join(ids)
                counts.append(joined.count(" ") + 1 if joined else 0)
                ids_digests.append(hashlib.sha256(joined.encode()).hexdigest())
                text_digests.append(hashlib.sha256(" ".join(map(strings_of.__getitem__, ids)).encode()).hexdigest())
                if with_ids:
                    all_ids.append([int(x) for x in joined.split(" ")] if joined else [])
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    workers_find_library(docs.sparkSession)
    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)
