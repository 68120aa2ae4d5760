"""BPE by a queue of merges against the public library."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n\t ", "The the THE", "it's we'll I'VE x'", "  spaced   out wide  ", "ΣΊΣΥΦΟΣ ΣΑΣ", "İstanbul IŞIK ǅ", "éẹ́ ẞ", "中文字123٣४ 한국어 かな",
    "a<|endoftext|>B <|startoftext|><|startoftext|> <|ENDOFTEXT|>", "<|endoftext|>", "x" * 30000, "ab" * 20000 + "!" * 9000, "😀😀 ok‍\U0001fae9 Ᲊ \U00010d50", "\x00\x1c\x85 \x7f", "a\r\nb\x0bc", "12345 3.14 #tag @x", "The the THE",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
    return ids, (len(ids), *digests)


def test_texts_equal_the_library(spark, library):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n_tokens", "ids", "__text", "word")})
    got = {r["doc_id"]: r for r in word_bpe.encode_texts(docs.union(docs), PATH, with_ids=True).collect()}
    assert len(got) == len(TEXTS) and word_bpe.encode_texts(docs.union(docs), PATH).count() == 2 * len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids, rest = expected(library, text)
        assert list(got[i]["ids"]) == ids and (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == rest, text and text[:50]
    assert word_bpe.encode_texts(docs.where("false"), PATH).collect() == []


def test_random_texts_equal_the_library(library):
    own, rng = word_bpe.coder(PATH), random.Random(3)
    letters = "abcdeinrth' sStT<|>ΣİßÅéẹ̣́中文123٣\t\n\x1c\x85'll're!!..😀Ᲊ"
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40))) + rng.choice(["", "", "<|endoftext|>", "<|startoftext|>x"])
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode_text(text) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False), text


def test_every_agreed_character_counts_as_in_the_library(library):
    own = word_bpe.coder(PATH)
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(0x10000) if re.fullmatch(word_bpe.AGREED, chr(c)) and not 0xD800 <= c < 0xE000]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert own.encode_text(text) == found.ids, hex(ord(text[1]))


def by_rounds(own, word):
    """Merging by definition: the best pair of all, the left one of equals, again and again."""
    at = [own.ids[s] for s in [own.shown[b] for b in word.encode()]]
    at[-1] = own.ids[own.shown[word.encode()[-1]] + own.end]
    while found := [(own.merges[p][0], i) for i, p in enumerate(zip(at, at[1:])) if p in own.merges]:
        i = min(found)[1]
        at[i : i + 2] = [own.merges[at[i], at[i + 1]][1]]
    return at


def test_queue_merges_as_defined():
    own, rng = word_bpe.coder(PATH), random.Random(5)
    for _ in range(1500):
        word = "".join(rng.choice(rng.choice(["ab", "inthe", "abcdefghijklmnopqrstuvwxyz", "éü"])) for _ in range(rng.randrange(1, 40)))
        assert own.encode(word) == by_rounds(own, word)


def test_memos_stay_bounded(monkeypatch):
    monkeypatch.setattr(word_bpe, "MEMO_BYTES", 5000)
    memo = word_bpe._Memo(lambda text: text[::-1])
    for i in range(1000):
        assert memo[f"w{i}"] == f"w{i}"[::-1] and memo["again"] == "niaga"
    assert len(memo) + len(memo.before) < 100 and memo["x" * 500] == "x" * 500 and "x" * 500 not in memo
