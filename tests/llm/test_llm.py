"""The text operators against brute force on small tables, and the cases each docstring defines."""

import base64
import collections
import hashlib
import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat_format, components, decontaminate, license_scan, line_dedup, minhash_forest, pii_surrogates, quality_rank, risk_rules, toxicity

EXTRA = {"row": 1, "seed": "s", "label": 0, "score": 0.5, "words": "w", "line": "l", "kind": "k", "node": 3, "quality": 1, "toxic": 1, "n_words": 9, "component": 2}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(n, seed, size=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def odd_texts():
    base = words(60, 1)
    near = base[:30] + ["changed"] + base[31:]
    return [" ".join(base), " ".join(near), None, "", " \n\t ", "one two", "one two", "x" * 5000, " ".join(words(6000, 2)), "\n".join([" ".join(base)] * 3), "Ünï cödé 中文 😀 K MİT license", "a\r\nb\x0bc"]


@pytest.fixture(scope="module")
def odd(spark):
    docs = docs_of(spark, odd_texts())
    repeated = docs.where("doc_id in (0, 5)")
    without_id = docs.where("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long"))
    return docs.union(repeated).union(without_id).withColumns({c: F.lit(v) for c, v in EXTRA.items()})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


LABELS = "doc_id long, quality long, toxic long"


def test_odd_rows_and_empty_tables(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (None, 1, 1), (5, None, None), (0, 1, 0), (8, 1, 0), (9, 0, 1)], LABELS)
    none = spark.createDataFrame([], LABELS)
    items = spark.createDataFrame([(1, " ".join(words(60, 1)[:20])), (2, None), (None, "a b")], "item_id long, text string")
    n = odd.count()
    runs = [
        lambda d, la: toxicity.score(d, la, most_toxic=5, most_clean=5), lambda d, la: toxicity.kept(d, la), lambda d, la: line_dedup.report(d), lambda d, la: line_dedup.deduplicated(d), lambda d, la: license_scan.scan(d),
        lambda d, la: quality_rank.score(d, la), lambda d, la: minhash_forest.groups(d), lambda d, la: decontaminate.report(d, items), lambda d, la: decontaminate.clean(d, items), lambda d, la: risk_rules.judge(d, la), lambda d, la: pii_surrogates.replace(d, "k"),
    ]
    for i, run in enumerate(runs):
        got = run(odd, labels).count()
        assert got == n if i not in (1, 3, 8) else 0 < got <= n, i
        assert run(empty, none).count() == 0, i


def test_toxicity_learns_words_and_scores_whole_texts(spark):
    bad = ["scumword", "trashword", "idiotword"]
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(400):
        w = words(rng.randint(20, 120), i)
        if i % 4 == 0:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        texts.append(" ".join(w))
        labels.append((i, 1, int(i % 4 == 0)))
    docs, known = docs_of(spark, texts), spark.createDataFrame(labels, LABELS)
    got = toxicity.score(docs, known).toPandas().set_index("doc_id")
    held = got[got.held_out]
    assert 50 < len(held) < 150
    truth = np.array([i % 4 == 0 for i in held.index])
    assert (held.predicted.to_numpy()[truth] == 1).mean() > 0.9 and (held.predicted.to_numpy()[~truth] == 0).mean() > 0.9
    net = toxicity.fit(texts, np.array([i % 4 == 0 for i in range(400)]))
    import pyarrow as pa

    late = " ".join(words(5000, 9) + bad * 2)
    clean, dirty, gone, space = net.score(pa.array([" ".join(words(5000, 9)), late, None, " "]))
    assert dirty > 0.9 > 0.5 > clean and gone == space == 0


def test_windows_cover_every_word():
    for n in (1, 31, 32, 33, 56, 57, 500):
        w, of = toxicity.windows_of(np.array([n, 0, 3]))
        assert set(w[of == 0].ravel()) - {0} == set(range(1, n + 1)) and not (of == 1).any()


def test_network_gradient():
    net = toxicity.Network(np.array([1, 2, 3], np.uint64), 2)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    grams, ends = np.array([1, 2, 3, 4, 5, 6, 7]), np.array([2, 5, 7])
    windows = np.zeros((2, toxicity.WINDOW), int)
    windows[0, :3], windows[1, :2] = [1, 2, 3], [3, 1]
    wanted = np.array([1.0, 0.0])
    first = np.concatenate(([0], ends[:-1]))

    def loss():
        logit = net.logits(net.gates(net.inputs(np.array([0, 1, 3]), grams, first, ends)), windows)
        return float(np.mean(np.log1p(np.exp(-logit.astype(float) * np.where(wanted > 0, 1, -1)))))

    g = net.step(np.array([0, 1, 3]), (grams, ends), windows, wanted)
    for name, at in (("word", (1, 2)), ("gram", (4, 1)), ("into", (1, 3, 5)), ("back", (0, 2, 20)), ("bias", (1, 0, 3)), ("look", (4, 2)), ("weigh", (3,)), ("out", (9,)), ("shift", (0,))):
        net.w[name][at] += 1e-2
        up = loss()
        net.w[name][at] -= 2e-2
        down = loss()
        net.w[name][at] += 1e-2
        assert g[name][at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-5), name


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(7)
    lines = [" ".join(words(rng.randint(1, 25), i, 60)) for i in range(60)]
    texts = []
    for _ in range(40):
        own = []
        for line in rng.choices(lines, k=6):
            w = line.split(" ")
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = f"w{rng.randrange(60)}"
            own.append(" ".join(w))
        texts.append("\n".join([*own, ""]))
    got = {r["doc_id"]: r["removed"] for r in line_dedup.report(docs_of(spark, texts)).collect()}
    seen, want = [], {}
    for d, text in enumerate(texts):
        want[d] = []
        for i, line in enumerate(text.split("\n")):
            s = frozenset(line.split(" ")) - {""}
            if s:
                if any(10 * len(s & t) >= 9 * len(s | t) for t in seen):
                    want[d].append(i)
                seen.append(s)
    assert got == {d: ",".join(map(str, x)) for d, x in want.items()}
    kept = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(docs_of(spark, texts)).collect()}
    for d, text in enumerate(texts):
        left = [line for i, line in enumerate(text.split("\n")) if i not in want[d]]
        assert kept.get(d) == ("\n".join(left) if any(x.strip() for x in left) else None)


def test_licence_places_against_brute_force(spark):
    texts = ["GNU General Public License gnu general public license", "mit license MIT-License", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0 is not licensed under cc by", "mMIT license", None, "the MİT License", "K mit licence", "license " * 3000 + "released under the mit license"]
    got = {r["doc_id"]: r for r in license_scan.scan(docs_of(spark, texts)).collect()}
    phrases = [(p.split(), label) for p, label in license_scan.BASE]
    for d, text in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER)))
        at = [(i, label) for p, label in phrases for i in range(len(w)) if w[i : i + len(p)] == p]
        r = got[d]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(at), ",".join(sorted({label for _, label in at})))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
    assert got[2]["labels"] == "apache,apache-2.0" and got[2]["score"] == 1.0 and got[8]["labels"] == "mit,mit-named" and got[4]["labels"] == ""


def vocabulary():
    tokens = [bytes([i]) for i in range(256)] + [b"th", b"in", b"the", b"ing", b" t", b" the", b"aa", b"aaa", b"aaaa", b"ab", b"bc", b"abc"]
    return {t: i for i, t in enumerate(tokens)}


def plain_bpe(ranks, piece):
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        best = min(((ranks.get(a + b, math.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(math.inf, 0))
        if best[0] == math.inf:
            return [ranks[p] for p in parts]
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_prefix_table_is_exact_for_appends_and_edits():
    coder, rng = bpe.PrefixCoder(vocabulary()), random.Random(3)
    for _ in range(400):
        text = bytes(rng.choice(b"abc the ing") for _ in range(rng.randint(1, 40)))
        assert coder.encode(text) == plain_bpe(coder.ranks, text) and coder.decode(coder.encode(text)) == text
        table = coder.fill(text)
        assert coder.fill(text + b"thing", table) == coder.fill(text + b"thing")
        a = rng.randint(0, len(text))
        b = rng.randint(a, min(len(text), a + 4))
        new, edited = coder.edit(text, table, a, b, rng.choice([b"", b"aa", b"the"]))
        assert edited == coder.fill(new)


def test_bpe_agrees_with_tiktoken(spark):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    want = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts()
    got = bpe.encode_texts(docs_of(spark, texts), path, public.PATTERN, with_ids=True).collect()
    for r in got:
        text = texts[r["doc_id"]] or ""
        ids = want.encode_ordinary(text)
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    bare = bpe.encode_texts(docs_of(spark, [None, ""]), path, public.PATTERN, with_ids=True).collect()
    assert [(r["ids"], r["n_tokens"]) for r in bare] == [([], 0)] * 2


def test_quality_ranks_unseen_documents(spark):
    texts = [" ".join(words(80, i)) + "." if i % 3 else " ".join(w.upper() + "!!" for w in words(60, i)) for i in range(300)]
    known = spark.createDataFrame([(i, int(bool(i % 3)), 0) for i in range(300)], LABELS)
    got = quality_rank.score(docs_of(spark, texts), known).toPandas().set_index("doc_id")
    held = got[got.held_out]
    assert len(held) > 50 and all(held.predicted[i] == int(bool(i % 3)) for i in held.index) and got.score.between(0, 1).all()


def shingles(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER)))
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def test_near_copies_against_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", "one two", "ONE two", "one two three"]
    for g in range(12):
        base = words(rng.randint(20, 150), g, 5000)
        for _ in range(rng.choice([1, 2, 8])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"z{rng.random()}"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r["doc_id"]: r for r in minhash_forest.groups(docs_of(spark, texts)).collect()}
    for d in range(len(texts)):
        assert (got[d]["n_shingles"], got[d]["component_id"], got[d]["kept"]) == (len(sets[d]), find(d), find(d) == d)


def test_near_copies_of_dense_groups(spark):
    """Stars, trees and two-level groups of variants, whose links the forest alone does not all find."""
    rng = random.Random(12)
    family = []

    def variant(of, group):
        w = list(of)
        for at in rng.sample(range(len(w)), 2):
            w[at] = f"z{rng.random()}"
        family.append((group, w))
        return w

    star, tree, hub = words(140, 31, 9000), [words(140, 32, 9000)], words(140, 33, 9000)
    for _ in range(1000):
        variant(star, "star")
        tree.append(variant(rng.choice(tree), "tree"))
    middle = [variant(hub, "two") for _ in range(30)]
    for _ in range(1000):
        variant(rng.choice(middle), "two")
    family += [("star", star), ("tree", tree[0]), ("two", hub)]
    rng.shuffle(family)
    # Brute force over all pairs of a group.
    want = {}
    for group in ("star", "tree", "two"):
        ids = [d for d, (g, _) in enumerate(family) if g == group]
        sets = [shingles(" ".join(family[d][1])) for d in ids]
        number = {x: i for i, x in enumerate(set().union(*sets))}
        table = np.zeros((len(ids), len(number)), np.float32)
        for i, s in enumerate(sets):
            table[i, [number[x] for x in s]] = 1
        common, size = table @ table.T, table.sum(axis=1)
        near = 100 * common >= 85 * (size[:, None] + size - common)
        least = np.arange(len(ids))
        while True:
            lower = np.where(near, least, len(ids)).min(axis=1)
            if (lower == least).all():
                break
            least = lower
        want |= {d: ids[x] for d, x in zip(ids, least.tolist(), strict=True)}
    got = {r["doc_id"]: r["component_id"] for r in minhash_forest.groups(docs_of(spark, [" ".join(w) for _, w in family])).collect()}
    assert got == want


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(500, 499), (499, 499)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 131), 100), 499: 499, 500: 499}


def test_decontamination_tolerates_substitutions(spark):
    item = words(30, 77, 3000)
    swapped = list(item)
    swapped[13] = "other"
    texts = [" ".join(words(50, 1, 3000) + item + words(50, 2, 3000)), " ".join(words(20, 3, 3000) + swapped), " ".join(words(200, 4, 3000)), " ".join(item[:11]), ", ".join(item).upper(), None]
    items = spark.createDataFrame([(5, " ".join(item)), (6, "too short"), (7, " ".join(item[:20]))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.report(docs_of(spark, texts), items).collect()}
    assert [got[d]["contaminated"] for d in range(6)] == [True, True, False, False, True, False]
    assert (got[0]["items"], got[0]["best_score"], got[1]["best_words"], got[1]["best_score"]) == ("5,7", 30, 29, 26)
    assert {r["doc_id"] for r in decontaminate.clean(docs_of(spark, texts), items).collect()} == {2, 3, 5}


def test_masks_find_each_single_substitution(spark):
    item = words(24, 5, 3000)
    texts = [" ".join([*item[:i], "zz", *item[i + 1 :]]) for i in range(24)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert decontaminate.report(docs_of(spark, texts), items).where("contaminated").count() == 24


def test_chat_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <|end|> b"), (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (3, 0, "system", "s"), (4, 1, None, None), (4, 0, "user", "u"), (None, 0, "user", "x")]
    pairs = chat_format.against_neighbours(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").withColumns({"prompt": F.lit(1), "chosen": F.lit(2)}))
    got = {r["conv_id"]: r for r in chat_format.format_pairs(pairs, "conv_id").collect()}
    assert sorted(got) == [1, 2, 3, 4]
    one = got[2]
    assert one["n_common"] == 1 and one["prompt"] == "<|user|>\nhi<|end|>\n" and one["chosen"] == "<|assistant|>\nother<|end|>\n"
    for r in got.values():
        for side in ("chosen", "rejected"):
            for s in r[f"{side}_spans"]:
                assert r[side][: s["start"]].endswith("<|assistant|>\n") and r[side][s["stop"] :].startswith("<|end|>\n")
    assert got[1]["chosen"] == "<|assistant|>\na <\\|end|> b<|end|>\n" and got[3]["chosen"] == "" and got[4]["n_common"] == 2


def exact_tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 5, 50, 700, 1000) for k in (0, 1, 3, 9) if k < n * 0.01 or k == 0]
    rows = spark.createDataFrame(cases, "k long, n long").select("k", "n", risk_rules.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p")).collect()
    for r in rows:
        assert r["p"] == pytest.approx(exact_tail(r["k"], r["n"], 0.01), rel=1e-9)


def test_cutoffs_keep_their_promise(spark):
    rng = random.Random(1)
    texts = [" ".join(words(40, i)) + (" #" * rng.randint(10, 90) if i % 5 == 0 else "") for i in range(3000)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(3000)], LABELS)
    got = risk_rules.judge(docs_of(spark, texts), labels, alpha=0.05).toPandas().set_index("doc_id")
    good = [i for i in range(3000) if i % 5]
    assert got.kept[good].mean() > 0.95 and got.kept[[i for i in range(3000) if i % 5 == 0]].mean() < 0.3
    few = risk_rules.judge(docs_of(spark, texts[:50]), labels.where("doc_id < 50"), alpha=0.05)
    assert few.where("size(rejected_by) > 0").count() == 0


def test_repeated_words_against_brute_force(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(60)] + odd_texts()
    got = {r["doc_id"]: r for r in risk_rules.statistics(docs_of(spark, texts), "doc_id").collect()}
    for d, text in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {i + j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(8)}
        assert (got[d]["n_words"], got[d]["n_repeat_words"], got[d]["word_chars"]) == (len(w), len(covered), sum(map(len, w)))


def test_surrogates_are_distinct_consistent_and_alike(spark):
    texts = ["mail Ann.Lee7@Site3.example.com or ann.lee7@site3.example.com", "call +1 (743) 555-3824, +17435553824", "card 4111 1111 1111 1111 and 4111111111111111.", "ip 10.1.2.3. token 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "Mrs. Smith met Mr Smith; Госпожа Иванова", None, "nothing"]
    texts += [f"host 10.0.{i // 250}.{i % 250}" for i in range(600)]
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: r for r in pii_surrogates.replace(docs, "key").collect()}
    for d in range(5):
        assert not any(m in got[d]["text"] for m in re.findall(r"[\w.]+@[\w.]+|\d[\d ().-]{8,}\d|[0-9a-f]{40}", texts[d]))
    a, b = re.findall(r"\S+@\S+", got[0]["text"])
    assert a.lower() == b and b.endswith(".com") and a[0].isupper() and a[4].isupper()
    x, y = re.findall(r"\+1[^,]+", got[1]["text"])
    assert re.sub(r"\D", "", x) == re.sub(r"\D", "", y) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", x)
    p, q = re.findall(r"\d[\d ]{14,}\d", got[2]["text"])
    digits = [int(c) for c in p.replace(" ", "")]
    assert p.replace(" ", "") == q and sum(sum(divmod(2 * c, 10)) if i % 2 == 0 else c for i, c in enumerate(digits)) % 10 == 0
    assert re.match(r"Mrs\. ([A-Z]\w+) met Mr \1; Госпожа [А-Я]\w+а$", got[4]["text"])
    hosts = [got[d]["text"] for d in range(7, len(texts))]
    assert len(set(hosts)) == 600 and not set(hosts) & set(texts)
    assert (got[5]["text"], got[6]["text"], got[6]["n_entities"]) == (None, "nothing", 0)
    other = {r["doc_id"]: r["text"] for r in pii_surrogates.replace(docs, "another").collect()}
    assert other[0] != got[0]["text"]
    assert {r["doc_id"]: r["text"] for r in pii_surrogates.replace(docs, "key").collect()} == {d: r["text"] for d, r in got.items()}


def test_colliding_surrogates_are_drawn_again(spark, monkeypatch):
    narrow = lambda kind, entity, turn, secret: F.concat(F.lit("s"), F.pmod(F.xxhash64(entity, turn), F.lit(40)).cast("string"))
    monkeypatch.setattr(pii_surrogates, "surrogate", narrow)
    names = spark.createDataFrame([("ip", f"e{i}") for i in range(15)] + [("ip", f"s{i}") for i in range(5)], "kind string, entity string")
    got = pii_surrogates.assigned(names, "k").collect()
    shown = [r["surrogate"] for r in got]
    assert len(got) == 20 == len(set(shown)) and not set(shown) & {r["entity"] for r in got}


def test_pipeline_keeps_columns_and_catches_planted_rows(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    item = words(30, 900, 3000)
    texts = ["\n".join(" ".join(words(20, 10 * i + k, 3000)) for k in range(4)) for i in range(40)]
    texts += [texts[0], " ".join(words(20, 500, 3000) + item), None, ""]
    docs_of(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = {r["doc_id"]: r for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {*range(40), 42, 43}
    assert got[42]["n_tokens"] == 0 and all(got[i]["decoded_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest() for i in range(40))


def test_quality_cutoff_keeps_the_true_share_of_labels(spark):
    texts = [" ".join(words(40, i)) + "!" * (i % 7) for i in range(600)]
    known = spark.createDataFrame([(i, int(random.Random(i).random() < 0.85), 0) for i in range(600)], LABELS)
    got = quality_rank.score(docs_of(spark, texts), known, most_labelled=50).toPandas()
    assert abs(got.predicted.mean() - 0.85) < 0.12
    values = np.random.default_rng(1).random(31)
    assert abs(quality_rank.weighted_quantile(values, np.ones(31), 0.2) - np.quantile(values, 0.2)) < 1e-12


def test_a_file_with_many_licences_keeps_all(spark):
    chosen = ["bsd", "isc", "mpl-2.0", "mit-grant", "apache-2.0", "unlicense", "lgpl"]
    text = "\n\n".join(t.text + " filler words between" for t in license_scan.TEMPLATES if t.label in chosen)
    got = {r["doc_id"]: r["labels"].split(",") for r in license_scan.scan(docs_of(spark, [text, "nothing of that kind"])).collect()}
    assert set(chosen) <= set(got[0]) and got[1] == [""]


def test_upper_case_secrets_go_and_names_do_not_run_out(spark, monkeypatch):
    secret = "9233A8EC" * 4 + "0123ABCD"
    texts = [f'TOKEN = "{secret}"', f"again {secret}", f"lower {secret.lower()}"]
    got = {r["doc_id"]: r["text"] for r in pii_surrogates.replace(docs_of(spark, texts), "k").collect()}
    shown = re.fullmatch(r'TOKEN = "([0-9A-F]{40})"', got[0]).group(1)
    assert shown != secret and got[1] == f"again {shown}" and re.fullmatch(r"lower [0-9a-f]{40}", got[2]) and secret.lower() not in got[2]
    monkeypatch.setattr(pii_surrogates, "LATIN", ("al", "be") * 8)
    monkeypatch.setattr(pii_surrogates, "ROUNDS", 12)
    names = [f"Mr. {a}{b}ston" for a in "BCDFGHKL" for b in "aeiouy"]
    got = [r["text"] for r in pii_surrogates.replace(docs_of(spark, names), "k").collect()]
    assert len(set(got)) == len(names) and not set(got) & set(names)


def test_pipeline_drops_near_copies_from_four_fifths_on(spark):
    import corpus_pipeline

    base = words(120, 41, 9000)
    near, far = list(base), list(base)
    near[30], near[80] = "other", "another"  # 106 of 126 shingles: 0.84
    far[20], far[60], far[100] = "x", "y", "z"  # 101 of 131: 0.77
    assert 0.80 <= len(shingles(" ".join(base)) & shingles(" ".join(near))) / len(shingles(" ".join(base)) | shingles(" ".join(near))) < 0.85
    left = corpus_pipeline.drop_near_copies(spark, docs_of(spark, [" ".join(base), " ".join(near), " ".join(far)]), "")
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 2]


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert json.dumps(sorted(entry.oracle_sql()))
