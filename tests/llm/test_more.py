"""Brute force for what SQL cannot express, and odd rows with their values."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from test_llm import DOCS, LABELS, docs_of, odd_texts, words
from tidemark.llm import bpe, chat_format, decontaminate, license_scan, line_dedup, minhash_forest, pii_surrogates, quality_rank, risk_rules, store, toxicity

CLASH = {"row": 1, "gone": 2, "ROW_": 3, "__row": 4, "__gone": 5, "key": 6, "found": 7, "shown": 8, "place": 9, "words": 10, "c": 11, "n": 12, "at": 13, "__label": 14, "seed": 15, "item": 16}


@pytest.fixture(scope="module")
def clashing(spark):
    docs = docs_of(spark, odd_texts())
    return docs.union(docs.where("doc_id in (0, 5)")).withColumns({c: F.lit(v) for c, v in CLASH.items()})


def test_windows_score_one_by_one(spark):
    """The score of a text is that of its worst window, each window read alone; repeated words are read."""
    rng = random.Random(3)
    texts = [" ".join(words(rng.randint(1, 90), i, 50)) + (" bad" * rng.randint(0, 3)) for i in range(60)] + ["bad bad bad bad", "", None]
    net = toxicity.fit(texts[:60], np.array(["bad" in t for t in texts[:60]]), rounds=2, least_texts=2)
    got = net.score(pa.array(texts, pa.string()))
    for text, score in zip(texts, got, strict=True):
        w = (text or "").split()
        starts = sorted({min(s, max(0, len(w) - toxicity.WINDOW)) for s in range(0, max(1, len(w) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)})
        naive = max((float(net.score(pa.array([" ".join(w[s : s + toxicity.WINDOW])]))[0]) for s in starts if w), default=0.0)
        assert score == pytest.approx(naive, abs=1e-5)
    # Every passage of WINDOW - STRIDE + 1 words lies in one window.
    place, _ = toxicity.windows_of(np.array([500]))
    inside = [{*row} - {0} for row in place.tolist()]
    assert all(any(set(range(a, a + toxicity.WINDOW - toxicity.STRIDE + 1)) <= x for x in inside) for a in range(1, 500 - toxicity.WINDOW))


def test_pair_ranking_against_a_plain_fit():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, quality_rank.N_FEATURES))
    good = x[:, 0] + 0.5 * x[:, 3] + rng.normal(size=60) * 0.3 > -0.5
    model = quality_rank.fit(x, good, rounds=300)
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6)
    plain, pairs = np.zeros(x.shape[1]), [(a, b) for a in np.flatnonzero(good) for b in np.flatnonzero(~good)]
    for _ in range(300):
        step = np.zeros_like(plain)
        for a, b in pairs:
            d = z[a] - z[b]
            step += d / (1 + np.exp(d @ plain)) / len(pairs)
        plain += step - 1e-3 * plain
    won = lambda w: np.mean([(z[a] - z[b]) @ w > 0 for a, b in pairs])
    assert won(model.weights) > won(plain) - 0.02 and np.corrcoef(model.weights, plain)[0, 1] > 0.9
    assert abs((model.score(x) >= 0.5).mean() - good.mean()) < 0.05


def naive_stretch(doc, item, shift):
    best = (0, 0)
    now = run = 0
    for i, w in enumerate(item):
        if 0 <= shift + i < len(doc):
            same = doc[shift + i] == w
            now = max(0, now + (1 if same else -decontaminate.MISMATCH))
            run = run + same if now > 0 else 0
            if now > best[0]:
                best = (now, run)
    return best


def test_decontamination_against_brute_force(spark):
    rng = random.Random(8)
    items = [words(rng.randint(5, 40), 100 + i, 300) for i in range(6)]
    texts = []
    for d in range(50):
        w = words(rng.randint(0, 60), d, 300)
        for _ in range(rng.randint(0, 2)):
            part = list(rng.choice(items))
            for _ in range(rng.randint(0, 5)):
                part[rng.randrange(len(part))] = "zz"
            at = rng.randint(0, len(w))
            w[at:at] = part[rng.randint(0, 5) :]
        texts.append(" ".join(w))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    want = {}
    for d, text in enumerate(texts):
        doc = text.split()
        for i, item in enumerate(items):
            shifts = {a - b for a in range(len(doc) - decontaminate.SPAN + 1) for b in range(len(item) - decontaminate.SPAN + 1) if any(all(doc[a + o] == item[b + o] for o in mask) for mask in decontaminate.MASKS)}
            score = max((naive_stretch(doc, item, s) for s in shifts), default=(0, 0))
            if score[0] >= decontaminate.SCORE:
                want.setdefault(d, {})[i] = score
    for most in (store.MOST_KEYS, 0):  # broadcast, and dealt by a salt
        decontaminate.MOST_KEYS, before = most, decontaminate.MOST_KEYS
        try:
            got = {r["doc_id"]: r for r in decontaminate.report(docs_of(spark, texts), bench).collect()}
        finally:
            decontaminate.MOST_KEYS = before
        for d in range(len(texts)):
            found = want.get(d, {})
            assert got[d]["items"] == ",".join(map(str, sorted(found))) and (got[d]["best_score"], got[d]["best_words"]) == max(found.values(), default=(0, 0))


def test_every_mention_and_nothing_else_is_replaced(spark):
    rng = random.Random(4)
    parts = ["plain words here", "Ann.Lee@site.example.com", "+49 30 1234567", "4111 1111 1111 1111", "10.20.30.40", "123-45-6789", "Mrs. Anna Keller", "Mr Keller", "Herr Jörg Maier", "Госпожа Иванова", "AKIA" + "A1B2" * 4, "no 12 numbers 7", "x@y", "Mrs"]
    texts = [" ; ".join(rng.choices(parts, k=rng.randint(1, 8))) for _ in range(80)]
    got = {r["doc_id"]: r for r in pii_surrogates.replace(docs_of(spark, texts), "k").collect()}
    pattern = regex.compile(pii_surrogates.ANY)
    shown = {}
    for d, text in enumerate(texts):
        found = list(pattern.finditer(text))
        assert got[d]["n_entities"] == len(found)
        rest, at = got[d]["text"], 0
        for i, m in enumerate(found):
            before = text[at : m.start()]
            assert rest.startswith(before)
            rest, at = rest[len(before) :], m.end()
            after = text[at : found[i + 1].start()] if i + 1 < len(found) else text[at:]
            stand_in = rest[: rest.index(after)] if after else rest
            assert stand_in != m.group() and shown.setdefault(m.group(), stand_in) == stand_in
            rest = rest[len(stand_in) :]
        assert rest == text[at:]
    assert len(set(shown.values())) == len(shown)
    # A surname that two mentions share stays shared; titles stay.
    assert shown["Mrs. Anna Keller"].split()[-1] == shown["Mr Keller"].split()[-1] and shown["Mrs. Anna Keller"].startswith("Mrs. ")


def test_many_names_stay_distinct(spark):
    letters = "bcdfghjklmnprstvwz"
    names = [f"{a}{v}{b}{u}{c}" for a in letters for v in "aeiou" for b in letters for u in "ae" for c in letters][:25_000]
    entities = spark.createDataFrame([(pii_surrogates.WORD_KINDS[i % 2], n) for i, n in enumerate(names)], "kind string, entity string")
    made = pii_surrogates.assigned(entities, "k")
    real = made.select(F.col("entity").alias("surrogate"))
    assert made.count() == len(names) == made.select("surrogate").distinct().count() and made.join(real, "surrogate").count() == 0


def test_words_of_names_are_the_same_person_everywhere(spark):
    texts = ["Mrs Anna Keller", "Mr Keller", "Mrs Anna", "MRS ANNA KELLER", "Dr. ANNA KELLER", "Frau Keller-Anna", "Herr Jonas von der Keller", "Mr Jonas", "Ms Ingrid Holm", "Ms Holm", "Mr Robin Holm", "Mrs Robin Keller"]
    got = {texts[r["doc_id"]]: r["text"] for r in pii_surrogates.replace(docs_of(spark, texts), "k").collect()}
    anna, keller = got["Mrs Anna Keller"].split()[1:]
    assert got["Mr Keller"] == f"Mr {keller}" and got["Mrs Anna"] == f"Mrs {anna}" and got["MRS ANNA KELLER"] == "MRS ANNA KELLER"  # MRS is no title
    assert got["Dr. ANNA KELLER"] == f"Dr. {anna.upper()} {keller.upper()}" and got["Frau Keller-Anna"] == f"Frau {keller}-{anna}"
    jonas = got["Mr Jonas"].split()[1]
    assert got["Herr Jonas von der Keller"] == f"Herr {jonas} von der {keller}"
    # Female endings: by the word's own, or by its use as a given name behind female titles only.
    assert anna.endswith("a") and got["Ms Ingrid Holm"].split()[1].endswith("a") and not any(w.endswith("a") for w in (keller, jonas, got["Ms Holm"].split()[1], got["Mr Robin Holm"].split()[1]))
    assert len({anna, keller, jonas, *got["Ms Ingrid Holm"].split()[1:], got["Mr Robin Holm"].split()[1]}) == 6


def test_forms_that_were_written_by_hand_are_found(spark):
    """Recall on forms that are not made from the patterns: no real value is left, and what surrounds it is."""
    forms = [
        "Mr McDonald", "Mr. O'Neil", "Mr JOHN SMITH", "Dr Smith", "Prof. D’Angelo", "Mme Lefèvre-Dubois", "Señora María García López", "Herr Müller", "Госпожа Иванова", "Miss van der", "(555) 123-4567", "555-123-4567", "+49 30 1234567", "+1 (212) 555 0199",
        "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "FR14 2004 1010 0505 0001 3M02 606", "3782 822463 10005", "371449635398431", "4111 1111 1111 1111", "5500-0000-0000-0004", "123-45-6789", "jane.o'doe+tag@mail.example.co.uk", "a_b@x.io", "192.168.0.254",
        "ghp_" + "aB3" * 12, "sk-" + "Zz9" * 8, "0123456789abcdef" * 2,
    ]
    texts = [f"before {f}, after" for f in forms]
    got = {r["doc_id"]: r["text"] for r in pii_surrogates.replace(docs_of(spark, texts), "k").collect()}
    found = [got[i].startswith("before ") and got[i].endswith(", after") and not any(part in got[i] for part in regex.findall(r"[\p{L}\d]{3,}", f)[1 if regex.match(r"Mr|Dr|Prof|Mme|Se|Herr|Гос", f) else 0 :] if part not in ("com", "ghp", "example")) for i, f in enumerate(forms)]
    missed = [f for f, ok in zip(forms, found) if not ok]
    assert len(missed) <= 0.1 * len(forms), missed
    clean = ["Order 1234-5678 of 2024-01-15 at 10:30, 12 items, v1.2.3", "Mr and Mrs are titles. Doctor who?", "x @ y", "AB12", "the dr said 555-12", "room 101-202"]
    assert [r["text"] for r in pii_surrogates.replace(docs_of(spark, clean), "k").orderBy("doc_id").collect()] == clean
    luhn = lambda d: sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    for i, f in enumerate(forms):
        digits = regex.sub(r"\D", "", f)
        if f[0] in "345" and len(digits) in (15, 16):
            assert luhn(regex.sub(r"\D", "", got[i])) == luhn(digits)


def test_short_addresses_do_not_run_out(spark):
    names = spark.createDataFrame([("email", f"{a}@{b}.io") for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"], "kind string, entity string")
    made = pii_surrogates.assigned(names, "k").collect()
    assert len({r["surrogate"] for r in made}) == len(made) == 676 and not {r["surrogate"] for r in made} & {r["entity"] for r in made}


def test_clashing_names_are_kept(spark, clashing):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], LABELS)
    bench = spark.createDataFrame([(1, " ".join(words(60, 1)[:20]))], "item_id long, text string")
    n = clashing.count()
    for out in (line_dedup.deduplicated(clashing), decontaminate.clean(clashing, bench), toxicity.kept(clashing, labels, most_toxic=5, most_clean=5)):
        rows = out.collect()
        assert out.columns == clashing.columns and 0 < len(rows) <= n and all(r[c] == v for r in rows for c, v in CLASH.items())
    masked = pii_surrogates.replace(clashing, "k", keep=("doc_id", "text", "key", "found"))
    assert masked.columns == ["doc_id", "key", "found", "text", "n_entities", "kinds"] and masked.count() == n
    assert minhash_forest.groups(clashing).count() == license_scan.scan(clashing).count() == risk_rules.judge(clashing, labels).count() == n


def test_odd_rows_have_stated_values(spark, clashing):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], LABELS)
    empties = (2, 3, 4)
    lines = {r["doc_id"]: r for r in line_dedup.report(clashing).collect()}
    assert all((lines[d]["n_lines"], lines[d]["removed"]) == (0, "") for d in empties if d != 4) and lines[6]["removed"] == "0" and lines[5]["removed"] == "" and lines[9]["n_removed"] == 3
    scores = {r["doc_id"]: r for r in toxicity.score(clashing, labels, most_toxic=5, most_clean=5).collect()}
    assert all(scores[d]["score"] == 0 and scores[d]["predicted"] == 0 for d in empties)
    groups = {r["doc_id"]: r for r in minhash_forest.groups(clashing).collect()}
    assert all((groups[d]["n_shingles"], groups[d]["component_id"], groups[d]["kept"]) == (0, d, True) for d in empties) and groups[6]["component_id"] == 5 and groups[8]["n_shingles"] > 5900
    found = {r["doc_id"]: r for r in license_scan.scan(clashing).collect()}
    assert all((found[d]["n_words"], found[d]["n_base"], found[d]["labels"], found[d]["score"]) == (0, 0, "", 0.0) for d in empties) and found[8]["n_words"] == 6000
    judged = {r["doc_id"]: r for r in risk_rules.judge(clashing, labels).collect()}
    assert all(judged[d]["base_failed"] and not judged[d]["kept"] and judged[d]["n_words"] == 0 for d in empties)
    assert len({r["score"] for r in quality_rank.score(clashing, labels).where("doc_id in (2, 3)").collect()}) == 1


def test_bpe_and_chats_of_odd_rows(spark, clashing):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_multi_50k.tiktoken")
    rows = bpe.encode_texts(clashing, path, public.PATTERN, keep=("doc_id", "row")).collect()
    assert len(rows) == clashing.count() and all(r["n_tokens"] == 0 for r in rows if r["doc_id"] in (2, 3)) and all(r["row"] == 1 for r in rows)
    twice = [r for r in rows if r["doc_id"] == 0]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert bpe.encode_texts(spark.createDataFrame([], DOCS), path, public.PATTERN).count() == 0
    turns = [(10, 0, "user", "hi"), (10, 0, "user", "hi"), (10, 1, "assistant", "x" * 100_000), (11, 0, "user", "hi"), (11, 0, "user", "hi"), (11, 1, "assistant", ""), (-4, 0, None, None)]
    chats = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").withColumns({"__pair": F.lit(1), "__rows": F.lit(2), "turns": F.lit(3)})
    got = {r["conv_id"]: r for r in chat_format.format_pairs(chat_format.against_neighbours(chats), "conv_id").collect()}
    assert sorted(got) == [-4, 10, 11] and got[10]["n_common"] == 2 and len(got[10]["chosen"]) > 100_000 and got[11]["rejected"].count("x") == 100_000 and got[-4]["n_common"] == 1
    assert chat_format.against_neighbours(chats.where("conv_id > 99")).count() == 0


def test_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = docs_of(spark, odd_texts())
    docs = docs.union(docs.where("doc_id in (0, 5)")).union(docs.where("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long")))
    labels, bench = spark.createDataFrame([], LABELS), spark.createDataFrame([], "item_id long, text string")
    for name, rows in (("odd", docs), ("none", docs.limit(0))):
        for table, df in (("documents", rows), ("labels", labels), ("benchmark", bench)):
            df.write.parquet(str(tmp_path / name / f"{table}.parquet"))
        got = pipeline.run(spark, str(tmp_path / name)).collect()
        # Without labels nothing is toxic; copies and their rows go, texts without a word stay.
        assert (len(got) == 0) if name == "none" else {2, 3, 4, 0, 5, 8} <= {r["doc_id"] for r in got} and len(got) <= docs.count()


def shingle_set(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def naive_groups(rows, percent):
    """Group of each set, and the least doc_id of each group, by all pairs of distinct sets."""
    group = {s: s for s in {shingle_set(t) for d, t in rows if d is not None} if s}
    for a in group:
        for b in group:
            if group[a] != group[b] and 100 * len(a & b) >= percent * len(a | b):
                old, new = group[b], group[a]
                group = {s: new if g == old else g for s, g in group.items()}
    least = {}
    for d, t in rows:
        if d is not None and shingle_set(t):
            g = group[shingle_set(t)]
            least[g] = min(least.get(g, d), d)
    return group, least


def test_one_doc_id_over_several_texts(spark):
    import corpus_pipeline

    rng = random.Random(8)
    a, u = " ".join(words(60, 1)), " ".join(words(60, 2))
    rows = [(3, a), (7, a), (7, u), (9, " ".join(words(60, 3)))]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == {(3, a), (7, u), (9, rows[3][1])}
    bases = [words(50, 10 + i) for i in range(8)]
    rows = []
    for _ in range(120):
        w = list(bases[rng.randrange(8)])
        for _ in range(rng.choice([0, 0, 1, 3])):
            w[rng.randrange(len(w))] = f"z{rng.randrange(9)}"
        rows.append((rng.choice([None, *range(30)]), " ".join(w)))
    rows += [(5, ""), (5, None), (6, "two words"), (None, "two words")]
    group, least = naive_groups(rows, 85)
    for kind in ("long", "int"):
        docs = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(6)
        keys = docs.select(store.row_key().alias("k"), "text").select("k.one", "k.two", "text").distinct()
        judged = minhash_forest.groups(docs, percent=85, with_row=True)
        got = judged.join(keys, (judged["row1"] == keys["one"]) & (judged["row2"] == keys["two"])).collect()
        assert len(got) == len(rows)
        for r in got:
            own = shingle_set(r["text"])
            want = least[group[own]] if own in group else r["doc_id"] if not own else None
            assert r["component_id"] == want and r["kept"] == (r["doc_id"] is not None and r["doc_id"] == want)
    group, _ = naive_groups(rows, 80)
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    for g in {*group.values()}:
        assert len({(d, t) for d, t in left if d is not None and shingle_set(t) and group[shingle_set(t)] == g}) == 1
    assert {r for r in rows if r[0] is None or not shingle_set(r[1])} <= {*left} <= {*rows}


def test_one_long_text_does_not_end_the_sample(spark):
    """Texts are learned from as if one labelled text above the bound were not there."""
    rows = [(i, " ".join(words(30, i))) for i in range(60)]
    long_id = 1000
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(long_id, 1)], "doc_id long, quality long")
    chosen = []
    for longer in ([], [(long_id, "x" * 200_000)]):
        docs = spark.createDataFrame(rows + longer, "doc_id long, text string")
        known = quality_rank.learnable(docs, labels, "quality", 3, 5)
        chosen.append({r["doc_id"] for r in quality_rank.labelled(docs, known, {0: 50, 1: 50}, 100_000).collect()})
    assert chosen[0] == chosen[1] and len(chosen[0]) == 60


def test_a_pair_of_sets_meets_once_however_many_shingles_it_shares(spark):
    """Joined rows grow with the pairs, not with the shingles that each pair shares."""
    rng = np.random.default_rng(6)
    fields = "shingle long, node long, n_shingles long, at int, component long, degree long"
    rows, heads = [], {}
    for node in range(30):
        heads[node] = sorted(rng.choice(40, 12, replace=False).tolist()) if node > 3 else list(range(12))
        rows += [(s, node, 1000, at, node // 2, 0) for at, s in enumerate(heads[node])]
    classes = spark.createDataFrame([(node, [0] * 8, None) for node in heads], "node long, bits array<long>, wide array<long>")
    placed = spark.createDataFrame(rows, fields)
    n = placed.groupBy("shingle").count().withColumnRenamed("count", "n")
    got = [(r["node"], r["other"]) for r in minhash_forest._all_pairs(placed.join(n, "shingle"), classes, 85).collect()]
    want = {(a, b) for a in heads for b in heads if a < b and a // 2 != b // 2 and {*heads[a]} & {*heads[b]}}
    assert set(got) == want and got.count((0, 2)) == got.count((1, 3)) == 1 and len(got) < 1.5 * len(want)


def test_shingles_of_two_unlike_sets_are_not_open(spark):
    fields = "shingle long, node long, n_shingles long, component long, degree long, at int"
    rows = [(1, 1, 100, 1, 0, 0), (1, 2, 80, 2, 0, 0), (2, 1, 100, 1, 0, 1), (2, 3, 90, 3, 0, 0), (3, 1, 100, 1, 0, 15), (3, 3, 90, 3, 0, 12), (4, 1, 100, 1, 0, 2), (4, 4, 95, 1, 0, 2)]
    rows += [(5, 1, 100, 1, 0, 3), (5, 2, 80, 2, 0, 1), (5, 4, 95, 1, 0, 3)]
    left = minhash_forest._open(spark.createDataFrame(rows, fields), 85)
    assert sorted((r["shingle"], r["node"], r["n"]) for r in left.collect()) == [(2, 1, 2), (2, 3, 2), (5, 1, 3), (5, 2, 3), (5, 4, 3)]


def test_quality_learns_from_all_labels(spark, monkeypatch):
    """Blocks and the cutoff take in every label, however rare one is; each block has pairs."""
    rng = np.random.default_rng(8)
    n, rare = 900, 7
    x = rng.normal(size=(n, quality_rank.N_FEATURES))
    good = np.arange(n) >= rare
    x[good, 0] += 1.5
    found = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "doc_id long, x array<double>")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id long, quality long")
    monkeypatch.setattr(quality_rank, "BLOCK", 100)
    rows = found.join(labels.withColumnRenamed("quality", "label"), "doc_id")
    blocks = quality_rank.blocks_of(rows, {0: rare, 1: n - rare}).collect()
    met = {tuple(v) for b in blocks for v in np.reshape(b["x"], (-1, quality_rank.N_FEATURES)).tolist()}
    assert len(blocks) == 9 and met == {tuple(v) for v in x.tolist()} and all({*b["labels"]} == {0, 1} for b in blocks)
    model = quality_rank.train(found, labels, of=3, remainder=5)
    assert abs((model.score(x) < 0.5).sum() - rare) <= 1
    whole = quality_rank.fit(x, good)
    assert np.corrcoef(model.weights, whole.weights)[0, 1] > 0.9 and abs(model.weights - quality_rank.train(found.where("doc_id < 100"), labels, of=3, remainder=5).weights).max() > 0.01


def test_common_words_stand_in_two_bands(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "COMMON", 0)
    rng, lines = random.Random(11), []
    for i in range(40):
        own = [f"w{rng.randrange(200)}" for _ in range(rng.randint(9, 40))]
        # Shorter and longer likenesses, before and after.
        some = [own, own[1:], [*own, f"v{i}"], [*own[:-1], f"u{i}"], own[: -max(1, len(own) // 11)]]
        rng.shuffle(some)
        lines += some
    rng.shuffle(lines)
    texts = ["\n".join(" ".join(w) for w in lines[at : at + 5]) for at in range(0, len(lines), 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, want = [], {}
    for d, text in enumerate(texts):
        want[d] = []
        for i, line in enumerate(text.split("\n")):
            s = frozenset(line.split(" "))
            if any(10 * len(s & t) >= 9 * len(s | t) for t in seen):
                want[d].append(str(i))
            seen.append(s)
    assert {r["doc_id"]: r["removed"] for r in line_dedup.report(docs).collect()} == {d: ",".join(x) for d, x in want.items()}
    classes = line_dedup.nodes(docs, line_dedup.rarity(docs), 90).select(F.struct("doc_id", "row", "line_no").alias("place"), "n", "prefix", "bits", F.monotonically_increasing_id().alias("c"))
    assert line_dedup._entries(classes, 90).count() == 2 * classes.agg(F.sum(F.size("prefix"))).first()[0]


def test_rare_words_of_lines_do_not_look_frequent(spark):
    frequent, rare = [f"often{i}" for i in range(6000)], [f"once{i}" for i in range(20000)]
    texts = [" ".join(frequent[at : at + 60]) for at in range(0, 6000, 60)] * 20 + [" ".join(rare[at : at + 50]) for at in range(0, 20000, 50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    numbers = docs.where("doc_id >= 2000").select(F.explode(line_dedup._numbers(F.col("text"), line_dedup.rarity(docs))).alias("w"))
    ranks = numbers.groupBy(F.shiftright("w", 56).alias("rank")).count().collect()
    assert sum(r["count"] for r in ranks) == 20000
    # Some 2 % of them share a bucket with a frequent word (20 places, rank 17); with 65536 buckets it was 9 %.
    assert sum(r["count"] for r in ranks if r["rank"] >= 17) < 0.04 * 20000


def test_lines_without_doc_id_come_first(spark):
    """Null comes before every doc_id, and of one document the earlier line stays, also among sets that meet in pairs."""
    rng = random.Random(5)
    rows = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(60)]
        near = [" ".join([*base[:at], f"x{g}y{at}", *base[at + 1 :]]) for at in rng.sample(range(60), 3)]
        rows += [(g + 1, f"{near[0]}\n{near[1]}"), (None if g % 2 else 100 + g, near[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = sorted(((d is not None, d or 0, k, i, line) for k, (d, t) in enumerate(rows) for i, line in enumerate(t.split("\n"))), key=lambda x: x[:4])
    seen, want = [], {k: [] for k in range(len(rows))}
    for _, _, k, i, line in lines:
        s = frozenset(line.split(" "))
        if any(10 * len(s & t) >= 9 * len(s | t) for t in seen):
            want[k].append(str(i))
        seen.append(s)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["removed"]) for r in line_dedup.report(docs).collect())
    assert got == sorted((d is not None, d or 0, ",".join(want[k])) for k, (d, _) in enumerate(rows))


def test_facts_of_many_nodes_stay_off_the_driver(spark):
    classes = spark.range(6000).select(F.col("id").alias("node"), F.lit(900).cast("long").alias("n_shingles"), F.array(F.lit(1).cast("long")).alias("bits"), F.array(F.lit(1).cast("long")).alias("wide"))
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    plan = minhash_forest.plausible(pairs, classes, 80)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert minhash_forest.plausible(pairs, classes, 80).count() == 1


def test_training_holds_its_texts_once():
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(2000)) for _ in range(150)]
    tracemalloc.start()
    toxicity.fit(texts, np.arange(150) % 3 == 0, rounds=1, least_steps=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 35 * sum(map(len, texts)), peak / sum(map(len, texts))
