"""The training-data operators against brute force, and their edge cases.

Each operator gets NULLs in every column, empty and very long texts, ties, repeated rows, an empty
table, and extra columns whose names clash with those that it uses inside.
"""

import itertools
import os
import random
import subprocess
import sys
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from compare import assert_equal
from quern.llm import frequency, language, leakage, lookalikes, mixing, neardup, queries, spans, survivors
from quern.llm.oracle import SQL
from quern.llm.tokens import blank_tokens, grams, sliding_min

WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
VOCAB = [a + b for a in ("ka", "lu", "thi", "mo", "zei", "pau") for b in ("n", "ng", "k", "l", "m", "p", "")]


def text(rng, n, vocab=None):
    return " ".join(rng.choice(vocab or VOCAB) for _ in range(n))


@pytest.mark.parametrize("name", sorted(queries.Q))
def test_query(spark, sf, name):
    df = queries.Q[name](spark, sf)
    if name in SQL:
        assert_equal(df, SQL[name], sf)
    else:
        df.collect()


# ---- tokens


def test_blank_tokens_are_split():
    texts = ["a b\tc\n d", None, "", "  ", "é x ", "one", "a b\tc\n d"]
    hashes, rows = blank_tokens(pa.array(texts))
    want = [(i, w) for i, t in enumerate(texts) for w in regex.split(r"[ \t\r\n]+", t or "") if w]
    assert rows.tolist() == [i for i, _ in want]
    assert len(set(zip(hashes.tolist(), [w for _, w in want]))) == len({w for _, w in want}) == len(set(hashes.tolist()))


def test_grams_and_minimum():
    h = np.arange(1, 30, dtype=np.uint64)
    twice = np.r_[h, h]
    g = grams(twice, 5)
    assert (g[:25] == g[29:54]).all()
    assert len(set(g.tolist())) < len(g)
    x = np.random.default_rng(1).integers(0, 99, 60)
    for w in (1, 2, 3, 7, 16, 26):
        assert sliding_min(x, w).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]


# ---- 1


LOOK = [
    ("Сuaiphuik", "Cuaiphuik"), ("λόγος", "λόγος"), ("мудрый", "мудрый"), ("1O3", "103"), ("covid10", "covid10"), ("A1", "A1"), ("thu​m­", "thum"),
    ("a b　c", "a b c"), ("ｋｈｕｍ，", "khum,"), ("é", "é"), ("၀ိုးဗုင်", "ဝိုးဗုင်"), ("၉၄ဝ", "၉၄၀"), ("၁၀ရက်", "၁၀ရက်"), ("ဝ", "ဝ"), ("၀", "၀"), ("၀ိ", "ဝိ"), ("၇၀ိ", "ရဝိ"), ("Plain  text", "Plain  text"), ("", ""),
    ("န့်", "န့်"), ("tab\there", "tab here"),
]


def _canon(spark, rows, words=()):
    df = spark.createDataFrame(rows, "id long, v string, folded string, tokens string, f string")
    lex = spark.createDataFrame([(w,) for w in words], "token string")
    got = lookalikes.canonicalise([("t", "v", df)], [(lex, "token")])
    return {r.record_id: r.canonical for r in got.collect()}


def test_canonical_forms(spark):
    got = _canon(spark, [(i, a, None, "x", "y") for i, (a, _) in enumerate(LOOK)] + [(99, None, None, None, None)])
    assert got == {i: b for i, (_, b) in enumerate(LOOK)}
    assert all(unicodedata.is_normalized("NFC", v) for v in got.values())


def test_vocabulary_decides(spark):
    assert _canon(spark, [(1, "ho1i", None, None, None)], ["holi"])[1] == "holi"
    assert _canon(spark, [(1, "ho1i", None, None, None)], ["hoii", "hoii", "holi"])[1] == "hoii"
    assert _canon(spark, [(1, "Ӏung 0m", None, None, None)], ["lung", "om"])[1] == "Lung om"
    assert _canon(spark, [(1, "0m", None, None, None)])[1] == "0m"


def test_trie_is_zero_cost_search():
    rng = random.Random(5)
    words = {"".join(rng.choice("aeliouhkpsc") for _ in range(rng.randint(2, 7))) for _ in range(300)}
    trie = lookalikes.Trie()
    for w in words:
        trie.add(w, 1)
    back = defaultdict(list)
    for k, v in lookalikes.LATIN_LIKE.items():
        if len(v) == 1 and v.islower():
            back[v].append(k)
    for w in words:
        odd = "".join(rng.choice([c, *back[c]]) for c in w)
        assert trie.spelling(odd) == w
        assert lookalikes.skeleton(odd) == lookalikes.skeleton(w)
    assert trie.spelling("zzz") is None


def brute_cost(token, word):
    """Least edits between a token and a word, look-alikes free."""
    row = list(range(len(word) + 1))
    for i, c in enumerate(token, 1):
        row = _next_row(row, i, c, word)
    return row[-1]


def _next_row(row, i, c, b):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (y not in lookalikes._stands_for(c))))
    return new


def test_edit_budget():
    rng = random.Random(12)
    words = sorted({"".join(rng.choice("aelkhp") for _ in range(rng.randint(1, 5))) for _ in range(120)})
    trie = lookalikes.Trie()
    for i, w in enumerate(words):
        trie.add(w, 1 + i % 7)
    for _ in range(300):
        token = "".join(rng.choice("аelkhр1p") for _ in range(rng.randint(1, 6)))
        for budget in (0, 1, 2):
            want = {w: brute_cost(token, w) for w in words}
            got = {w: c for c, _, w in trie.search(token, budget)}
            assert got == {w: c for w, c in want.items() if c <= budget}
        for w in words:  # one edit apart: a common key
            if brute_cost(token, w) <= 1:
                assert set(lookalikes.near_keys(token).tolist()) & set(lookalikes.near_keys(w).tolist())


def test_budget_is_bound_by_confidence(spark):
    df = spark.createDataFrame([(1, "hol1m"), (2, "bаrk"), (3, "zzzz0z"), (4, None), (5, "а" * 20_000)], "id long, v string")
    lex = spark.createDataFrame([("holims",)] * 9 + [("holi",)] + [("bark",)] + [("barx",)] * 3, "token string")
    near = {r.token: (r.near, r.n, r.confidence) for r in lookalikes.near_report([("t", "v", df)], [(lex, "token")]).collect()}
    assert near == {"hol1m": ("holims", 9, 0.9)}
    get = lambda **kw: {r.record_id: r.canonical for r in lookalikes.canonicalise([("t", "v", df)], [(lex, "token")], **kw).collect()}
    assert get()[1] == "hollm"
    assert get(budget=1)[1] == "holims"
    assert get(budget=1, confidence=0.95)[1] == "hollm"
    assert {k: v for k, v in get(budget=1).items() if k != 1} == {2: "bark", 3: "zzzzoz", 5: "a" * 20_000}


def test_lookalike_edges(spark):
    long = "а" * 50_000
    assert _canon(spark, [(1, long, None, None, None), (1, long, None, None, None)])[1] == "a" * 50_000
    assert _canon(spark, [(1, None, None, None, None)]) == {}


# ---- 3


def brute_pairs(rows, t, size, least):
    sets = {}
    for i, x in rows:
        w = WORD.findall((x or "").lower())
        if len(w) >= max(least, size):
            sets[i] = set(zip(*(w[k:] for k in range(size))))
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b])}


@pytest.mark.parametrize(("seed", "t", "size"), [(1, 0.5, 3), (2, 0.8, 5), (3, 0.5, 3), (4, 0.6, 2)])
def test_similarity_join_is_exact(spark, seed, t, size):
    rng = random.Random(seed)
    rows = []
    for base in range(12):
        w = text(rng, rng.randint(8, 60)).split()
        for _ in range(rng.randint(1, 6)):
            v = list(w)
            for _ in range(rng.randint(0, 4)):
                v[rng.randrange(len(v))] = rng.choice(VOCAB)
            rows.append((len(rows), " ".join(v).upper() if rng.random() < 0.3 else ", ".join(v)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, rows[0][1])]
    df = spark.createDataFrame([(i, x, "p", 1) for i, x in rows], "id long, text string, key string, n int")
    members, links = neardup.similar_pairs(df, t, size, 10)
    got = {(r.id_a, r.id_b) for r in neardup.expand(members, links).collect()}
    assert got == brute_pairs(rows, t, size, 10)
    groups = {r.id: r for r in neardup.duplicate_groups(members, links).collect()}
    label = {i: i for i in groups}
    for _ in range(len(rows)):
        for a, b in got:
            label[a] = label[b] = min(label[a], label[b])
    assert {i: r.group_id for i, r in groups.items()} == label


def test_parts_do_not_mix(spark):
    x = text(random.Random(1), 20)
    df = spark.createDataFrame([("a", 1, x), ("b", 2, x), ("b", 1, x), ("b", None, x), (None, 7, x)], "part string, id long, text string")
    members, links = neardup.similar_pairs(df, 0.5, 3, 10, part_col="part")
    assert sorted((r.part, r.id_a, r.id_b) for r in neardup.expand(members, links).collect()) == [("b", 1, 2)]
    empty = neardup.similar_pairs(df.limit(0), 0.5, 3, 10, part_col="part")
    assert neardup.expand(*empty).count() == 0


def test_hot_group_of_copies(spark):
    x = text(random.Random(2), 30)
    df = spark.range(400).select("id", F.lit(x).alias("text")).unionAll(spark.createDataFrame([(1000, text(random.Random(3), 30))], "id long, text string"))
    members, links = neardup.similar_pairs(df, 0.8, 5)
    g = neardup.duplicate_groups(members, links)
    assert g.where("group_id = 0").count() == 400
    assert links.count() == 0


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([("", i, i + 1) for i in range(60)] + [("", 100, 101)], "part string, a long, b long")
    got = {r.id: r.group_id for r in neardup.components(e).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# ---- 4


SAMPLES = {"own": ["ka", "pai", "hi", "leh", "nuam", "thei", "lo", "zong", "tua"], "eng": ["the", "of", "and", "school", "with", "fathers", "were", "rain", "hammer"], "miz": ["chu", "tih", "hrawh", "tlang", "zawk", "rawn", "chhung", "hmun", "vek"]}


@pytest.fixture(scope="module")
def classifier():
    rng = random.Random(3)
    return language.Classifier({k: text(rng, 400, v) for k, v in SAMPLES.items()})


def test_passages(classifier):
    rng = random.Random(4)
    own, eng, few = (text(rng, n, SAMPLES[k]) for n, k in ((40, "own"), (15, "eng"), (6, "miz")))
    found = list(classifier.passages([f"{own}. {eng}\n{own}", f"{own} ({few}) {own}", eng, "", None, "ka pai", f"{few}"]))
    assert [(d, lang, a, b) for d, lang, a, b, _ in found] == [(0, "own", 1, 40), (0, "eng", 41, 55), (0, "own", 56, 95), (1, "own", 1, 86), (2, "eng", 1, 15)]
    assert all(0 <= c <= 1 for *_, c in found)


def test_narrow_margins_are_rejected(classifier):
    found = list(classifier.passages(["12 34 56 78 90 12 34 56 78 90 11 22 33"], 10))
    assert [x[1] for x in found] == [None]


def test_held_out_accuracy(spark, sf):
    rows = spark.read.parquet(f"{sf}/language_samples.parquet").orderBy("sample_id").collect()
    train, test = [r for r in rows if r.sample_id % 3], [r for r in rows if r.sample_id % 3 == 0]
    c = language.fit(spark.createDataFrame(train))
    got = defaultdict(set)
    for d, lang, *_ in c.passages([r.sample_text for r in test]):
        got[d].add(lang)
    known = [d for d, r in enumerate(test) if len(WORD.findall(r.sample_text)) >= 10]
    assert sum(got[d] == {test[d].lang} for d in known) >= 0.97 * len(known)


def test_language_frames(spark, classifier):
    rng = random.Random(5)
    df = spark.createDataFrame([(1, text(rng, 20, SAMPLES["eng"]), " EN ", 3), (2, None, "own", 3), (3, "", None, 3), (4, text(rng, 20_000, SAMPLES["own"]), "und", 3), (4, text(rng, 20, SAMPLES["own"]), "x", None)], "id long, content string, label string, passage_no int")
    labels = spark.createDataFrame([("en", "eng"), ("own", "own"), (None, "own"), ("bad", None)], "label string, lang string")
    found = language.passages(df, classifier)
    assert sorted((r.id, r.lang, r.n_words) for r in found.collect()) == [(1, "eng", 20), (4, "own", 20), (4, "own", 20_000)]
    docs = {r.id: r for r in language.documents(df.limit(4), found, labels, label_col="label").collect()}
    assert (docs[1].stated_lang, docs[1].lang, docs[2].stated_lang, docs[2].lang, docs[4].stated_lang) == ("eng", "eng", "own", None, None)
    assert language.passages(df.limit(0), classifier).count() == 0
    with pytest.raises(ValueError):
        language.fit(spark.createDataFrame([], "lang string, sample_text string"))


def test_paths_are_cheapest(classifier):
    rng = random.Random(9)
    docs = [text(rng, n, VOCAB + SAMPLES["own"] + SAMPLES["eng"] + SAMPLES["miz"]).split() for n in (1, 300, 0, 7, 7, 40, 2)]
    for chosen in (docs, docs[:1], docs[1:2], docs[2:3], []):
        ids = classifier.word_ids(chosen)
        for ws, i, path in zip(chosen, ids, classifier.paths(ids)):
            assert len(path) == len(ws)
            if not ws:
                continue
            best = classifier.table[i[0]].copy()
            for e in classifier.table[i[1:]]:
                best = np.minimum(best, best.min() + language.CHANGE) + e
            cost = classifier.table[i, path].sum() + language.CHANGE * (np.diff(path) != 0).sum()
            assert cost == pytest.approx(best.min())


def test_a_very_long_document_needs_little_memory():
    code = """
import random, resource
from quern.llm import language
rng = random.Random(1)
c = language.Classifier({"a": "ka pai hi leh nuam thei lo zong tua", "b": "the of and school with fathers were rain", "c": "chu tih hrawh tlang zawk rawn", "d": "x y z", "e": "q w"})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
long = " ".join(rng.choice(["ka pai hi leh", "nuam thei lo zong"]) for _ in range(250_000))
found = list(c.passages([long] + ["the of and school with fathers were rain the of and school"] * 255))
assert (found[0][1], found[0][3]) == ("a", 1_000_000) and len(found) == 256, found[:2]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    assert int(done.stdout) < 500


def test_dictionaries_keep_their_bound(spark):
    samples = spark.createDataFrame([("own", "ka pai " * 500), ("eng", "the of " * 500)], "lang string, sample_text string")
    labelled = spark.createDataFrame([(1, "own", "ka pai hi " * 500)], "id long, lang string, text string")
    for limit in (100, 5000, 65536):
        assert all(len(t.encode()) <= limit for t in language.fit(samples, labelled, dictionary_bytes=limit).texts.values())


# ---- 5


def brute_terms(values):
    occ, rows, n = Counter(), Counter(), 0
    for v in values:
        if v is None or not v.strip() or v.strip() == "-":
            continue
        n += 1
        w = WORD.findall(v.lower())
        occ.update(w)
        rows.update(set(w))
    return {w: (occ[w], rows[w], "rare" if rows[w] <= 2 else "common" if rows[w] > 0.2 * n else None) for w in occ}


def test_term_frequency(spark):
    rng = random.Random(6)
    values = [text(rng, rng.randint(0, 12)) for _ in range(300)] + [None, "", " ", "-", "Hot hot HOT", "ﬁ é é x-y 12", "ΛΌΓΟΣ λόγος İx", " ".join(f"u{i}" for i in range(20_000))]
    df = spark.createDataFrame([(v, "c", 5) for v in values], "v string, term string, n_rows int").repartition(5)
    got = {r.term: (r.occurrences, r.n_rows, r.mark) for r in frequency.term_frequency([("t.v", df, "v", True)]).collect()}
    assert got == brute_terms(values)
    whole = frequency.term_frequency([("t.n", df, "n_rows", False), ("t.e", df.limit(0), "v", True)]).collect()
    assert [(r.field_name, r.term, r.n_rows, r.mark) for r in whole] == [("t.n", "5", len(values), "common")]


@pytest.mark.parametrize("limit", [1, 2_000, 1 << 30])
def test_radix_spill_is_exact(limit):
    rng = random.Random(7)
    rows = [("f", f"w{rng.randrange(3000)}", rng.randint(1, 5), 1) for _ in range(20_000)] + [("f", "hot", 1, 1)] * 5_000
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 500])], schema=frequency.PARTIAL) for i in range(0, len(rows), 500)]
    spill = frequency.RadixSpill(limit, 128, depth=3)
    got = {}
    for t in spill.run(iter(batches)):
        for r in t.to_pylist():
            assert r["term"] not in got
            got[r["term"]] = (r["occurrences"], r["n_rows"])
    want = defaultdict(lambda: [0, 0])
    for _, w, o, n in rows:
        want[w][0] += o
        want[w][1] += n
    assert got == {k: tuple(v) for k, v in want.items()}
    assert (spill.files_split > 0) == (limit == 2_000 or limit == 1)


# ---- 6


def test_layers(spark):
    rng = random.Random(8)
    rows = [(i, f"w{rng.randrange(12)}", rng.choice(["x", None]), rng.choice(["y", "-"]), rng.choice(["a.txt", "b.txt", "c.txt", None]), rng.choice([0.1, 0.5, 0.9, None]), rng.choice(["2024-01-01", "2024-02-02", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, zolai string, english string, pos string, source_file string, confidence double, updated_at string")
    trust = spark.createDataFrame([("a.txt", 1), ("b.txt", 2)], "source_file string, trust_rank int")
    fields = ["english", "pos"]
    found = survivors.skylines(df, trust, "zolai", fields)
    got = {r.record_id: (r.group_id, r.n_fields, r.layer, r.n_above) for r in survivors.layer_rows(found, fields).collect()}
    rank = {"a.txt": 1, "b.txt": 2}
    good = {i: ({f for f, v in (("e", e), ("p", p)) if v not in (None, "-")}, rank.get(s, 99), (c if c is not None else -1, u or "")) for i, _, e, p, s, c, u in rows}
    above = lambda a, b: good[a][0] >= good[b][0] and good[a][1] <= good[b][1] and (good[a][2], -a) > (good[b][2], -b)
    by_policy = lambda ids: sorted(sorted(ids, key=lambda i: (good[i][2], -i), reverse=True), key=lambda i: good[i][1])
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r[0])
    for ids in groups.values():
        layer = {}
        for i in by_policy(ids):
            layer[i] = 1 + max((layer[j] for j in layer if above(j, i)), default=0)
        for i in ids:
            if layer[i] == 1:  # every undominated record is kept, and named so
                assert got[i][:3] == (min(ids), len(good[i][0]), 1)
            elif i in got:
                assert got[i][2] > 1
    best = {(r.group_id, r.field_name): r.record_id for r in survivors.long_form(survivors.chosen(found, fields), fields).collect()}
    for ids in groups.values():
        for f, k in (("english", "e"), ("pos", "p")):
            have = [i for i in by_policy(ids) if k in good[i][0]]
            assert best.get((min(ids), f)) == (have[0] if have else None)


def test_hot_headword_keeps_few_records(spark):
    df = spark.range(5000).select("id", F.lit("Hot").alias("zolai"), F.when(F.col("id") % 2 == 0, "x").alias("english"), F.lit("a.txt").alias("source_file"), (F.col("id") % 97 / 100).alias("confidence"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    trust = spark.createDataFrame([("a.txt", 1)], "source_file string, trust_rank int")
    (r,) = survivors.skylines(df, trust, "zolai", ["english"]).collect()
    assert (r.n_records, [(b.id, b.layer) for b in r.best]) == (5000, [(96, 1), (193, 2)])


def test_survivors(spark):
    rows = [
        (1, " Ka  Pai ", None, "a/x.txt", 0.9, "2024-01-02", "n"), (2, "ka pai", "go", "b/y.txt", None, "2024-01-01", "-"), (3, "KA PAI", "walk", "y.txt", 0.1, "2024-01-01", None),
        (4, "ka pai", "run", "z.txt", 1.0, "2024-05-05", " "), (4, "ka pai", "run", "z.txt", 1.0, "2024-05-05", " "), (5, "alone", "x", None, None, None, None), (6, None, "x", None, None, None, None), (7, None, "y", None, None, None, None),
        (8, "tie", "b", "x.txt", float("nan"), None, None), (9, "tie", "a", "x.txt", None, None, None), (None, "tie", "z", "x.txt", 1.0, None, None), (10, "bare", "-", None, None, None, ""), (11, "bare", None, None, None, None, ""),
    ]
    df = spark.createDataFrame(rows, "id long, zolai string, english string, source_file string, confidence double, updated_at string, pos string").withColumn("updated_at", F.to_timestamp_ntz("updated_at")).withColumns({"k": F.lit(1), "_key": F.lit("c"), "trust_rank": F.lit(0)})
    trust = spark.createDataFrame([("y.txt", 1), ("x.txt", 2), ("x.txt", 3), (None, 0)], "source_file string, trust_rank int")
    s = survivors.field_survivors(df, trust, "zolai", ["english", "pos"])
    got = sorted(map(tuple, survivors.long_form(s, ["english", "pos"]).collect()))
    assert got == [(1, "english", 3), (1, "pos", 1), (8, "english", 8)]
    assert {r.group_id: r.n_records for r in s.collect()} == {1: 5, 8: 2, 10: 2}
    assert survivors.field_survivors(df.limit(0), trust, "zolai", ["english"]).count() == 0
    assert survivors.field_survivors(df, trust.limit(0), "zolai", ["english"]).count() == 3
    assert {r.group_id: (r.english, r.pos) for r in s.collect()} == {1: ("walk", "n"), 8: ("b", None), 10: (None, None)}


# ---- 7


def brute_leaks(docs, items, window=12):
    out = set()
    for i, p in items:
        w = WORD.findall((p or "").lower())
        n = min(window, len(w))
        want = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
        for d, t in docs:
            v = WORD.findall((t or "").lower())
            if any(tuple(v[k : k + n]) in want for k in range(len(v) - n + 1)):
                out.add((d, i))
    return out


def test_leaks(spark):
    rng = random.Random(9)
    items = [(i, text(rng, rng.choice([1, 5, 11, 12, 13, 30]), [f"q{k}" for k in range(40)])) for i in range(40)] + [(90, None), (91, ""), (92, "é kà x 5 km")]
    docs = []
    for d in range(120):
        t = text(rng, rng.randint(0, 40)).split()
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items)[1] or ""
            w = w.split()
            a = rng.randint(0, 3)
            t[rng.randint(0, len(t)) : 0] = w[a : a + rng.choice([10, 12, 14, 40])]
        docs.append((d, " ".join(t).title() if rng.random() < 0.2 else ", ".join(t)))
    docs += [(500, None), (501, ""), (502, "É Kà x 5 km"), (503, text(rng, 50_000) + " " + items[5][1])]
    df = spark.createDataFrame([(a, b, 7, 1) for a, b in docs], "doc_id long, text string, item_id int, passage int")
    ev = spark.createDataFrame([(a, b, "c") for a, b in items], "item_id long, passage string, doc_id string")
    want = brute_leaks(docs, items)
    for size in (4 << 20, 1000):  # in one block, and in several
        got = {(r.doc_id, r.item_id) for r in leakage.find_leaks(df, ev, block_bytes=size).where("exact").collect()}
        assert got == want
    assert leakage.find_leaks(df.limit(0), ev).count() == 0
    assert leakage.find_leaks(df, ev.limit(0)).count() == 0


def test_reparameterised(spark):
    base = "the farmer {n} sold 12 goats for 40 dollars and {n} bought 12 new hoes in the town"
    ev = spark.createDataFrame([(1, base.format(n="Thang"))], "item_id long, passage string")
    docs = spark.createDataFrame(
        [(1, base.format(n="Thang")), (2, base.format(n="Mary").replace("12", "15").replace("40", "99")), (3, base.format(n="Mary").replace("12", "15", 1)), (4, base.format(n="Mary").replace("goats", "sheep").replace("hoes", "ploughs"))],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.exact): r.n_windows for r in leakage.find_leaks(docs, ev).collect()}
    assert set(got) == {(1, True), (2, False), (3, False)}
    assert got[2, False] > got[3, False]  # a number renamed in one place only breaks the windows that hold both


# ---- 8


def test_mix(spark):
    rng = random.Random(10)
    rows = [(i, rng.choice(["big"] * 6 + ["mid"] * 3 + ["low"]), text(rng, rng.randint(1, 60))) for i in range(600)]
    rows += [(9001, "big", None), (9002, "big", ""), (9003, None, "x"), (9004, "other", "y"), (9005, "tiny", "ka pai")]
    df = spark.createDataFrame([(*r, 3, "c") for r in rows], "doc_id long, source string, text string, n_tokens int, budget string")
    targets = spark.createDataFrame([("big", 0.3, 1), ("mid", 0.3, 2), ("low", 0.2, 4), ("tiny", 0.1, 2), ("none", 0.1, 5), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    chosen, shares = mixing.mix(df, targets)
    rep = {r.doc_id: r for r in chosen.collect()}
    sh = {r.source: r for r in shares.collect()}
    assert not {9001, 9002, 9003, 9004} & rep.keys()
    assert rep[9005].repeats == 2
    limits = {"big": 1, "mid": 2, "low": 4, "tiny": 2}
    assert all(1 <= r.repeats <= limits[r.source] for r in rep.values())
    used = Counter()
    for r in rep.values():
        used[r.source] += r.n_tokens * r.repeats
    assert {k: v.used for k, v in sh.items()} == {**used, "none": 0}
    longest = max(r.n_tokens for r in rep.values())
    assert all(abs(v.used - v.budget) <= longest for v in sh.values())
    assert sum(v.budget for v in sh.values()) == pytest.approx(sum(v.tokens for v in sh.values()), abs=5)
    free = [v for v in sh.values() if v.exponent == 1]
    assert len({round(v.budget / v.target_share / 20) for v in free}) == 1  # in target proportions
    assert all(0 < v.exponent < 1 and v.budget == v.tokens * v.max_repeats for v in sh.values() if v.tokens and v not in free)
    assert sh["tiny"].exponent < 1
    assert sh["none"].exponent is None
    exact = {r.source: r for r in mixing.mix(df, targets, total="exact")[1].collect()}
    assert all(r.exponent == 1 for r in exact.values() if r.tokens)
    assert min(r.budget / (r.tokens * r.max_repeats) for r in exact.values() if r.tokens) <= 1
    e, s = mixing.mix(df.limit(0), targets)
    assert e.count() == 0
    assert s.where("used > 0").count() == 0


def test_ranges_do_not_change_the_choice(spark, monkeypatch):
    df = spark.createDataFrame([(i, "ab"[i % 3 == 0], "ka pai " * (1 + i % 5)) for i in range(300)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], "source string, target_share double, max_repeats int")
    once = {tuple(r) for r in mixing.mix(df, targets)[0].collect()}
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    assert {tuple(r) for r in mixing.mix(df, targets)[0].collect()} == once


def _rows(*given):
    return [{"source": s, "target_share": t, "max_repeats": r, "tokens": n} for s, t, r, n in given]


def test_exponent():
    natural, target = np.array([0.7, 0.2, 0.1]), np.array([0.2, 0.3, 0.5])
    x = mixing.bisect_exponent(lambda y: bool((mixing.tempered(natural, target, y) <= natural * 2).all()))
    w = mixing.tempered(natural, target, x)
    assert (w <= natural * 2 + 1e-9).all()
    assert (w / natural).max() == pytest.approx(2, abs=1e-6)
    two = _rows(("a", 0.5, 2, 1000), ("b", 0.5, 2, 10))
    plan = mixing.plan_mix(two)
    assert [p["budget"] for p in plan] == [990, 20]
    assert plan[0]["exponent"] == 1
    # at its exponent the tempered share of b is its limit
    assert 1010 * mixing.tempered(np.array([1000, 10]) / 1010, np.array([0.5, 0.5]), plan[1]["exponent"])[1] == pytest.approx(20)
    assert [p["budget"] for p in mixing.plan_mix(two, 10**6)] == [2000, 20]
    assert [p["budget"] for p in mixing.plan_mix(two, "exact")] == [20, 20]
    even = mixing.plan_mix(_rows(("a", 0.9, 9, 9000), ("b", 0.1, 9, 1000)), entropy_of=0.6)
    share = np.array([p["budget"] for p in even]) / sum(p["budget"] for p in even)
    assert mixing.entropy(share) == pytest.approx(0.6, abs=1e-3)
    assert mixing.plan_mix(_rows(("a", 0.9, 9, 9000), ("b", 0.1, 9, 1000)), entropy_of=0.1)[0]["budget"] == 9000  # natural is more even already
    assert mixing.plan_mix(_rows(("a", 0.9, 9, 0))) == [{"source": "a", "target_share": 0.9, "max_repeats": 9, "tokens": 0, "budget": 0, "exponent": None, "goal": 0.0}]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_tokenizers(spark, name):
    df = spark.createDataFrame([(1, "s", "ka pai hi"), (2, "s", None), (3, None, "")], "doc_id long, source string, text string")
    got = {r.doc_id: r.n_tokens for r in mixing.token_counts(df, f"/opt/tokenizers/{name}").collect()}
    assert got[2] == got[3] == 0
    assert 3 <= got[1] <= 9


# ---- 9


def brute_spans(docs, length):
    where = defaultdict(set)
    toks = {d: [w for w in regex.split(r"[ \t\r\n]+", t or "") if w] for d, t in docs}
    for d, w in toks.items():
        for i in range(len(w) - length + 1):
            where[tuple(w[i : i + length])].add(d)
    out = set()
    for d, w in toks.items():
        hit = [False] * len(w)
        for i in range(len(w) - length + 1):
            if len(where[tuple(w[i : i + length])]) > 1:
                hit[i : i + length] = [True] * length
        i = 0
        while i < len(w):
            if hit[i]:
                j = i
                while j + 1 < len(w) and hit[j + 1]:
                    j += 1
                out.add((d, i + 1, j + 1))
                i = j
            i += 1
    return out


@pytest.mark.parametrize(("seed", "length", "gram"), [(1, 10, 5), (2, 50, 25), (3, 7, 7), (4, 12, 3)])
def test_shared_spans(spark, seed, length, gram):
    rng = random.Random(seed)
    pool = [text(rng, rng.randint(length - 3, 2 * length)).split() for _ in range(6)]
    docs = []
    for d in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += text(rng, rng.randint(0, length)).split()
            p = rng.choice(pool)
            a = rng.randint(0, 4)
            w += p[a : len(p) - rng.randint(0, 4)]
        docs.append((d, "".join(x + rng.choice([" ", "\n", "\t", "  "]) for x in w)))
    docs += [(100, None), (101, ""), (102, docs[0][1]), (103, "ka " * 3 * length), (104, " ".join(f"u{i}" for i in range(30_000)))]
    df = spark.createDataFrame([(a, b, 1, "c") for a, b in docs], "doc_id long, text string, anchor int, digest string").repartition(4)
    got = {tuple(r) for r in spans.shared_spans(df, length, gram).collect()}
    assert got == brute_spans(docs, length)


def test_units_are_shared_with_offsets(spark):
    a, b, c = (text(random.Random(k), n) for k, n in ((1, 12), (2, 15), (3, 11)))
    docs = [(1, f"é {a}\n\n{b}\n{c}"), (2, f"{b}\tx\n{a.replace(' ', '  ')}\n{c} "), (3, f"short\n{c}"), (4, None), (5, ""), (None, a)]
    df = spark.createDataFrame([(i, x, 1, "d") for i, x in docs], "doc_id long, text string, first int, digest string")
    got = {tuple(r) for r in spans.shared_units(df, 10).collect()}
    assert got == {(1, 28, 38, True), (2, 28, 38, False), (3, 1, 11, False)}
    again = {tuple(r) for r in spans.shared_units(df.unionAll(df.where("doc_id = 1").withColumn("doc_id", F.lit(9).cast("bigint"))), 10).collect()}
    # document, paragraphs and the line of 15 tokens
    assert {x for x in again if x[0] == 9} == {(9, 0, 38, False), (9, 0, 12, False), (9, 13, 38, False), (9, 13, 27, False), (9, 28, 38, False)}
    assert spans.shared_units(df.limit(0), 10).count() == 0


def test_span_edges(spark):
    t = text(random.Random(1), 60)
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (2, "x")], "doc_id long, text string")
    assert spans.shared_spans(df).count() == 0  # one document, however often it is stored
    assert spans.shared_spans(df.limit(0)).count() == 0
    share = {r.doc_id: (r.n_tokens, r.n_shared, r.shared_share) for r in spans.shared_share(spark.createDataFrame([(1, t), (2, None), (3, t)], "doc_id long, text string"), spans.shared_spans(spark.createDataFrame([(1, t), (3, t)], "doc_id long, text string"))).collect()}
    assert share == {1: (60, 60, 1.0), 2: (0, 0, None), 3: (60, 60, 1.0)}


def test_repeated_lines(spark):
    line = "this line is long enough to count as one, surely"
    docs = [(2, f"a\n{line}\nb"), (1, f"{line.upper()}  \n{line}"), (3, None), (4, ""), (5, "short\nshort")]
    df = spark.createDataFrame([(a, b, 3) for a, b in docs], "doc_id long, text string, unit int")
    got = sorted(map(tuple, spans.repeated_lines(df).collect()))
    assert got == [(1, 2, 51, 99, 1, 1), (2, 2, 2, 50, 1, 1)]
    stored = dict(docs)
    for d, _, a, b, *_ in got:
        assert stored[d][a:b] == line
    assert spans.repeated_lines(df.limit(0)).count() == 0
