"""Literal expectations and edge cases of the core operators."""

import json

import pytest
from pyspark.sql import functions as F

from quern.functions import rules
from quern.functions import text as T
from quern.operators import dedup, filters, joins, knowledge, mutate, patterns, quality, search, stats, training, validation
from quern.plans.queries import Q
from quern.sources import readers, sinks
from quern.streaming import streams


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


CEILINGS = [("GEN", 1, 31), ("GEN", 2, 25), ("1CH", 19, 19), ("3JN", 1, 14), ("JOL", 3, 21)]


@pytest.mark.parametrize(
    ("ref", "valid"),
    [("GEN 1:1", True), ("GEN 1:31", True), ("1CH 19:19", True), ("3JN 1:14", True), ("JOL 3:21", True), ("GEN 2:31", False), ("GEN 1:32", False), ("1CH 19:20", False), ("3JN 1:15", False), ("JOL 4:12", False), ("NOTABOOK 1:1", False), ("", False), (None, False)],
)
def test_refs(spark, ref, valid):
    c = spark.createDataFrame(CEILINGS, "book string, chapter int, ceiling int")
    assert filters.valid_refs(spark.createDataFrame([(ref,)], "ref string"), "ref", c).first().valid is valid


def test_impossible_reference_stops_the_build(spark):
    c = spark.createDataFrame(CEILINGS, "book string, chapter int, ceiling int")
    good = spark.createDataFrame([("GEN 1:1",)], "ref string")
    assert filters.guard_refs(good, "ref", c).count() == 1
    with pytest.raises(ValueError):
        filters.guard_refs(good.unionAll(spark.createDataFrame([("GEN 2:31",)], "ref string")), "ref", c)


def test_token_patterns(spark):
    f = lambda c: patterns.token_patterns(T.tokens(c, "alpha"))
    assert "SOV" in one(spark, "pasian in vantung a piangsak hi", f)
    assert "negation_kei" in one(spark, "ka pai kei hi", f)
    assert "agreement_ka" in one(spark, "ka ne hi", f)
    assert one(spark, "", f) == []
    assert one(spark, None, f) == []


def test_language_and_rewrites(spark):
    assert one(spark, "Pasian in hi leh a piangsak hi", T.language_guess) == "ZO"
    assert one(spark, "The price of the rice", T.language_guess) == "EN"
    assert one(spark, "Pathian, ram (cun)!", T.replace_forms) == "Pasian, gam (tua)!"
    assert one(spark, "a a b b", lambda c: F.array_join(T.drop_repeats(T.words(c)), " ")) == "a b"
    assert one(spark, "ka pai", lambda c: F.array_join(T.end_with_verb(T.words(c)), " ")) == "ka pai hi"
    assert one(spark, "", lambda c: F.size(T.end_with_verb(T.words(c)))) == 0
    assert one(spark, "i pai uh hi", T.plural_rule) == "i pai hi"
    assert one(spark, "gen.1.2", T.dotted_ref) == "GEN 1:2"
    assert one(spark, "v1", T.bump_version) == "v2.0"
    assert one(spark, "odd", T.bump_version) == "v2.0"
    assert one(spark, "v3.0", T.bump_version) == "v4.0"
    assert one(spark, '["a", "က", " "]', T.repair_list) == ["a"]
    assert one(spark, "Anna saw Ann", lambda c: T.mask_names(c, {"Ann": "PERSON"})) == "Anna saw [PERSON]"
    many = {"St. Ann": "PLACE", "Ann": "PERSON", "A(b)": "X$1", "": "NONE"}
    assert one(spark, "St. Ann, Ann, StxAnn and A(b)!", lambda c: T.mask_names(c, many)) == "[PLACE], [PERSON], StxAnn and [X$1]!"
    assert one(spark, "none", lambda c: T.mask_names(c, {})) == "none"
    assert one(spark, "Ram x", lambda c: T.replace_forms(c, {"ram": "g" * 3000})) == "G" + "g" * 2999 + " x"
    assert one(spark, "x &amp; y &foo;", T.unescape_html) == "x & y '"
    assert one(spark, "é", T.nfc) == "é"
    assert one(spark, "Ａ", T.nfkc_squeeze) == "A"
    for f in (T.nfc, T.clean_text, T.deep_clean, T.strip_markup, T.headword):
        assert one(spark, None, f) is None


def test_reasons(spark):
    df = spark.createDataFrame([(1, "### marker text that is long", None), (2, "a fine text that is long enough", None), (3, "a fine  text that is long enough", None), (4, "short", None), (5, "the ram text that is long enough", None), (6, "another fine text long enough", "FCL"), (7, None, None)], "id long, t string, dialect string")
    got = {r.id: r.reason for r in filters.clean_with_reasons(df, "id", "t", "dialect").collect()}
    assert got == {1: "marker", 2: "kept", 3: "duplicate", 4: "short", 5: "dialect", 6: "dialect", 7: "short"}
    assert filters.clean_with_reasons(df.limit(0), "id", "t", "dialect").count() == 0


def test_quality_by_hand(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "aaa bbbb"), (3, "hi hi pasian in tua bang hi leh a pai"), (4, None)], "id long, t string")
    f = {r.id: r for r in quality.features(df, "id", "t").collect()}
    assert f[1].char_repetition == 0.0
    assert f[1].perplexity == 1.0
    assert f[2].char_repetition == 1.0
    assert f[3].word_repetition == pytest.approx(1 / 8)
    assert f[3].language_id == pytest.approx(0.3 / 6 + 0.3 if 3 <= 28 / 10 <= 8 else 0.3 / 6)
    assert f[4].word_count == 0
    assert f[4].perplexity == 1.0


def test_majority(spark):
    v = spark.createDataFrame([(1, "A"), (1, "B"), (1, "A"), (2, "z"), (2, "y"), (3, None)], "k long, v string")
    got = {r.k: (r.winner, r.agreement) for r in stats.majority(v, "k", "v").collect()}
    assert got == {1: ("A", pytest.approx(2 / 3, abs=1e-6)), 2: ("y", 0.5)}


def test_dedup_and_merge(spark):
    df = spark.createDataFrame([(3, "a", ""), (1, "a", None), (2, "a", "x"), (4, None, "y"), (5, None, "z")], "id long, k string, v string")
    assert sorted(r.id for r in dedup.keep_first(df, F.col("k"), ["id"]).collect()) == [1, 4]
    m = dedup.merge_on_key(df, F.col("k"), [F.col("id")], "id", ["v"]).collect()
    assert [(r.key, r.id, r.n, r.v) for r in m] == [("a", 1, 3, "x")]
    assert dedup.keep_first(df.limit(0), F.col("k"), ["id"]).count() == 0


def test_mutations(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c")], "id long, v string")
    assert sorted(map(tuple, mutate.upsert(old, new, ["id"]).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted(map(tuple, mutate.changes(old, new, "id", ["v"]).collect())) == [(2, "v", None, "b")]
    r = mutate.rebuild(spark.createDataFrame([("w", 2, "second"), ("w", 1, "firstlong"), (" ", 3, "x")], "k string, o int, e string"), "k", ["o"], {"e": 5}, {"e": "none"})
    assert [(x.k, x.e) for x in r.collect()] == [("w", "first")]


def test_split_sizes(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    n = {r.split: r["count"] for r in training.split(df, "k").groupBy("split").count().collect()}
    assert n == {"test": 100, "val": 100, "train": 803}
    tiny = {r.split: r["count"] for r in training.split(df.limit(3), "k", least_test=500, least_val=1000).groupBy("split").count().collect()}
    assert tiny == {"test": 3}
    ranks = [r.rank for r in training.digest_rank(df, F.col("k"), "k")[0].collect()]
    assert sorted(ranks) == list(range(1, 1004))


def test_quiz_options_hold_the_answer(spark):
    df = spark.createDataFrame([(i, f"w{i}", f"m{i % 7}") for i in range(300)], "id long, w string, m string")
    for r in training.quiz(df, "id", "w", "m").collect():
        assert r.answer in r.options
        assert len(set(r.options)) == len(r.options)


@pytest.mark.parametrize(("answers", "others"), [(300, 3), (4, 3), (2, 1), (1, 0), (0, 0)])
def test_quiz_has_all_distractors(spark, answers, others):
    rows = [(i, f"w{i}", f"m{i}") for i in range(answers)] + [(1000 + i, f"x{i}", "m0") for i in range(50 if answers else 0)] + [(2000, "y", None), (2001, "y", " ")]
    got = training.quiz(spark.createDataFrame(rows, "id long, w string, m string"), "id", "w", "m").collect()
    assert sorted(r.id for r in got) == [i for i, _, m in rows if m and m.strip()]
    assert all(r.answer in r.options and len(set(r.options)) == len(r.options) == others + 1 for r in got)


def test_cooccurrence_pairs_all_words(spark):
    ws = [f"w{i:02}" for i in range(12)]
    df = spark.createDataFrame([("B", ws), ("B", [*ws, ws[0]]), ("C", ["w00", "w11"]), ("C", ["w00"]), ("C", None)], "book string, ws array<string>")
    got = {(r.book, r.a, r.b): r.n for r in stats.cooccurrence(df, "book", F.col("ws")).collect()}
    assert got == {("C", "w00", "w11"): 1} | {("B", a, b): 2 for a in ws for b in ws if a < b}


def test_first_value_skips_the_dash(spark, tmp_path):
    rows = [(1, "a", "m", "z", "n"), (2, " - ", "m", "z", None), (3, "-", "-", "z", None), (4, None, " ", "z", None), (5, "", "-", "-", None), (6, "x", None, None, None)]
    spark.createDataFrame(rows, "id long, english string, myanmar string, zolai string, pos string").write.parquet(f"{tmp_path}/dictionary_enhanced.parquet")
    got = {r.id: (r.first_value, r.format) for r in Q["record_formats"](spark, str(tmp_path)).collect()}
    assert got == {1: ("a", "dictionary"), 2: ("m", "parallel"), 3: ("z", "parallel"), 4: ("z", "corpus"), 5: (None, "parallel"), 6: ("x", "corpus")}


def test_terms_of_all_entries(spark, tmp_path):
    rows = [(1, "w", "to see; look (at); to see (it);look", None), (2, "gamna", None, "n"), (3, "u", None, None), (4, "u", "b;a;b;c;a", "v")]
    spark.createDataFrame(rows, "id long, zolai string, english string, pos string").write.parquet(f"{tmp_path}/dictionary_enhanced.parquet")
    got = {r.id: (r.term, r.bare, r.meanings, r.pos_shape, r.pos_form) for r in Q["dictionary_terms"](spark, str(tmp_path)).collect()}
    assert got == {
        1: ("to see; look (at); to see (it);look", "w", "to see | look", "phrase", "v"), 2: ("n", "gamna", None, None, "n"),
        3: ("", "u", None, None, None), 4: ("v b;a;b;c;a", "u", "b | a | c", "noun", None),
    }


def test_evidence_reaches_verses(spark, tmp_path):
    spark.createDataFrame([(900, "Gam", "land"), (901, "gam", "country"), (902, "gam  lian a om", "great land"), (903, "zz", None), (904, "-", "x")], "id long, zolai string, english string").write.parquet(f"{tmp_path}/zolai_vocabulary.parquet")
    spark.createDataFrame([(i, "gam lian a om hi") for i in range(1, 13)] + [(13, None)], "id long, zolai_text string").write.parquet(f"{tmp_path}/bible_verses_enhanced.parquet")
    got = sorted(map(tuple, Q["evidence_graph"](spark, str(tmp_path)).collect()))
    ids = [str(i) for i in range(1, 11)]
    assert got == sorted([("gam", "verse", i) for i in ids] + [("gam lian a om", "phrase-verse", i) for i in ids] + [("gam", "meaning", "land"), ("gam", "meaning", "country"), ("gam lian a om", "meaning", "great land")])


def test_phrases_and_families(spark):
    t = spark.createDataFrame([(1, ["a", "b", "a", "b"]), (2, [])], "id long, ws array<string>")
    p = spark.createDataFrame([("a b",), ("b",), ("x",)], "phrase string")
    assert sorted(map(tuple, joins.phrase_hits(t, p).collect())) == [(1, "a b", 2), (1, "b", 2)]
    f = {r.word: r.related for r in joins.families(spark.createDataFrame([(f"stem{i}",) for i in range(9)] + [("alone",), (None,)], "word string")).collect()}
    assert f["stem0"] == ["stem1", "stem2", "stem3", "stem4", "stem5", "stem6"]
    assert f["stem8"] == ["stem0", "stem1", "stem2", "stem3", "stem4", "stem5"]
    assert f["alone"] == []


def test_gloss_is_greedy(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, "B  c x"), (3, None), (4, ""), (5, "a b " * 300)], "id long, t string")
    lex = spark.createDataFrame([("a", "A"), ("a b", "AB"), ("b c", "BC"), ("c", "C"), ("a b c d e f", "long")], "phrase string, gloss string")
    got = {r.id: r.gloss for r in patterns.gloss(df, lex, "id", "t").collect()}
    assert got == {1: "AB C ?", 2: "BC ?", 4: "", 5: " ".join(["AB"] * 300)}
    assert {r.gloss for r in patterns.gloss(df, lex.limit(0), "id", "t").collect()} == {"? ? ? ?", "? ? ?", "", " ".join(["?"] * 600)}


def test_search(spark):
    df = spark.createDataFrame([(1, "goat and maize"), (2, "goat goat"), (3, None)], "id long, t string")
    assert [r.id for r in search.match_all(search.postings(df, "id", "t"), ["goat", "maize"]).collect()] == [1]
    assert [r.id for r in search.retrieve(df, "id", "t", ["goat", "maize"]).collect()] == [1, 2]
    assert search.substring(df, ["t"], "MAIZE").count() == 1


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": 1, "text": "x"}\nnot json\n\n{"id": 2}\n')
    (tmp_path / "master_a.jsonl").write_text('{"id": 9}\n')
    df = readers.read_jsonl(spark, str(tmp_path), "id long, text string", glob="*.jsonl", skip="^master_").cache()
    assert df.where("_corrupt_record IS NULL").count() == 2
    assert df.where("_corrupt_record IS NOT NULL").count() == 1
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(p), "id long, text string", "FAILFAST").collect()
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "news", "a"), (2, "song", "b")], "id long, kind string, text string")
    sinks.write_jsonl(rows, out, ["kind"])
    assert sorted(x.name for x in (tmp_path / "out").iterdir() if x.is_dir()) == ["kind=news", "kind=song"]
    assert sinks.append_once(rows, str(tmp_path / "t"), "id", ["id"]) == 2
    assert sinks.append_once(rows.unionAll(spark.createDataFrame([(3, "x", "c")], rows.schema)), str(tmp_path / "t"), "id", ["id"]) == 1
    m = sinks.manifest(rows, rows.unionAll(rows), "kind").first()
    assert (m.total, m.kept, m.removed_pct, json.loads(m.splits)) == (4, 2, 50.0, {"news": 1, "song": 1})
    assert "license: mit" in sinks.card("x", "mit", ["a"], 3)
    with pytest.raises(ValueError):
        sinks.registry_json({"a": {}})
    assert [r.f for r in sinks.formula_sheet(rows, "id", ["text"], {"f": "gloss"}).collect()] == ['=AI("gloss", A2)', '=AI("gloss", A3)']


def test_parsers(spark):
    md = spark.createDataFrame([(1, "## Chapter 1\n**1:1**\nTDB77: own text\nKJV: other\n**1:2**\nTDB77: [Missing]\n")], "id long, t string")
    got = sorted((r.ref, r.label, r.value or "") for r in readers.verse_blocks(md, "id", "t").collect())
    assert got == [("1:1", "KJV", "other"), ("1:1", "TDB77", "own text"), ("1:2", "TDB77", "")]
    usx = '<usx><book code="GEN"/><chapter number="1"/><para><verse number="1"/>In the <note>x</note>start<verse number="2"/>and</para><para>then</para></usx>'
    rows = readers.usx_verses(spark.createDataFrame([("f", usx), ("g", "<broken")], "id string, t string"), "id", "t").collect()
    assert [(r.book, r.chapter, r.verse, r.text) for r in rows] == [("GEN", 1, 1, "In the start"), ("GEN", 1, 2, "and then")]
    html = '<p>a &amp; b</p><script>no</script><span class="verse" data-n="3">x <b>y</b></span>'
    assert one(spark, html, readers.html_text).startswith("a & b")
    assert [tuple(r) for r in readers.html_verses(spark.createDataFrame([(1, html)], "id long, h string"), "id", "h").collect()] == [(1, 3, "x y")]
    p = one(spark, "### Instruction: Translate this\n### Input: a\n### Response: b", readers.packed_instruction)
    assert (p.instruction, p.input, p.output, p.kind) == ("Translate this", "a", "b", "parallel")
    s = readers.stories(spark.createDataFrame([(1, "intro\n1. First\nka pai hi\n2. Second\nna ne hi\nzo\n")], "id long, t string"), "id", "t").collect()
    assert [(r.story_no, r.title, r.n_lines, r.n_words) for r in s] == [(1, "First", 1, 3), (2, "Second", 2, 4)]


def test_streams_match_batches(spark, tmp_path):
    rows = [(i, i % 3, f"2024-01-01 0{i % 5}:00:00", float(i)) for i in range(50)]
    e = spark.createDataFrame(rows, "event_id long, user_id long, t string, value double").withColumn("ts", F.to_timestamp("t")).drop("t")
    e.unionAll(e).repartition(6).write.parquet(str(tmp_path / "e.parquet"))
    s = streams.file_stream(spark, str(tmp_path / "e.parquet"), 2)
    assert streams.run(streams.first_seen(s, "event_id", "ts")).count() == 50
    n = {r.key: r.n_correct for r in streams.run(streams.running_count(s, "user_id", F.col("value") >= 25), "update", ["key"]).collect()}
    assert n == {k: 2 * sum(1 for i in range(25, 50) if i % 3 == k) for k in range(3)}
    assert streams.run(streams.window_counts(s, "ts", "user_id", "value"), "complete").agg(F.sum("n")).first()[0] == 100


def test_empty_tables(spark):
    e = spark.createDataFrame([], "id long, zolai string, english string, pos string, lang string, text string")
    assert stats.coverage(e, ["zolai"]).first().pct is None
    assert joins.fill_blank(e, e, ("zolai", "zolai"), "english").count() == 0
    assert stats.association(e, T.tokens(F.col("text"), "alpha")).count() == 0
    assert training.split(e, "id").count() == 0
    assert search.tiered(e.select("id", F.col("zolai").alias("word"), F.col("english").alias("meaning")), e.select(F.col("text").alias("q"))).count() == 0


def test_stages(spark, tmp_path):
    from quern.plans.stages import run_stages

    st = {"a": lambda s, read: s.range(3), "b": lambda s, read: read("a").where("id > 0")}
    assert run_stages(spark, str(tmp_path), st) == {"a": "built", "b": "built"}
    assert run_stages(spark, str(tmp_path), st) == {"a": "kept", "b": "kept"}
    assert run_stages(spark, str(tmp_path), st, force=True, only="b") == {"a": "skipped", "b": "built"}
    assert spark.read.parquet(str(tmp_path / "b")).count() == 2


def test_lexicon_edges(spark):
    from quern.operators import lexicon

    v = spark.createDataFrame([(1, "a b", ["a", "b"]), (2, "a " * 6, ["a"] * 6), (3, None, []), (4, "a " * 8, ["a"] * 8)], "id long, text string, ws array<string>")
    w = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "word string")
    assert [(r.word, r.id) for r in lexicon.best_examples(w, v).collect()] == [("a", 2)]
    assert [tuple(r) for r in lexicon.references(spark.createDataFrame([("a", 3), ("a", 1), ("a", 1), ("a", 2), ("a", 9)], "word string, id long")).collect()] == [("a", 5, [1, 2, 3])]
    assert {(r.head, r.near): r.n for r in lexicon.contexts(v, F.col("ws"), ["b"]).collect()} == {("b", "a"): 1}
    r = one(spark, 'Here:\n```json\n{"a": "x"}\n```', lambda c: T.json_answer(c, ["a", "b"]))
    assert (r.a, r.b) == ("x", None)
    assert one(spark, "no json", lambda c: T.json_answer(c, ["a"])).a is None
    assert one(spark, "Title\n\nVerse 1\nka pai\nna pai", lambda c: T.lyric_lines(c, F.lit("title"))) == ["ka pai", "na pai"]


# ---- validation and knowledge


def test_deep_checks(spark):
    v = spark.createDataFrame([("topa in gam mu hi",), ("ka inn lei ding",)], "text string").select(validation.clause_words(F.col("text")).alias("ws"))
    known = spark.createDataFrame([("topa",), ("gam",), ("mu",), ("inn",), ("lei",), (None,)], "word string")
    rows = [
        (1, "Topa in gam mu hi.", False), (2, "topa in inn mu hi", False), (3, "zz in gam pai hi", False), (4, None, False), (5, "Pathian, mu hi ka", True), (6, '"mu hi ka"', True), (7, "gamsak", False), (8, " ".join(["q"] * 500), None),
    ]
    got = {r.id: r.asDict() for r in validation.deep_checks(spark.createDataFrame(rows, "id long, text string, referenced boolean"), known, v).collect()}
    # the word before the first final is the verb, and stands among the words before it
    assert (got[1]["collocation"], got[1]["score"]) == (10, 90)
    assert (got[2]["collocation"], got[2]["score"]) == (10, 90)
    assert (got[3]["unknown"], got[3]["verb_use"]) == (10, 15)
    assert (got[4]["unknown"], got[4]["verb_use"], got[4]["pattern"]) == (0, 5, 5)
    assert (got[5]["forbidden"], got[5]["word_order"], got[5]["pattern"]) == (20, 5, 0)
    assert got[6]["word_order"] == 0
    assert got[7]["unknown"] == 0
    assert got[8]["score"] == 0
    assert validation.deep_checks(spark.createDataFrame([], "id long, text string, referenced boolean"), known, v).count() == 0


def test_translation_rules():
    assert len(rules.TRANSLATION_RULES) == 15


@pytest.mark.parametrize(("text", "named"), [("Khua ah a va pai hi.", ["has_agreement_a", "has_directional_va", "no_forbidden_words"]), ("Hika hong pai in.", ["has_directional_hong", "has_imperative_in", "no_forbidden_words"])])
def test_correct_translations(spark, text, named):
    assert one(spark, text, lambda c: validation.failed_rules(c, named)) == []
    assert one(spark, "x", lambda c: validation.failed_rules(c, named)) == sorted(n for n in named if not n.startswith("no_"))


def test_context_and_routes(spark):
    v = spark.createDataFrame([("GEN", ["aa", "bb"]), ("GEN", ["aa", "cc"])], "book string, ws array<string>")
    s = spark.createDataFrame([(1, "GEN", ["aa", "bb"]), (2, "EXO", ["xx", "yy"]), (3, "GEN", []), (4, None, ["aa"])], "id long, book string, ws array<string>")
    got = {r.id: r.score for r in validation.context_scores(s, spark.createDataFrame([("aa",), ("bb",)], "word string"), v).collect()}
    assert got == {1: 100.0, 2: 40.0, 3: 0.0, 4: 80.0}
    o = validation.override(spark.createDataFrame([(1, 50.0), (9, 7.0)], "id long, score double"), spark.createDataFrame([(1, 60.0)], "id long, score double"))
    assert {tuple(r) for r in o.collect()} == {(1, 60.0, True), (9, 7.0, False)}
    d = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "worse")], "id long, t string")
    r = validation.route(d, "t", lambda c: F.when(c == "good", 90).otherwise(10), lambda c: F.replace(c, F.lit("bad"), F.lit("good")), 80)
    assert {(x.id, x.route, x.before, x.after) for x in r.collect()} == {(1, "valid", 90, 90), (2, "corrected", 10, 90), (3, "invalid", 10, 10)}


def test_sources_join_and_versions(spark):
    rows = spark.createDataFrame([("a", 2, 1, "y", "late", 5), ("a", 1, 9, "x", " ", 3), ("a", 1, 10, "x", "first", None), (None, 1, 1, "x", "z", 1)], "key string, priority int, ord long, source string, english string, n int")
    assert [tuple(r) for r in knowledge.source_union(rows, ["english"], ["n"]).collect()] == [("a", "x", ["x", "y"], "first", 5)]
    d = spark.createDataFrame([(1, "a", "m"), (2, "a", "m"), (3, "a", None), (4, "a", None), (5, " ", "m"), (6, " ", "m")], "id long, zolai string, myanmar string")
    assert {r.id for r in knowledge.drop_later(d, ["zolai", "myanmar"], "id").collect()} == {1, 3, 4, 5, 6}
    p = knowledge.provenance_state(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, d string"), spark.createDataFrame([("a", "0"), ("a", "1"), ("b", "9"), (None, "3")], "k string, d string"), "k", "d")
    assert {tuple(r) for r in p.collect()} == {("a", "skip"), ("b", "replace"), ("c", "new")}
    e = spark.createDataFrame([(1, " N ", "v1.2"), (2, "n", "v1.2"), (3, None, None)], "id long, pos string, v string")
    got = {r.id: (r.pos, r.v, r.notes) for r in knowledge.new_versions(e, {"pos": F.lower(F.trim("pos"))}, "v", "notes").collect()}
    assert got == {1: ("n", "v2.0", "pos:  N  -> n"), 2: ("n", "v1.2", None), 3: (None, None, None)}
    t = knowledge.FillTask("t", "en", "w", "w IS NOT NULL", "Say {w} ({x}).")
    f = spark.createDataFrame([("a", None, "1"), ("a", "-", None), ("b", "ok", "2"), (None, None, "3")], "w string, en string, x string")
    assert [tuple(r) for r in t.pending(f).collect()] == [("t", "a", "Say a ().")]
    filled = t.apply(f, spark.createDataFrame([("t", "a", "A"), ("t", "a", "B"), ("u", "b", "no")], "task string, key string, answer string"))
    assert sorted(str(r.en) for r in filled.collect()) == ["A", "A", "None", "ok"]
    assert knowledge.report_markdown("T", [("s", "m", 2.0), ("r", "k", 1.5)]) == "# T\n\n## r\n\n| metric | value |\n|---|---|\n| k | 1.5 |\n\n## s\n\n| metric | value |\n|---|---|\n| m | 2 |\n"
    assert [one(spark, w, knowledge.syllables) for w in ("pasian", "khuang", "nga", "zo-en", "strip", "")] == [["pa", "sian"], ["khuang"], ["nga"], ["zo", "en"], ["strip"], []]


def test_tables_belong_to_a_scope(spark):
    import os

    from quern import session

    df = session.cut_lineage(spark.range(3))
    with session.scope():
        inner = session.cut_lineage(spark.range(5))
        path = session._written[-1][1]
        assert inner.count() == 5
        assert os.path.isdir(path)
    assert not os.path.isdir(path)
    assert df.count() == 3


def test_song_layouts(spark):
    files = [("/x/Hymns/12 - A song.txt", "ka pai\n"), ("/x/Hymns/A song.txt", "again"), ("/x/Youth/B_7.txt", "tu"), ("/x/Book/all.txt", "1. One\nx\ny\n2. Two\nz\n")]
    df = spark.createDataFrame([(p, p.rsplit("/", 1)[1], t) for p, t in files], "path string, name string, text string")
    assert sorted(map(tuple, readers.song_files(df).collect()), key=str) == [("Book", 1, "One", "x\ny"), ("Book", 2, "Two", "z"), ("Hymns", 12, "A song", "ka pai"), ("Youth", 7, "B", "tu")]


def test_ordered_split(spark):
    df = spark.range(1, 11).withColumn("split", F.lit("own"))
    got = {r.id: r.split for r in training.ordered_split(df, "id", [("train", 0.8), ("val", 0.1), ("test", 0.1)]).collect()}
    assert got == {**{i: "train" for i in range(1, 9)}, 9: "val", 10: "test"}
    assert training.ordered_split(df.limit(0), "id", [("train", 1.0)]).count() == 0


def test_line_flags(spark):
    df = spark.createDataFrame([(1, "ka pai hi uh"), (2, "the hi"), (3, "### x"), (4, None), (5, "LOREM ipsum text"), (6, "# a hi in"), (7, "မြန်မာ စာ")], "id long, t string")
    got = {r.id: tuple(r)[1:] for r in df.select("id", *filters.line_flags(F.col("t"), ["hi"], ["lorem ipsum"])).collect()}
    assert got == {1: (True, False, False, False), 2: (False, False, False, False), 3: (False, False, True, False), 4: (False, False, True, False), 5: (False, True, False, False), 6: (False, False, False, False), 7: (False, False, False, True)}
    assert [one(spark, w, filters.english_headword) for w in ("the", "nation", "thought", "kei")] == [True, True, True, False]
