"""Queries that write with the sinks, read back with the readers and must give what was written (inventories A, B, C, J, L, M, O, P).

Everything goes to the folder that all executors share and vanishes with the scope of the query.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quern.functions import text as T
from quern.operators import mutate, training
from quern.plans.registry import query
from quern.session import scratch, table
from quern.sources import readers, sinks

SONG = "id bigint, collection string, song_number int, title string, text string"


@query("SELECT id, collection, song_number, title, text FROM zolai_songs")
def jsonl_lines(spark, d):
    """A1, A3, A4, B1: JSON lines there and back, with an explicit schema; a bad line would raise."""
    path = scratch(spark)
    sinks.write_jsonl(table(spark, d, "zolai_songs").select("id", "collection", "song_number", "title", "text"), path)
    return readers.read_jsonl(spark, path, SONG, "FAILFAST")


@query("SELECT count(*) FILTER (text IS NOT NULL) AS good, count(*) FILTER (text IS NULL) AS bad FROM zolai_songs")
def jsonl_tolerant(spark, d):
    """A2: lines cut short are kept apart and can be counted; blank lines don't count."""
    path = scratch(spark)
    s = table(spark, d, "zolai_songs")
    line = F.when(F.col("text").isNotNull(), F.to_json(F.struct("id", "title"))).otherwise(F.concat(F.lit('{"id": '), "id", F.lit(', "title": "')))
    s.select(F.explode(F.array(line, F.lit(""))).alias("value")).write.text(path)
    got = readers.read_jsonl(spark, path, "id bigint, title string").select("id", readers.CORRUPT)
    return got.agg(F.count_if(F.col(readers.CORRUPT).isNull() & F.col("id").isNotNull()).alias("good"), F.count(readers.CORRUPT).alias("bad"))


@query("SELECT source, id, word FROM (SELECT 'entries' AS source, id, headword AS word FROM entries UNION ALL SELECT 'dictionary', id, zolai FROM dictionary_enhanced)")
def jsonl_many_sources(spark, d):
    """A5: several folders at once, told apart by their path; files that the pattern skips are left out."""
    base = scratch(spark)
    sinks.write_jsonl(table(spark, d, "entries").select("id", F.col("headword").alias("word")), f"{base}/entries")
    sinks.write_jsonl(table(spark, d, "dictionary_enhanced").select("id", F.col("zolai").alias("word")), f"{base}/dictionary")
    got = readers.read_jsonl(spark, [f"{base}/entries", f"{base}/dictionary"], "id bigint, word string", "FAILFAST", "*.json", r"^_").withColumn("path", F.col("_metadata.file_path"))
    return got.select(F.regexp_extract("path", r"([a-z]+)/[^/]+$", 1).alias("source"), "id", "word")


@query("SELECT wiki_category, count(*) AS n, sum(word_count)::BIGINT AS words FROM wiki_content WHERE wiki_category IS NOT NULL GROUP BY 1")
def json_documents(spark, d):
    """One JSON document in a file, over several lines."""
    path = scratch(spark)
    w = table(spark, d, "wiki_content").where("wiki_category IS NOT NULL").groupBy("wiki_category").agg(F.count(F.lit(1)).alias("n"), F.sum("word_count").alias("words"))
    w.select("wiki_category", F.concat(F.lit('{\n "n": '), "n", F.lit(',\n "words": '), "words", F.lit("\n}")).alias("value")).repartition("wiki_category").write.partitionBy("wiki_category").text(path)
    return readers.read_json_docs(spark, path, "n bigint, words bigint, wiki_category string").select("wiki_category", "n", "words")


@query("SELECT regexp_replace(lower(collection), '[^a-z]+', '_', 'g') AS collection, count(*) AS n_songs FROM (SELECT DISTINCT collection, song_number, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title FROM zolai_songs WHERE collection IS NOT NULL AND title IS NOT NULL AND song_number IS NOT NULL) GROUP BY 1")
def song_collections(spark, d):
    """A text file of numbered sections for each collection, read whole; songs counted by number and title."""
    path = scratch(spark)
    s = table(spark, d, "zolai_songs").where("collection IS NOT NULL AND title IS NOT NULL AND song_number IS NOT NULL")
    s = s.select(F.regexp_replace(F.lower("collection"), "[^a-z]+", "_").alias("collection"), "song_number", F.trim(F.regexp_replace("title", r"\s+", " ")).alias("title")).distinct()
    # a title may have several numbers, so the number is part of it here
    s.select("collection", F.format_string("%d. %d %s\nline", "song_number", "song_number", "title").alias("value")).repartition("collection").write.partitionBy("collection").text(path)
    got = readers.song_files(readers.read_files(spark, path, "*.txt"))
    return got.groupBy(F.regexp_replace("collection", "^collection=", "").alias("collection")).agg(F.count(F.lit(1)).alias("n_songs"))


_STOP2 = "len(list_filter(w, lambda x: x IN ('a', 'ah', 'ahin', 'hi', 'hin', 'i', 'in', 'na', 'nae', 'nei', 'ning', 'ni', 'nu', 'nung', 'pe', 'pen', 'pi', 'pin', 'po', 'sak', 'si', 'sin', 'su', 'te', 'thei', 'ti', 'tu', 'tua', 'un', 'unga', 'ungah', 'vei', 'veh', 'vnge', 'zong', 'zonga'))) >= 2"


@query(
    rf"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM zolai_songs WHERE text IS NOT NULL), w AS (SELECT line, list_filter(string_split_regex(lower(line), '\s+'), lambda x: x <> '') AS w FROM l WHERE line <> '')
SELECT line, CASE WHEN regexp_matches(lower(line), '(^|\s)(hen|un|uh)[.!?]*$') THEN 'formal' ELSE 'casual' END AS register, len(w)::INT AS word_count FROM w WHERE (regexp_matches(line, '[က-႟]') OR {_STOP2}) AND len(w) >= 2"""
)
def conversation_lines(spark, d):
    """Text lines written and read back, with register."""
    path = scratch(spark)
    table(spark, d, "zolai_songs").where("text IS NOT NULL").select(F.explode(F.split("text", "\n")).alias("value")).where("value <> ''").write.text(path)
    return readers.conversation_lines(readers.read_lines(spark, path), "line").drop("context")


@query(r"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(zolai), '[\p{L}]+')) AS word FROM zolai_vocabulary WHERE zolai IS NOT NULL) GROUP BY 1")
def wordlist_counts(spark, d):
    """A TSV with a header and its candidate words."""
    path = scratch(spark)
    sinks.write_csv(table(spark, d, "zolai_vocabulary").select("id", "zolai", "pos"), path, "\t")
    return readers.read_wordlist(spark, path, "zolai").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, lang, doc_type, text FROM documents")
def table_folders(spark, d):
    """A partitioned Parquet table there and back; a second write replaces the first as a whole."""
    path = scratch(spark)
    t = table(spark, d, "documents").select("doc_id", "lang", "doc_type", "text")
    sinks.write_table(t.limit(1), path, ["doc_type"])
    sinks.write_table(t, path, ["doc_type"])
    return spark.read.schema("doc_id bigint, lang string, doc_type string, text string").parquet(path)


@query("SELECT 'Source: ' || zolai_text || chr(10) || 'English: ' || english_text AS text FROM bible_verses_enhanced WHERE zolai_text IS NOT NULL AND english_text IS NOT NULL")
def rendered_texts(spark, d):
    """Rendered training texts as JSON lines."""
    path = scratch(spark)
    v = table(spark, d, "bible_verses_enhanced").where("zolai_text IS NOT NULL AND english_text IS NOT NULL")
    sinks.write_texts(v, path, training.render(F.lit("parallel"), F.col("zolai_text"), F.col("english_text")))
    return readers.read_jsonl(spark, path, "text string", "FAILFAST")


_FIRST = "SELECT book, chapter, verse, {0} AS t FROM bible_verses_enhanced WHERE {0} IS NOT NULL AND trim(regexp_replace({0}, '\\s+', ' ', 'g')) NOT IN ('', '-') QUALIFY row_number() OVER (PARTITION BY book, chapter, verse ORDER BY id) = 1"


def _chapters(spark, d, column: str, verse: str):
    """``ref, value``: for each chapter its verses, each rendered by a format with %d and %s, in order."""
    from quern.operators.dedup import first_rows

    v = table(spark, d, "bible_verses_enhanced").where(~T.blank(F.col(column))).select("id", "book", "chapter", "verse", F.col(column).alias("t"))
    v = first_rows(v, ["book", "chapter", "verse"], [F.col("id")])
    text = F.replace(F.replace(F.replace(F.translate("t", "\r\n", "  "), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    each = F.struct("verse", F.format_string(verse, "verse", text).alias("x"))
    g = v.groupBy("book", "chapter").agg(F.sort_array(F.collect_list(each)).alias("vs"))  # one chapter of one version
    return g.select(F.concat_ws(".", "book", "chapter").alias("ref"), "book", "chapter", F.array_join(F.transform("vs", lambda x: x["x"]), "").alias("value"))


@query(rf"SELECT book || '.' || chapter AS id, book, chapter, verse, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM ({_FIRST.format('zolai_text')})")
def usx_chapters(spark, d):
    """Chapters as USX documents, parsed as trees."""
    c = _chapters(spark, d, "zolai_text", '<verse number="%d" style="v"/>%s <note>not this</note>')
    x = F.concat(F.lit('<usx version="3.0"><book code="'), "book", F.lit('" style="id"/><chapter number="'), "chapter", F.lit('" style="c"/><para style="p">'), "value", F.lit("</para></usx>"))
    return readers.usx_verses(c.select("ref", x.alias("x")), "ref", "x")


@query(rf"SELECT book || '.' || chapter AS id, verse, trim(regexp_replace(regexp_replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[​-‍⁠﻿]|<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS text FROM ({_FIRST.format('english_text')})")
def html_chapters(spark, d):
    """Stored JSON pages with the chapter's HTML."""
    c = _chapters(spark, d, "english_text", '<span class="verse" data-n="%d">%s</span>')
    return readers.page_verses(c.select("ref", F.to_json(F.struct(F.col("value").alias("content"))).alias("page")), "ref", "page")


@query(
    rf"""WITH v AS (SELECT book, chapter, verse, trim(translate(z.t, chr(13) || chr(10), '  ')) AS t FROM ({_FIRST.format('zolai_text')}) z)
SELECT book || '.' || chapter AS id, chapter || ':' || verse AS ref, 'ZO' AS label, CASE WHEN replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') <> '[Missing]' THEN replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') END AS value FROM v"""
)
def marked_verses(spark, d):
    """Markdown with verse markers."""
    c = _chapters(spark, d, "zolai_text", "**CH:%d**\nZO: %s\n")
    return readers.verse_blocks(c.select("ref", F.replace("value", F.lit("**CH:"), F.concat(F.lit("**"), F.col("chapter").cast("string"), F.lit(":"))).alias("value")), "ref", "value")


@query(r"SELECT id, trim(title) AS title, date, link, len(list_filter(string_split_regex(content, '\s+'), lambda w: w <> ''))::INT AS word_count FROM articles WHERE content IS NOT NULL AND title IS NOT NULL")
def crawl_pages(spark, d):
    """Stored pages of a crawl, ten posts each."""
    a = table(spark, d, "articles").where("content IS NOT NULL AND title IS NOT NULL")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    box = lambda c: F.struct(F.concat(F.lit("<p>"), esc(F.col(c)), F.lit("</p>")).alias("rendered")).alias(c)
    pages = a.groupBy(F.floor(F.col("id") / 10).alias("page")).agg(F.to_json(F.collect_list(F.struct("id", box("title"), "date", "link", "tags", box("content")))).alias("json"))
    return readers.posts(pages, "json").select("id", "title", "date", "link", "word_count")


@query(r"SELECT item_id, nullif(trim(regexp_replace(question, '^\s+|\s+$', '', 'g')), '') AS instruction, nullif(trim(regexp_replace(answer, '^\s+|\s+$', '', 'g')), '') AS output FROM eval_items WHERE question IS NOT NULL AND answer IS NOT NULL AND NOT contains(question || answer, '###')")
def packed_instructions(spark, d):
    """Packed instruction texts taken apart."""
    e = table(spark, d, "eval_items").where("question IS NOT NULL AND answer IS NOT NULL AND NOT contains(concat(question, answer), '###')")
    p = readers.packed_instruction(F.concat(F.lit("### Instruction:\n"), "question", F.lit("\n### Response:\n"), "answer"))
    return e.select("item_id", p.alias("p")).select("item_id", "p.instruction", "p.output")


@query(r"SELECT id, 1 AS story_no, trim(regexp_replace(title, '\s+', ' ', 'g')) AS title, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))::INT AS n_lines FROM zolai_songs WHERE title IS NOT NULL AND text IS NOT NULL AND NOT regexp_matches(text, '(?m)^[0-9]+\.\s')")
def story_parts(spark, d):
    """Texts under numbered headers."""
    s = table(spark, d, "zolai_songs").where("title IS NOT NULL AND text IS NOT NULL").where(~F.col("text").rlike(r"(?m)^[0-9]+\.\s"))
    s = s.select("id", F.concat(F.lit("1. "), F.trim(F.regexp_replace("title", r"\s+", " ")), F.lit("\n"), "text").alias("t"))
    return readers.stories(s, "id", "t").select("id", "story_no", "title", "n_lines")


@query("SELECT zolai, english, '=AI(\"Explain\", A' || (row_number() OVER (ORDER BY id) + 1) || ')' AS explain FROM (SELECT id, zolai, english FROM zolai_vocabulary ORDER BY frequency_bible DESC NULLS LAST, id LIMIT 100)")
def formula_sheet(spark, d):
    """A sheet of the hundred most frequent words (a sheet is a top-k) with one formula column."""
    top = table(spark, d, "zolai_vocabulary").orderBy(F.col("frequency_bible").desc_nulls_last(), "id").limit(100)
    return sinks.formula_sheet(top.select("id", "zolai", "english"), "id", ["zolai", "english"], {"explain": "Explain"})


@query(
    """WITH r AS (SELECT lower(trim(zolai)) AS zolai, left(english, 20) AS english, coalesce(pos, 'pending') AS pos, id FROM dictionary_enhanced WHERE trim(coalesce(zolai, '')) <> '')
SELECT zolai, english, pos FROM r QUALIFY row_number() OVER (PARTITION BY zolai ORDER BY id) = 1"""
)
def rebuilt_table(spark, d):
    """A table rebuilt from JSON lines: first record per headword, long values clipped, defaults filled."""
    path = scratch(spark)
    sinks.write_jsonl(table(spark, d, "dictionary_enhanced").select("id", F.lower(F.trim("zolai")).alias("zolai"), "english", "pos"), path)
    rows = readers.read_jsonl(spark, path, "id bigint, zolai string, english string, pos string", "FAILFAST")
    return mutate.rebuild(rows, "zolai", ["id"], {"english": 20}, {"pos": "pending"}).select("zolai", "english", "pos")


@query("SELECT '---' || chr(10) || 'pretty_name: corpus' || chr(10) || 'license: cc-by-4.0' || chr(10) || 'tags:' || chr(10) || '- text' || chr(10) || '---' || chr(10) || chr(10) || '# corpus' || chr(10) || chr(10) || count(*) || ' rows.' || chr(10) AS card, '{\"corpus\": {\"licence\": \"cc-by-4.0\", \"path\": \"documents\", \"tags\": [\"text\"]}}' AS registry FROM documents")
def dataset_card(spark, d):
    """The card and the registry entry of the documents (uploads are left out)."""
    n = table(spark, d, "documents").count()
    reg = sinks.registry_json({"corpus": {"path": "documents", "licence": "cc-by-4.0", "tags": ["text"]}})
    return spark.createDataFrame([(sinks.card("corpus", "cc-by-4.0", ["text"], n), reg)], "card string, registry string")


NAMES = {"the council": "GROUP", "council": "PERSON", "village": "PLACE"}


_MARK = r"regexp_replace({0}, '([^\p{{L}}\p{{N}}])(the  council|council|village)([^\p{{L}}\p{{N}}])', '\1Ā\2Ā\3', 'g')"


@query(
    # neighbours share the character between them, hence twice; the marks are letters, so that nothing is marked again
    f"""SELECT id, trim(replace(replace(replace(regexp_replace({_MARK.format(_MARK.format("' ' || replace(english_text, ' ', '  ') || ' '"))}, '  ', ' ', 'g'), 'Āthe councilĀ', '[GROUP]'), 'ĀcouncilĀ', '[PERSON]'), 'ĀvillageĀ', '[PLACE]')) AS masked
FROM bible_verses_enhanced WHERE english_text IS NOT NULL AND NOT regexp_matches(english_text, 'Ā|  ')"""
)
def masked_names(spark, d):
    """Names of a gazetteer masked by their label, the longest first; texts with double spaces can't be told in SQL and are left to the tests."""
    v = table(spark, d, "bible_verses_enhanced").where("english_text IS NOT NULL").where(~F.col("english_text").rlike("Ā|  "))
    return v.select("id", F.trim(T.mask_names(F.col("english_text"), NAMES)).alias("masked"))


@query(
    r"""SELECT id, CASE WHEN lower(language) = 'tedim' OR language = 'Tedim_Chin' THEN 'Tedim' ELSE language END AS dialect,
 regexp_replace(lower(content), '^(i [^.,;!?]*?) uh( hi)?$', '\1\2') AS plural, upper('gen') || ' ' || word_count || ':' || id AS ref, len(regexp_extract_all(title, '[a-z]')) AS small FROM articles"""
)
def text_repairs(spark, d):
    """C16, C22, C24."""
    a = table(spark, d, "articles")
    return a.select(
        "id", T.canonical_dialect(F.col("language")).alias("dialect"), T.plural_rule(F.lower("content")).alias("plural"), T.dotted_ref(F.concat_ws(".", F.lit("gen"), "word_count", "id")).alias("ref"),
        F.regexp_count("title", F.lit("[a-z]")).cast("bigint").alias("small"),
    )


@query(r"SELECT id, array_to_string(list_filter(tags, lambda t: NOT regexp_matches(t, '[က-႟]') AND trim(t) <> ''), ' | ') AS items FROM articles WHERE len(list_filter(tags, lambda t: NOT regexp_matches(t, '[က-႟]') AND trim(t) <> '')) > 0")
def repaired_lists(spark, d):
    """Lists stored as text."""
    a = table(spark, d, "articles").select("id", T.repair_list(F.to_json("tags")).alias("items"))
    return a.where("items IS NOT NULL").select("id", F.array_join("items", " | ").alias("items"))


@query(r"SELECT id, array_to_string(list_transform(list_filter(string_split_regex(title, '\s+'), lambda w: w <> ''), lambda w: CASE WHEN lower(w) = 'word' THEN 'WORD' WHEN lower(w) = 'school' THEN 'School' ELSE w END), ' ') AS title FROM articles WHERE title IS NOT NULL AND NOT regexp_matches(title, '[^A-Za-z ]')")
def recased_titles(spark, d):
    """Names in their own spelling."""
    a = table(spark, d, "articles").where("title IS NOT NULL").where(~F.col("title").rlike("[^A-Za-z ]"))
    return a.select("id", T.recase(F.col("title"), {"word": "WORD", "school": "School"}).alias("title"))


@query("SELECT id, zolai AS word, NULL::VARCHAR AS note, confidence::VARCHAR AS confidence FROM dictionary_enhanced")
def conformed_rows(spark, d):
    """Rows in a wanted schema: cast, missing columns as NULL."""
    want = StructType([StructField("id", LongType()), StructField("word", StringType()), StructField("note", StringType()), StructField("confidence", StringType())])
    return readers.conform(table(spark, d, "dictionary_enhanced").withColumnRenamed("zolai", "word"), want)


@query("SELECT id, min(zolai) AS zolai FROM (SELECT id, zolai FROM zolai_vocabulary) GROUP BY 1")
def appended_once(spark, d):
    """An append-only table: a second run over all rows appends only what the first lacks."""
    path = scratch(spark)
    v = table(spark, d, "zolai_vocabulary").select("id", "zolai", "created_at")
    sinks.append_once(v.where("created_at < TIMESTAMP_NTZ'2024-06-01'").select("id", "zolai"), path, "id", ["zolai"])
    sinks.append_once(v.select("id", "zolai"), path, "id", ["zolai"])
    return spark.read.parquet(path).select("id", "zolai")


WORDS, LINKS = {"village": "hamlet", "storm": "gale"}, {"and": "plus"}


@query(r"SELECT id, array_to_string(list_transform(list_filter(string_split_regex(lower(english_text), '\s+'), lambda w: w <> ''), lambda w: CASE w WHEN 'village' THEN 'hamlet' WHEN 'storm' THEN 'gale' WHEN 'and' THEN 'plus' WHEN 'village.' THEN 'hamlet.' WHEN 'storm.' THEN 'gale.' WHEN 'and.' THEN 'plus.' WHEN 'village,' THEN 'hamlet,' WHEN 'storm,' THEN 'gale,' WHEN 'and,' THEN 'plus,' ELSE w END), ' ') AS other FROM bible_verses_enhanced WHERE english_text IS NOT NULL AND NOT regexp_matches(english_text, '[^A-Za-z ,.]')")
def paraphrases(spark, d):
    """L23, levels 1 and 2."""
    v = table(spark, d, "bible_verses_enhanced").where("english_text IS NOT NULL").where(~F.col("english_text").rlike("[^A-Za-z ,.]"))
    return v.select("id", training.paraphrase(F.lower("english_text"), WORDS, LINKS).alias("other"))
