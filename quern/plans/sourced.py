"""Queries over parsers, sinks and streams (inventories A, B, O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.plans.registry import query
from quern.session import table
from quern.sources import readers, sinks
from quern.streaming import streams


@query(
    r"""WITH l AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE doc_type = 'parallel' AND text IS NOT NULL))),
p AS (SELECT doc_id, i, regexp_extract(line, '^\s*([A-Za-z0-9]+):\s*(.*)$', 1) AS label, trim(regexp_extract(line, '^\s*([A-Za-z0-9]+):\s*(.*)$', 2)) AS v FROM l),
b AS (SELECT *, sum((label = 'ZO')::INT) OVER (PARTITION BY doc_id ORDER BY i) AS block FROM p WHERE label IN ('ZO', 'EN'))
SELECT doc_id AS id, block::BIGINT AS block, min(CASE WHEN label = 'ZO' AND v NOT IN ('', '[Missing]') THEN v END) AS own, min(CASE WHEN label = 'EN' AND v NOT IN ('', '[Missing]') THEN v END) AS other FROM b WHERE block > 0 GROUP BY 1, 2"""
)
def parallel_blocks(spark, d):
    """A10."""
    return readers.parallel_lines(table(spark, d, "documents").where("doc_type = 'parallel'"), "doc_id", "text", {"ZO": "own", "EN": "other"})


@query(
    r"""SELECT id, i AS paragraph_no, left(sha256(p[i]), 16) AS paragraph_id, p[i] AS paragraph FROM (SELECT id, p, unnest(range(1, len(p) + 1)) AS i FROM (
 SELECT id, list_filter(list_transform(string_split_regex(content, '\n\s*\n'), lambda x: trim(x)), lambda x: x <> '') AS p FROM articles WHERE content IS NOT NULL))"""
)
def paragraph_rows(spark, d):
    """A20."""
    return readers.paragraphs(table(spark, d, "articles"), "id", "content")


@query(
    r"""WITH l AS (SELECT id, i AS n, ls[i] AS line FROM (SELECT id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT id, string_split(content, chr(10)) AS ls FROM wiki_content WHERE content IS NOT NULL))),
s AS (SELECT *, last_value(nullif(regexp_extract(line, '^#{1,6}\s+(.*)$', 1), '') IGNORE NULLS) OVER (PARTITION BY id ORDER BY n ROWS UNBOUNDED PRECEDING) AS section FROM l),
k AS (SELECT *, CASE WHEN regexp_matches(line, '^\s*\|.*\|\s*$') THEN 'row' WHEN regexp_matches(line, '^\s*[-*]\s+') THEN 'bullet' END AS kind, trim(regexp_replace(line, '^\s*[-*]\s+', '')) AS item FROM s)
SELECT id, kind, section, row_number() OVER (PARTITION BY id, kind ORDER BY n) AS item_no, item FROM k WHERE kind IS NOT NULL QUALIFY item_no <= CASE WHEN kind = 'row' THEN 50 ELSE 100 END"""
)
def markdown_items(spark, d):
    """A22, A23, A31."""
    return readers.markdown_items(table(spark, d, "wiki_content"), "id", "content")


@query("SELECT id, split_part(source_path, '/', 2) AS category, CASE WHEN contains(source_path, 'grammar') THEN 'grammar' WHEN contains(source_path, 'reference') THEN 'reference' ELSE 'general' END AS lesson_type FROM wiki_content")
def path_categories(spark, d):
    """A21, C48."""
    t = table(spark, d, "wiki_content")
    return t.select("id", F.split("source_path", "/")[1].alias("category"), T.by_substring(F.col("source_path"), [("grammar", "grammar"), ("reference", "reference")], "general").alias("lesson_type"))


@query("SELECT coalesce(CASE WHEN trim(english) NOT IN ('', '-') THEN trim(english) END, CASE WHEN trim(myanmar) NOT IN ('', '-') THEN trim(myanmar) END, CASE WHEN trim(zolai) NOT IN ('', '-') THEN trim(zolai) END) AS first_value, CASE WHEN zolai IS NOT NULL AND pos IS NOT NULL THEN 'dictionary' WHEN zolai IS NOT NULL AND english IS NOT NULL THEN 'parallel' ELSE 'corpus' END AS format, id FROM dictionary_enhanced")
def record_formats(spark, d):
    """Over all rows; '-' is blank, so the next column is taken."""
    t = table(spark, d, "dictionary_enhanced")
    return t.select(F.trim(readers.first_field(t, ["english", "myanmar", "zolai"])).alias("first_value"), readers.record_format(t).alias("format"), "id")


@query("SELECT source, count(*) AS n, sum(length(text))::BIGINT AS chars, sum(length(text) // 3)::BIGINT AS tokens, round(avg(length(text)), 6) AS mean_chars, min(length(text)) AS shortest, max(length(text)) AS longest FROM documents GROUP BY 1")
def dataset_statistics(spark, d):
    """B6, G26."""
    return sinks.statistics(table(spark, d, "documents"), "text", "source")


@query("SELECT zolai, array_to_string(list_sort(array_agg(DISTINCT english))[1:4], ' | ') AS meanings FROM dictionary_enhanced WHERE english IS NOT NULL GROUP BY 1")
def translation_lists(spark, d):
    """B7."""
    return sinks.translation_lists(table(spark, d, "dictionary_enhanced"), "zolai", "english")


@query("SELECT 1000 * 0 + count(*) AS total, count(*) FILTER (lang IS NOT NULL) AS kept, round(100.0 * count(*) FILTER (lang IS NULL) / count(*), 2) AS removed_pct FROM documents")
def build_manifest(spark, d):
    """B5."""
    t = table(spark, d, "documents").select("doc_id", "lang", "doc_type")
    return sinks.manifest(t.where("lang IS NOT NULL"), t, "doc_type").select("total", "kept", "removed_pct")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_windows(spark, d):
    """O1 (extension): hourly windows, equal to the batch result."""
    s = streams.window_counts(streams.file_stream(spark, f"{d}/events.parquet"), "ts", "event_type", "value")
    return streams.run(s, "complete").withColumns({"total": F.round("total", 4), "window_start": F.col("window_start").cast("timestamp_ntz")})


@query("SELECT user_id AS key, count(*) FILTER (value >= 50) AS n_correct FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def stream_reviews(spark, d):
    """Counts kept as state."""
    e = streams.file_stream(spark, f"{d}/events.parquet").where("user_id IS NOT NULL")
    return streams.run(streams.running_count(e, "user_id", F.col("value") >= 50), "update", ["key"])


@query("SELECT event_type, count(*) AS n FROM (SELECT DISTINCT event_id, event_type FROM events) GROUP BY 1")
def stream_distinct(spark, d):
    """Resumable de-duplicated ingest."""
    e = streams.file_stream(spark, f"{d}/events.parquet").select("event_id", "event_type", "ts")
    return streams.run(streams.first_seen(e, "event_id", "ts")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
