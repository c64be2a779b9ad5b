"""Sources and parsers (inventory A). Readers are lazy; parsers work on a text column, one shuffle at most."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.functions import text as T

CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, mode: str = "PERMISSIVE", glob: str | None = None, skip: str | None = None) -> DataFrame:
    """JSON lines with an explicit schema. FAILFAST raises on a bad line; PERMISSIVE keeps it in
    ``_corrupt_record``, so that drops can be counted; blank lines are skipped. ``glob`` names the
    files to take, ``skip`` a pattern of file names to leave out."""
    s = schema if mode != "PERMISSIVE" else f"{schema}, {CORRUPT} string"
    r = spark.read.schema(s).option("mode", mode)
    if mode == "PERMISSIVE":
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.json(path)
    return df.where(~F.col("_metadata.file_name").rlike(skip)) if skip else df


def read_json_docs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document per file; unreadable files are skipped."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("ignoreCorruptFiles", True).json(path)


def read_files(spark: SparkSession, path: str, glob: str = "*", skip: str | None = None) -> DataFrame:
    """Whole text files as ``path, name, text``."""
    df = spark.read.option("wholetext", True).option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    df = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    return df.where(~F.col("path").rlike(skip)) if skip else df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def read_wordlist(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A TSV with a header; the clean candidate words of one column, one per row."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    return df.select(F.explode(F.regexp_extract_all(F.lower(F.col(column)), F.lit(r"[\p{L}]+"), F.lit(0))).alias("word"))


def read_jdbc(spark: SparkSession, url: str, query: str, driver: str, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A query over JDBC, read in ranges of a numeric column if given (column, low, high, parts)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q").option("driver", driver)
    if partition:
        c, lo, hi, n = partition
        r = r.option("partitionColumn", c).option("lowerBound", lo).option("upperBound", hi).option("numPartitions", n)
    return r.load()


def first_field(df: DataFrame, names: list[str]) -> Column:
    """The first of several columns that exists and isn't blank."""
    have = [T.nullif_blank(F.col(n)) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def record_format(df: DataFrame) -> Column:
    """Instruction, parallel, dictionary or corpus, by which columns have values."""
    has = lambda c: F.col(c).isNotNull() if c in df.columns else F.lit(False)
    return F.when(has("instruction"), "instruction").when(has("zolai") & has("pos"), "dictionary").when(has("zolai") & has("english"), "parallel").otherwise("corpus")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns, cast; missing ones as NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def lines_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n, line``: the lines of each text with their ordinal."""
    return df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.posexplode(F.split(text_col, "\n")).alias("n", "line"))


def parallel_lines(df: DataFrame, id_col: str, text_col: str, labels: dict[str, str]) -> DataFrame:
    """A10: ``LABEL: text`` lines grouped into numbered blocks; a block begins with the first label. One column per label.

    Blocks are numbered by a running count within a text; lines before the first block are dropped.
    """
    first = next(iter(labels))
    ls = lines_of(df, id_col, text_col)
    parsed = ls.select("id", "n", F.regexp_extract("line", r"^\s*([A-Za-z0-9]+):\s*(.*)$", 1).alias("label"), F.trim(F.regexp_extract("line", r"^\s*([A-Za-z0-9]+):\s*(.*)$", 2)).alias("value"))
    parsed = parsed.where(F.col("label").isin(list(labels)))
    w = Window.partitionBy("id").orderBy("n")
    parsed = parsed.withColumn("block", F.sum((F.col("label") == first).cast("int")).over(w)).where("block > 0")
    value = F.when(~F.col("value").isin("", "[Missing]"), F.col("value"))
    return parsed.groupBy("id", "block").agg(*[F.min(F.when(F.col("label") == k, value)).alias(name) for k, name in labels.items()])


def verse_blocks(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Markdown with ``**c:v**`` markers and ``LABEL: text`` lines: ``id, ref, label, value``; markers are carried forward."""
    ls = lines_of(df, id_col, text_col)
    ref = F.nullif(F.regexp_extract("line", r"\*\*([0-9]+:[0-9]+)\*\*", 1), F.lit(""))
    w = Window.partitionBy("id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    ls = ls.withColumn("ref", F.last(ref, ignorenulls=True).over(w))
    rows = ls.select("id", "ref", F.regexp_extract("line", r"^([A-Za-z0-9]+):\s*(.+)$", 1).alias("label"), F.trim(F.regexp_extract("line", r"^([A-Za-z0-9]+):\s*(.+)$", 2)).alias("value"))
    return rows.where("ref IS NOT NULL AND label <> ''").withColumn("value", F.when(F.col("value") != "[Missing]", F.col("value")))


def usx_verses(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """USX documents as ``id, book, chapter, verse, text``; notes left out, paragraphs of a verse joined.

    The element tree is walked per document in Arrow batches; a document that isn't XML gives no row.
    """

    def walk(xml: str):
        try:
            root = ET.fromstring(xml)
        except ET.ParseError:
            return
        book = (root.find("book").get("code") if root.find("book") is not None else None) or ""
        chapter = verse = 0
        out: dict[tuple[int, int], list[str]] = {}

        def add(s):
            if s and verse:
                out.setdefault((chapter, verse), []).append(s)

        def visit(node):
            nonlocal chapter, verse
            if node.tag == "note":
                add(node.tail)
                return
            if node.tag == "chapter" and node.get("number"):
                chapter, verse = int(node.get("number")), 0
            elif node.tag == "verse" and node.get("number"):
                verse = int(node.get("number").split("-")[0])
            elif node.tag != "book":
                add(node.text)
            for child in node:
                visit(child)
            add(node.tail if node is not root else None)

        visit(root)
        for (c, v), parts in out.items():
            yield book, c, v, re.sub(r"\s+", " ", " ".join(parts), flags=re.ASCII).strip(" ")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, *r) for i, x in zip(b["id"], b["x"]) if x for r in walk(x)]
            yield pd.DataFrame(rows, columns=["id", "book", "chapter", "verse", "text"])

    return df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("x")).mapInPandas(run, "id string, book string, chapter int, verse int, text string")


def html_text(c: Column) -> Column:
    """Tags become line breaks, entities are resolved, blank lines thinned."""
    c = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</\1>", "")
    c = T.unescape_html(F.regexp_replace(c, "<[^>]+>", "\n"))
    c = F.regexp_replace(F.regexp_replace(c, r"[ \t]*\n[ \t]*", "\n"), r"\n{3,}", "\n\n")
    return T.strip(c)


def html_verses(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """``id, verse, text`` of ``<span class="verse" data-n="..">`` elements."""
    p = r'<span class="verse" data-n="([0-9]+)">(.*?)</span>'
    hits = F.arrays_zip(F.regexp_extract_all(F.col(html_col), F.lit(p), F.lit(1)).alias("n"), F.regexp_extract_all(F.col(html_col), F.lit(p), F.lit(2)).alias("t"))
    return df.select(F.col(id_col).alias("id"), F.explode(hits).alias("h")).select("id", F.col("h.n").cast("int").alias("verse"), T.strip_markup(F.col("h.t")).alias("text"))


def page_verses(df: DataFrame, id_col: str, json_col: str, field: str = "content") -> DataFrame:
    """Verses of stored pages, each a JSON object with the chapter's HTML in ``field``: ``id, verse, text``; a page that isn't JSON gives none."""
    return html_verses(df.select(F.col(id_col), F.get_json_object(json_col, f"$.{field}").alias("_html")).where("_html IS NOT NULL"), id_col, "_html")


def posts(df: DataFrame, json_col: str) -> DataFrame:
    """``id, title, date, link, tags, content, word_count`` of stored pages of a REST crawl, each a JSON array of posts; HTML as text."""
    kind = "array<struct<id:bigint,title:struct<rendered:string>,date:string,link:string,tags:array<string>,content:struct<rendered:string>>>"
    p = df.select(F.explode(F.from_json(json_col, kind)).alias("p")).where("p.id IS NOT NULL")
    p = p.select("p.id", html_text(F.col("p.title.rendered")).alias("title"), "p.date", "p.link", "p.tags", html_text(F.col("p.content.rendered")).alias("content"))
    return p.withColumn("word_count", F.size(T.words(F.col("content"))))


def conversation_lines(df: DataFrame, line: str, least: int = 2) -> DataFrame:
    """``line, context, register, word_count`` of lines of ``least`` or more words that read as the language (Burmese script or two function words).

    The context is the label of the line's form; a line is formal if it has a polite ending, else casual.
    """
    from quern.functions import rules

    ws = T.words(F.lower(line))
    own = F.col(line).rlike(T.MYANMAR) | (T.member_count(ws, rules.STOPWORDS) >= 2)
    register = F.when(F.lower(line).rlike(r"(^|\s)(hen|un|uh)[.!?]*$"), "formal").otherwise("casual")
    return df.where(own & (F.size(ws) >= least)).select(F.col(line).alias("line"), T.conversation_label(F.col(line)).alias("context"), register.alias("register"), F.size(ws).alias("word_count"))


SONG_NAMES = [r"^([0-9]+)[ ._-]+(.+)\.[a-z]+$", r"^(.+?)[ _-]+([0-9]+)\.[a-z]+$", r"^(.+)\.[a-z]+$"]


def song_files(files: DataFrame) -> DataFrame:
    """``collection, number, title, text`` of text files (path, name, text) in the four layouts: number first, number last, no number, or
    a file of ``N. title`` sections; the collection is the folder. Of songs with one title in a collection the first path counts."""
    f = files.select("path", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("collection"), "name", "text")
    many = f.where(F.col("text").rlike(r"(?m)^[0-9]+\.\s"))
    s = many.select("path", "collection", F.explode(F.filter(F.split("text", r"(?m)(?=^[0-9]+\.\s)"), lambda x: x.rlike(r"^[0-9]+\.\s"))).alias("s"))
    s = s.select("path", "collection", F.regexp_extract("s", r"^([0-9]+)", 1).cast("int").alias("number"), F.trim(F.regexp_extract("s", r"^[0-9]+\.\s+([^\n]*)", 1)).alias("title"), T.strip(F.regexp_replace("s", r"^[^\n]*\n?", "")).alias("text"))
    first, last, none = SONG_NAMES
    get = lambda p, i: F.nullif(F.regexp_extract("name", p, i), F.lit(""))
    one = f.join(many.select("path").distinct(), "path", "left_anti")
    one = one.select("path", "collection", F.coalesce(get(first, 1), get(last, 2)).cast("int").alias("number"), F.trim(F.coalesce(get(first, 2), get(last, 1), get(none, 1))).alias("title"), T.strip(F.col("text")).alias("text"))
    m = s.unionByName(one).groupBy("collection", "title").agg(F.min(F.struct("path", "number", "text")).alias("m"))
    return m.select("collection", "m.number", "title", "m.text")


def packed_instruction(c: Column) -> Column:
    """``### Instruction / Input / Response`` text as a struct, with ``kind``: parallel if it asks to translate."""
    part = lambda name: F.nullif(T.strip(F.regexp_extract(c, rf"(?s)###\s*{name}:?\s*(.*?)(?=###|$)", 1)), F.lit(""))
    kind = F.when(part("Instruction").rlike("(?i)translat"), "parallel").when(part("Response").isNotNull(), "instruction")
    return F.struct(part("Instruction").alias("instruction"), part("Input").alias("input"), part("Response").alias("output"), kind.alias("kind"))


def paragraphs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, paragraph_no, paragraph_id, paragraph`` of texts split at blank lines."""
    p = F.filter(F.transform(F.split(text_col, r"\n\s*\n"), lambda x: F.trim(x)), lambda x: x != "")
    e = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.posexplode(p).alias("i", "paragraph"))
    return e.select("id", (F.col("i") + 1).cast("bigint").alias("paragraph_no"), F.substring(F.sha2("paragraph", 256), 1, 16).alias("paragraph_id"), "paragraph")


def markdown_items(df: DataFrame, id_col: str, text_col: str, bullets: int = 100, tables: int = 50) -> DataFrame:
    """``id, kind, section, item_no, item``: pipe rows and bullets with the heading above them; the first of each kind."""
    ls = lines_of(df, id_col, text_col)
    w = Window.partitionBy("id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    head = F.nullif(F.regexp_extract("line", r"^#{1,6}\s+(.*)$", 1), F.lit(""))
    ls = ls.withColumn("section", F.last(head, ignorenulls=True).over(w))
    kind = F.when(F.col("line").rlike(r"^\s*\|.*\|\s*$"), "row").when(F.col("line").rlike(r"^\s*[-*]\s+"), "bullet")
    item = F.trim(F.regexp_replace("line", r"^\s*[-*]\s+", ""))
    it = ls.withColumn("kind", kind).where("kind IS NOT NULL").withColumn("item", item)
    it = it.withColumn("item_no", F.row_number().over(Window.partitionBy("id", "kind").orderBy("n")))
    return it.where(F.col("item_no") <= F.when(F.col("kind") == "row", tables).otherwise(bullets)).select("id", "kind", "section", F.col("item_no").cast("bigint").alias("item_no"), "item")


def stories(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts split before ``1. ``-like headers: ``id, story_no, title, n_lines, n_words``."""
    parts = F.filter(F.split(text_col, r"(?m)(?=^[0-9]+\.\s)"), lambda s: s.rlike(r"^[0-9]+\.\s"))
    e = df.select(F.col(id_col).alias("id"), F.explode(parts).alias("s"))
    ls = F.filter(F.split("s", "\n"), lambda x: F.trim(x) != "")
    body = F.slice(ls, F.lit(2), F.greatest(F.size(ls), F.lit(1)))
    return e.select("id", F.regexp_extract("s", r"^([0-9]+)\.", 1).cast("int").alias("story_no"), F.trim(F.regexp_extract("s", r"^[0-9]+\.\s+([^\n]*)", 1)).alias("title"), F.size(body).alias("n_lines"), F.size(T.words(F.array_join(body, " "))).alias("n_words"))


def union_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """Sources one below the other with their name; missing columns as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("source_table", F.lit(n)) for n, df in sorted(parts.items())])


def constants(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Literal phrase lists as a table."""
    return spark.createDataFrame(rows, schema)
