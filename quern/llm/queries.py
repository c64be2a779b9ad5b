"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import frequency, language, leakage, lookalikes, mixing, neardup, spans, survivors
from quern.session import spread, table, texts

Q: dict = {}


def query(f):
    Q[f.__name__] = f
    return f


def _fields5(spark, d):
    return [
        ("bible_verses_enhanced.zolai_text", table(spark, d, "bible_verses_enhanced"), "zolai_text", True),
        ("wiki_content.content", table(spark, d, "wiki_content"), "content", True),
        ("zolai_vocabulary.frequency_corpus", table(spark, d, "zolai_vocabulary"), "frequency_corpus", False),
    ]


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return frequency.term_frequency(_fields5(spark, d)).where("mark IS NOT NULL").select("field_name", "term", "mark")


@query
def p5_terms(spark: SparkSession, d: str) -> DataFrame:
    return frequency.term_frequency(_fields5(spark, d)).select("field_name", "term", "occurrences", "n_rows", "mark")


P6_FIELDS = ["english", "myanmar", "pos"]


def _duplicates(spark, d):
    return table(spark, d, "dictionary_enhanced"), table(spark, d, "source_trust"), "zolai", P6_FIELDS


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.long_form(survivors.chosen(survivors.skylines(*_duplicates(spark, d)), P6_FIELDS), P6_FIELDS)


@query
def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivors.field_survivors(*_duplicates(spark, d))


@query
def p6_layers(spark: SparkSession, d: str) -> DataFrame:
    return survivors.layer_rows(survivors.skylines(*_duplicates(spark, d)), P6_FIELDS)


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_spans(texts(spark, d, "documents", "doc_id", "text"))


@query
def p9_units(spark: SparkSession, d: str) -> DataFrame:
    """What whole documents, paragraphs and lines show without windows, as runs."""
    units = spans.shared_units(texts(spark, d, "documents", "doc_id", "text"))
    return spans.islands(units.select("doc_id", F.col("first").alias("a"), F.col("last").alias("b")))


@query
def p9_share(spark: SparkSession, d: str) -> DataFrame:
    docs = texts(spark, d, "documents", "doc_id", "text")
    return spans.shared_share(docs, spans.shared_spans(docs))


@query
def p9_lines(spark: SparkSession, d: str) -> DataFrame:
    return spans.repeated_lines(texts(spark, d, "documents", "doc_id", "text"))


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(texts(spark, d, "documents", "doc_id", "text"), table(spark, d, "eval_items")).where("exact").select("doc_id", "item_id")


@query
def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(texts(spark, d, "documents", "doc_id", "text"), table(spark, d, "eval_items"))


def _near3(spark, d):
    both = table(spark, d, "zolai_songs").select(F.lit("zolai_songs").alias("part"), "id", "text")
    both = both.unionAll(table(spark, d, "articles").select(F.lit("articles").alias("part"), "id", F.col("content").alias("text")))
    return neardup.similar_pairs(spread(both), 0.5, 3, 10, part_col="part")


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    members, links = _near3(spark, d)
    return neardup.expand(members, links).withColumnRenamed("part", "table_name")


@query
def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.duplicate_groups(*_near3(spark, d)).withColumnRenamed("part", "table_name")


def _mix(spark, d, **how):
    return mixing.mix(texts(spark, d, "documents", "doc_id", "source", "text"), table(spark, d, "mix_targets"), **how)


@query
def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """As many tokens as the target sources have."""
    return _mix(spark, d)[0]


@query
def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


@query
def p8_shares_exact(spark: SparkSession, d: str) -> DataFrame:
    """The largest mixture in which every source with tokens has exactly its target share."""
    return _mix(spark, d, total="exact")[1]


@query
def p8_shares_entropy(spark: SparkSession, d: str) -> DataFrame:
    """Natural shares tempered to the entropy of the target shares."""
    return _mix(spark, d, entropy_of="target")[1]


@query
def p8_budgets(spark: SparkSession, d: str) -> DataFrame:
    """The plan alone, over sizes in bytes, which SQL can sum."""
    docs = table(spark, d, "documents").where(F.octet_length("text") > 0)
    sizes = docs.groupBy("source").agg(F.sum(F.octet_length("text")).alias("tokens"), F.count(F.lit(1)).alias("n"))
    return mixing.plan_frame(sizes, table(spark, d, "mix_targets")).select("source", "tokens", "budget", (F.col("exponent") < 1).alias("at_limit"))


def _fields1(spark, d):
    vocabulary, verses = table(spark, d, "zolai_vocabulary"), texts(spark, d, "bible_verses_enhanced", "id", "zolai_text", "myanmar_text")
    fields = [("zolai_vocabulary", "zolai", vocabulary), ("bible_verses_enhanced", "zolai_text", verses), ("bible_verses_enhanced", "myanmar_text", verses)]
    return fields, [(vocabulary, "zolai"), (vocabulary, "myanmar")]


def _canonical(spark, d, keep_clean):
    return lookalikes.canonicalise(*_fields1(spark, d), keep_clean=keep_clean)


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _canonical(spark, d, False).select("table_name", "field_name", "record_id")


@query
def p1_values(spark: SparkSession, d: str) -> DataFrame:
    return _canonical(spark, d, True).select("table_name", "field_name", "record_id", "canonical")


@query
def p1_near(spark: SparkSession, d: str) -> DataFrame:
    """What an edit budget of one could change beyond look-alikes."""
    return lookalikes.near_report(*_fields1(spark, d))


def _passages(spark, d):
    articles, labels = table(spark, d, "articles"), table(spark, d, "language_labels")
    labelled = language.with_stated(articles.select("id", "language", F.col("content").alias("text")), "language", labels).withColumnRenamed("stated_lang", "lang")
    return articles, labels, language.passages(texts(spark, d, "articles", "id", "content"), language.fit(table(spark, d, "language_samples"), labelled))


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    articles, labels, found = _passages(spark, d)
    said = language.with_stated(articles.select("id", "language"), "language", labels)
    each = found.where("lang IS NOT NULL").select("id", "lang").distinct().join(said, "id")
    return each.where("stated_lang IS NULL OR stated_lang <> lang").select("id", "lang")


@query
def p4_passages(spark: SparkSession, d: str) -> DataFrame:
    return _passages(spark, d)[2]


@query
def p4_documents(spark: SparkSession, d: str) -> DataFrame:
    articles, labels, found = _passages(spark, d)
    return language.documents(articles, found, labels)
