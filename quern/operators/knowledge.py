"""A lexicon rebuilt from several sources, and what words have to do with each other (inventories E, F, G, M, O, P)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators.stats import collocations, top_per_group
from quern.session import cut_lineage


def drop_later(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """``df`` without rows that repeat the key columns of a row with a smaller id; rows with a blank key column all stay.

    The survivor of each key is an aggregate, joined back: a key with a third of all rows isn't sorted in one task.
    """
    whole = reduce(lambda a, b: a & b, [~T.blank(F.col(k)) for k in keys])
    first = df.where(whole).groupBy(*keys).agg(F.min(id_col).alias("_first"))
    return df.join(first, keys, "left").where(F.col("_first").isNull() | (F.col(id_col) == F.col("_first"))).select(*df.columns)


def usable_key(c: Column, longest: int = 35) -> Column:
    """one word, not blank, at most ``longest`` characters, without a hyphen in front."""
    return ~T.blank(c) & ~F.trim(c).contains(" ") & (F.length(F.trim(c)) <= longest) & ~F.trim(c).startswith("-")


def source_union(rows: DataFrame, fill: list[str], largest: list[str] = []) -> DataFrame:  # noqa: B006
    """one row per ``key``: each ``fill`` column's value from the first source that has one, each
    ``largest`` column's maximum, ``first_source`` and the sorted set of ``sources``.

    ``rows``: key, priority, ord (orders the rows of one source), source. A source is one of a few names, so the sets are
    small; everything combines on the map side.
    """
    rank = [F.col("priority"), F.col("ord")]
    picks = [F.min(F.when(~T.blank(F.col(c).cast("string")), F.struct(*rank, F.col(c).alias("v")))).alias(c) for c in fill]
    out = rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.min(F.struct(*rank, "source")).alias("_first"), F.array_sort(F.collect_set("source")).alias("sources"), *picks, *[F.max(c).alias(c) for c in largest])
    return out.select("key", F.col("_first.source").alias("first_source"), "sources", *[F.col(f"{c}.v").alias(c) for c in fill], *largest)


def related_words(pairs: DataFrame, books: DataFrame, least: int = 6, top: int = 30, k: int = 8, own_books: int = 2, other_books: int = 3, noise: float = 0.3) -> DataFrame:
    """``word, rank, related, n``: the first ``k`` partners of each word.

    ``pairs``: a < b, n; ``books``: word, books (in how many a word occurs). Of a word's ``top`` partners those count that occur with it
    ``least`` times, in ``other_books`` books, hold no apostrophe and whose own total isn't above ``noise`` of the largest total.
    """
    pairs = cut_lineage(pairs)  # read for the totals, their maximum and the partners
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("related"), "n").unionAll(pairs.select(F.col("b").alias("word"), F.col("a").alias("related"), "n"))
    totals = both.groupBy("related").agg(F.sum("n").alias("total"))
    quiet = totals.where(F.col("total") <= noise * (totals.agg(F.max("total")).first()[0] or 0)).select("related")
    fit = books.where(F.col("books") >= other_books).select(F.col("word").alias("related")).join(quiet, "related")
    first = top_per_group(both, ["word"], top, [F.desc("n"), F.col("related")]).drop("rank").where(F.col("n") >= least)
    first = first.where(~F.col("related").contains("'")).join(fit, "related", "left_semi").join(books.where(F.col("books") >= own_books).select("word"), "word", "left_semi")
    return top_per_group(first, ["word"], k, [F.desc("n"), F.col("related")]).select("word", "rank", "related", "n")


def negation_antonyms(df: DataFrame, ws: Column, markers: list[str], plain: list[str], before: int = 3, after: int = 3, least: int = 2, k: int = 5) -> DataFrame:
    """``word, rank, opposite, n``: the words most often around a negated one.

    The context of a text is the words up to ``before`` ahead of and ``after`` behind its first negation marker, without markers,
    ``plain`` words and words of up to two letters; its first word is the negated one.
    """
    w = df.select(ws.alias("ws")).withColumn("at", F.array_min(F.transform("ws", lambda x, i: F.when(x.isin(markers), i)))).where("at IS NOT NULL")
    lo = F.greatest(F.col("at") - before, F.lit(0))
    around = F.filter(F.slice("ws", lo + 1, F.col("at") - lo + 1 + after), lambda x: ~x.isin(markers + plain) & (F.length(x) > 2))
    c = w.select(around.alias("c")).where(F.size("c") >= 2).select(F.get("c", F.lit(0)).alias("word"), F.explode(F.slice("c", F.lit(2), F.size("c"))).alias("opposite"))
    c = c.where((F.col("word") != F.col("opposite")) & ~F.col("opposite").contains("'")).groupBy("word", "opposite").agg(F.count(F.lit(1)).alias("n"))
    # the first k count, of which those seen often enough stay
    return top_per_group(c, ["word"], k, [F.desc("n"), F.col("opposite")]).where(F.col("n") >= least).select("word", "rank", "opposite", "n")


def alignment_vocabulary(dictionary: DataFrame, alignments: DataFrame, texts: DataFrame, examples: int = 3, k: int = 5, meanings: int = 5) -> DataFrame:
    """``word, english, pos, meanings, frequency, examples, collocations, confidence, source`` of every word of either side.

    ``dictionary``: word (unique), meanings (array), pos, source; ``alignments``: word, id, meaning, confidence; ``texts``: ws. A word that
    no alignment has gets frequency 0 and confidence 0.5, one that the dictionary lacks the source ``corpus_only``.
    """
    a = alignments.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"), F.round(F.avg("confidence"), 2).alias("confidence"))
    first = top_per_group(alignments.select("word", "id", "meaning"), ["word"], examples, [F.col("id"), F.col("meaning")])
    shown = first.groupBy("word").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.concat_ws(": ", "id", "meaning").alias("x")))), lambda s: s["x"]).alias("examples"))
    near = top_per_group(collocations(texts, F.col("ws")).where(F.length("near") > 1), ["word"], k, [F.desc("n"), F.col("near")])
    close = near.groupBy("word").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.concat_ws(":", "near", "n").alias("x")))), lambda s: s["x"]).alias("collocations"))
    j = dictionary.join(a, "word", "full").join(shown, "word", "left").join(close, "word", "left")
    none = F.array().cast("array<string>")
    return j.select(
        "word", F.coalesce(F.get("meanings", F.lit(0)), F.lit("")).alias("english"), F.coalesce("pos", F.lit("")).alias("pos"), F.slice(F.coalesce("meanings", none), 1, meanings).alias("meanings"), F.coalesce("frequency", F.lit(0).cast("bigint")).alias("frequency"),
        F.coalesce("examples", none).alias("examples"), F.coalesce("collocations", none).alias("collocations"), F.coalesce("confidence", F.lit(0.5)).alias("confidence"), F.coalesce("source", F.lit("corpus_only")).alias("source"),
    )


def foreign_headwords(foreign: DataFrame, dictionary: DataFrame, corpus: DataFrame) -> DataFrame:
    """``word, reason, in_corpus, in_dictionary, category`` of a foreign-word list (word unique, reason): ``cognate`` if the
    corpus has it, else ``present`` if a dictionary headword equals it, else ``absent``."""
    known = lambda df, name: df.select("word").where("word IS NOT NULL").distinct().withColumn(name, F.lit(True))
    j = foreign.join(known(corpus, "c"), "word", "left").join(known(dictionary, "d"), "word", "left")
    has = lambda c: F.coalesce(c, F.lit(False))
    return j.select("word", "reason", has("c").alias("in_corpus"), has("d").alias("in_dictionary"), F.when(has("c"), "cognate").when(has("d"), "present").otherwise("absent").alias("category"))


def provenance_state(incoming: DataFrame, stored: DataFrame, key: str, digest: str) -> DataFrame:
    """``key, state`` of incoming files: ``skip`` if the stored digest is the same, ``replace`` if another is stored, else ``new``.

    Of several stored digests of a key any may match.
    """
    s = stored.select(key, F.col(digest).alias("_d")).where(F.col(key).isNotNull())
    j = incoming.select(key, digest).join(s, key, "left")
    return j.groupBy(key, digest).agg(F.max(F.coalesce(F.col("_d") == F.col(digest), F.lit(False))).alias("_same"), F.count("_d").alias("_n")).select(key, F.when(F.col("_same"), "skip").when(F.col("_n") > 0, "replace").otherwise("new").alias("state"))


def new_versions(df: DataFrame, changed: dict[str, Column], version: str, remarks: str) -> DataFrame:
    """``df`` with the changed columns; rows that change get the next version and what changed as remarks, others keep their version and NULL remarks."""
    differs = {c: ~F.col(c).eqNullSafe(v) for c, v in changed.items()}
    notes = F.array_compact(F.array(*[F.when(differs[c], F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c), F.lit("NULL")), F.lit(" -> "), F.coalesce(v, F.lit("NULL")))) for c, v in changed.items()]))
    any_ = reduce(lambda a, b: a | b, differs.values())
    return df.select(*[c for c in df.columns if c not in changed and c != version], *[v.alias(c) for c, v in changed.items()], F.when(any_, T.bump_version(F.col(version))).otherwise(F.col(version)).alias(version), F.when(any_, F.array_join(notes, "; ")).alias(remarks))


def from_cache(requests: DataFrame, cache: DataFrame, key: str, value: str) -> DataFrame:
    """``key, value, cached`` of distinct requests; what isn't cached is left for whoever answers, and merged by ``mutate.upsert``."""
    c = cache.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.lit(True).alias("_hit"))
    return requests.select(key).where(F.col(key).isNotNull()).distinct().join(c, key, "left").select(key, value, F.coalesce("_hit", F.lit(False)).alias("cached"))


def by_category(sources: dict[str, tuple[DataFrame, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Each category's processor over its rows, one below the other with the ``category``; processors return ``id, text``."""
    return reduce(DataFrame.unionByName, [f(df).select(F.lit(name).alias("category"), F.col("id").cast("bigint").alias("id"), "text") for name, (df, f) in sorted(sources.items())])


@dataclass(frozen=True)
class FillTask:
    """What is to be filled: the blank ``target`` of rows that meet ``needs``; ``prompt`` has ``{column}`` places."""

    name: str
    target: str
    key: str
    needs: str
    prompt: str

    def pending(self, df: DataFrame) -> DataFrame:
        """``task, key, prompt`` of the rows to fill, each key once (of several prompts the smallest)."""
        parts = []
        for i, piece in enumerate(self.prompt.replace("{", "\0{").replace("}", "}\0").split("\0")):
            parts.append(F.coalesce(F.col(piece[1:-1]).cast("string"), F.lit("")) if piece.startswith("{") and piece.endswith("}") else F.lit(piece))
        rows = df.where(T.blank(F.col(self.target)) & F.expr(self.needs))
        return rows.groupBy(F.col(self.key).cast("string").alias("key")).agg(F.min(F.concat(*parts)).alias("prompt")).select(F.lit(self.name).alias("task"), "key", "prompt")

    def apply(self, df: DataFrame, answers: DataFrame) -> DataFrame:
        """``df`` with blank targets filled from ``answers`` (task, key, answer); the smallest of several answers."""
        a = answers.where(F.col("task") == self.name).groupBy(F.col("key").alias("_k")).agg(F.min("answer").alias("_a"))
        j = df.join(a, F.col(self.key).cast("string") == F.col("_k"), "left")
        return j.withColumn(self.target, F.when(T.blank(F.col(self.target)) & F.expr(self.needs), F.coalesce("_a", self.target)).otherwise(F.col(self.target))).drop("_k", "_a")


def report(sections: dict[str, DataFrame]) -> DataFrame:
    """``section, metric, value`` of several audits, each ``metric, value``; :func:`report_markdown` renders it."""
    return reduce(DataFrame.unionAll, [df.select(F.lit(n).alias("section"), F.col("metric").cast("string").alias("metric"), F.col("value").cast("double").alias("value")) for n, df in sorted(sections.items())])


def report_markdown(title: str, rows: list[tuple[str, str, float]]) -> str:
    """The report as Markdown, a table for each section; ``rows`` are the few rows of :func:`report`."""
    out = [f"# {title}"]
    for section in sorted({r[0] for r in rows}):
        out += ["", f"## {section}", "", "| metric | value |", "|---|---|", *[f"| {m} | {v:g} |" for s, m, v in sorted(rows) if s == section]]
    return "\n".join(out) + "\n"


def syllables(w: Column) -> Column:
    """A word's syllables, by rule: each vowel group takes the one consonant, or aspirated pair, before it; other consonants
    close the syllable before; a word's leading consonants belong to its first. Hyphens part syllables."""
    cut = F.regexp_replace(F.lower(w), "((?:[ckptz]h|[^aeiou\\-])?[aeiou]+)", "-$1")
    cut = F.regexp_replace(cut, "(^|-)-*([^aeiou\\-]+)-([^aeiou\\-]*[aeiou])", "$1$2$3")
    return F.filter(F.split(cut, "-"), lambda x: x != "")
