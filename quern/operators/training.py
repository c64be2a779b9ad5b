"""Examples, exercises, splits and samples (inventory L).

Random choices are seeded digests of a row's key, so a lost task makes the same choice again. Exact
ranks over a whole table are two-level (rank within a digest range, plus the counts of the ranges
before), so no window gathers the table in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.session import cut_lineage

SYSTEM = "You answer in the language of the question."


def chatml(user: Column, assistant: Column, system: str = SYSTEM) -> Column:
    """L2: a three-turn conversation as one string."""
    return F.concat(F.lit(f"<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n"), user, F.lit("<|im_end|>\n<|im_start|>assistant\n"), assistant, F.lit("<|im_end|>"))


def messages(user: Column, assistant: Column) -> Column:
    """L3: an array of (role, content)."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("user", user), turn("assistant", assistant))


def render(kind: Column, own: Column, other: Column, names: tuple[str, str] = ("Source", "English")) -> Column:
    """One training text by record type; NULL where a needed field is missing."""
    return (
        F.when(kind == "parallel", F.concat(F.lit(f"{names[0]}: "), own, F.lit(f"\n{names[1]}: "), other))
        .when(kind == "dictionary", F.concat(own, F.lit(" = "), other))
        .when(kind == "instruction", F.concat(F.lit("### Instruction:\n"), own, F.lit("\n### Response:\n"), other))
        .otherwise(own)
    )


def choose(seed: str, key: Column, options: list[str]) -> Column:
    """L4, Q15: one of the options by a digest of the row's key."""
    n = F.conv(F.substring(F.md5(F.concat(F.lit(seed), key.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return F.array(*[F.lit(o) for o in options])[(n % len(options)).cast("int")]


def both_ways(df: DataFrame, id_col: str, own: str, other: str) -> DataFrame:
    """Two examples per pair, one in each direction; pairs with a blank side give none."""
    two = F.array(
        F.struct(F.lit("own-other").alias("direction"), F.col(own).alias("source_text"), F.col(other).alias("target_text")),
        F.struct(F.lit("other-own").alias("direction"), F.col(other).alias("source_text"), F.col(own).alias("target_text")),
    )
    return df.where(~T.blank(F.col(own)) & ~T.blank(F.col(other))).select(id_col, F.explode(two).alias("x")).select(id_col, "x.*")


def digest_rank(df: DataFrame, key: Column, tie: str, seed: str = "42") -> tuple[DataFrame, int]:
    """(``df`` with ``rank``, its number of rows): the 1-based position by the seeded digest of ``key``, over the whole table.

    The sizes of at most 4096 digest ranges go over the driver; ``df`` is read twice, so an
    expensive one should be cut off first.
    """
    d = df.withColumn("_d", F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))).withColumn("_r", F.substring("_d", 1, 3))
    sizes = {r["_r"]: r["count"] for r in d.groupBy("_r").count().collect()}
    before, total = [], 0
    for r in sorted(sizes):
        before.append((r, total))
        total += sizes[r]
    offsets = df.sparkSession.createDataFrame(before, "_r string, _before bigint")
    inner = d.withColumn("_i", F.row_number().over(Window.partitionBy("_r").orderBy("_d", tie)))
    return inner.join(F.broadcast(offsets), "_r").withColumn("rank", F.col("_i") + F.col("_before")).drop("_d", "_r", "_i", "_before"), total


def split(df: DataFrame, key: str, test: float = 0.1, val: float = 0.1, least_test: int = 0, least_val: int = 0, seed: str = "42") -> DataFrame:
    """``df`` with ``split``: exact sizes max(least, floor(n * share)), the rest train; at most all rows."""
    r, n = digest_rank(df, F.col(key), key, seed)
    n_test = min(n, max(least_test, int(n * test)))
    n_val = min(n - n_test, max(least_val, int(n * val)))
    return r.withColumn("split", F.when(F.col("rank") <= n_test, "test").when(F.col("rank") <= n_test + n_val, "val").otherwise("train")).drop("rank")


def ordered_split(df: DataFrame, key: str, shares: list[tuple[str, float]]) -> DataFrame:
    """``df`` with ``split`` by shares of the largest ``key``, in its order, not shuffled; the last share takes the rest.

    ``key`` is a dense ordinal; only its maximum is needed, so nothing is ranked or shuffled.
    """
    most = df.agg(F.max(key)).first()[0] or 0
    out, upto = None, 0.0
    for name, share in shares[:-1]:
        upto += share
        hit = F.col(key) <= F.lit(int(round(upto, 9) * most))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return df.withColumn("split", out.otherwise(shares[-1][0]) if out is not None else F.lit(shares[-1][0]))


def sample(df: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """The ``n`` rows with the smallest seeded digests (a sampling operator: its limit is the feature)."""
    return df.withColumn("_d", F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))).orderBy("_d", key).limit(n).drop("_d")


def weighted_sample(df: DataFrame, key: str, weight: str, n: int, seed: str = "42") -> DataFrame:
    """``n`` rows without replacement, likelier with more weight: the largest u ** (1 / w), u from a digest."""
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), 1, 8), 16, 10).cast("double") + 1) / 4294967297.0
    return df.where(F.col(weight) > 0).withColumn("_u", F.log(u) / F.col(weight)).orderBy(F.desc("_u"), key).limit(n).drop("_u")


def stratified(df: DataFrame, stratum: str, key: str, n: dict[str, int], seed: str = "42") -> DataFrame:
    """The given number of rows of each stratum, by seeded digest; each stratum is a top-k of its own."""
    return reduce(DataFrame.unionAll, [sample(df.where(F.col(stratum) == s), key, k, seed) for s, k in sorted(n.items())])


def quiz(df: DataFrame, id_col: str, word: str, answer: str, k: int = 3, seed: str = "42") -> DataFrame:
    """``id, word, answer, options``: the answer and ``k`` others (all others, if there are fewer).

    The distinct answers are numbered by digest over the whole table; the ``k`` that follow on the ring of
    numbers are an answer's others, the same on every run. NULL or blank answers make no question.
    """
    q = df.where(~T.blank(F.col(answer)) & ~T.blank(F.col(word))).select(F.col(id_col).alias("id"), F.col(word).alias("word"), F.col(answer).alias("answer"))
    ranked, n = digest_rank(cut_lineage(q.select("answer").distinct()), F.col("answer"), "answer", seed)
    at = ranked.select("answer", (F.col("rank") - 1).alias("i"))
    steps = F.array(*[F.lit(s).cast("bigint") for s in range(1, min(k, n - 1) + 1)]).cast("array<bigint>")
    others = at.select(F.col("answer").alias("other"), F.explode(F.transform(steps, lambda s: F.pmod(F.col("i") - s, F.lit(max(n, 1))))).alias("i")).groupBy("i").agg(F.collect_list("other").alias("others"))
    given = at.join(others, "i", "left").select("answer", F.coalesce("others", F.array().cast("array<string>")).alias("others"))
    return q.join(given, "answer").select("id", "word", "answer", F.array_sort(F.concat(F.array("answer"), F.col("others"))).alias("options"))


def fill_blank(df: DataFrame, id_col: str, sentence: str, seed: str = "42") -> DataFrame:
    """An inner word, chosen by digest, replaced by ``___``; sentences of four or more words."""
    s = df.select(F.col(id_col).alias("id"), T.words(F.col(sentence)).alias("w")).where(F.size("w") >= 4)
    n = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("id").cast("string"))), 1, 8), 16, 10).cast("bigint")
    s = s.withColumn("i", (n % (F.size("w") - 2)).cast("int") + 1)
    masked = F.concat(F.slice("w", F.lit(1), F.col("i")), F.array(F.lit("___")), F.slice("w", F.col("i") + 2, F.size("w")))
    return s.select("id", F.array_join(masked, " ").alias("question"), F.get("w", F.col("i")).alias("answer"))


def reorder(df: DataFrame, id_col: str, sentence: str) -> DataFrame:
    """Words in digest order, and the sentence they make."""
    s = df.select(F.col(id_col).alias("id"), T.words(F.col(sentence)).alias("w")).where(F.size("w") >= 4)
    keyed = F.array_sort(F.transform("w", lambda x, i: F.struct(F.md5(F.concat(x, i.cast("string"))).alias("d"), x.alias("x"))))
    return s.select("id", F.array_join(F.transform(keyed, lambda k: k["x"]), " ").alias("question"), F.array_join("w", " ").alias("answer"))


def variations(df: DataFrame, id_col: str, sentence: str) -> DataFrame:
    """Negation, question and future forms of statements that end with ``hi``; distinct from the original."""
    s = df.select(F.col(id_col).alias("id"), F.array_join(T.words(F.lower(F.regexp_replace(sentence, "[.,;:!?]", ""))), " ").alias("s")).where(F.col("s").rlike("[^ ] hi$"))
    stem = F.regexp_replace("s", " hi$", "")
    forms = F.array(*[F.struct(F.lit(k).alias("kind"), F.concat(stem, F.lit(end)).alias("variant")) for k, end in (("future", " ding hi"), ("negation", " lo hi"), ("question", " hiam"))])
    return s.select("id", F.explode(forms).alias("v")).select("id", "v.*")


def paraphrase(c: Column, synonyms: dict[str, str], connectors: dict[str, str]) -> Column:
    """Levels 1-2: whole-word synonyms and connectors replaced, case and punctuation kept."""
    return T.replace_forms(c, {**synonyms, **connectors})


def evidence_edges(words: DataFrame, meanings: DataFrame, most: int = 10, phrases: DataFrame | None = None) -> DataFrame:
    """``word, kind, target`` edges: up to ``most`` verses and three meanings of each word, and with ``phrases``
    (phrase, id) up to ``most`` verses of each phrase (kind ``phrase-verse``), smallest first."""
    top = lambda df, key, col, k, kind: (
        df.select(F.col(key).alias("word"), F.col(col).cast("string").alias("target"), F.col(col).alias("_o")).distinct()
        .withColumn("r", F.row_number().over(Window.partitionBy("word").orderBy("_o"))).where(F.col("r") <= k).select("word", F.lit(kind).alias("kind"), "target")
    )
    edges = top(words, "word", "id", most, "verse").unionAll(top(meanings, "word", "meaning", 3, "meaning"))
    return edges if phrases is None else edges.unionAll(top(phrases, "phrase", "id", most, "phrase-verse"))


def validate_examples(df: DataFrame, fields: list[str], denied: list[str]) -> Column:
    """Issues of an example: missing fields and denied substrings, sorted."""
    return F.array_compact(F.array(*[F.when(T.blank(F.col(f)), f"missing:{f}") for f in sorted(fields)], *[F.when(F.concat_ws(" ", *fields).contains(x), f"denied:{x}") for x in sorted(denied)]))
