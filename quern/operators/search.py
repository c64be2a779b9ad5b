"""Lookup and retrieval (inventory N)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T


def postings(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``term, id, tf``: an inverted index as a table."""
    t = df.select(F.col(id_col).alias("id"), F.explode(T.tokens(F.col(text_col), "word")).alias("term"))
    return t.groupBy("term", "id").agg(F.count(F.lit(1)).alias("tf"))


def match_all(index: DataFrame, terms: list[str]) -> DataFrame:
    """Ids that hold every term, with the sum of their counts."""
    want = sorted({t.lower() for t in terms})
    hits = index.where(F.col("term").isin(want)).groupBy("id").agg(F.count(F.lit(1)).alias("k"), F.sum("tf").alias("score"))
    return hits.where(F.col("k") == len(want)).select("id", "score")


def tiered(entries: DataFrame, queries: DataFrame) -> DataFrame:
    """``q, id, tier`` of the best tier that answers a query: 1 word, 2 meaning, 3 stem, 4 word inside the meaning.

    ``entries``: id, word, meaning; ``queries``: q. Each tier is an equi-join on lower-cased keys.
    """
    e = entries.select("id", F.lower(F.trim("word")).alias("word"), F.lower(F.trim("meaning")).alias("meaning"))
    q = queries.select("q", F.lower(F.trim("q")).alias("k")).where("k <> ''").distinct()
    tiers = [
        e.select("id", F.col("word").alias("k")),
        e.select("id", F.col("meaning").alias("k")),
        e.select("id", F.explode(T.stems(F.col("word"))).alias("k")),
        e.select("id", F.explode(F.array_distinct(T.tokens(F.col("meaning"), "word"))).alias("k")),
    ]
    hits = reduce(DataFrame.unionAll, [t.join(q, "k").select("q", "id", F.lit(i + 1).alias("tier")) for i, t in enumerate(tiers)])
    return hits.groupBy("q", "id").agg(F.min("tier").alias("tier")).withColumn("best", F.min("tier").over(Window.partitionBy("q"))).where("tier = best").drop("best")


def substring(df: DataFrame, cols: list[str], needle: str) -> DataFrame:
    """Rows that hold the needle in any column, with the names of the columns."""
    where = F.array_compact(F.array(*[F.when(F.contains(F.lower(F.col(c)), F.lit(needle.lower())), c) for c in cols]))
    return df.withColumn("match_in", where).where(F.size("match_in") > 0)


def retrieve(df: DataFrame, id_col: str, text_col: str, words: list[str], k: int = 5) -> DataFrame:
    """The ``k`` texts that hold most of the query words as substrings (a top-k report); ties to the smaller id."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    score = sum((low.contains(w.lower()).cast("int") for w in sorted(set(words))), F.lit(0))
    return df.select(F.col(id_col).alias("id"), score.alias("score")).where("score > 0").orderBy(F.desc("score"), "id").limit(k)


def answer_matches(given: F.Column, right: F.Column) -> F.Column:
    """Either string holds the other, case aside; blank never matches."""
    a, b = F.lower(F.trim(given)), F.lower(F.trim(right))
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def nearest(df: DataFrame, id_col: str, vec_col: str, step: int = 100, k: int = 3) -> DataFrame:
    """Extension: for each vector whose id is divisible by ``step`` its ``k`` nearest others by cosine.

    The stated query set stands against all rows, in blocks: each map task multiplies its batch with
    a broadcast block of queries (at most 8 MB) and keeps its own best ``k`` before the shuffle.
    """
    import numpy as np
    import pandas as pd

    v = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    queries = v.where(F.pmod("id", F.lit(step)) == 0)
    width = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    if not width.n:
        return v.select(F.col("id").alias("query_id"), "id", F.lit(0.0).alias("similarity")).limit(0)
    blocks = 1 + width.n * width.d * 8 // (8 << 20)
    sc = df.sparkSession.sparkContext

    def block(b: int) -> DataFrame:
        rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        q = np.array([r.v for r in rows]).reshape(len(rows), -1)
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12) if len(rows) else 1
        shared = sc.broadcast((np.array([r.id for r in rows]), q))

        def scan(batches):
            ids, m = shared.value
            for b in batches:
                if not len(b) or not len(ids):
                    continue
                x = np.vstack(b["v"].to_numpy()).astype(float)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                sim = m @ x.T
                own = b["id"].to_numpy()
                sim[ids[:, None] == own[None, :]] = -2
                top = np.argsort(-sim, axis=1, kind="stable")[:, : k + 1]
                out = pd.DataFrame({"query_id": np.repeat(ids, top.shape[1]), "id": own[top.ravel()], "similarity": np.take_along_axis(sim, top, 1).ravel()})
                yield out[out["similarity"] > -2]

        return v.mapInPandas(scan, "query_id bigint, id bigint, similarity double")

    best = reduce(DataFrame.unionAll, [block(b) for b in range(blocks)])
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("similarity", 9)), "id")
    return best.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")
