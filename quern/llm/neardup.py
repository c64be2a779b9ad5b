"""Near-duplicate records by an exact set-similarity join.

Records with equal shingle sets are one class first. Shingles are ordered rare-first over the
whole collection; two sets of similarity t must share a shingle within their prefixes, of which
those that occur once need not be joined at all. Length, positional and suffix (signature bits
that differ) filters thin the candidates; each pair is then verified once, on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.leakage import words
from quern.llm.tokens import grams, mix
from quern.session import cut_lineage

SUFFIX_WORDS = 4  # 64-bit words of a set's signature


class _WordHashes(dict):
    """Word -> 64-bit hash, kept for words seen before."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_sets(df: DataFrame, least_words: int, size: int, id_col: str, text_col: str, part_col: str | None = None) -> DataFrame:
    """``part, id, n, sh, key``: the distinct shingle hashes of each text with enough words, sorted, and their digest."""
    part = F.col(part_col) if part_col else F.lit("")
    given = df.select(part.cast("string").alias("part"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    given = given.where("text IS NOT NULL AND id IS NOT NULL")
    need = max(least_words, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for whole in batches:
            step = max(1, int(whole.num_rows * (4 << 20) / max(1, whole.nbytes)))
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                keep, sets, keys = [], [], []
                for i, (text, p) in enumerate(zip(b.column(2).to_pylist(), b.column(0).to_pylist())):
                    w = words(text)
                    if len(w) < need:
                        continue
                    h = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
                    # the part is in the hash: records of two parts share no shingle
                    sh = np.unique(mix(grams(h, size) ^ np.uint64(xxhash.xxh3_64_intdigest(p or ""))).view(np.int64))
                    keep.append(i)
                    sets.append(sh)
                    keys.append(xxhash.xxh3_128_hexdigest(sh.tobytes()))
                if keep:
                    n = np.array([len(x) for x in sets], np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(np.concatenate(sets)))
                    at_ = pa.array(keep)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(at_), b.column(1).take(at_), pa.array(n), lists, pa.array(keys)], names=["part", "id", "n", "sh", "key"])

    return given.mapInArrow(run, "part string, id bigint, n int, sh array<bigint>, key string")


def similar_pairs(df: DataFrame, threshold: float = 0.8, size: int = 5, least_words: int = 1, id_col: str = "id", text_col: str = "text", part_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, links): ``members`` has ``part, id, class_id``, ``links`` has ``part, a, b, similarity`` of classes, a < b.

    A class is all records with one shingle set, named by its smallest id. Every two classes of one
    ``part`` with a Jaccard similarity of at least ``threshold`` are linked; records with fewer
    than ``least_words`` or ``size`` words, NULL or empty texts and NULL ids belong to no class.
    """
    docs = cut_lineage(shingle_sets(df, least_words, size, id_col, text_col, part_col).withColumn("rid", F.monotonically_increasing_id()))
    # classes by digest: ids and digests move, shingles don't; of rows that repeat an id with one text a single one stays
    keys = docs.select("part", "id", "key", "rid")
    firsts = keys.groupBy("part", "key").agg(F.min(F.struct("id", "rid")).alias("m"), F.count(F.lit(1)).alias("copies"))
    members = keys.join(firsts.select("part", "key", F.col("m.id").alias("class_id")), ["part", "key"]).select("part", "id", "class_id").distinct()
    several = firsts.where("copies > 1").select("part", "key", F.col("m.rid").alias("first"))
    # stored, so that its size is known when the join with the sets is planned
    others = cut_lineage(keys.join(several, ["part", "key"]).where("rid <> first").select("rid"))
    each = docs.join(others, "rid", "left_anti").select("rid", "n", F.explode("sh").alias("g"))

    # few shingles occur twice; stored, so that their number is known when the join with all others is planned
    df2 = cut_lineage(each.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    t = F.lit(threshold)
    need = F.ceil(t * F.col("n") - 1e-9)
    bits = [F.expr(f"bit_or(if(pmod(g, {64 * SUFFIX_WORDS}) div 64 = {k}, shiftleft(1L, cast(pmod(g, 64) AS int)), 0L))").alias(f"s{k}") for k in range(SUFFIX_WORDS)]
    sig = [f"s{k}" for k in range(SUFFIX_WORDS)]
    # shingles that occur once come first and cannot match: they only move the positions
    ranked = each.join(df2, "g").groupBy("rid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("o"), *bits)
    ranked = ranked.select("rid", "n", *sig, F.transform("o", lambda x: x["g"]).alias("o")).withColumn("m", F.size("o"))
    ranked = cut_lineage(ranked.withColumn("once", F.col("n") - F.col("m")).withColumn("prefix", F.col("n") - need + 1 - F.col("once")).where("prefix > 0"))
    post = ranked.select("rid", "n", "m", "once", *sig, F.posexplode(F.slice("o", F.lit(1), F.col("prefix").cast("int"))).alias("i", "g"))
    post = post.select("g", "rid", "n", "m", *sig, (F.col("once") + F.col("i")).alias("pos"))
    a, b = post.alias("a"), post.alias("b")
    overlap = F.ceil(t / (1 + t) * (F.col("a.n") + F.col("b.n")) - 1e-9)
    length = F.least("a.n", "b.n") >= t * F.greatest("a.n", "b.n") - 1e-9
    position = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) >= overlap
    # each signature bit that differs is a shingle of one side alone
    apart = sum((F.bit_count(F.col(f"a.s{k}").bitwiseXOR(F.col(f"b.s{k}"))) for k in range(SUFFIX_WORDS)), F.lit(0))
    suffix = F.col("a.m") + F.col("b.m") - apart >= 2 * overlap
    cand = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.rid") < F.col("b.rid")) & length & position & suffix)
    pairs = cut_lineage(cand.select(F.col("a.rid").alias("a"), F.col("b.rid").alias("b")).distinct())
    # what two sets share occurs at least twice, so the shortened sets give the whole overlap
    left = pairs.join(ranked.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("o").alias("oa")), "a")
    both = left.join(ranked.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("o").alias("ob")), "b")
    both = both.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), F.size(F.array_intersect("oa", "ob")).alias("both"))
    similar = both.withColumn("similarity", F.col("both") / (F.col("n") - F.col("both"))).where(F.col("similarity") >= t - 1e-12)
    names = keys.select("rid", "part", "id")
    named = similar.join(names.select(F.col("rid").alias("a"), "part", F.col("id").alias("ia")), "a").join(names.select(F.col("rid").alias("b"), F.col("id").alias("ib")), "b")
    return members, named.select("part", F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), "similarity").where("a < b")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``part, id, group_id``: the smallest id that each node of ``edges`` (part, a, b) is connected with.

    Labels run along edges and are shortcut to their own label's label each round, so rounds grow
    with the logarithm of a chain's length. Rounds are checkpointed in shared storage; only the
    count of changed labels reaches the driver.
    """
    both = cut_lineage(edges.select("part", "a", "b").unionAll(edges.select("part", F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut_lineage(both.groupBy("part", "a").agg(F.min("b").alias("m")).select("part", F.col("a").alias("id"), F.least("a", "m").alias("l")))
    for _ in range(rounds):
        seen = both.join(label.select("part", F.col("id").alias("b"), "l"), ["part", "b"]).groupBy("part", "a").agg(F.min("l").alias("m"))
        step = label.join(seen.withColumnRenamed("a", "id"), ["part", "id"]).select("part", "id", "l", F.least("l", "m").alias("x"))
        jump = step.select("part", F.col("id").alias("x"), F.col("x").alias("y"))
        step = step.join(jump, ["part", "x"], "left").select("part", "id", F.col("l").alias("old"), F.least("x", F.coalesce("y", "x")).alias("l"))
        step = cut_lineage(step)
        changed = step.where("old <> l").limit(1).count()
        label = step.select("part", "id", "l")
        if not changed:
            return label.withColumnRenamed("l", "group_id")
    raise RuntimeError(f"no fixed point within {rounds} rounds")


def expand(members: DataFrame, links: DataFrame) -> DataFrame:
    """``part, id_a, id_b`` (id_a < id_b) of all records: pairs of linked classes and of copies within a class."""
    m = members.select("part", "id", "class_id")
    across = links.select("part", F.col("a").alias("ca"), F.col("b").alias("cb"))
    x = across.join(m.select("part", F.col("class_id").alias("ca"), F.col("id").alias("ia")), ["part", "ca"])
    x = x.join(m.select("part", F.col("class_id").alias("cb"), F.col("id").alias("ib")), ["part", "cb"]).select("part", "ia", "ib")
    more = m.join(m.groupBy("part", "class_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), ["part", "class_id"])
    within = more.select("part", "class_id", F.col("id").alias("ia")).join(more.select("part", "class_id", F.col("id").alias("ib")), ["part", "class_id"]).where("ia < ib")
    return x.unionAll(within.select("part", "ia", "ib")).select("part", F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))


def duplicate_groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """One row per record: ``part, id, class_id, group_id, n_links`` (links of its class; 0 alone, group = class)."""
    degree = links.select("part", F.col("a").alias("class_id")).unionAll(links.select("part", F.col("b").alias("class_id"))).groupBy("part", "class_id").agg(F.count(F.lit(1)).alias("n_links"))
    comp = components(links).select("part", F.col("id").alias("class_id"), "group_id")
    out = members.join(comp, ["part", "class_id"], "left").join(degree, ["part", "class_id"], "left")
    return out.select("part", "id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
