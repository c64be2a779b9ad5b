"""Mixing sources to target weights, in tokens of a public tokenizer.

The token share of each source is tempered towards its target, ``natural ** (1 - x) * target ** x``:
at exponent 1 it has its target share, at 0 its natural one. For a source that would have to exceed
its repetition limit the exponent is bisected to the largest one at which it doesn't, and for a
wanted entropy to the largest at which the mixture is that even. The weights are realised as budgeted
block permutations: the documents of a source stand in a seeded random order, whole blocks of the
source are repeated, and the last block is cut where its running token sum meets the budget. Running
sums are two-level (per source and hash range, then within), so a source with a third of all rows is
spread over all tasks; the number of ranges grows with the rows.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.session import cut_lineage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # a default; any .tiktoken, .json or .model file
# fixed value: the pattern that belongs to the ranks of that file, cutting text before the merges
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANGE_ROWS = 50_000  # rows that a hash range holds on average; their token sums are put in order


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str):
    """The tokenizer of a .tiktoken, .json or .model file, as a function of texts to token counts."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(enc.encode_ordinary(t)) for t in texts]
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        return lambda texts: [len(e) for e in tok.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]


def token_counts(df: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", pattern: str = PATTERN) -> DataFrame:
    """``doc_id, source, n_tokens``; a NULL or empty text has 0 tokens. A narrow map over Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _encoder(tokenizer, pattern)
        for b in batches:
            n = count([t or "" for t in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "source", "n_tokens"])

    given = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id bigint, source string, n_tokens bigint")


def entropy(p: np.ndarray) -> float:
    p = p[p > 0]
    return float(-(p * np.log(p)).sum())


def tempered(natural: np.ndarray, target: np.ndarray, x: float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        w = np.where(natural > 0, np.exp((1 - x) * np.log(natural) + x * np.log(np.maximum(target, 1e-300))), 0.0)
    return w / w.sum() if w.sum() else w


def bisect_exponent(holds, low: float = 0.0, high: float = 1.0, steps: int = 60) -> float:
    """The largest x in [low, high] with holds(x), which is true up to a point and false beyond."""
    if holds(high):
        return high
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if holds(mid) else (low, mid)
    return low


def plan_mix(rows: list[dict], total: int | str = "available", entropy_of: float | str | None = None) -> list[dict]:
    """Budget and exponent of each source; ``rows`` have ``source, target_share, max_repeats, tokens``.

    ``total``: tokens to make, or ``available``: as many as the sources have, or ``exact``: the most for which
    every source that has tokens meets its share exactly. A source whose share of that would exceed
    its repetition limit has its exponent bisected between its natural share (0) and its target (1)
    to where it meets the limit, and the others share the rest in their target proportions. If all
    are at their limits less than ``total`` is made. A source without tokens gets nothing.

    With ``entropy_of`` (nats, or ``target``: that of the target shares) the goal is not the target shares but the natural
    ones raised to the largest power in [0, 1] at which their entropy is at least that.
    """
    out = [dict(r, budget=0, exponent=None, goal=0.0) for r in rows]
    left = [r for r in out if r["tokens"] > 0 and r["max_repeats"] > 0 and (r["target_share"] > 0 or entropy_of is not None)]
    if not left:
        return out
    natural = np.array([r["tokens"] for r in left], float)
    natural /= natural.sum()
    goal = np.array([r["target_share"] for r in left], float)
    if entropy_of is not None:
        wanted = entropy(goal / goal.sum()) if entropy_of == "target" else min(float(entropy_of), math.log(len(left)))
        # natural ** power / sum: tempering towards even shares
        goal = tempered(natural, np.ones(len(left)), 1 - bisect_exponent(lambda y: entropy(tempered(natural, np.ones(len(left)), 1 - y)) >= wanted - 1e-12))
    for r, g, n in zip(left, goal / goal.sum(), natural):
        r["goal"], r["natural"], r["cap"] = float(g), float(n), r["tokens"] * r["max_repeats"]
    if total == "exact":
        rest = min(r["cap"] / r["goal"] for r in left)
    else:
        rest = float(sum(r["tokens"] for r in left)) if total == "available" else max(0.0, float(total))
    while left:
        goal, natural = (np.array([r[k] for r in left]) for k in ("goal", "natural"))
        goal, natural = goal / goal.sum(), natural / natural.sum()
        over = [i for i, r in enumerate(left) if rest * goal[i] > r["cap"] * (1 + 1e-9)]
        if not over:
            for r, w in zip(left, goal):
                r["budget"], r["exponent"] = int(math.floor(min(rest * w, r["cap"]) + 1e-6)), 1.0
            break
        i = min(over, key=lambda i: left[i]["cap"] / left[i]["goal"])
        cap = left[i]["cap"]
        left[i]["exponent"] = bisect_exponent(lambda x: rest * tempered(natural, goal, x)[i] <= cap)
        left[i]["budget"] = cap
        rest = max(0.0, rest - cap)
        del left[i]
    return out


def plan_rows(sizes: DataFrame, targets: DataFrame) -> list[dict]:
    """What :func:`plan_mix` takes, from ``sizes`` (source, tokens, n): one row per target source reaches the driver."""
    want = targets.where("source IS NOT NULL").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    return [dict(r.asDict(), tokens=r.tokens or 0, n=r.n or 0, max_repeats=r.max_repeats or 0, target_share=r.target_share or 0.0) for r in want.join(sizes, "source", "left").orderBy("source").collect()]


PLAN = "source string, target_share double, max_repeats int, tokens bigint, budget bigint, exponent double"


def plan_frame(df: DataFrame, targets: DataFrame, total: int | str = "available", entropy_of: float | str | None = None) -> DataFrame:
    """The plan of :func:`plan_mix` as a table; ``df``: source, tokens, n by source."""
    plan = plan_mix(plan_rows(df, targets), total, entropy_of)
    return df.sparkSession.createDataFrame([(r["source"], float(r["target_share"]), int(r["max_repeats"]), int(r["tokens"]), int(r["budget"]), r["exponent"]) for r in plan], PLAN)


def mix(
    df: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, total: int | str = "available", entropy_of: float | str | None = None, seed: int = 42, pattern: str = PATTERN, **cols: str
) -> tuple[DataFrame, DataFrame]:
    """(chosen, shares). ``chosen``: ``doc_id, source, n_tokens, repeats`` with repeats >= 1.

    ``shares``: one row per target source with ``target_share, max_repeats, tokens, budget, exponent, used,
    reached_share, most_repeats``; ``exponent`` is 1 where the target holds, less where the repetition limit or
    the wanted entropy tempers it, NULL without tokens. Only documents of target sources are read; those of 0 tokens
    (NULL, empty) are never chosen. ``targets`` is a small dimension (one row per source): only the
    token sums per source reach the driver. No document is used more than ``max_repeats`` times,
    and a source's used tokens are within one document of its budget. The tokenizer runs once; its
    counts are stored. ``total`` and ``entropy_of`` as in :func:`plan_mix`.
    """
    text, source, id_col = cols.get("text_col", "text"), cols.get("source_col", "source"), cols.get("id_col", "doc_id")
    mine = df.join(targets.where("source IS NOT NULL").select(F.col("source").alias(source)).distinct(), source, "left_semi")
    docs = cut_lineage(token_counts(mine, tokenizer, id_col, text, source, pattern).where("n_tokens > 0"))
    sizes = cut_lineage(docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    budgets = plan_frame(sizes, targets, total, entropy_of)

    bits = max(0, math.ceil(math.log2(max(1, largest / RANGE_ROWS))))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    placed = docs.withColumn("h", key).withColumn("range", F.shiftright("h", 64 - bits) if bits else F.lit(0).cast("bigint"))
    ranges = placed.groupBy("source", "range").agg(F.sum("n_tokens").alias("t"))  # a row for RANGE_ROWS documents
    before = F.coalesce(F.sum("t").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ranges.select("source", "range", before.alias("offset"))
    inner = Window.partitionBy("source", "range").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    run = placed.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(offsets, ["source", "range"])
    run = run.join(F.broadcast(budgets.select("source", "tokens", "budget", "max_repeats")), "source").withColumn("start", F.col("offset") + F.col("inner"))
    whole = F.floor(F.col("budget") / F.col("tokens"))
    part = F.col("budget") - whole * F.col("tokens")
    # the last block takes a document if more than half of it lies within the budget
    extra = (F.col("start") * 2 + F.col("n_tokens") <= part * 2) & (part > 0)
    repeats = F.least(whole + extra.cast("bigint"), F.col("max_repeats").cast("bigint"))
    chosen = run.select("doc_id", "source", "n_tokens", repeats.alias("repeats")).where("repeats >= 1")
    used = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("used"), F.max("repeats").alias("most_repeats"))
    shares = budgets.join(used, "source", "left").withColumn("used", F.coalesce("used", F.lit(0).cast("bigint")))
    shares = shares.withColumn("all_used", F.sum("used").over(Window.partitionBy()))  # one row per target source
    reached = F.when(F.col("all_used") > 0, F.round(F.col("used") / F.col("all_used"), 6))
    return chosen, shares.select(
        "source", "target_share", "max_repeats", "tokens", "budget", F.round("exponent", 6).alias("exponent"), "used", reached.alias("reached_share"),
        F.coalesce("most_repeats", F.lit(0).cast("bigint")).alias("most_repeats"),
    )
