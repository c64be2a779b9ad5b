"""Long spans that stand word for word in more than one record.

Units (whole documents, paragraphs, lines) are normalised to their tokens, their digests grouped
globally, the earliest ranked occurrence is kept and the others are reported with their original
offsets.

* ``repeated_lines``: the unit is a line, compared without regard to case.
* ``shared_spans``: units of ``length`` tokens or more that another document also has are shared as
  they are. A unit cannot show a span that begins or ends inside it; so windows of ``length`` tokens
  follow for the rest. All windows would be as many rows as tokens; so windows are first filed under
  their anchor, the smallest hash among the grams they hold. Equal windows have equal anchors, so
  only windows under an anchor that another document has too go on to be grouped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.tokens import blank_tokens, grams, sliding_min
from quern.session import cut_lineage


def _windows(column: pa.Array, length: int, gram: int):
    """(row, first token within row, window hash, anchor hash) of each window of ``length`` tokens."""
    hashes, rows = blank_tokens(column)
    n = len(hashes)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    first_of_row = np.searchsorted(rows, rows)
    whole = np.flatnonzero(rows[: n - length + 1] == rows[length - 1 :])
    small = grams(hashes, gram)
    bits = max(1, int(len(small)).bit_length())
    low = np.uint64((1 << bits) - 1)
    tagged = (small & ~low) | np.arange(len(small), dtype=np.uint64)
    anchor = small[(sliding_min(tagged, length - gram + 1) & low).astype(np.int64)]
    return rows[whole], whole - first_of_row[whole], grams(hashes, length)[whole], anchor[whole]


def _slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` bytes of text; a longer text stays whole."""
    step = max(1, int(batch.num_rows * most / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


_SPACES = re.compile(r"\s+", re.ASCII)
_BREAK, _GAP = re.compile(r"\n"), re.compile(r"\n[ \t\r]*\n")


def shared_units(df: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, first, last, kept``: units of ``length`` tokens or more that another document has too; tokens from 0.

    Units are the whole text, its paragraphs (cut at blank lines) and its lines. ``kept`` is the earliest
    occurrence by (doc_id, first). Only digests and offsets are shuffled.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL AND doc_id IS NOT NULL")

    def units(batches):
        for whole in batches:
            for b in _slices(whole):
                out = []
                for doc, text, (hashes, starts) in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _by_row(b.column(1))):
                    if len(hashes) < length:
                        continue
                    seen = set()
                    for cut in (None, _GAP, _BREAK):
                        ends = [m.start() for m in cut.finditer(text)] if cut else []
                        at = np.r_[0, np.searchsorted(starts, _byte_offsets(text, ends)), len(hashes)]
                        for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
                            if z - a >= length and (a, z) not in seen:
                                seen.add((a, z))
                                d = xxhash.xxh3_128_digest(hashes[a:z].tobytes())
                                out.append((doc, d, a, z - 1))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.int32(), pa.int32()))], names=["doc_id", "digest", "first", "last"])

    found = cut_lineage(docs.mapInArrow(units, "doc_id bigint, digest binary, first int, last int"))
    groups = found.groupBy("digest").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min(F.struct("doc_id", "first")).alias("k")).where("lo < hi").select("digest", "k")
    return found.join(groups, "digest").select("doc_id", "first", "last", (F.struct("doc_id", "first") == F.col("k")).alias("kept"))


def _byte_offsets(text: str, ends: list[int]) -> list[int]:
    if text.isascii() or not ends:
        return ends
    width = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    upto = np.cumsum(1 + (width > 0x7F).astype(np.int64) + (width > 0x7FF) + (width > 0xFFFF))
    return [int(upto[e - 1]) if e else 0 for e in ends]


def _by_row(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The token hashes of each row and their byte offsets within it."""
    hashes, rows, starts = blank_tokens(column, offsets=True)
    at = np.searchsorted(rows, np.arange(len(column) + 1))
    for a, b in zip(at[:-1], at[1:]):
        yield hashes[a:b], starts[a:b]


def shared_spans(df: DataFrame, length: int = 50, gram: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, first_token, last_token``: maximal runs of tokens that another document holds too.

    Tokens are maximal runs of characters other than space, tab and line break, numbered from 1. A
    token is shared if a run of ``length`` or more tokens around it stands in another document.
    NULL, empty and shorter texts share nothing; a repeat within one document alone doesn't count;
    copies of a text count as other documents. Rows that repeat an id are the same document, rows
    with a NULL id none.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL AND doc_id IS NOT NULL")

    def anchors(batches):
        for whole in batches:
            for b in _slices(whole):
                row, _, _, anchor = _windows(b.column(1), length, gram)
                if not len(row):
                    continue
                new = np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row[new])), pa.array(anchor[new].view(np.int64))], names=["doc_id", "anchor"])

    def windows(batches):
        for whole in batches:
            for b in _slices(whole):
                row, first, digest, anchor = _windows(b.column(1), length, gram)
                if not len(row):
                    continue
                new = np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]
                at = np.flatnonzero(new)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[at, len(row)].astype(np.int32)), pa.array(digest.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row[at])), pa.array(anchor[at].view(np.int64)), pa.array(first[at].astype(np.int32)), lists],
                    names=["doc_id", "anchor", "first", "digests"],
                )

    # map-side combined: a hot anchor costs one row per task
    several = lambda rows, *key: rows.groupBy(*key).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select(*key)
    shared_anchors = several(docs.mapInArrow(anchors, "doc_id bigint, anchor bigint"), "anchor")
    filed = docs.mapInArrow(windows, "doc_id bigint, anchor bigint, first int, digests array<bigint>")
    # read twice below (grouped, and joined with the groups), so written once to shared storage
    near = cut_lineage(filed.join(shared_anchors, "anchor", "left_semi").select("doc_id", "anchor", "first", "digests"))
    single = near.select("doc_id", "anchor", "first", F.posexplode("digests").alias("i", "digest")).select("doc_id", "anchor", (F.col("first") + F.col("i")).alias("at"), "digest")
    # anchor and digest, 128 bits: of 10 ** 13 windows, 64 would make some look equal that aren't
    hits = single.join(several(single, "anchor", "digest"), ["anchor", "digest"], "left_semi").select("doc_id", F.col("at").alias("a"), (F.col("at") + length - 1).alias("b"))
    units = shared_units(df, length, id_col, text_col).select("doc_id", F.col("first").alias("a"), F.col("last").alias("b"))
    return islands(units.unionAll(hits))


def islands(spans: DataFrame) -> DataFrame:
    """Runs of covered tokens, numbered from 1, of spans ``doc_id, a, b`` (from 0): spans that touch or overlap are one run."""
    w = Window.partitionBy("doc_id").orderBy("a", "b")
    before = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.withColumn("fresh", F.coalesce(F.col("a") - before > 1, F.lit(True)).cast("int"))
    runs = starts.withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("doc_id", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return runs.select("doc_id", (F.col("a") + 1).cast("bigint").alias("first_token"), (F.col("b") + 1).cast("bigint").alias("last_token"))


def shared_share(df: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_shared, shared_share`` for every document; 0 where nothing is shared, NULL share of no tokens."""
    n = F.size(F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), r"[ \t\r\n]+"), lambda t: t != ""))
    sizes = df.select(F.col(id_col).cast("bigint").alias("doc_id"), n.cast("bigint").alias("n_tokens"))
    shared = spans.groupBy("doc_id").agg(F.sum(F.col("last_token") - F.col("first_token") + 1).alias("n_shared"))
    out = sizes.join(shared, "doc_id", "left").withColumn("n_shared", F.coalesce("n_shared", F.lit(0).cast("bigint")))
    return out.withColumn("shared_share", F.when(F.col("n_tokens") > 0, F.round(F.col("n_shared") / F.col("n_tokens"), 6)))


def repeated_lines(df: DataFrame, least_chars: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines to remove: ``doc_id, line_no, first_char, last_char, kept_doc_id, kept_line_no``.

    Lines are compared trimmed, lower-cased and with runs of white space as one; lines of fewer than
    ``least_chars`` such characters never count. Of equal lines the one with the smallest (doc_id,
    line_no) is kept, also within one document. Offsets (0-based, end exclusive) are of the stored text.
    """
    given = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def lines(batches):
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                first = 0
                for no, line in enumerate(text.split("\n"), 1):
                    unit = _SPACES.sub(" ", line).strip(" ").lower() if len(line) >= least_chars else ""
                    if len(unit) >= least_chars:
                        out.append((doc, no, first, first + len(line), xxhash.xxh3_128_digest(unit)))
                    first += len(line) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "line_no", "first_char", "last_char", "digest"])

    # read twice below; only offsets and digests are stored and shuffled, never text
    placed = cut_lineage(given.mapInArrow(lines, "doc_id bigint, line_no bigint, first_char bigint, last_char bigint, digest binary"))
    earliest = placed.groupBy("digest").agg(F.min(F.struct("doc_id", "line_no")).alias("kept"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    again = placed.join(earliest, "digest").where((F.col("doc_id") != F.col("kept.doc_id")) | (F.col("line_no") != F.col("kept.line_no")))
    return again.select("doc_id", "line_no", "first_char", "last_char", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.line_no").alias("kept_line_no"))
