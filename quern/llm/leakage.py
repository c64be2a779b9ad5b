"""Held-out passages that stand, wholly, partly or re-parameterised, in corpus documents.

Passages are turned into templates: numbers, unit words and names become typed placeholders. The
templates of all windows of ``window`` words (or of a whole shorter passage) form a hash table
that every map task holds; documents stream past it once, hashed with the same templates, and a
template hit is settled by its slots: equal words are an exact leak, a consistent renaming of the
slots is a re-parameterised one. Documents are neither shuffled nor cut.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.tokens import grams, mix

_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_ASCII = re.compile(r"[a-z0-9]+")
_NAME = regex.compile(r"(?<=[\p{L}\p{N},;:] )\p{Lu}[\p{L}\p{M}\p{N}]*")
NUM, UNIT, NAME, FIRST = 1, 2, 3, 8
# fixed values: unit words that take the unit placeholder
UNITS = frozenset("mm cm m km g kg mg l ml ha acre acres inch inches foot feet mile miles hour hours minute minutes second seconds day days week weeks month months year years percent dollar dollars kyat rupee rupees".split())


def words(text: str) -> list[str]:
    """Maximal runs of letters, marks and digits of the lower-cased text."""
    low = text.lower()
    return _ASCII.findall(low) if low.isascii() else _WORD.findall(low)


class _Ids(dict):
    """Word -> template symbol; a number is NUM, a word of no passage is 0."""

    def __missing__(self, word: str) -> int:
        return NUM if word.isnumeric() else 0


class TemplateIndex:
    """Templates of the windows of held-out passages."""

    def __init__(self, items: list[tuple[int, str]], window: int, units: frozenset = UNITS) -> None:
        self.window = window
        names = {n.lower() for _, p in items for n in _NAME.findall(p)}
        self.ids, self.has_names = _Ids(), bool(names)
        self.words = {item: words(p) for item, p in items}
        for ws in self.words.values():
            for w in ws:
                if w not in self.ids and not w.isnumeric():
                    self.ids[w] = UNIT if w in units else NAME if w in names else FIRST + len(self.ids)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        found = defaultdict(list)
        for item, ws in self.words.items():
            n = min(window, len(ws))
            if n:
                h = grams(mix(self.symbols(ws).astype(np.uint64)), n)
                found[n].extend(zip(h.tolist(), [item] * len(h), range(len(h))))
        for n, rows in found.items():
            rows.sort()
            self.tables[n] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64))

    def symbols(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.ids.__getitem__, ws), np.int64, len(ws))

    def search(self, texts: list[str]) -> Iterator[tuple[int, int, bool, int]]:
        """(text, item, exact?, first word) of each window hit."""
        per = [words(t) for t in texts]
        flat = [w for ws in per for w in (*ws, "")]  # an empty word between texts matches nothing
        ids = self.symbols(flat)
        if self.has_names:
            at = 0
            for t, ws in zip(texts, per):
                caps = {n.lower() for n in _NAME.findall(t)}
                for i, w in enumerate(ws if caps else ()):
                    if ids[at + i] == 0 and w in caps:
                        ids[at + i] = NAME
                at += len(ws) + 1
        n = len(ids)
        sizes = np.array([len(ws) + 1 for ws in per], np.int64)
        begins = np.cumsum(sizes) - sizes
        gap = np.minimum.accumulate(np.where(ids == 0, np.arange(n), n)[::-1])[::-1]
        run = gap - np.arange(n)
        hashed = mix(ids.astype(np.uint64))
        for length, (table, items, starts) in self.tables.items():
            can = np.flatnonzero(run >= length)
            if not len(can):
                continue
            h = grams(hashed, length)[can]
            lo = np.searchsorted(table, h, side="left")
            hit = (lo < len(table)) & (table[np.minimum(lo, len(table) - 1)] == h)
            for pos, first, key in zip(can[hit].tolist(), lo[hit].tolist(), h[hit].tolist()):
                text = int(np.searchsorted(begins, pos, side="right")) - 1
                got = flat[pos : pos + length]
                while first < len(table) and int(table[first]) == key:
                    item, start = int(items[first]), int(starts[first])
                    want = self.words[item][start : start + length]
                    if got == want:
                        yield text, item, True, pos - int(begins[text])
                    elif self._consistent(got, want):
                        yield text, item, False, pos - int(begins[text])
                    first += 1

    def _consistent(self, got: list[str], want: list[str]) -> bool:
        """Equal outside slots, and the slots renamed one to one."""
        there: dict[str, str] = {}
        back: dict[str, str] = {}
        for a, b in zip(want, got):
            sym = self.ids[a]
            if sym >= FIRST or sym != (self.ids[b] or NAME):
                if a != b:
                    return False
            elif there.setdefault(a, b) != b or back.setdefault(b, a) != a:
                return False
        return True


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = 12, units: frozenset = UNITS, block_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", passage_col: str = "passage"
) -> DataFrame:
    """``doc_id, item_id, exact, n_windows, first_word, last_word`` for each document and item that hit.

    ``exact``: the document's words hold ``window`` successive words of the passage, or all of a
    shorter one; else only its template does. NULL or empty passages and texts, and NULL ids, never hit; repeated rows give repeated hits. Words are
    numbered from 1. The held-out side is measured first; beyond ``block_bytes`` of passages
    it is taken in blocks, each compared with all documents, so that no task holds more than that.
    """
    items = items.where(F.col(passage_col).isNotNull() & F.col(item_col).isNotNull()).select(F.col(item_col).cast("bigint").alias("item_id"), F.col(passage_col).alias("passage"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("passage")), F.lit(0))).first()[0]
    blocks = 1 + size // block_bytes
    spark = docs.sparkSession
    docs = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def block(b: int) -> DataFrame:
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else items
        index = spark.sparkContext.broadcast(TemplateIndex([(r.item_id, r.passage) for r in mine.collect()], window, units))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                step = max(1, int(whole.num_rows * (2 << 20) / max(1, whole.nbytes)))
                for at in range(0, whole.num_rows, step):
                    part = whole.slice(at, step)
                    ids = part.column(0).to_pylist()
                    found: dict[tuple[int, int], list] = {}
                    for text, item, exact, first in index.value.search(part.column(1).to_pylist()):
                        n = min(window, len(index.value.words[item]))
                        row = found.setdefault((text, item), [False, 0, first + 1, first + n])
                        row[0] |= exact
                        row[1] += 1
                        row[2], row[3] = min(row[2], first + 1), max(row[3], first + n)
                    if found:
                        cols = list(zip(*((ids[t], i, *r) for (t, i), r in found.items())))
                        types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(cols, types)], names=["doc_id", "item_id", "exact", "n_windows", "first_word", "last_word"])

        return docs.mapInArrow(scan, "doc_id bigint, item_id bigint, exact boolean, n_windows bigint, first_word bigint, last_word bigint")

    return reduce(DataFrame.unionAll, [block(b) for b in range(blocks)])
