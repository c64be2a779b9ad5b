"""Language of documents and of the passages of mixed ones, by compression.

Each language has a raw-content zstandard dictionary; text belongs to the language whose dictionary
makes it smallest. Words are sized one by one between paddings (sizes are cached, and padding lets
even a short word find its match), a shortest path with a price for each change of language cuts
the document, and the smallest size of each passage names its language: the sum over its words,
or where that is close its running text. A narrow margin to the second rejects it.

The dictionaries are the only thing fitted: on the labelled samples, and on passages of a bounded
number of documents whose stated language the samples confirm.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_PAD = b"\0" * 64
CHANGE = 14.0  # bytes that a change of language costs
CACHE = 400_000  # words whose sizes a task keeps
SURE = 1.0  # bytes a word between the two smallest sizes from which the sizes of single words decide
STRETCH = 10  # words that are encoded together
ALONE = 8192  # words of a lone long document that are looked up at a time


def _params() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        window_log=18, hash_log=17, chain_log=18, search_log=9, min_match=3, target_length=64, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False
    )


class Classifier:
    """Compressors with one dictionary per language, and the segmentation of texts by them."""

    def __init__(self, texts: dict[str, str]) -> None:
        self.langs = sorted(texts)
        self.texts = texts
        self.words: dict[str, int] = {}
        self.table = np.zeros((0, len(self.langs)))
        self._compressors = None

    def __getstate__(self):
        return {"texts": self.texts}

    def __setstate__(self, state):
        self.__init__(state["texts"])

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of a text under each language's dictionary."""
        if self._compressors is None:
            params = _params()
            self._compressors = []
            for lang in self.langs:
                d = zstandard.ZstdCompressionDict(self.texts[lang].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=params)
                self._compressors.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        data = _PAD + f" {text} ".encode() + _PAD
        return [len(c.compress(data)) for c in self._compressors]

    def word_ids(self, docs: list[list[str]]) -> list[np.ndarray]:
        """For each document the rows of ``table`` (bytes beyond the best language's) of its words."""
        if len(self.words) > CACHE:
            self.words, self.table = {}, np.zeros((0, len(self.langs)))
        out, new = [], []
        for ws in docs:
            row = np.empty(len(ws), np.int32)
            for j, w in enumerate(ws):
                i = self.words.get(w)
                if i is None:
                    i = self.words[w] = len(self.words)
                    size = np.array(self.sizes(w), float)
                    new.append(size - size.min())
                row[j] = i
            out.append(row)
        if new:
            self.table = np.vstack([self.table, np.array(new)])
        return out

    def paths(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """The cheapest language of each word, all documents in lockstep, longest first.

        Memory is a byte for each word and language, whatever the length of the longest document.
        """
        order = sorted((i for i in range(len(ids)) if len(ids[i])), key=lambda i: -len(ids[i]))
        out = [np.zeros(0, np.int8)] * len(ids)
        if not order:
            return out
        n = np.array([len(ids[i]) for i in order])
        begins = np.cumsum(n) - n
        flat = np.concatenate([ids[i] for i in order])
        k, every = len(self.langs), np.arange(len(self.langs))
        back = np.zeros((len(flat), k), np.int8)
        best = self.table[flat[begins]].copy()
        shared = int(n[1]) if len(n) > 1 else 1  # beyond, the longest document is alone
        active = len(n) - np.searchsorted(n[::-1], np.arange(shared), side="right")
        for t in range(1, shared):
            a = active[t]
            rows = begins[:a] + t
            now = best[:a]
            low = now.argmin(1)
            move = now[np.arange(a), low][:, None] + CHANGE
            stay = now <= move
            back[rows] = np.where(stay, every, low[:, None])
            best[:a] = np.where(stay, now, move) + self.table[flat[rows]]
        alone = best[0].tolist()
        for at in range(shared, int(n[0]), ALONE):
            part = self.table[flat[at : min(at + ALONE, int(n[0]))]].tolist()
            for t, e in enumerate(part, at):
                m = min(alone)
                low, move = alone.index(m), m + CHANGE
                from_ = [j if x <= move else low for j, x in enumerate(alone)]
                alone = [min(x, move) + y for x, y in zip(alone, e)]
                back[t] = from_
        best[0] = alone
        state = best.argmin(1)
        path = np.zeros(len(flat), np.int8)
        one = int(state[0])
        for t in range(int(n[0]) - 1, shared - 1, -1):
            path[t] = one
            one = int(back[t, one])
        state[0] = one
        for t in range(shared - 1, -1, -1):
            a = active[t]
            rows = begins[:a] + t
            path[rows] = state[:a]
            state[:a] = back[rows, state[:a]]
        for i, at, m in zip(order, begins, n):
            out[i] = path[at : at + m]
        return out

    def passages(self, texts: list[str | None], least: int = 10, margin: float = 0.25) -> Iterator[tuple[int, str | None, int, int, float]]:
        """(text, language, first word, last word, confidence) of passages of ``least`` or more words; words from 1.

        Shorter stretches between two long ones of one language belong to them. The language is None
        where the two smallest sizes differ by less than ``margin`` bytes a word.
        """
        docs = [_WORD.findall((t or "").lower()) for t in texts]
        ids = self.word_ids(docs)
        for d, path in enumerate(self.paths(ids)):
            if not len(path):
                continue
            cut = np.r_[0, np.flatnonzero(np.diff(path)) + 1, len(path)]
            runs = [[int(path[a]), int(a), int(b)] for a, b in zip(cut[:-1], cut[1:])]
            merged: list[list[int]] = []
            i = 0
            while i < len(runs):
                r = runs[i]
                if (
                    merged and r[2] - r[1] < least and i + 1 < len(runs) and merged[-1][0] == runs[i + 1][0]
                    and merged[-1][2] - merged[-1][1] >= least and runs[i + 1][2] - runs[i + 1][1] >= least
                ):
                    merged[-1][2] = runs[i + 1][2]
                    i += 2
                    continue
                merged.append(r)
                i += 1
            for _, a, b in merged:
                if b - a >= least:
                    yield (d, *self.decide(docs[d][a:b], ids[d][a:b], margin, a))

    def decide(self, words: list[str], ids: np.ndarray, margin: float, at: int = 0) -> tuple[str | None, int, int, float]:
        """The language with the smallest size of a passage, with its margin's confidence.

        The sizes of its words decide where they are far apart (``SURE`` bytes a word); otherwise the
        passage is encoded as running text, ``STRETCH`` words at a time, so that it can't match itself.
        """
        sizes, n = self.table[ids].sum(0), len(ids)
        apart = lambda s: float(np.subtract(*np.partition(s, 1)[1::-1])) / n if len(s) > 1 else 1.0
        if apart(sizes) < SURE:
            sizes = sum(np.array(self.sizes(" ".join(words[i : i + STRETCH])), float) for i in range(0, n, STRETCH))
        per_word = apart(sizes)
        return self.langs[int(sizes.argmin())] if per_word >= margin else None, at + 1, at + n, round(1 - 0.5**per_word, 4)


def fit(samples: DataFrame, labelled: DataFrame | None = None, sample_rows: int = 5000, adapt_rows: int = 2000, dictionary_bytes: int = 65536) -> Classifier:
    """The dictionaries. ``samples``: ``lang, sample_text``; ``labelled``: ``id, lang, text`` with stated languages.

    At most ``sample_rows`` samples and ``adapt_rows`` labelled documents (those with the smallest
    id hashes) are read to the driver, and a dictionary holds at most ``dictionary_bytes``; these
    bounds concern the fit alone, every document is classified.
    """
    texts: dict[str, list[str]] = defaultdict(list)
    for r in samples.where("lang IS NOT NULL AND sample_text IS NOT NULL").orderBy(F.xxhash64("sample_text"), "sample_text").limit(sample_rows).collect():
        texts[r.lang].append(r.sample_text.lower())
    clip = lambda s, n: s.encode()[:n].decode(errors="ignore") if n > 0 else ""
    base = {lang: clip(" ".join(ts), dictionary_bytes) for lang, ts in texts.items()}
    if not base:
        raise ValueError("no labelled samples")
    plain = Classifier(base)
    if labelled is None:
        return plain
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(adapt_rows).collect()
    more: dict[str, list[str]] = defaultdict(list)
    docs = [_WORD.findall(r.text.lower()) for r in rows]
    for d, lang, a, b, _ in plain.passages([r.text for r in rows], least=15, margin=1.0):
        if lang == rows[d].lang:
            more[lang].append(" ".join(docs[d][a - 1 : b]))
    # the samples stand last, where matches cost least
    return Classifier({lang: f"{clip(' '.join(more[lang]), dictionary_bytes - len(t.encode()) - 1)} {t}".lstrip() for lang, t in base.items()})


def with_stated(df: DataFrame, label_col: str, labels: DataFrame) -> DataFrame:
    """``df`` with ``stated_lang``: the language that the trimmed, lower-cased label states; NULL if it states none.

    ``labels``: ``label, lang``; of a label that stands twice the smaller language counts.
    """
    known = labels.where("label IS NOT NULL AND lang IS NOT NULL").groupBy(F.col("label").alias("_label")).agg(F.min("lang").alias("stated_lang"))
    plain = F.lower(F.regexp_replace(F.col(label_col), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return df.withColumn("_own", plain).join(known, F.col("_own") == F.col("_label"), "left").drop("_own", "_label")


def passages(df: DataFrame, classifier: Classifier, id_col: str = "id", text_col: str = "content", least: int = 10, margin: float = 0.25) -> DataFrame:
    """``id, passage_no, lang, first_word, last_word, n_words, confidence``: passages of ``least`` or more words, in order.

    NULL, empty and shorter texts have none; ``lang`` is NULL where no language is clearly the
    smallest. A narrow map; the broadcast classifier has a fixed size.
    """
    given = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    shared = df.sparkSession.sparkContext.broadcast(classifier)
    names = ["id", "passage_no", "lang", "first_word", "last_word", "n_words", "confidence"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for whole in batches:
            step = max(1, int(whole.num_rows * (4 << 20) / max(1, whole.nbytes)))
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                ids, out, seen = b.column(0).to_pylist(), [], defaultdict(int)
                for d, lang, first, last, conf in c.passages(b.column(1).to_pylist(), least, margin):
                    seen[d] += 1
                    out.append((ids[d], seen[d], lang, first, last, last - first + 1, conf))
                if out:
                    types = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c_, t) for c_, t in zip(zip(*out), types)], names=names)

    return given.mapInArrow(run, "id bigint, passage_no int, lang string, first_word int, last_word int, n_words int, confidence double")


def documents(df: DataFrame, found: DataFrame, labels: DataFrame, id_col: str = "id", label_col: str = "language") -> DataFrame:
    """``id, stated_lang, lang, confidence, share, n_langs`` of every document: the language of most words.

    ``share`` is that language's part of the classified words; a document without a classified
    passage has a NULL ``lang``.
    """
    per = found.where("lang IS NOT NULL").groupBy("id", "lang").agg(F.sum("n_words").alias("w"), F.sum(F.col("n_words") * F.col("confidence")).alias("c"))
    top = per.groupBy("id").agg(F.max(F.struct("w", F.col("c"), "lang")).alias("m"), F.sum("w").alias("all"), F.count(F.lit(1)).alias("n_langs"))
    base = with_stated(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label")), "label", labels)
    return base.join(top, "id", "left").select(
        "id", "stated_lang", F.col("m.lang").alias("lang"), F.round(F.col("m.c") / F.col("m.w"), 4).alias("confidence"), F.round(F.col("m.w") / F.col("all"), 4).alias("share"),
        F.coalesce("n_langs", F.lit(0).cast("bigint")).alias("n_langs"),
    )
