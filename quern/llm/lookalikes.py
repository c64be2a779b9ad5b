"""One consistent form for text that looks the same but differs in its characters.

Characters that need no context are folded by table: invisible ones go, every space becomes the
plain one, full- and half-width and font variants become ordinary, marks are composed (NFC). Letters
and digits are settled by word: a token with look-alikes walks a trie of the vocabulary as a weighted
edit automaton in which look-alikes and ignorables cost nothing and any other edit one; the most
frequent spelling reached at the least cost within a budget is canonical. Tokens that reach none are
normalised by table and position.

Only distinct doubtful tokens and distinct vocabulary words are shuffled, to buckets by skeleton
(equal for all spellings within zero cost), so each trie holds one bucket of the vocabulary. With a
budget above zero, tokens that found nothing go to the buckets of their skeleton and of all forms of
it that lack a letter, as do the words: two words within one edit share one of these.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.tokens import BASE, INVERSE, mix, powers
from quern.session import cut_lineage

# fixed values: letters that pass for Latin ones, with what they may stand for
LATIN_LIKE = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "li", "ү": "y",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Һ": "H", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ӏ": "Il", "Ү": "Y",
    # Greek
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
    # Armenian
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "յ": "j", "ց": "g", "Օ": "O", "Ս": "U", "Լ": "L", "Տ": "S",
    # Latin letters of other alphabets
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ʋ": "v", "ʟ": "L", "ꞓ": "c", "ꜱ": "s", "ᴄ": "c", "ᴏ": "o", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ⅼ": "l", "ⅰ": "i", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m", "ⅴ": "v", "ⅹ": "x",
}
# fixed values: digits and letters that pass for each other
DIGIT_LETTERS = {"0": "oO", "1": "lI"}
BURMESE = {"၀": "ဝ", "၇": "ရ"}

_INVISIBLE_MORE = [(0x34F, 0x34F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x2065, 0x2065), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0xE0000, 0xE0FFF)]
_SPACES = "".join(chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Zs", "Zl", "Zp") and c != 32) + "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85"
_VARIANTS = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0x2100, sys.maxunicode + 1) if unicodedata.decomposition(chr(c)).startswith(("<wide>", "<narrow>", "<font>"))}
_FOLD = {ord(c): " " for c in _SPACES} | {ord(c): t for c, t in _VARIANTS.items() if t.strip()}
_FOLD |= {c: None for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Cf", "Cc") and c not in _FOLD}
_FOLD |= {c: None for a, b in _INVISIBLE_MORE for c in range(a, b + 1)}
_ODD_ASCII = re.compile(r"[\x00-\x1f\x7f]|[A-Za-z][01]|[01][A-Za-z]|[0-9][oOlI]|[oOlI][0-9]")
_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_DIGIT_OF = {c: d for d, cs in DIGIT_LETTERS.items() for c in cs} | {v: k for k, v in BURMESE.items()}
_LETTERS_OF = DIGIT_LETTERS | BURMESE
_DOUBT = re.compile(
    "[" + "".join(LATIN_LIKE) + "]|[A-Za-z][01]|[01][A-Za-z]|[0-9][oOlI]|[oOlI][0-9]"
    "|[၀၇][က-ဿၐ-႟]|[က-ဿၐ-႟][၀၇]|[၀-၉][ဝရ]|[ဝရ][၀-၉]"
)


def fold(value: str) -> str:
    """What needs no context: spaces, invisible characters, width and font variants, composition."""
    return unicodedata.normalize("NFC", value.translate(_FOLD))


def doubtful(folded: str) -> list[str]:
    """Tokens of a folded value that hold characters which may stand for others."""
    if not _DOUBT.search(unicodedata.normalize("NFD", folded) if any(c in _PRECOMPOSED for c in folded) else folded):
        return []
    return [t for t in _TOKEN.findall(folded) if _DOUBT.search(unicodedata.normalize("NFD", t)) or _DOUBT.search(t)]


_PRECOMPOSED = {c for c in map(chr, range(0x370, 0x530)) if len(unicodedata.normalize("NFD", c)) > 1}


@lru_cache(maxsize=4096)
def _stands_for(c: str) -> str:
    """All plain characters that a character may stand for at no cost, lower case; itself first."""
    low = c.lower()
    out = [low] if len(low) == 1 else [c]
    for x in LATIN_LIKE.get(c, "") + LATIN_LIKE.get(low, "") + _LETTERS_OF.get(c, "") + _DIGIT_OF.get(c, ""):
        if x.lower() not in out:
            out.append(x.lower())
    return "".join(out)


@lru_cache(maxsize=4096)
def _class(c: str) -> str:
    """One name for all characters within zero cost of each other."""
    low = c.lower()
    first = LATIN_LIKE.get(c, LATIN_LIKE.get(low, low))[0].lower()
    first = _LETTERS_OF.get(first, first)[0].lower()
    return "l" if first in "li" else first


def skeleton(token: str) -> str:
    return "".join(_class(c) for c in unicodedata.normalize("NFD", token))


class Trie:
    """Vocabulary words with their counts, walked by look-alike."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str, count: int) -> None:
        node = self.root
        for c in unicodedata.normalize("NFD", word.lower()):
            node = node.setdefault(c, {})
        node[""] = node.get("", 0) + count

    def search(self, token: str, budget: int = 0) -> list[tuple[int, int, str]]:
        """(cost, count, spelling) of the words within the budget, in the token's letter case, the best first.

        States are spellings so far, with their node and least cost; ignorable characters are consumed without a move.
        Ties go to the greater spelling.
        """
        states: dict[str, tuple[dict, int]] = {"": (self.root, 0)}
        for c in unicodedata.normalize("NFD", token):
            if ord(c) in _FOLD and _FOLD[ord(c)] is None:
                continue
            upper = c.isupper()
            new: dict[str, tuple[dict, int]] = {}

            def put(out: str, node: dict, cost: int) -> None:
                if out not in new or cost < new[out][1]:
                    new[out] = node, cost

            for out, (node, cost) in self._skipping(states, budget).items():
                for x in _stands_for(c):
                    if x in node:
                        put(out + (x.upper() if upper else x), node[x], cost)
                if cost < budget:
                    put(out, node, cost + 1)
                    for x, child in node.items():
                        if x:
                            put(out + (x.upper() if upper else x), child, cost + 1)
            states = new
            if not states:
                return []
        ends = [(cost, node[""], out) for out, (node, cost) in self._skipping(states, budget).items() if "" in node]
        return [(c, n, unicodedata.normalize("NFC", out)) for c, n, out in sorted(ends, key=lambda e: (-e[0], e[1], e[2]), reverse=True)]

    @staticmethod
    def _skipping(states: dict[str, tuple[dict, int]], budget: int) -> dict[str, tuple[dict, int]]:
        """The states and those behind letters that the token lacks."""
        if not budget:
            return states
        out, todo = dict(states), list(states.items())
        while todo:
            at, (node, cost) = todo.pop()
            if cost < budget:
                for x, child in node.items():
                    if x and (at + x not in out or cost + 1 < out[at + x][1]):
                        out[at + x] = child, cost + 1
                        todo.append((at + x, out[at + x]))
        return out

    def spelling(self, token: str) -> str | None:
        """The most frequent word within zero cost, in the token's letter case; None if there is none."""
        found = self.search(token)
        return found[0][2] if found else None


def near_keys(token: str) -> np.ndarray:
    """Hashes of a skeleton and of every form of it that lacks one letter, in time linear in its length."""
    points = np.frombuffer(skeleton(token).encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(points)
    with np.errstate(over="ignore"):
        before = np.r_[np.uint64(0), np.cumsum(mix(points) * powers(BASE, n))].astype(np.uint64)
        whole = mix(before[-1:] + mix(np.array([n], np.uint64)))
        less = mix(before[:-1] + (before[-1] - before[1:]) * INVERSE + mix(np.array([n - 1], np.uint64))) if n else whole[:0]
    return np.unique(np.r_[whole, less]).view(np.int64)


def by_table(token: str) -> str:
    """The table's form of a token that is in no trie.

    Letters of other alphabets become Latin only if every letter of the token passes for one. A
    character that may be a digit or a letter follows its neighbours: a mark behind it makes it a
    letter; else the nearest certain characters on both sides decide, if they agree.
    """
    chars = list(unicodedata.normalize("NFD", token))
    letters = [c for c in chars if c.isalpha()]
    if any(c in LATIN_LIKE for c in letters) and all(c in LATIN_LIKE or c.isascii() or unicodedata.name(c, "").startswith("LATIN") for c in letters):
        chars = [LATIN_LIKE.get(c, c)[0] for c in chars]
    unsure = [c in _LETTERS_OF or c in _DIGIT_OF for c in chars]
    marked = any(u and c.isdigit() and unicodedata.category(n)[0] == "M" for u, c, n in zip(unsure, chars, chars[1:]))
    alike = all(u or not c.isalnum() for u, c in zip(unsure, chars)) and len({c.isdigit() for c in chars if c.isalnum()}) < 2
    if not any(unsure) or alike and not marked:
        return unicodedata.normalize("NFC", "".join(chars))
    burmese = any("က" <= c <= "႟" for c in chars)
    out = chars[:]
    for i, c in enumerate(chars):
        if not unsure[i]:
            continue
        left = next((x.isdigit() for x, u in zip(chars[i - 1 :: -1] if i else [], unsure[i - 1 :: -1] if i else []) if not u), None)
        right = next((x.isdigit() for x, u in zip(chars[i + 1 :], unsure[i + 1 :]) if not u), None)
        if i + 1 < len(chars) and unicodedata.category(chars[i + 1])[0] == "M":
            digit = False
        elif left is None and right is None:
            digit = True  # only unsure ones, digits among them
        elif left is not None and right is not None:
            if left != right:
                continue
            digit = left
        else:
            digit = right if left is None else left
            if not burmese and not digit:
                continue
        if digit and c in _DIGIT_OF:
            out[i] = _DIGIT_OF[c]
        elif not digit and c in _LETTERS_OF:
            out[i] = _LETTERS_OF[c][0]
    return unicodedata.normalize("NFC", "".join(out))


def _scan(fields: list[tuple[int, DataFrame, str, str]], keep_clean: bool) -> DataFrame:
    """``f, record_id, value, folded, tokens`` of the values to look at (all of them with keep_clean)."""
    parts = [df.select(F.lit(i).alias("f"), F.col(idc).cast("bigint").alias("record_id"), F.col(col).cast("string").alias("value")) for i, df, col, idc in fields]
    rows = reduce(DataFrame.unionAll, parts).where("value IS NOT NULL")
    if not keep_clean:
        rows = rows.where(F.col("value").rlike(r"[^ -~]|[A-Za-z][01]|[01][A-Za-z]|[0-9][oOlI]|[oOlI][0-9]"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(2).to_pylist()
            folded, tokens, keep = [], [], []
            for i, v in enumerate(values):
                if v.isascii() and not _ODD_ASCII.search(v):
                    s, t = v, []
                else:
                    s = fold(v)
                    t = doubtful(s)
                if keep_clean or t or s != v:
                    keep.append(i)
                    folded.append(s)
                    tokens.append(t)
            if keep:
                at = pa.array(keep)
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(3)), pa.array(folded, pa.string()), pa.array(tokens, pa.list_(pa.string()))], names=["f", "record_id", "value", "folded", "tokens"])

    return rows.mapInArrow(run, "f int, record_id bigint, value string, folded string, tokens array<string>")


def _spellings(tokens: DataFrame, lexicon: DataFrame, buckets: int) -> DataFrame:
    """``token, canonical`` for each distinct token, by a trie of each bucket of the lexicon."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"bucket": [skeleton(t) for t in b["token"]], "token": b["token"], "n": b["n"]})

    both = lexicon.select("token", "n").unionAll(tokens.select("token", F.lit(0).cast("bigint").alias("n")))
    both = both.mapInPandas(keyed, "bucket string, token string, n bigint").withColumn("bucket", F.pmod(F.xxhash64("bucket"), F.lit(buckets)))
    # lexicon words (n > 0) come before the tokens of their bucket
    both = both.repartition("bucket").sortWithinPartitions("bucket", F.col("n").desc())

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, trie = None, Trie()
        for b in batches:
            out: list[tuple[str, str, bool]] = []
            for key, token, n in zip(b["bucket"].tolist(), b["token"].tolist(), b["n"].tolist()):
                if key != bucket:
                    bucket, trie = key, Trie()
                if n:
                    trie.add(token, n)
                else:
                    found = trie.spelling(token)
                    out.append((token, found or by_table(token), found is not None))
            yield pd.DataFrame(out, columns=["token", "canonical", "found"]).astype({"found": bool})

    return both.mapInPandas(walk, "token string, canonical string, found boolean")


def near_spellings(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``token, near, n, confidence``: for each distinct token the most frequent word at one edit; those that reach none have no row.

    ``confidence`` is the share of that word in the occurrences of all words at one edit. ``lexicon``: token, n.
    """

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = [near_keys(t) for t in b["token"]]
            sizes = [len(k) for k in keys]
            rows = b.loc[b.index.repeat(sizes)]
            yield pd.DataFrame({"bucket": np.concatenate(keys) if keys else np.zeros(0, np.int64), "token": rows["token"].to_numpy(), "n": rows["n"].to_numpy()})

    both = lexicon.select("token", "n").unionAll(tokens.select("token", F.lit(0).cast("bigint").alias("n")).distinct())
    both = both.mapInPandas(keyed, "bucket bigint, token string, n bigint").repartition("bucket").sortWithinPartitions("bucket", F.col("n").desc())

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, trie = None, Trie()
        for b in batches:
            out: list[tuple[str, str, int]] = []
            for key, token, n in zip(b["bucket"].tolist(), b["token"].tolist(), b["n"].tolist()):
                if key != bucket:
                    bucket, trie = key, Trie()
                if n:
                    trie.add(token, n)
                else:
                    out += [(token, word, count) for cost, count, word in trie.search(token, 1) if cost == 1]
            yield pd.DataFrame(out, columns=["token", "near", "n"]).astype({"n": "int64"})

    # a word may be met in several buckets
    found = both.mapInPandas(walk, "token string, near string, n bigint").distinct()
    best = found.groupBy("token").agg(F.max(F.struct("n", "near")).alias("m"), F.sum("n").alias("all"))
    return best.select("token", F.col("m.near").alias("near"), F.col("m.n").alias("n"), F.round(F.col("m.n") / F.col("all"), 4).alias("confidence"))


def _lexicon(fields: list[tuple[DataFrame, str]]) -> DataFrame:
    """``token, n``: distinct lower-case words of the vocabulary that hold nothing doubtful."""
    parts = [df.where(F.col(c).isNotNull()).select(F.explode(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))).alias("token")) for df, c in fields]
    words = reduce(DataFrame.unionAll, parts).groupBy("token").agg(F.count(F.lit(1)).alias("n"))

    def sure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[fold(t) == t and not doubtful(t) for t in b["token"]]]

    return words.mapInPandas(sure, "token string, n bigint")


def near_report(fields: list[tuple[str, str, DataFrame]], lexicon: list[tuple[DataFrame, str]], id_col: str = "id", buckets: int = 4096) -> DataFrame:
    """``token, by_table, near, n, confidence`` of the doubtful tokens that no word equals at zero cost but one does at one edit: what a budget of 1 could change."""
    scanned = _scan([(i, df, c, id_col) for i, (_, c, df) in enumerate(fields)], False)
    distinct = cut_lineage(scanned.select(F.explode("tokens").alias("token")).distinct())
    lost = cut_lineage(_spellings(distinct, _lexicon(lexicon), buckets).where("NOT found").select("token", F.col("canonical").alias("by_table")))
    return lost.join(near_spellings(lost.select("token"), _lexicon(lexicon)), "token")


def canonicalise(fields: list[tuple[str, str, DataFrame]], lexicon: list[tuple[DataFrame, str]], id_col: str = "id", keep_clean: bool = True, buckets: int = 4096, budget: int = 0, confidence: float = 0.9) -> DataFrame:
    """``table_name, field_name, record_id, value, canonical`` of every value that is not NULL.

    With a ``budget`` of 1, a doubtful token that no word equals at zero cost takes the word at one edit, if its ``confidence`` is as high.
    ``fields``: (table name, column, table); ``lexicon``: (table, column) whose clean words are the
    vocabulary. Without ``keep_clean`` only values that differ from their canonical form come out.
    Letter case, extra plain spaces and accents as such are kept; empty text stays empty.
    """
    scanned = cut_lineage(_scan([(i, df, c, id_col) for i, (_, c, df) in enumerate(fields)], False))
    doubt = scanned.where(F.size("tokens") > 0)
    distinct = doubt.select(F.explode("tokens").alias("token")).distinct()
    spelt = _spellings(distinct, _lexicon(lexicon), buckets)
    if budget:
        spelt = cut_lineage(spelt)
        near = near_spellings(spelt.where("NOT found").select("token"), _lexicon(lexicon)).where(F.col("confidence") >= confidence)
        spelt = spelt.join(near.select("token", "near"), "token", "left").select("token", F.coalesce("near", "canonical").alias("canonical"))
    changed = spelt.where("token <> canonical").select("token", "canonical")
    pairs = doubt.select("f", "record_id", F.explode(F.array_distinct("tokens")).alias("token")).join(changed, "token")
    fixes = pairs.groupBy("f", "record_id").agg(F.collect_list(F.struct("token", "canonical")).alias("fixes"))
    scanned = scanned.join(fixes, ["f", "record_id"], "left")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for s, fx in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
                if fx:
                    to = {x["token"]: x["canonical"] for x in fx}
                    s = unicodedata.normalize("NFC", _TOKEN.sub(lambda m: to.get(m[0], m[0]), s))
                out.append(s)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.string())], names=["f", "record_id", "value", "canonical"])

    done = scanned.select("f", "record_id", "value", "folded", "fixes").mapInArrow(apply, "f int, record_id bigint, value string, canonical string").where("value <> canonical")
    names = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(c).alias("c")) for t, c, _ in fields])
    if keep_clean:
        every = reduce(DataFrame.unionAll, [df.where(F.col(c).isNotNull()).select(F.lit(i).alias("f"), F.col(id_col).cast("bigint").alias("record_id"), F.col(c).alias("value")) for i, (_, c, df) in enumerate(fields)])
        done = every.join(done.select("f", "record_id", "canonical"), ["f", "record_id"], "left").withColumn("canonical", F.coalesce("canonical", "value"))
    return done.select(names[F.col("f")]["t"].alias("table_name"), names[F.col("f")]["c"].alias("field_name"), "record_id", "value", "canonical")
