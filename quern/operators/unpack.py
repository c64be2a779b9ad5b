"""Several values packed in one string field, split into one row per value.

The string buffer of an Arrow batch is decoded once into code points and scanned as a whole: quote events
are stepped through in lockstep over all values (the first event of every value, then the second,
...), which gives quote parity; a delimiter mask follows from it; child offsets of a list array
are derived from the masks, and the list is flattened with its parent ordinals. No Python code
runs per value, but for the rare ones that hold backslash escapes other than of quotes.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: kind of field -> what a value may hold outside quotes
KINDS = {"name": "letters, digits, space . ' - ( )", "part": "letters", "code": "letters, digits"}

_ALLOWED, _SPACE, _DQ, _SQ, _LC, _RC, _BACK, _DELIM = range(8)


@lru_cache(maxsize=8192)
def _class_of(cp: int, kind: str) -> int:
    ch = chr(cp)
    if ch == '"':
        return _DQ
    if ch == "'":
        return _SQ
    if ch == "“":
        return _LC
    if ch == "”":
        return _RC
    if ch == "\\":
        return _BACK
    cat = unicodedata.category(ch)
    if cat[0] in "LM":
        return _ALLOWED
    if kind == "part":
        return _DELIM
    if cat[0] == "N":
        return _ALLOWED
    if kind == "code":
        return _DELIM
    if cat == "Zs":
        return _SPACE
    return _ALLOWED if ch in ".-()’" else _DELIM


def _classes(cps: np.ndarray, kind: str) -> np.ndarray:
    seen, back = np.unique(cps, return_inverse=True)
    return np.array([_class_of(int(c), kind) for c in seen], dtype=np.uint8)[back]


def _next_other(skip: np.ndarray, n: int) -> np.ndarray:
    """For each i the first j > i with not skip[j]; n where there is none."""
    at = np.where(skip, n, np.arange(n))
    out = np.full(n, n)
    if n > 1:
        out[:-1] = np.minimum.accumulate(at[::-1])[::-1][1:]
    return out


def _prev_other(skip: np.ndarray, n: int) -> np.ndarray:
    at = np.where(skip, -1, np.arange(n))
    out = np.full(n, -1)
    if n > 1:
        out[1:] = np.maximum.accumulate(at)[:-1]
    return out


def split_packed(values: pa.Array, kind: str) -> pa.ListArray:
    """A list array with the values packed in each string; NULL, blank and ``-`` give no value."""
    count = len(values)
    cps, lengths = _code_points(values)
    n = len(cps)
    if n == 0:
        return pa.ListArray.from_arrays(pa.array(np.zeros(count + 1, np.int32)), pa.array([], pa.string()))
    owner = np.repeat(np.arange(count), lengths)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    cls = _classes(cps, kind)
    where = np.arange(n)

    # an odd run of backslashes escapes the character after it
    back = cls == _BACK
    run = where - np.maximum.accumulate(np.where(back, -1, where))
    escaped = np.zeros(n, bool)
    escaped[1:] = (run[:-1] % 2 == 1) & (owner[1:] == owner[:-1])
    quote = np.isin(cls, (_DQ, _SQ, _LC, _RC)) & ~escaped

    # is the neighbour that counts a boundary: the end of the value or a delimiter?
    skip = cls == _SPACE
    nxt, prv = _next_other(skip, n), _prev_other(skip, n)
    bounds = np.isin(cls, (_DELIM,))
    nxt_bound = (nxt >= ends[owner]) | bounds[np.minimum(nxt, n - 1)]
    prv_bound = (prv < starts[owner]) | bounds[np.maximum(prv, 0)]

    opens, closes = _parity(cls, quote, owner, count, nxt_bound, prv_bound)
    depth = np.cumsum(opens.astype(np.int32) - closes.astype(np.int32))
    inside = (depth > 0) | closes
    fresh = np.zeros(n, bool)
    fresh[starts[lengths > 0]] = True
    # a quote closed and opened again without a gap is a doubled, that is, a literal one
    doubled = np.zeros(n, bool)
    doubled[1:] = opens[1:] & closes[:-1] & (cls[1:] == cls[:-1]) & ~fresh[1:]
    marks = (opens | closes) & ~doubled
    apostrophe = (cls == _SQ) & ~opens & ~closes
    fine = inside | (cls == _ALLOWED) | (cls == _SPACE) | (apostrophe & (kind == "name")) | marks
    escapes = back & ~escaped & inside
    # pieces are runs of fine characters within one value
    starts_piece = fine.copy()
    starts_piece[1:] &= ~fine[:-1] | fresh[1:]
    piece = np.cumsum(starts_piece) - 1
    content = fine & ~marks & ~escapes
    blank = np.isin(cps, _blanks(cps))
    solid = np.flatnonzero(content & ~blank)
    if not len(solid):
        return pa.ListArray.from_arrays(pa.array(np.zeros(count + 1, np.int32)), pa.array([], pa.string()))
    pid = piece[solid]
    head = np.r_[True, pid[1:] != pid[:-1]]
    first, last = solid[head], solid[np.r_[head[1:], True]]
    # a bracket that closes elsewhere, or that encloses all, isn't part of the value
    opened, closed = cps[first] == 40, cps[last] == 41
    if kind == "name" and (opened.any() or closed.any()):
        total = np.r_[0, np.cumsum((cps == 40).astype(np.int64) - (cps == 41))]
        net = total[last + 1] - total[first]
        quoted = inside[first]
        low = np.zeros(len(first), np.int64)
        both = np.flatnonzero(opened & closed & ~quoted)
        if len(both):  # the least depth within each piece
            low[both] = np.minimum.reduceat(total, np.c_[first[both] + 1, last[both] + 1].ravel())[::2] - total[first[both]]
        first = first + (~quoted & opened & ((net > 0) | (low > 0)))
        last = last - (~quoted & closed & ((net < 0) | (low > 0)))
        whole = first <= last  # a piece of brackets alone is empty
        first, last = first[whole], last[whole]
    keep_from = np.zeros(n + 1, np.int32)
    np.add.at(keep_from, first, 1)
    np.add.at(keep_from, last + 1, -1)
    kept = (np.cumsum(keep_from)[:-1] > 0) & content
    sizes = np.add.reduceat(kept.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    odd = back & escaped & inside | escapes & _escapes_letter(cps)
    dash = (sizes == 1) & (cps[first] == 45)
    out = _strings(cps[kept], sizes)
    if odd.any():
        hit = np.flatnonzero(np.isin(piece[first], np.unique(piece[odd])))
        fixed = out.to_pylist()
        for i in hit:
            fixed[i] = _unescape(cps[first[i] : last[i] + 1].tobytes().decode("utf-32-le"))
        out = pa.array(fixed, pa.string())
    alive = (sizes > 0) & ~dash
    parent = owner[first][alive]
    offsets = np.r_[0, np.cumsum(np.bincount(parent, minlength=count))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), out.filter(pa.array(alive)))


def _code_points(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all strings, one after the other, and how many each has; NULL has none."""
    strings = pc.fill_null(values.cast(pa.large_string()), "")
    strings = strings.combine_chunks() if isinstance(strings, pa.ChunkedArray) else strings
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64, len(strings) + 1, strings.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint32), np.zeros(len(strings), np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    upto = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)][at - at[0]]  # bytes that begin a code point
    return np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.uint32), np.diff(upto)


def _blanks(cps: np.ndarray) -> np.ndarray:
    return np.array([c for c in np.unique(cps) if chr(c).isspace()], dtype=np.uint32)


def _escapes_letter(cps: np.ndarray) -> np.ndarray:
    nxt = np.r_[cps[1:], 0]
    return np.isin(nxt, np.frombuffer("untrbf".encode("utf-32-le"), np.uint32))


def _unescape(raw: str) -> str:
    try:
        return json.loads('"' + raw.replace('\\"', '"').replace("\\'", "'").replace('"', '\\"') + '"').strip()
    except ValueError:
        return raw.replace("\\\\", "\\").strip()


def _strings(cps: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A string array over code points; sizes: of each string, in code points."""
    data = cps.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    width = 1 + (cps > 0x7F).astype(np.int64) + (cps > 0x7FF) + (cps > 0xFFFF)
    upto = np.r_[0, np.cumsum(width)][np.r_[0, np.cumsum(sizes)]].astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(upto), pa.py_buffer(data))


def _parity(cls, quote, owner, count, nxt_bound, prv_bound):
    """Which quote characters open and which close; stepped in lockstep, once.

    A quote closes at the next one of its kind that may close, so an opening quote behind the last of these in its value
    is never closed: it is an ordinary character.
    """
    n = len(cls)
    opens, closes = np.zeros(n, bool), np.zeros(n, bool)
    events = np.flatnonzero(quote)
    if not len(events):
        return opens, closes
    own, what = owner[events], cls[events]
    closed = np.zeros(len(events), bool)
    for kind, ends in ((_DQ, what == _DQ), (_SQ, (what == _SQ) & nxt_bound[events]), (_LC, what == _RC)):
        last = np.full(count, -1, np.int64)
        last[own[ends]] = events[ends]  # in order: the last one stays
        closed |= (what == kind) & (events < last[own])
    rank = np.arange(len(own)) - np.searchsorted(own, own)
    order = np.argsort(rank, kind="stable")
    steps = np.split(order, np.cumsum(np.bincount(rank))[:-1])
    state = np.full(count, 255, np.uint8)  # the class of the quote that is open
    for step in steps:
        at, who, now_what = events[step], own[step], what[step]
        now = state[who]
        may = (now_what == _DQ) | ((now_what == _SQ) & prv_bound[at]) | (now_what == _LC)
        op = (now == 255) & may & closed[step]
        shut = ((now == _DQ) & (now_what == _DQ)) | ((now == _SQ) & (now_what == _SQ) & nxt_bound[at]) | ((now == _LC) & (now_what == _RC))
        opens[at[op]] = True
        closes[at[shut]] = True
        state[who[op]] = now_what[op]
        state[who[shut]] = 255
    return opens, closes


def unpack(df: DataFrame, kind: str, least: int = 1, id_col: str = "record_id", value_col: str = "packed") -> DataFrame:
    """One row (``record_id``, ``value_pos``, ``value``) for each value packed in ``value_col``.

    ``kind`` is a key of :data:`KINDS`; ``least``: leave out fields that hold fewer values. Missing
    fields (NULL, blank, ``-``) give no row, empty values are neither output nor counted, repeated
    ones are kept. The split is a narrow map: no shuffle, and no field, however long, is cut.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {sorted(KINDS)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = split_packed(batch.column(1), kind)
            sizes = np.diff(lists.offsets.to_numpy())
            parents = pc.list_parent_indices(lists).to_numpy()
            pos = np.arange(len(parents)) - lists.offsets.to_numpy()[parents] + 1
            keep = sizes[parents] >= least
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(parents[keep])), pa.array(pos[keep].astype(np.int64)), pc.list_flatten(lists).filter(pa.array(keep))],
                    names=["record_id", "value_pos", "value"],
                )

    given = df.select(F.col(id_col).cast("bigint").alias("record_id"), F.col(value_col).cast("string").alias("packed"))
    given = given.where(F.col("packed").isNotNull() & ~F.trim("packed").isin("", "-"))
    return given.mapInArrow(run, "record_id bigint, value_pos bigint, value string")
