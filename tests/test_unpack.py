"""The packed-field splitter against a character-by-character version, and its edge cases."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.operators.unpack import split_packed, unpack

NAMES = ["Old primer", "Teacher's cards", "Bridge list v2.1", "Youth camp (2nd ed.)", "Zo-En pocket list"]
ODD = ['List "B", copied', "Plants, birds; beasts", "Names | places", "Verbs + particles"]


def pack(values, rng):
    out = []
    for v in values:
        plain = v in NAMES
        kind = rng.choice(["plain", "dq", "curly", "json"] if plain else ["dq", "json", "sq"])
        if kind == "plain":
            out.append(v)
        elif kind == "dq":
            out.append('"' + v.replace('"', '""') + '"')
        elif kind == "json":
            out.append('"' + v.replace('"', '\\"') + '"')
        elif kind == "curly":
            out.append(f"“{v}”")
        else:
            out.append(f"'{v}'")
    text = out[0]
    for o in out[1:]:
        text += rng.choice([", ", ";", "|", " / ", "\n", "\t", "，", " + ", ";; ", ", , "]) + o
    return rng.choice(["%s", "[%s]", "{%s}", " %s ", "%s;"]) % text


@pytest.mark.parametrize("seed", range(200))
def test_round_trip(seed):
    rng = random.Random(seed)
    values = [rng.choice(NAMES + ODD) for _ in range(rng.randint(1, 7))]
    assert split_packed(pa.array([pack(values, rng)]), "name").to_pylist() == [values]


@pytest.mark.parametrize(
    ("kind", "text", "want"),
    [
        ("name", None, []),
        ("name", "", []),
        ("name", "  ", []),
        ("name", "-", []),
        ("name", "A; -; B", ["A", "B"]),
        ("name", "a;a;a", ["a", "a", "a"]),
        ("name", "(A b; C d)", ["A b", "C d"]),
        ("name", 'He said "x; y', ["He said", "x", "y"]),
        ("name", '"Zo\\u00e9; x", y', ["Zoé; x", "y"]),
        ("name", '["a\\\\", "b"]', ["a\\", "b"]),
        ("name", "'Elder's notebook'; b", ["Elder's notebook", "b"]),
        ("part", "hia-pu-ngeil-", ["hia", "pu", "ngeil"]),
        ("part", '{"pa-ne",tik}', ["pa-ne", "tik"]),
        ("part", "thau · “tai” · piam", ["thau", "tai", "piam"]),
        ("code", "JOL \"LUK\"//1CH & 'REV'", ["JOL", "LUK", "1CH", "REV"]),
    ],
)
def test_cases(kind, text, want):
    assert split_packed(pa.array([text], pa.string()), kind).to_pylist() == [want]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab ,;|\"'“”\\()[]-é\n", max_size=30)), max_size=8), st.sampled_from(["name", "part", "code"]))
def test_batch_is_rows(values, kind):
    """A batch gives what its values give alone."""
    alone = [split_packed(pa.array([v], pa.string()), kind).to_pylist()[0] for v in values]
    assert split_packed(pa.array(values, pa.string()), kind).to_pylist() == alone


def test_long_value():
    text = ";".join(f'"v{i}"' for i in range(30_000))
    got = split_packed(pa.array([text, "x"]), "name").to_pylist()
    assert len(got[0]) == 30_000
    assert got[0][-1] == "v29999"
    assert got[1] == ["x"]


def test_frame(spark):
    df = spark.createDataFrame([(1, "a;b", "k"), (2, "a", "k"), (3, None, "k"), (3, "c|d|", "k")], "id long, packed string, value string")
    got = sorted(map(tuple, unpack(df, "name", 2, "id", "packed").collect()))
    assert got == [(1, 1, "a"), (1, 2, "b"), (3, 1, "c"), (3, 2, "d")]
    assert unpack(df.limit(0), "name", 1, "id", "packed").count() == 0
    with pytest.raises(ValueError):
        unpack(df, "other")


def test_unclosed_quotes_take_one_pass():
    import time

    for quote in ("\u201c", '"', "'"):
        value = ", ".join(f"{quote}a{i}" for i in range(2001))
        began = time.perf_counter()
        got = split_packed(pa.array([value, "x; y"]), "name").to_pylist()
        assert time.perf_counter() - began < 0.5
        assert got[1] == ["x", "y"]
        if quote == "\u201c":
            assert len(got[0]) == 2001


def test_sliced_and_chunked_buffers():
    values = pa.array(["zz", "é, (b c), “d;e”", None, "", "𝒳 | y"])
    assert split_packed(values.slice(1, 4), "name").to_pylist() == [["é", "b c", "d;e"], [], [], ["𝒳", "y"]]
