"""Place parsing (P2) against golden strings and a plain Python ``re`` parse."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tremor.operators import clean

# Golden table: text -> (distance, direction, nearest, state); None = null.
GOLDEN = [
    ("10 km SSE of Volcano, Hawaii", ("10 km", "SSE", "Volcano", "Hawaii")),
    ("8km NW of The Geysers, CA", ("8km", "NW", "The Geysers", "CA")),
    ("5 KM n OF x, ca", ("5 KM", "n", "x", "ca")),
    ("12 km of Foo, CA", ("12 km", None, "of Foo", "CA")),
    ("S of the Fiji Islands", (None, "S", "the Fiji Islands", None)),
    ("Puerto Rico region", (None, None, "Puerto Rico region", None)),
    ("5 km", (None, None, "5 km", None)),
    ("5 km , CA", ("5 km", None, "", "CA")),
    ("3 km N of A, B, CA", (None, None, "3 km N of A, B, CA", None)),
    ("1 km E of San José, Québec", (None, None, "1 km E of San José, Québec", None)),
    ("Foo,", (None, None, "Foo,", None)),
    ("  7 km W of Bar, Nevada  ", ("7 km", "W", "Bar", "Nevada")),
    (" 4 km E of Baz, NV\u3000", ("4 km", "E", "Baz", "NV")),
    ("\x1c6 km S of Qux, Utah\x1f", ("6 km", "S", "Qux", "Utah")),
    ("9\xa0km\xa0N of Ash, OR", ("9\xa0km", "N", "Ash", "OR")),
    ("2 km N of X\uffffY, CA", ("2 km", "N", "X\uffffY", "CA")),
    ("\uffff", (None, None, "\uffff", None)),
]

# FIXED VALUES — the place grammar for Python's re (the behaviour to match).
PY_PATTERN = re.compile(r"(?:(\d+\s*km)\s*)?(?:([NSEW]{1,3})\s*of\s*)?([^,]+?)(?:,\s*([A-Za-z ]+))?$",
                        re.IGNORECASE)


def py_parse(txt):
    """Parts as a Python ``re`` match of the stripped text gives them."""
    m = PY_PATTERN.match(txt.strip())
    if m is None:
        return (None, None, txt, None)
    distance, direction, nearest, state = m.groups()
    return (distance, direction, nearest.strip(), state)


def spark_parse(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, place string")
    rows = clean.parse_place(df).orderBy("i").collect()
    return [(r["distance"], r["direction"], r["nearest"], r["state"]) for r in rows]


def test_golden(spark):
    got = spark_parse(spark, [t for t, _ in GOLDEN])
    assert got == [e for _, e in GOLDEN]


def test_golden_matches_python(spark):
    assert [py_parse(t) for t, _ in GOLDEN] == [e for _, e in GOLDEN]


_ALPHABET = st.sampled_from(list("0123456789kmKMNSEWnsewOoFf ,abcxyz\u00e9") +
                            ["km", " of ", ", ", "\t", "\xa0", "\u3000", "\uffff",
                             "\x1c", "\u0663"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(_ALPHABET, min_size=1, max_size=12).map("".join),
                min_size=40, max_size=60))
def test_random_texts_match_python(spark, texts):
    assert spark_parse(spark, texts) == [py_parse(t) for t in texts]


def test_null_place(spark):
    df = spark.createDataFrame([(1, None)], "i int, place string")
    r = clean.parse_place(df).first()
    assert (r["distance"], r["direction"], r["nearest"], r["state"]) == (None,) * 4


def test_only_complete_parses_survive(spark):
    texts = [t for t, _ in GOLDEN]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, place string")
    kept = clean.drop_incomplete(clean.parse_place(df),
                                 ["distance", "direction", "nearest", "state"])
    expected = sum(1 for _, e in GOLDEN if None not in e)
    assert kept.count() == expected
