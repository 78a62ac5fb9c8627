import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from knotwork.operators.packed import FILLERS, parse, unpack


def values(text):
    return [v[0] for v in parse(text)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, []), ("", []), ("  ", []), (",", []), ("[]", []), ('""', []), ("-", []), ("NaN", []), ("none,S2-1", ["S2-1"]), ("S2-1", ["S2-1"]),
        ("S2-1, S3-2;S2-3|S3-4", ["S2-1", "S3-2", "S2-3", "S3-4"]), ("S2-1 / S3-2", ["S2-1", "S3-2"]), ("a/b", ["a/b"]), ("S2-1，S3-2\tS2-3\nS3-4", ["S2-1", "S3-2", "S2-3", "S3-4"]),
        ('"S2-1 | review", "S3-2"', ["S2-1 | review", "S3-2"]), ('"S2-1 ""closed""" | S3-2', ['S2-1 "closed"', "S3-2"]), (r'"S2-1 \"x\""', ['S2-1 "x"']),
        ("['S2-1', 'S3-2']", ["S2-1", "S3-2"]), ("{S2-1}", ["S2-1"]), ("(S2-1 S3-2)", ["S2-1", "S3-2"]), ('"none", "S2-1"', ["S2-1"]), ('{"S2-1"\n-\n"S3-2"}', ["S2-1", "S3-2"]),
    ],
)
def test_grammar(text, expected):
    assert values(text) == expected


def test_malformed_quotes_and_brackets_are_flagged():
    assert parse('"S2-1, S3-2') == [("S2-1", "bare", "open_quote", 0), ("S3-2", "bare", None, 7)]
    assert [v[2] for v in parse("[S2-1, S3-2")] == ["open_bracket", "open_bracket"]
    assert values('"a"b, c') == ['a"b', "c"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab1 ,;\"'|/[]", min_size=1, max_size=8).map(str.strip).filter(lambda s: s.lower() not in FILLERS), max_size=6))
def test_quoted_values_come_back(xs):
    assert values(", ".join('"' + x.replace('"', '""') + '"' for x in xs)) == xs
    assert values(json.dumps(xs)) == xs


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="S2-1 \"',;|/[](){}\\", max_size=40))
def test_any_text_parses(text):
    assert all(v[0].strip() for v in parse(text))


def test_long_malformed_text_takes_linear_time():
    assert len(parse('"a ' * 100_000)) == 100_000


def test_unpack_rows(spark):
    rows = [("a", "x,y", 1), ("a", "x,y", 1), (None, "z", 2), ("b", None, 3), ("c", '["p q"]', 4), ("d", "solo", 5)]
    df = spark.createDataFrame(rows, "id string, ids string, matched_value int")
    got = sorted(map(tuple, unpack(df, "ids", ["id"]).collect()), key=str)
    assert got == sorted([("a", 1, "x"), ("a", 2, "y"), ("a", 1, "x"), ("a", 2, "y"), (None, 1, "z"), ("c", 1, "p q"), ("d", 1, "solo")], key=str)
    assert unpack(df.limit(0), "ids", ["id"]).count() == 0
    flagged = unpack(spark.createDataFrame([("a", '"x')], "id string, ids string"), "ids", ["id"], flags=True).collect()
    assert flagged[0]["error"] == "open_quote" and flagged[0]["at"] == 0


def test_random_lists(spark):
    r = random.Random(1)
    rows = [(i, [f"S{r.randint(2, 3)}-{r.randint(1, 99)}" for _ in range(r.randint(0, 5))], r.choice([",", ";", " | ", "\t", "\n", " / ", "，"])) for i in range(200)]
    df = spark.createDataFrame([(str(i), s.join(x)) for i, x, s in rows], "id string, ids string")
    got = {}
    for x in unpack(df, "ids", ["id"]).collect():
        got.setdefault(x.id, {})[x.value_no] = x.matched_value
    assert got == {str(i): dict(enumerate(x, 1)) for i, x, _ in rows if x}
