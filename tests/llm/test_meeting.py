"""Pairs that meet under keys, against brute force over all pairs."""

import random
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from knotwork.llm import meeting, names

COLUMNS = ["given", "families", "trade", "number", "joined", "folded"]


def readings(n, seed):
    r = random.Random(seed)
    syllables = "kel mav or tru desh san od ik fev ull gro phan xeq wyz aa ee रो шко".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    base = [word() for _ in range(max(4, n // 40))]

    def typo(w):
        i = r.randrange(len(w))
        return r.choice([w, w, w, w[:i] + w[i + 1 :], w[:i] + "e" + w[i:], w + "xxx", w[:i] + w[i : i + 2][::-1] + w[i + 2 :]]) or w

    out = {("", "a" * 300, "", "", "", False), ("", "", "", "", "b" * 300, False)}
    while len(out) < n:
        kind, f = r.random(), [typo(r.choice(base)) for _ in range(r.choice([1, 2, 2, 2, 2, 3, 4]))]
        joined = "".join(f) if kind < 0.2 else ""
        out.add((r.choice(["", "", "robert", "r", "edward|theodore", "é"]), "" if joined else " ".join(f), r.choice(["", "roofing", "bakery"]), r.choice(["", "", "2"]), joined, r.random() < 0.15))
    return pd.DataFrame(sorted(out), columns=COLUMNS)


@pytest.mark.parametrize("seed", [1, 2])
def test_no_pair_that_agrees_is_ruled_out(seed):
    df = readings(350, seed)
    rows = df.values.tolist()
    s = np.frombuffer(b"".join(names._signature(*(x[c] for c in (0, 1, 2, 4, 5))) for x in rows), names.SIGNATURE)
    i, j = (np.array(x) for x in zip(*combinations(range(len(df)), 2)))
    agree = names._agree(df.iloc[i].reset_index(drop=True), df.iloc[j].reset_index(drop=True)).values
    left = {(min(p), max(p)) for p in zip(*(x.tolist() for x in names._possible(s)(i, j)))}
    assert agree.sum() > 300 and {(a, b) for a, b, ok in zip(i.tolist(), j.tolist(), agree) if ok} <= left
    # and most others are
    two = np.array([len(x[1].split()) == 2 for x in rows])
    assert sum(two[a] and two[b] for a, b in left) < 3 * (agree & two[i] & two[j]).sum()


def test_neighbours():
    r = np.random.default_rng(4)
    for n in (0, 1, 400):
        key = np.sort(r.integers(0, 60, n))
        leads = r.random(n) < 0.5
        got = [(int(a), int(b)) for i, j in meeting.neighbours(key, leads) for a, b in zip(i, j)]
        assert sorted(got) == [(a, b) for a, b in combinations(range(n), 2) if key[a] == key[b] and leads[a]]


def test_pairs_become_rows_once_and_only_if_possible(spark, monkeypatch):
    kind = np.dtype([("x", "<i4")])
    r = random.Random(7)
    rows = [(k, n, n % 3 > 0, np.int32(n % 5).tobytes()) for n in range(300) for k in {r.randrange(40) for _ in range(3)}]
    df = spark.createDataFrame(rows, "key long, n long, leads boolean, signature binary")
    want = {tuple(sorted((a[1], b[1]))) for a, b in combinations(rows, 2) if a[0] == b[0] and (a[2] or b[2]) and a[1] % 5 == b[1] % 5 and a[1] != b[1]}

    def possible(s):
        x = s["x"]
        return lambda i, j: (i[x[i] == x[j]], j[x[i] == x[j]])

    found = meeting.possible_pairs(df, kind, possible)
    got = [tuple(x) for x in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert "Join" not in found._jdf.queryExecution().toString()
    # a key may go on over many batches of Arrow, and a task's rows are taken in several goes
    monkeypatch.setattr(meeting, "ROWS", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert {tuple(x) for x in meeting.possible_pairs(df, kind, possible).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_signatures_of_a_slice():
    column = pa.array([b"abcd", b"efgh", b"ijkl"], pa.binary()).slice(1)
    assert meeting.signatures(column, np.dtype([("x", "S4")]))["x"].tolist() == [b"efgh", b"ijkl"]
