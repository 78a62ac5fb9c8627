import random

import numpy as np
import pytest

from knotwork.functions import pairs as P
from knotwork.functions.similarity import jaro_winkler, lcs, osa, ratio


def slow_osa(a, b):
    d = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def slow_lcs(a, b):
    p = [0] * (len(b) + 1)
    for c in a:
        q = [0]
        for j, e in enumerate(b):
            q.append(max(q[-1], p[j + 1], p[j] + 1 if c == e else 0))
        p = q
    return p[-1]


def samples(n=3000, letters="abcd", most=12):
    r = random.Random(0)
    word = lambda: "".join(r.choice(letters) for _ in range(r.randint(0, most)))
    return [word() for _ in range(n)], [word() for _ in range(n)]


def test_distances_against_plain_tables():
    a, b = samples()
    assert osa(a, b).tolist() == [slow_osa(*x) for x in zip(a, b)]
    assert lcs(a, b).tolist() == [slow_lcs(*x) for x in zip(a, b)]


def test_jaro_winkler_against_sql():
    duckdb = pytest.importorskip("duckdb")
    import pandas as pd

    a, b = samples(2000, "abcdef", 20)
    keep = [i for i in range(len(a)) if a[i] and b[i]]
    t = pd.DataFrame({"i": range(len(keep)), "a": [a[i] for i in keep], "b": [b[i] for i in keep]})
    con = duckdb.connect()
    con.register("t", t)
    expected = [x[0] for x in con.sql("select jaro_winkler_similarity(a, b) from t order by i").fetchall()]
    assert np.allclose(P.similar(t.a.tolist(), t.b.tolist()), expected, atol=1e-9)


def test_partial_ratio_against_all_windows():
    a, b = samples(400, "abc", 10)

    def slow(x, y):
        best = 0.0
        for s, t in [(x, y)] if len(x) < len(y) else [(y, x)] if len(y) < len(x) else [(x, y), (y, x)]:
            for k in range(1 - len(s), len(t)):
                w = t[max(0, k) : k + len(s)]
                best = max(best, 200 * slow_lcs(s, w) / (len(s) + len(w)))
        return best

    assert np.allclose(P.partial_ratio(a, b), [slow(*x) if all(x) else (100.0 if x[0] == x[1] else 0.0) for x in zip(a, b)])


def test_long_texts_take_the_same_way():
    a, b = samples(200, "abcd", 60)
    assert lcs(a, b).tolist() == [slow_lcs(*x) for x in zip(a, b)]


def test_edges():
    assert jaro_winkler(["", "", "a"], ["", "x", "a"]).tolist() == [1.0, 0.0, 1.0]
    assert ratio(["kitten"], ["sitting"])[0] == pytest.approx(61.538, abs=1e-3)
    assert len(jaro_winkler([], [])) == 0


def test_word_ratios():
    assert P.token_set_ratio(["fuzzy was a bear"], ["fuzzy fuzzy was a bear"])[0] == 100
    assert P.partial_ratio(["this is a test"], ["this is a test!"])[0] == 100
    assert P.weighted_ratio(["acme corp"], ["acme corp"])[0] == 100
    assert P.token_set_ratio(["ab cd"], ["ef gh"])[0] == pytest.approx(ratio(["ab cd"], ["ef gh"])[0])
