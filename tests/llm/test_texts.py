import random

import numpy as np
import pytest

from knotwork.llm import leaks, packing, truncated

ITEM = "Assume that Poditel holds 2694 pairs and that no record weighs over 2 grams. Given the Betaman matrix with 218 rows, find the barrel whose Metomill is hidden. Explain why Stobilesh must exceed 3808."
OTHER = "Assume that Fanodik holds 17 pairs and that no vector weighs over 9 grams. Given the Wadorel matrix with 44 rows, find the signal whose Grobilus is narrow. Explain why Hetanor must exceed 12."

#: An exercise of the same kind with other names and figures.
UNLIKE = "Assume that Kelor holds 31 pairs and that no signal weighs over 77 grams. Given the Dratus matrix with 5 rows, find the panel whose Mevik is rough. Explain why Lopard must exceed 640."


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_leaks(spark):
    w = ITEM.split()
    changed = " ".join("shipment" if i in (5, 19) else x for i, x in enumerate(w))
    json_text = '{"cells": [{"source": ["' + " ".join(w[:16]) + '\\n"]}, {"source": ["' + " ".join(w[16:]) + '"]}]}'
    rows = [
        (1, f"Intro.\n{ITEM}\nOutro."), (2, ITEM.upper().replace(".", " ;")), (3, changed), (4, " ".join(w[:18])), (5, " ".join(w[:6])), (6, UNLIKE), (7, None), (8, ""),
        (9, json_text), (10, "# " + "\n# ".join(" ".join(w[i : i + 4]) for i in range(0, len(w), 4))), (11, "nothing here " * 5000), (1, f"Intro.\n{ITEM}\nOutro."),
    ]
    items = spark.createDataFrame([(1, ITEM, "a"), (2, OTHER, "b"), (3, None, "c"), (4, "too short", "d"), (5, ITEM, "again")], "item_id long, text string, doc_id string")
    got = {tuple(r) for r in leaks.leaked(spark, docs(spark, rows), items).collect()}
    assert got == {(i, d) for i in (1, 5) for d in (1, 2, 3, 4, 9, 10)}
    assert leaks.leaked(spark, docs(spark, rows), items.limit(0)).count() == 0 and leaks.leaked(spark, docs(spark, []), items).count() == 0


def exercise(r):
    """One of a family of items that share their frame and differ in names and figures."""
    name = lambda: "".join(r.choice(["ka", "ro", "mi", "tel", "van", "dus", "pel", "gor"]) for _ in range(4)).title()
    return f"Assume that {name()} holds {r.randint(2, 9999)} pairs and that no record weighs over {r.randint(2, 99)} grams. Given the {name()} matrix with {r.randint(2, 999)} rows, find the barrel whose {name()} is hidden. Explain why {name()} must exceed {r.randint(2, 9999)}."


@pytest.mark.parametrize("siblings", [3, 4, 12])
def test_near_identical_items_are_all_found(spark, siblings):
    """Items of equal words but for the last one are named by what they share."""
    texts = [ITEM.replace("3808", str(3000 + i)) for i in range(siblings)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    got = {tuple(r) for r in leaks.leaked(spark, docs(spark, [(1, f"See here. {texts[0]} And so on."), (2, " ".join(ITEM.split()[:20]))]), items).collect()}
    assert {(i, 1) for i in range(siblings)} | {(i, 2) for i in range(siblings)} == got


def test_blocks_and_partitions_change_nothing(spark, monkeypatch):
    r = random.Random(8)
    texts = [exercise(r) for _ in range(60)] + [ITEM, OTHER]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(i, f"{r.choice(texts)} Some words between. {' '.join(r.choice(texts).split()[:20])}") for i in range(40)]
    expected = sorted(tuple(x) for x in leaks.spans(spark, docs(spark, rows), items).collect())
    assert len(expected) >= 80
    for size, parts in ((400, 1), (2000, 7)):
        monkeypatch.setattr(leaks, "BLOCK_BYTES", size)
        assert sorted(tuple(x) for x in leaks.spans(spark, docs(spark, rows).repartition(parts), items.repartition(parts)).collect()) == expected


def test_more_than_twenty_thousand_items(spark):
    r = random.Random(6)
    texts = [exercise(r) for _ in range(20_500)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    asked = r.sample(range(len(texts)), 60)
    got = {tuple(x) for x in leaks.leaked(spark, docs(spark, [(i, f"Intro. {texts[i]} Outro.") for i in asked]), items).collect()}
    assert got == {(i, i) for i in asked}


def test_every_copy_is_a_span(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    d = docs(spark, [(1, f"{ITEM} {ITEM}"), (2, f"a {ITEM} " + "filler " * 500 + ITEM), (3, f"{ITEM} " * 200)])
    found = {}
    for x in leaks.spans(spark, d, items).collect():
        found.setdefault(x.doc_id, []).append((x.first_word, x.end_word))
    n = len(leaks.words(ITEM))
    assert sorted(found["1"]) == [(0, n), (n, 2 * n)] and len(found["2"]) == 2 and sorted(found["3"]) == [(k * n, (k + 1) * n) for k in range(200)]
    left = {x.doc_id: x.text for x in leaks.without_leaks(spark, d, items).collect()}
    assert not any("Poditel" in t for t in left.values())


def test_recall_on_planted_parts(spark):
    """Thirds and more of items, with a word in nine changed, put between other text."""
    r = random.Random(11)
    texts = [exercise(r) for _ in range(300)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows, planted = [], set()
    for d in range(300):
        i = r.randrange(len(texts))
        w = texts[i].split()
        n = r.randint(-(-len(w) * 45 // 100), len(w))
        at = r.randint(0, len(w) - n)
        part = ["other" if k % 9 == 4 else x for k, x in enumerate(w[at : at + n])]
        rows.append((d, " ".join(["word"] * 30 + part + ["more"] * 30)))
        planted.add((i, d))
    rows += [(d, exercise(r)) for d in range(300, 600)]
    got = {tuple(x) for x in leaks.leaked(spark, docs(spark, rows), items).collect()}
    assert len(got & planted) >= 0.97 * len(planted) and len(got - planted) <= 0.03 * len(planted)


def test_removal(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    d = docs(spark, [(1, f"Keep this. {ITEM} And this."), (2, "clean"), (3, None)])
    kept = {r.doc_id: r.text for r in leaks.without_leaks(spark, d, items).collect()}
    assert kept[1].startswith("Keep this.") and kept[1].endswith("And this.") and "Poditel" not in kept[1] and kept[2] == "clean" and 3 in kept
    assert {r.doc_id for r in leaks.without_leaks(spark, d, items, whole_documents=True).collect()} == {2, 3}


def brute(lengths, capacity):
    return -(-sum(lengths) // capacity)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_plan_covers_and_fills(seed):
    r = random.Random(seed)
    lengths = [min(500, max(1, int(r.lognormvariate(4.5, 0.8)))) for _ in range(4000)]
    h = {}
    for x in lengths:
        h[x] = h.get(x, 0) + 1
    packed = packing.plan(h, 500)
    back = {}
    for p, k in packed:
        assert sum(p) <= 500 and k > 0
        for v in p:
            back[v] = back.get(v, 0) + k
    assert back == h
    assert sum(k for _, k in packed) <= brute(lengths, 500) * 1.02 + 2


def test_short_texts_are_packed_by_fitted_patterns():
    r = np.random.default_rng(5)
    lengths, counts = np.unique(r.integers(50, 201, 200_000), return_counts=True)
    patterns = packing.patterns_of(lengths, counts, 4096)
    assert len(patterns) > 1000 and all(4096 - 4096 // 50 <= sum(p) <= 4096 and len(set(p)) <= 6 for p in patterns)
    x = packing.fit(lengths, counts, patterns)
    fitted = sum(int(v + 0.5) * sum(p) for v, p in zip(x, patterns))
    assert fitted >= 0.9 * (lengths * counts).sum()
    packed = packing.plan(dict(zip(lengths.tolist(), counts.tolist())), 4096)
    assert sum(k for _, k in packed) <= -(-int((lengths * counts).sum()) // 4096) * 1.005 + 1


def test_plan_edges():
    assert packing.plan({}, 10) == [] and packing.plan({10: 3}, 10) == [((10,), 3)] and sum(k for _, k in packing.plan({6: 5}, 10)) == 5
    assert sum(k for _, k in packing.plan({5: 10**9, 10: 3}, 10)) == 5 * 10**8 + 3


def test_fit_is_non_negative_least_squares():
    lengths = np.array([2, 3, 5])
    x = packing.fit(lengths, np.array([30, 20, 10]), [(5,), (3, 2), (2, 2)], 3000)
    assert (x >= 0).all() and np.allclose(x, [10, 20, 5], atol=0.1)


def test_pack_texts(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "x1", "=="]) for _ in range(r.choice([0, 1, 5, 40, 300])))) for i in range(300)] + [(900, None), (901, "same"), (901, "same"), (902, "word " * 3000)]
    d = docs(spark, rows)
    counts = {}
    for x in packing.token_counts(d, "text", packing.tokenizer_path()).collect():
        counts.setdefault(x.doc_id, []).append(x.tokens)
    assert counts[900] == [None]
    out = packing.pack(spark, d, 128).collect()
    total = {}
    seats = {}
    for x in out:
        total[x.doc_id] = total.get(x.doc_id, 0) + x.n_tokens
        seats.setdefault(x.container, []).append((x.place, x.n_tokens))
    assert total == {k: sum(v) for k, v in counts.items() if v[0]}
    for s in seats.values():
        at = 0
        for place, n in sorted(s):
            assert place == at
            at += n
        assert at <= 128
    assert sorted(seats) == list(range(len(seats)))
    assert all(x.n_tokens == 128 for x in out if x.doc_id == 902 and x.first_token + 128 <= counts[902][0])
    f = packing.fill(packing.pack(spark, d, 128), 128).collect()[0]
    assert f.containers == len(seats) and f.fullest <= 128
    assert packing.pack(spark, d.limit(0), 128).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark, d, 0)


def test_censored_fit():
    r = np.random.default_rng(0)
    x = r.normal(7.0, 0.6, 20_000)
    limit = 7.3
    seen = x[x < limit]
    mu, sd = truncated.censored_fit(len(seen), seen.sum(), (seen**2).sum(), (x >= limit).sum(), limit)
    assert mu == pytest.approx(7.0, abs=0.03) and sd == pytest.approx(0.6, abs=0.03)


def corpus(spark, n=400):
    r = random.Random(9)
    word = lambda: r.choice("vector signal harbor matrix engine lantern quarry basin table route".split())
    rows, cut = [], set()
    for i in range(n):
        blocks = []
        for _ in range(r.randint(3, 25)):
            if r.random() < 0.6:
                blocks.append(" ".join(f"The {word()} holds {r.randint(1, 99)} rows per {word()}." for _ in range(r.randint(1, 3))))
            else:
                blocks.append("```python\n" + "\n".join(f"{word()}_{word()} = load('{word()}', {r.randint(1, 99)})" for _ in range(r.randint(1, 4))) + "\n```")
        text, source = "\n\n".join(blocks), "capped" if i % 2 else "free"
        if source == "capped" and len(text) > 900:
            text = text[:900]
            cut.add(i)
        elif source == "free" and i % 20 == 0:
            text = text[: r.randint(60, max(61, len(text) - 20))]
            cut.add(i)
        rows.append((i, text, source, None))
    rows += [(n, None, "free", None), (n + 1, "", None, None), (n + 2, '{"cells": []}', "free", 0), (n + 3, '{"cells": [{"a', "free", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_cells int"), cut | {n + 3}


def test_truncation(spark):
    df, cut = corpus(spark)
    found = {r.doc_id for r in truncated.truncated(spark, df).collect()}
    assert len(found & cut) >= 0.85 * len(cut) and len(found - cut) <= 0.1 * len(cut)
    rates = {r.source: r for r in truncated.truncation_rates(spark, df).collect()}
    assert rates["capped"].rate > rates["free"].rate and sum(r.documents for r in rates.values()) == df.count()
    assert truncated.truncated(spark, df.limit(0)).count() == 0


def test_shapes():
    assert truncated.shape("x = load('a', 12)") == truncated.shape("total = load('b', 7)")
    assert truncated.shape("1.25 2.50") != truncated.shape("1.25 2.5")
    assert truncated.shape("A" * 40) == "B" and truncated.shape("A" * 41) == "b"
