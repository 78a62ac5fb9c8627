"""Evaluation texts leaking into training text.

The n-grams of the normalised test items form a hash set that is broadcast; items are taken in blocks of bounded bytes,
so what is broadcast is bounded. One pass over the corpus for each block slides windows of n words over every text and
looks them up. Hits name candidate items; each is verified by aligning the item's words with the text around the hits,
tolerating changed words and cell borders. Spans can be cut out, or documents dropped.

How many items have a word or an n-gram is counted over all items before they are divided, so results don't depend on
blocks or partitions. An item is looked up by its rare n-grams; where a third of it has hardly any, by the rarest there, however many items have them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knotwork.operators.skew import lookup_join
from knotwork.session import Scratch

_WORD = re.compile(r"[^\W_]+")
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")

#: Words of a window; an n-gram is rare if at most SHARED items have it; bytes of the items of one broadcast block.
N, SHARED, BLOCK_BYTES = 3, 3, 32_000_000
#: In a third of an item with fewer than RARE rare n-grams it is looked up by the PICKED rarest there, too.
RARE, PICKED = 2, 4
#: A word is an item's own if at most SHARED items, or this share of all items, have it.
OWN_SHARE = 1 / 200
#: Words of an item that may be changed between two matching parts, and words of layout that may stand between them.
ITEM_GAP, TEXT_GAP = 2, 60
#: Share of an item's words that must be carried; share of the carried words, and of those among them that at most
#: hardly any item has (names, figures), that must match. Exercises of one kind share only the common words.
SHARE, MATCHING, OWN = 1 / 3, 0.8, 0.6


def readable(text: str) -> str:
    """Text with the escapes of JSON strings resolved, where there are any; otherwise unchanged."""
    if "\\" in text and text.lstrip()[:1] in "{[":
        text = text.replace("\\n", " \n").replace("\\t", " \t").replace('\\"', ' "')
        if "\\u" in text:
            text = _ESCAPE.sub(lambda m: chr(int(m[1], 16)), text)
    return text


def words(text: str) -> list[str]:
    """Words and numbers in lower case, without punctuation."""
    return _WORD.findall(text.lower())


def keys_of(n_words: int, having: list[int]) -> list[int]:
    """Places of the n-grams by which an item of ``n_words`` is looked up, given how many items have each of them."""
    size = max(1, -(-n_words // 3) - N + 1)
    found = {k for k, n in enumerate(having) if n <= SHARED}
    rare = [0, *accumulate(n <= SHARED for n in having)]
    for at in range(max(0, len(having) - size + 1)):
        if rare[at + size] - rare[at] < min(RARE, size):
            found.update(sorted(range(at, at + size), key=lambda k: (having[k], k))[:PICKED])
    return sorted(found)


def carried(item: list[str], own: set[int], text: list[str]) -> tuple[int, int, int, int]:
    """(words of the item from its first to its last matching word, matching words, from, to in the text) of the best part.

    ``own`` are the places of the item's words that hardly any other item has.
    """
    best = (0, 0, 0, 0)
    run: list = []
    for m in SequenceMatcher(None, item, text, autojunk=False).get_matching_blocks():
        if not m.size:
            continue
        if run and (m.a - run[-1][0] - run[-1][2] > ITEM_GAP or m.b - run[-1][1] - run[-1][2] > TEXT_GAP):
            run = []
        run.append((m.a, m.b, m.size))
        firm = [r for r in run if r[2] > 1]  # a part begins and ends with two words in a row
        if firm:
            lo, hi = firm[0][0], firm[-1][0] + firm[-1][2]
            hits = [k for r in run if lo <= r[0] < hi for k in range(r[0], r[0] + r[2])]
            mine = sum(lo <= k < hi for k in own)
            if len(hits) >= MATCHING * (hi - lo) and (mine == 0 or sum(k in own for k in hits) >= OWN * mine):
                best = max(best, (hi - lo, len(hits), firm[0][1], firm[-1][1] + firm[-1][2]))
    return best


def _parts(item: list[str], own: set[int], w: list[str], at: list[int]) -> Iterator[tuple[int, int, int]]:
    """(words carried, first word, word after the last) of every part of the text ``w`` that carries enough of an item.

    ``at`` are the places of hits. A look reaches an item's length beyond hits that follow each other; what lies before
    and after a part found is looked at again, so an item may be carried many times.
    """
    reach = len(item) + TEXT_GAP
    todo = [(0, len(at), 0, len(w))]
    while todo:
        i, j, begin, end = todo.pop()
        if i >= j:
            continue
        k = i + 1
        while k < j and at[k] - at[k - 1] <= reach and at[k] - at[i] <= 2 * reach:
            k += 1
        start = max(begin, at[i] - reach)
        length, _, a, b = carried(item, own, w[start : min(end, at[k - 1] + N + reach)])
        if length >= SHARE * len(item) - 1e-9:
            a, b = start + a, start + b
            yield length, a, b
            todo.append((bisect_left(at, b, i, j), j, b, end))
            todo.append((i, bisect_left(at, a - N + 1, i, j), begin, a))
        elif k < j and at[k] - at[k - 1] <= reach:  # the look was cut short
            todo.append((i + max(1, (k - i) // 2), j, begin, end))
        else:
            todo.append((k, j, begin, end))


def leaks_in(text: str, items: dict[str, tuple[list[str], set[int]]], grams: dict[tuple, tuple[str, ...]]) -> list[tuple[str, float, int, int]]:
    """(item, share carried, first word, word after the last) of every part of ``text`` that carries a third of an item.

    ``items`` are the words of every item with the places of those that hardly any other item has.
    """
    w = words(text)
    found = grams.keys() & zip(*(w[k:] for k in range(N)))
    if not found:
        return []
    places: dict[str, list[int]] = defaultdict(list)
    for at, g in enumerate(zip(*(w[k:] for k in range(N)))):
        if g in found:
            for i in grams[g]:
                places[i].append(at)
    return [(i, length / len(items[i][0]), a, b) for i, at in places.items() for length, a, b in _parts(*items[i], w, at)]


def _having(texts: DataFrame, things: str, scratch: Scratch) -> DataFrame:
    """(i, having) of every text: how many texts have each thing of the array column ``things``, in order."""
    flat = scratch.cut(texts.select("i", F.posexplode(things).alias("at", "thing")))
    count = flat.select("i", "thing").distinct().groupBy("thing").agg(F.count("*").alias("n"))
    found = lookup_join(flat, "thing", count.withColumnRenamed("thing", "of"), "of", "n", "n")
    return found.groupBy("i").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "n"))), lambda x: x["n"]).alias("having"))


def prepared(spark: SparkSession, items: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(i, t, ids, own, having) of every different text of the items: its words, its ids, the places of its own words,
    and how many texts have each of its n-grams.

    ``i`` is a digest of the words, so it is the same in every run.
    """
    scratch = Scratch(spark)
    tests = items.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("t")).where("id is not null and t is not null").distinct()
    # items of the same words are one text with several ids
    tests = tests.groupBy(F.regexp_extract_all(F.lower("t"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("t")).agg(F.collect_set("id").alias("ids"))
    tests = scratch.cut(tests.where(F.size("t") >= N).select(F.md5(F.array_join("t", " ")).alias("i"), "t", "ids"))
    most = max(SHARED, int(tests.count() * OWN_SHARE))
    runs = F.transform(F.sequence(F.lit(0), F.size("t") - N), lambda k: F.array_join(F.slice("t", k + 1, N), " "))
    by_word, by_run = _having(tests, "t", scratch), _having(tests.select("i", runs.alias("g")), "g", scratch)
    own = F.filter(F.transform("w", lambda n, k: F.when(n <= most, k)), lambda k: k.isNotNull())
    out = tests.join(by_word.withColumnRenamed("having", "w"), "i").join(by_run, "i")
    return scratch.cut(out.select("i", "t", "ids", own.alias("own"), "having"))


def spans(spark: SparkSession, docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, doc_id, share, first_word, end_word) of every place where a document carries an item; ids as strings.

    ``share`` is the part of the item's words carried. Null and empty texts and items carry nothing; an item of
    fewer words than the window is never found. Repeated items and documents give repeated rows once.
    """
    tests = prepared(spark, items, item_id, item_text)
    size = tests.agg(F.sum(F.octet_length(F.array_join("t", " "))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    corpus = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("text is not null and doc_id is not null")
    out = None
    for block in range(blocks):
        # about BLOCK_BYTES of text, however many items there are
        known, grams, ids = {}, defaultdict(list), {}
        for r in tests.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block).toLocalIterator():
            known[r.i], ids[r.i] = (r.t, set(r.own)), r.ids
            for k in keys_of(len(r.t), r.having):
                if not (g := grams[tuple(r.t[k : k + N])]) or g[-1] != r.i:
                    g.append(r.i)
        shared = spark.sparkContext.broadcast((known, {g: tuple(x) for g, x in grams.items()}, ids))

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            known, grams, ids = shared.value
            for batch in batches:
                rows = [
                    (i, d, share, a, b)
                    for d, t in zip(batch["doc_id"], batch["text"]) if t
                    for k, share, a, b in leaks_in(readable(t), known, grams)
                    for i in ids[k]
                ]
                yield pd.DataFrame(rows, columns=["item_id", "doc_id", "share", "first_word", "end_word"])

        found = corpus.mapInPandas(scan, "item_id string, doc_id string, share double, first_word long, end_word long")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def leaked(spark: SparkSession, docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """(item_id, doc_id) of every document that carries a test item's passage or at least a third of it."""
    found = spans(spark, docs, items, **columns)
    i, d = items.schema[columns.get("item_id", "item_id")].dataType, docs.schema[columns.get("doc_id", "doc_id")].dataType
    return found.select(F.col("item_id").cast(i), F.col("doc_id").cast(d)).distinct()


def without_leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, whole_documents: bool = False, **columns) -> DataFrame:
    """``docs`` without leaked passages, or without the documents that hold any; columns stay as they are.

    A passage is cut from its first to its last word. Texts in notebook JSON would no longer parse, so such documents
    are dropped either way.
    """
    d, t = columns.get("doc_id", "doc_id"), columns.get("text", "text")
    found = spans(spark, docs, items, **columns).groupBy(F.col("doc_id").alias("_d")).agg(F.collect_list(F.struct("first_word", "end_word")).alias("_s"))
    joined = docs.join(found, F.col(f"`{d}`").cast("string") == F.col("_d"), "left")
    if whole_documents:
        return joined.where("_d is null").drop("_d", "_s")
    joined = joined.where(F.col("_d").isNull() | ~F.ltrim(F.col(f"`{t}`")).startswith("{"))
    cut = F.when(F.col("_s").isNotNull(), cut_words(F.col(f"`{t}`"), F.col("_s.first_word"), F.col("_s.end_word"))).otherwise(F.col(f"`{t}`"))
    return joined.withColumn(t, cut).drop("_d", "_s")


@F.pandas_udf(T.StringType())
def cut_words(texts: pd.Series, first: pd.Series, end: pd.Series) -> pd.Series:
    def one(text, a, b):
        if text is None or a is None:
            return text
        at = [m.span() for m in _WORD.finditer(text)]
        for x, y in sorted(zip(a, b), reverse=True):
            if x < y <= len(at):
                text = text[: at[x][0]] + text[at[y - 1][1] :]
        return text

    return pd.Series([one(*r) for r in zip(texts, first, end)])
