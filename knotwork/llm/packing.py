"""Filling fixed-capacity containers with texts, measured in tokens of a public tokenizer.

Method: pattern packing by non-negative least squares. Only the histogram of the lengths (at most ``capacity`` rows)
goes to the driver. There patterns of a few lengths that fill a container are enumerated, their repeat counts are fitted
to the histogram by non-negative least squares, rounded down to what is there, and what remains is packed pattern by
pattern, largest length first. The plan, again of a size bounded by the capacity, is broadcast, and every text finds its
container from its rank among the texts of its length: no text is moved to another by more than one shuffle.
"""

from __future__ import annotations

import base64
import importlib.util
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from knotwork.session import Scratch

#: Lengths ranked in so many parts, so that no task ranks all texts of a common length.
SALTS = 128


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of an installed public vocabulary file."""
    spec = importlib.util.find_spec("public_tokenizers")
    return str(Path(spec.origin).parent / name) if spec else f"/opt/tokenizers/{name}"


def token_counts(docs: DataFrame, text: str, vocabulary: str, out: str = "tokens") -> DataFrame:
    """``docs`` without ``text``, with the number of its tokens (null for a null text).

    ``vocabulary`` is a file of base64 byte pairs with ranks. Special tokens' strings are ordinary text.
    """
    kept = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{out}` long"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken
        from public_tokenizers import PATTERN

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary, "rb"))}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            n = [None if t is None else len(encoding.encode_ordinary(t)) for t in batch[text]]
            yield batch.drop(columns=[text]).assign(**{out: pd.array(n, dtype="Int64")})

    return docs.mapInPandas(count, schema)


def patterns_of(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of up to six different present lengths that leave little or nothing of a container unused.

    Where even six of the longest don't fill a container, two lengths stand in a pattern as often as fits.
    """
    present = np.sort(lengths)
    weights = np.cumsum(counts[np.argsort(lengths)]) / counts.sum()

    def below(x: int) -> int:
        """The largest present length up to x, or 0."""
        i = int(np.searchsorted(present, x, side="right"))
        return int(present[i - 1]) if i else 0

    typical = [int(present[min(int(np.searchsorted(weights, q)), len(present) - 1)]) for q in np.linspace(0.02, 0.98, 25)]
    typical = sorted(set(typical))
    short = 6 * int(present[-1]) < capacity
    out: set[tuple[int, ...]] = set()

    def add(*parts: int) -> None:
        rest = capacity - sum(parts)
        while rest > 0 and (len(set(parts)) if short else len(parts)) < 6:
            x = below(rest)
            if not x:
                break
            parts, rest = (*parts, x), rest - x
        if 0 <= rest <= capacity // 50:
            out.add(tuple(sorted(parts, reverse=True)))

    for i, a in enumerate(present.tolist() if short else ()):
        # each length with a few others from all over the range, both equally often but for the last places
        for b in present[(i + np.arange(8) * len(present) // 8) % len(present)].tolist():
            add(*[a, b] * max(1, capacity // (a + b) - 1))
    for a in present.tolist() if not short else ():
        add(a)
        for b in typical:
            if a + b <= capacity:
                add(a, b)
        for b in typical[:: max(1, len(typical) // 5)]:
            for c in typical[:: max(1, len(typical) // 5)]:
                if b <= c and a + b + c <= capacity:
                    add(a, b, c)
    return sorted(out, reverse=True)


def fit(lengths: np.ndarray, counts: np.ndarray, patterns: list[tuple[int, ...]], steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared difference of the patterns' lengths to the histogram.

    Accelerated projected gradient on the sparse incidence of patterns and lengths; rows are scaled by the root of
    their counts, so that rare lengths weigh as much as common ones relative to their spread.
    """
    row = {int(v): i for i, v in enumerate(lengths)}
    times = [Counter(p) for p in patterns]
    r = np.array([row[v] for p in times for v in p])
    c = np.repeat(np.arange(len(patterns)), [len(p) for p in times])
    scale = 1 / np.sqrt(counts.astype(float))
    val, b = scale[r] * np.array([k for p in times for k in p.values()]), counts * scale
    n, m = len(patterns), len(lengths)
    mult = lambda x: np.bincount(r, val * x[c], m)
    back = lambda y: np.bincount(c, val * y[r], n)
    v = np.random.default_rng(0).random(n)
    for _ in range(30):  # largest eigenvalue, for the step
        v = back(mult(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = z = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, z - back(mult(z) - b) / (norm * 1.05))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a container, how many such containers), covering the histogram exactly.

    The plan has at most one entry for each pattern that was fitted, and one for each length that remained.
    """
    left = {int(k): int(v) for k, v in histogram.items() if k > 0 and v > 0}
    out: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...], most: int) -> int:
        need: dict[int, int] = {}
        for v in pattern:
            need[v] = need.get(v, 0) + 1
        k = min(most, *(left.get(v, 0) // q for v, q in need.items()))
        if k > 0:
            out.append((pattern, k))
            for v, q in need.items():
                left[v] -= k * q
                if not left[v]:
                    del left[v]
        return k

    if left.get(capacity):
        take((capacity,), left[capacity])
    if len(left) > 1:
        lengths = np.array(sorted(left))
        counts = np.array([left[v] for v in lengths])
        patterns = patterns_of(lengths, counts, capacity)
        if patterns:
            x = fit(lengths, counts, patterns)
            for i in np.argsort(-x, kind="stable"):
                if x[i] < 0.5:
                    break
                take(patterns[i], int(x[i] + 0.5))
    # the rest: the largest length first, then always the largest that still fits
    while left:
        sizes = sorted(left, reverse=True)
        rest, pattern, used = capacity, [], {}
        for v in sizes:
            while v <= rest and left[v] - used.get(v, 0) > 0:
                pattern.append(v)
                used[v] = used.get(v, 0) + 1
                rest -= v
            if rest < sizes[-1]:
                break
        take(tuple(pattern), 1 << 62)
    return out


def _seats(packed: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: where in the order of its texts each pattern begins, its first container, places a container, and their offsets."""
    seats: dict[int, list[tuple]] = {}
    taken: dict[int, int] = {}
    first = 0
    for pattern, times in packed:
        offsets: dict[int, list[int]] = {}
        at = 0
        for v in pattern:
            offsets.setdefault(v, []).append(at)
            at += v
        for v, places in offsets.items():
            seats.setdefault(v, []).append((taken.get(v, 0), first, len(places), places))
            taken[v] = taken.get(v, 0) + times * len(places)
        first += times
    out = {}
    for v, rows in seats.items():
        flat = np.array([o for r in rows for o in r[3]], np.int64)
        at = np.cumsum([0] + [r[2] for r in rows[:-1]])
        out[v] = (*(np.array([r[k] for r in rows], np.int64) for k in range(3)), at, flat)
    return out


def pieces(lengths: DataFrame, capacity: int, keep: list[str]) -> DataFrame:
    """One row a piece: texts longer than the capacity are divided into full containers and a rest."""
    n = F.col("tokens")
    whole = F.floor((n - 1) / capacity).cast("int")
    return (
        lengths.where("tokens > 0").select(*keep, "tokens", F.explode(F.sequence(F.lit(0), whole)).alias("piece"))
        .select(*keep, F.col("piece"), (F.col("piece").cast("long") * capacity).alias("first_token"), F.least(F.lit(capacity), n - F.col("piece").cast("long") * capacity).cast("int").alias("n_tokens"))
    )


def pack(spark: SparkSession, docs: DataFrame, capacity: int, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, piece, first_token, n_tokens, container, place) with every token of every text in exactly one container.

    A text is divided only if it exceeds the capacity, into full containers and a rest that is packed like other
    texts. ``place`` is the offset in the container. Null and empty texts need no place and give no row. Repeated rows
    are packed each; rows of one length are ranked by a hash, ties by id and piece.
    """
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    scratch = Scratch(spark)
    base = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text")).where("text is not null")
    items = scratch.cut(pieces(token_counts(base, "text", vocabulary or tokenizer_path()), capacity, ["id"]))
    histogram = {r.n_tokens: r["count"] for r in items.groupBy("n_tokens").count().collect()}  # at most ``capacity`` rows
    shared = spark.sparkContext.broadcast(_seats(plan(histogram, capacity)))
    salted = items.withColumn("h", F.xxhash64("id", "piece")).withColumn("salt", F.pmod("h", F.lit(SALTS)))
    sizes = salted.groupBy("n_tokens", "salt").count()
    before = sizes.select("n_tokens", "salt", (F.sum("count").over(Window.partitionBy("n_tokens").orderBy("salt")) - F.col("count")).alias("before"))
    inner = F.row_number().over(Window.partitionBy("n_tokens", "salt").orderBy("h", "id", "piece")) - 1
    ranked = salted.withColumn("inner", inner).join(before, ["n_tokens", "salt"]).select("id", "piece", "first_token", "n_tokens", (F.col("before") + F.col("inner")).alias("rank"))
    id_type = docs.schema[id_column].dataType.simpleString()

    def seat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seats = shared.value
        for batch in batches:
            container, place = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            lengths, ranks = batch["n_tokens"].to_numpy(), batch["rank"].to_numpy()
            order = np.argsort(lengths, kind="stable")
            for part in np.split(order, np.nonzero(np.diff(lengths[order]))[0] + 1):
                if len(part):
                    begin, first, each, at, flat = seats[int(lengths[part[0]])]
                    i = np.searchsorted(begin, ranks[part], side="right") - 1
                    inside = ranks[part] - begin[i]
                    container[part] = first[i] + inside // each[i]
                    place[part] = flat[at[i] + inside % each[i]]
            yield batch.drop(columns=["rank"]).assign(container=container, place=place)

    out = ranked.mapInPandas(seat, f"id {id_type}, piece int, first_token long, n_tokens int, container long, place long")
    return out.withColumnRenamed("id", id_column)


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, pieces, tokens, and the share of the containers' space left unused."""
    one = packed.groupBy("container").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("p"))
    total = one.agg(F.count("*").alias("containers"), F.coalesce(F.sum("p"), F.lit(0)).alias("pieces"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"), F.coalesce(F.max("t"), F.lit(0)).alias("fullest"))
    return total.withColumn("unused", F.when(F.col("containers") > 0, 1 - F.col("tokens") / (F.col("containers") * capacity)))
