"""Joins of two sides by all keys they share, of which only a summary of each entity's or block's pairs is wanted.

The pairs themselves are never rows. Both sides of a country are cut into blocks by a hash, and each task meets one
block of entities and one of targets, has the targets' lists of keys as arrays of numbers, and gives the best
targets of each entity in the block, or a count. The shuffle has each side once for every block of the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.session import Scratch

#: Entities and targets of a block.
ENTITIES, TARGETS = 60_000, 750_000
#: Targets whose keys are split at once.
CHUNK = 50_000
#: Between keys of one entity, and between the kind of a key and the key; cleaned text has neither.
BETWEEN, KIND = "\x02", "\x01"
#: A list is kept as bits if more than one in so many targets of the block is in it.
DENSE = 64
#: Lists up to this length are gone through without looking whether they can change anything; results that took
#: more hits than the second are kept for entities with the same keys.
FEW, DEAR = 256, 20_000


def packed(keys: Column) -> Column:
    """An array of keys as one text."""
    return F.concat_ws(BETWEEN, keys)


def met(left: DataFrame, right: DataFrame, one: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> tuple[DataFrame | None, DataFrame | None]:
    """``one`` of every pair of blocks of ``left`` (s1, country, ...) and ``right`` (tgt, country, ...) of one country.

    First for the countries whose targets are one block, so that each entity is met once, then for the others; None where there are none.
    """
    left = Scratch(left.sparkSession).cut(left)
    size = lambda df, most, out: df.groupBy("country").agg(F.ceil(F.count("*") / most).cast("int").alias(out))
    # a row a country
    blocks = size(left, ENTITIES, "na").join(size(right, TARGETS, "nb"), "country")
    n = F.col("na").cast("long") * F.col("nb")
    cells = blocks.agg(F.sum(F.when(F.col("nb") == 1, n)), F.sum(F.when(F.col("nb") > 1, n))).first()
    block = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cell = ["country", "_a", "_b"]

    def of(blocks: DataFrame, cells: int | None) -> DataFrame | None:
        if not cells:
            return None
        # several places a cell, since a hash puts some cells at one place
        places = int(min(4 * cells, 10_000))
        a = left.join(F.broadcast(blocks), "country").withColumn("_a", block("s1", "na")).withColumn("_b", every("nb")).drop("na", "nb")
        b = right.join(F.broadcast(blocks), "country").withColumn("_b", block("tgt", "nb")).withColumn("_a", every("na")).drop("na", "nb")
        return a.repartition(places, *cell).groupBy(*cell).cogroup(b.repartition(places, *cell).groupBy(*cell)).applyInArrow(one, schema)

    return of(blocks.where("nb = 1"), cells[0]), of(blocks.where("nb > 1"), cells[1])


class Lists:
    """The keys of a block's entities as numbers, and for each the targets of the block that have it, in order of their ids."""

    def __init__(self, left: pa.Table, right: pa.Table, *columns: str):
        right = right.take(pc.sort_indices(right["tgt"]))
        self.s1, self.tgt, self.size = left["s1"].combine_chunks(), right["tgt"].combine_chunks(), right.num_rows
        flat, self.ends = zip(*[_split(left[c]) for c in columns])
        words = pa.concat_arrays(flat)
        known = pc.unique(words)
        ids = pc.index_in(words, value_set=known).to_numpy(zero_copy_only=False)
        self.ids = np.split(ids, np.cumsum([len(x) for x in flat])[:-1])
        rows, found = [], []
        for at in range(0, self.size, CHUNK):
            keys, ends = _split(right["keys"].slice(at, CHUNK))
            # of an entity without keys the text splits into an empty one, which no other has
            ids = pc.fill_null(pc.if_else(pc.equal(keys, ""), None, pc.index_in(keys, value_set=known)), -1).to_numpy(zero_copy_only=False)
            rows.append(np.repeat(np.arange(at, at + len(ends) - 1, dtype=np.int32), np.diff(ends))[ids >= 0])
            found.append(ids[ids >= 0])
        rows, found = np.concatenate(rows), np.concatenate(found)
        self.key_of, self.row_ends = found, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=self.size))])
        self.rows = rows[np.argsort(found, kind="stable")]
        self.n = np.bincount(found, minlength=len(known))
        self.list_ends = np.concatenate([[0], np.cumsum(self.n)])
        self.known = len(known)

    def of(self, key: int) -> np.ndarray:
        return self.rows[self.list_ends[key] : self.list_ends[key + 1]]

    def keys(self, column: int) -> Iterator[np.ndarray]:
        """The numbers of each entity's keys in a column."""
        ids, ends = self.ids[column], self.ends[column].tolist()
        return (ids[x:y] for x, y in zip(ends, ends[1:]))

    def with_one(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Those of ``rows``, each of which has some key, that have a key marked in ``wanted``."""
        if not len(rows):
            return rows
        n = self.row_ends[rows + 1] - self.row_ends[rows]
        begin = np.cumsum(n) - n
        at = np.arange(n.sum()) + np.repeat(self.row_ends[rows] - begin, n)
        return rows[np.logical_or.reduceat(wanted[self.key_of[at]], begin)]


def _split(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """All keys of packed texts one after the other, and where each text's end."""
    lists = pc.split_pattern(texts.combine_chunks(), BETWEEN)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return pc.list_flatten(lists), np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def _best(lists: list[np.ndarray], weights: np.ndarray, k: int, acc: np.ndarray, grade: Callable, hope: Callable, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(targets, grades, hits gone through) of the best ``k`` targets by the grade of their sum of weights, then their number.

    Short lists come first. Before a long one: if k targets are better already than all that is left could make of
    a new one, only those found that can still be among the best are looked up in what is left. Nothing is lost by it:
    a target that is passed over ends below k others. ``hope`` bounds the grade of a sum from above and adds up over lists.
    """
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    lists, weights = [lists[i] for i in order], weights[order]
    left = np.cumsum(weights[::-1])[::-1].tolist()
    found, n, cost, stop, enough = [], 0, 0, len(lists), 0
    for i, (p, w) in enumerate(zip(lists, weights.tolist())):
        if n >= k and len(p) > max(FEW, n // 8):
            found = [np.concatenate(found)]
            enough = int(np.partition(grade(acc[found[0]] - 1), n - k)[n - k])
            if enough > hope(left[i]):
                stop = i
                break
        g = acc[p]
        new = p[g == 0]
        acc[p] = g + w
        acc[new] += 1  # a sum of nothing differs from no hit
        found.append(new)
        n += len(new)
        cost += len(p)
    c = np.concatenate(found) if found else np.zeros(0, dtype=np.int32)
    v = acc[c] - 1
    acc[c] = 0
    if stop < len(lists):
        near = hope(v) + hope(left[stop]) >= enough
        c, v = c[near], v[near]
        for p, w in zip(lists[stop:], weights[stop:].tolist()):
            v += w * (p[np.minimum(np.searchsorted(p, c), len(p) - 1)] == c)
    v = grade(v)
    c, v = c[v >= least], v[v >= least]
    if len(c) > k:
        near = v >= np.partition(v, len(v) - k)[len(v) - k]
        c, v = c[near], v[near]
    top = np.lexsort((c, -v))[:k]
    return c[top], v[top], cost


def _best_of_cell(k: int, grade: Callable, hope: Callable, least: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"s1": pa.array([], pa.string()), "tgt": pa.array([], pa.string()), "w": pa.array([], pa.int64()), "rank": pa.array([], pa.int32())})
        of, targets, grades = [], [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
        x = Lists(left, right, "keys", "words")
        flat = lambda c: pc.list_flatten(left[c]).combine_chunks().to_numpy(zero_copy_only=False)
        all_weights, all_sure = flat("weights"), flat("sure").astype(bool)
        acc, wanted, memo, at = np.zeros(x.size, dtype=np.int64), np.zeros(x.known, dtype=bool), {}, 0
        for keys, words in zip(x.keys(0), x.keys(1)):
            weights, sure = all_weights[at : at + len(keys)], all_sure[at : at + len(keys)]
            at += len(keys)
            lists = [x.of(j) for j in keys.tolist()]
            alike = None if sure.any() else keys.tobytes() + weights.tobytes()
            if alike is None:
                wanted[words] = True
                lists = [x.with_one(p, wanted) if s else p for p, s in zip(lists, sure.tolist())]
                wanted[words] = False
            got = memo.get(alike) if alike else None
            if got is None:
                some = [i for i, p in enumerate(lists) if len(p)]
                *got, cost = _best([lists[i] for i in some], weights[some], k, acc, grade, hope, least)
                if alike and cost > DEAR:
                    memo[alike] = got
            of.append(len(got[0]))
            targets.append(got[0])
            grades.append(got[1])
        names = x.s1.take(pa.array(np.repeat(np.arange(len(of)), of)))
        rank = np.concatenate([np.zeros(0, dtype=np.int32), *[np.arange(1, n + 1, dtype=np.int32) for n in of]])
        return pa.table({"s1": names, "tgt": x.tgt.take(pa.array(np.concatenate(targets))), "w": pa.array(np.concatenate(grades)), "rank": pa.array(rank)})

    return one


def same(v):
    return v


def best_by_sum(left: DataFrame, right: DataFrame, k: int, least: int = 1) -> DataFrame:
    """(s1, tgt, w, rank): the ``k`` targets of the greatest sums of weights of shared keys, ties by target; sums below ``least`` don't count.

    ``left`` has (s1, country, keys, weights, sure, words): packed keys, each once, with a whole weight of nothing or more, and whether a hit
    counts only for a target that has one of the packed ``words``, too. ``right`` has (tgt, country, keys) with keys and words packed.
    """
    return _ranked(left, right, _best_of_cell(k, same, same, least), k)


#: What a hit adds to a sum that counts hits; one that is needed adds one more.
HIT = 1 << 20


def _hits(v):
    return v // HIT


def best_by_count(left: DataFrame, right: DataFrame, k: int, least: int) -> DataFrame:
    """(s1, tgt, w, rank): as ``best_by_sum``, by the number of shared keys, of which one must be of weight HIT + 1; the other keys weigh HIT."""
    def grade(v: np.ndarray) -> np.ndarray:
        return np.where((v % HIT > 0) & (v >= least * HIT), v // HIT, 0)

    return _ranked(left, right, _best_of_cell(k, grade, _hits, least), k)


def _ranked(left: DataFrame, right: DataFrame, one: Callable[[pa.Table, pa.Table], pa.Table], k: int) -> DataFrame:
    """The best of all blocks; where a country's targets are one block, its ranks stand."""
    schema = "s1 string, tgt string, w bigint, rank int"
    single, several = met(left, right, one, schema)
    if several is not None:
        w = Window.partitionBy("s1").orderBy(F.desc("w"), "tgt")
        several = several.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return _both(left, schema, single, several)


def _both(left: DataFrame, schema: str, *parts: DataFrame | None) -> DataFrame:
    out = [p for p in parts if p is not None] or [left.sparkSession.createDataFrame([], schema)]
    return reduce(DataFrame.unionByName, out)


def _sums(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of bits added up, bit by bit of the sums, least first."""
    planes: list[np.ndarray] = []
    for n, carry in enumerate(rows, 1):
        for i, p in enumerate(planes):
            planes[i], carry = p ^ carry, p & carry
        if n.bit_length() > len(planes):
            planes.append(carry)
    return planes


def _counted(planes: list[np.ndarray]) -> dict[int, int]:
    """How many places have each sum of more than nothing."""
    n = len(planes)
    # places that have all of some bits, then those that have these alone
    have = {0: 0}
    both: dict[int, np.ndarray] = {}
    for k in range(1, n + 1):
        for bits in combinations(range(n), k):
            m = sum(1 << b for b in bits)
            top = 1 << bits[-1]
            both[m] = planes[bits[-1]] if m == top else both[m ^ top] & planes[bits[-1]]
            have[m] = int(np.bitwise_count(both[m]).sum(dtype=np.int64))
    for b in range(n):
        for m in range(1, 1 << n):
            if not m >> b & 1 and m:
                have[m] -= have[m | 1 << b]
    return {m: c for m, c in have.items() if m and c}


def _count_cell(left: pa.Table, right: pa.Table) -> pa.Table:
    if not left.num_rows or not right.num_rows:
        return pa.table({"shared": pa.array([], pa.int64()), "count": pa.array([], pa.int64())})
    x = Lists(left, right, "keys")
    dense: dict[int, np.ndarray] = {}
    for j in np.flatnonzero(x.n > x.size // DENSE).tolist():
        bits = np.zeros(-(-x.size // 64) * 64, dtype=np.uint8)
        bits[x.of(j)] = 1
        dense[j] = np.packbits(bits, bitorder="little").view(np.uint64)
    # entities with the same frequent keys share their sums
    groups: dict[tuple, list[list[int]]] = {}
    for keys in x.keys(0):
        keys = keys.tolist()
        groups.setdefault(tuple(j for j in sorted(keys) if j in dense), []).append([j for j in keys if j not in dense and x.n[j]])
    total = np.zeros(64, dtype=np.int64)
    seen = np.zeros(x.size, dtype=np.int64)

    def add(counts: np.ndarray, sign: int = 1) -> None:
        nonlocal total
        if len(counts) > len(total):
            total = np.concatenate([total, np.zeros(len(counts), dtype=np.int64)])
        total[: len(counts)] += sign * counts

    for often, each in groups.items():
        planes = _sums([dense[j] for j in often])
        for shared, n in _counted(planes).items():
            c = np.zeros(shared + 1, dtype=np.int64)
            c[shared] = n * len(each)
            add(c)
        for rare in each:
            if not rare:
                continue
            new = []
            for j in rare:
                p = x.of(j)
                g = seen[p]
                new.append(p[g == 0])
                seen[p] = g + 1
            t = np.concatenate(new)
            more = seen[t]
            seen[t] = 0
            base = np.zeros(len(t), dtype=np.int64)
            at, bit = t >> 6, (t & 63).astype(np.uint64)
            for i, plane in enumerate(planes):
                base += ((plane[at] >> bit) & np.uint64(1)).astype(np.int64) << i
            add(np.bincount(base), -1)
            add(np.bincount(base + more))
    total[0] = 0
    at = np.flatnonzero(total)
    return pa.table({"shared": pa.array(at.astype(np.int64)), "count": pa.array(total[at])})


def counts_by_shared(left: DataFrame, right: DataFrame) -> DataFrame:
    """(shared, count): how many pairs of ``left`` (s1, country, keys) and ``right`` (tgt, country, keys) share so many keys, each pair that shares any once.

    Lists of frequent keys are bits, added up for 64 targets at once; pairs with rarer keys are moved from one count to the other.
    """
    schema = "shared bigint, count bigint"
    cells = _both(left, schema, *met(left, right, _count_cell, schema))
    return cells.groupBy("shared").agg(F.sum("count").alias("count"))
