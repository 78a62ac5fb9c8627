"""Pairs of rows under a common key, without a row for every pair.

Rows with a signature of fixed size are brought together by key, and each task goes through the pairs of its keys with
a few vector operations: the k-th neighbours of all rows at once, for k = 1, 2 and so on until no key holds that many. A
bound on the signatures rules out what the comparison proper can't accept; only what is left becomes a row, once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that are gone through at once (more if one key holds more), and pairs.
ROWS, PAIRS = 100_000, 200_000


def neighbours(key: np.ndarray, leads: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i before j, of all pairs of rows of equal key of which the first one leads; ``key`` is sorted."""
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    end = np.repeat(ends, np.diff(ends, prepend=0))
    held, n = [], 0
    i, d = np.flatnonzero(leads), 1
    while len(i := i[i + d < end[i]]):
        held.append((i, i + d))
        n += len(i)
        d += 1
        if n >= PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def signatures(column: pa.Array, kind: np.dtype) -> np.ndarray:
    column = column.cast(pa.binary())
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind)


def possible_pairs(keyed: DataFrame, kind: np.dtype, possible: Callable[[np.ndarray], Callable]) -> DataFrame:
    """(a, b), a < b, once for each two different ``n`` of ``keyed(key, n, leads, signature)`` that meet under a key and are possible.

    ``key`` and ``n`` are whole numbers. Two rows of a key of which none leads aren't a pair. ``possible`` of the
    signatures of many rows is a function from places (i, j) to those that are possible.
    """

    def of(table: pa.Table) -> pa.RecordBatch:
        n = table["n"].to_numpy()
        rule = possible(np.concatenate([signatures(c, kind) for c in table["signature"].chunks]))
        a, b = [], []
        for i, j in neighbours(table["key"].to_numpy(), table["leads"].to_numpy()):
            i, j = rule(i, j)
            a.append(np.minimum(n[i], n[j]))
            b.append(np.maximum(n[i], n[j]))
        both = np.rec.fromarrays([np.concatenate(a or [n[:0]]), np.concatenate(b or [n[:0]])], names="a,b")
        both = np.unique(both[both.a < both.b])
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[c])) for c in "ab"], names=["a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n >= ROWS:
                # the last key may go on
                keys = batch["key"].to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut or len(held) > 1 and held[-2]["key"][-1].as_py() != keys[-1]:
                    held[-1] = batch.slice(0, cut)
                    yield of(pa.Table.from_batches(held))
                    held, n = [batch.slice(cut)], batch.num_rows - cut
        if n:
            yield of(pa.Table.from_batches(held))

    rows = keyed.select("key", "n", "leads", "signature").repartition("key").sortWithinPartitions("key", F.desc("leads"))
    return rows.mapInArrow(task, "a long, b long").distinct()
