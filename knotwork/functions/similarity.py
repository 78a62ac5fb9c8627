"""String similarities over whole batches: every function takes two lists of strings and returns a float array.

Strings are laid out as matrices of code points and compared column by column with numpy, so the cost a pair is a
few vector operations and no Python loop over pairs. Definitions are the public ones: Jaro with a matching window
of half the longer length, Winkler's prefix weight 0.1 over at most four characters, Indel similarity
``2 LCS / (|a| + |b|)``, and restricted Damerau-Levenshtein distance.
"""

from __future__ import annotations

import numpy as np


def codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of code points padded with 0, lengths)."""
    n = len(strings)
    lengths = np.fromiter((len(s) for s in strings), np.int32, n)
    width = int(lengths.max()) if n else 0
    flat = np.array(strings, dtype=f"<U{max(width, 1)}")
    return flat.view(np.uint32).reshape(n, max(width, 1)), lengths


def _blocks(a: list[str], b: list[str], size: int = 16384):
    """Pairs in blocks of like lengths, so that padding stays small; yields positions and both halves."""
    longest = np.fromiter((max(len(x), len(y)) for x, y in zip(a, b)), np.int32, len(a))
    order = np.argsort(longest, kind="stable")
    for i in range(0, len(a), size):
        at = order[i : i + size]
        yield at, [a[k] for k in at], [b[k] for k in at]


def jaro_winkler(a: list[str], b: list[str], weight: float = 0.1) -> np.ndarray:
    """Jaro-Winkler similarity, 0 to 1; two empty strings are alike, an empty and another one are not."""
    out = np.zeros(len(a))
    for at, x, y in _blocks(a, b):
        out[at] = _jaro_winkler(*codes(x), *codes(y), weight)
    return out


def _jaro_winkler(A, la, B, lb, weight):
    n, wa, wb = len(la), A.shape[1], B.shape[1]
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    ma, mb = np.zeros((n, wa), bool), np.zeros((n, wb), bool)
    most = int(reach.max()) if n else 0
    for i in range(wa):
        open_ = i < la
        for j in range(max(0, i - most), min(wb, i + most + 1)):
            hit = open_ & (abs(i - j) <= reach) & (A[:, i] == B[:, j]) & (j < lb) & ~mb[:, j]
            mb[:, j] |= hit
            ma[:, i] |= hit
            open_ = open_ & ~hit
    m = ma.sum(1)
    # k-th matched character of both sides
    sa, sb = np.zeros((n, wa), np.uint32), np.zeros((n, wb), np.uint32)
    r, c = np.nonzero(ma)
    sa[r, (np.cumsum(ma, 1) - 1)[r, c]] = A[r, c]
    r, c = np.nonzero(mb)
    sb[r, (np.cumsum(mb, 1) - 1)[r, c]] = B[r, c]
    w = min(wa, wb)
    t = (sa[:, :w] != sb[:, :w]).sum(1) // 2  # whole transpositions
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / np.maximum(la, 1) + m / np.maximum(lb, 1) + (m - t) / np.maximum(m, 1)) / 3, 0.0)
    jaro = np.where((la == 0) & (lb == 0), 1.0, jaro)
    k = min(4, w)
    same = (A[:, :k] == B[:, :k]) & (A[:, :k] != 0)
    prefix = np.cumprod(same, 1).sum(1) if k else np.zeros(n)
    return jaro + prefix * weight * (1 - jaro)


def masks(s: str) -> dict[str, int]:
    """For each letter the places where it stands, as bits."""
    out: dict[str, int] = {}
    for i, c in enumerate(s):
        out[c] = out.get(c, 0) | 1 << i
    return out


def lcs_bits(places: dict[str, int], n: int, b: str) -> int:
    """Length of the longest common subsequence of a text of ``n`` letters, given by its masks, and ``b``.

    One addition of long integers a letter; zeros of the state are the steps of the table's last row.
    """
    full = (1 << n) - 1
    state = full
    for c in b:
        u = state & places.get(c, 0)
        state = ((state + u) | (state - u)) & full
    return n - state.bit_count()


#: From this length on a loop over letters with long integers beats vectors over pairs.
LONG = 16


def lcs(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence."""
    out = np.zeros(len(a), np.int64)
    for at, x, y in _blocks(a, b):
        if max(map(len, x), default=0) > LONG and max(map(len, y), default=0) > LONG:
            out[at] = [lcs_bits(masks(p), len(p), q) for p, q in zip(x, y)]
            continue
        A, la = codes(x)
        B, lb = codes(y)
        row = np.zeros((len(x), B.shape[1] + 1), np.int16)
        inside = np.arange(B.shape[1]) < lb[:, None]
        for i in range(A.shape[1]):
            eq = (A[:, i : i + 1] == B) & inside & (i < la)[:, None]
            best = np.maximum(row[:, 1:], np.where(eq, row[:, :-1] + 1, 0))
            row[:, 1:] = np.maximum.accumulate(best, axis=1)
        out[at] = row[:, -1]
    return out


def ratio(a: list[str], b: list[str]) -> np.ndarray:
    """Indel similarity on a scale to 100; two empty strings are alike."""
    total = np.fromiter((len(x) + len(y) for x, y in zip(a, b)), np.int64, len(a))
    return np.where(total == 0, 100.0, 200.0 * lcs(a, b) / np.maximum(total, 1))


def osa(a: list[str], b: list[str]) -> np.ndarray:
    """Restricted Damerau-Levenshtein distance: a swap of neighbours counts once."""
    out = np.zeros(len(a), np.int64)
    for at, x, y in _blocks(a, b):
        A, la = codes(x)
        B, lb = codes(y)
        n, w = len(x), B.shape[1]
        cols = np.arange(w + 1, dtype=np.int32)
        before, now = None, np.tile(cols, (n, 1))
        result = np.where(la == 0, lb, 0)
        for i in range(1, A.shape[1] + 1):
            nxt = np.empty_like(now)
            nxt[:, 0] = i
            sub = np.minimum(now[:, 1:] + 1, now[:, :-1] + (A[:, i - 1 : i] != B))
            if before is not None and w >= 2:
                swap = (A[:, i - 1 : i] == B[:, :-1]) & (A[:, i - 2 : i - 1] == B[:, 1:])
                sub[:, 1:] = np.where(swap, np.minimum(sub[:, 1:], before[:, :-2] + 1), sub[:, 1:])
            # insertions: running minimum of (value - column)
            shifted = np.concatenate([nxt[:, :1], sub], axis=1) - cols
            nxt = np.minimum.accumulate(shifted, axis=1) + cols
            before, now = now, nxt
            done = la == i
            result[done] = now[done, lb[done]]
        out[at] = result
    return out
