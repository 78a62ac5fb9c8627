"""Arrow functions that compare two text columns in whole batches."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from knotwork.functions.similarity import jaro_winkler, lcs_bits, masks, ratio


@F.pandas_udf(T.DoubleType())
def jaro_winkler_of(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler with the prefix counted only from a Jaro similarity above 0.7; null counts as empty."""
    return pd.Series(similar(a.fillna("").tolist(), b.fillna("").tolist()))


def similar(a: list[str], b: list[str]) -> np.ndarray:
    plain = jaro_winkler(a, b, 0.0)
    return np.where(plain > 0.7, jaro_winkler(a, b), plain)


def sorted_tokens(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_set_ratio(a: list[str], b: list[str]) -> np.ndarray:
    """100 if one side's words are all in the other; else the best ratio of common and differing words."""
    pairs_x: list[str] = []
    pairs_y: list[str] = []
    fixed = np.full(len(a), -1.0)
    for i, (x, y) in enumerate(zip(a, b)):
        s, t = set(x.split()), set(y.split())
        both = " ".join(sorted(s & t))
        u, v = " ".join(sorted(s - t)), " ".join(sorted(t - s))
        if not s or not t:
            fixed[i] = 0.0
        elif both and (not u or not v):
            fixed[i] = 100.0
        x1, y1 = (f"{both} {u}".strip(), f"{both} {v}".strip())
        pairs_x += [x1, both if both else "", both if both else ""]
        pairs_y += [y1, x1 if both else "-", y1 if both else "-"]
    r = ratio(pairs_x, pairs_y).reshape(-1, 3).max(1) if a else np.zeros(0)
    return np.where(fixed >= 0, fixed, r)


def _best_window(s: str, t: str) -> float:
    """Best ratio of ``s`` against the windows of its length in the longer ``t``, cut ones at the ends too.

    Windows are tried in the order of the most their letters could give, until no other can be better.
    """
    n, places = len(s), masks(s)
    need, have, shared, bounds = Counter(s), Counter(), 0, []
    for end in range(len(t) + n - 1):
        if end < len(t):
            c = t[end]
            have[c] += 1
            shared += have[c] <= need[c]
        if end >= n:
            c = t[end - n]
            shared -= have[c] <= need[c]
            have[c] -= 1
        lo, hi = max(0, end - n + 1), min(end + 1, len(t))
        bounds.append((200.0 * shared / (n + hi - lo), lo, hi))
    best = 0.0
    for bound, lo, hi in sorted(bounds, reverse=True):
        if bound <= best:
            break
        best = max(best, 200.0 * lcs_bits(places, n, t[lo:hi]) / (n + hi - lo))
    return best


def partial_ratio(a: list[str], b: list[str]) -> np.ndarray:
    """Best ratio of the shorter text against the windows of the longer one; of equal lengths either way."""
    out = np.zeros(len(a))
    for i, (x, y) in enumerate(zip(a, b)):
        if not x or not y:
            out[i] = 100.0 if x == y else 0.0
        elif len(x) == len(y):
            out[i] = max(_best_window(x, y), _best_window(y, x))
        else:
            out[i] = _best_window(*sorted((x, y), key=len))
    return out


def weighted_ratio(a: list[str], b: list[str]) -> np.ndarray:
    """The best of plain, sorted, set and, for unlike lengths, partial ratios with the usual discounts."""
    n = len(a)
    if not n:
        return np.zeros(0)
    base = ratio(a, b)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    rel = np.maximum(la, lb) / np.maximum(np.minimum(la, lb), 1)
    sa, sb = [sorted_tokens(x) for x in a], [sorted_tokens(x) for x in b]
    tokens = np.maximum(ratio(sa, sb), token_set_ratio(a, b))
    near = np.maximum(base, 0.95 * tokens)
    far = np.nonzero(rel >= 1.5)[0]
    out = near.copy()
    if len(far):
        x, y = [a[i] for i in far], [b[i] for i in far]
        scale = np.where(rel[far] <= 8, 0.9, 0.6)
        part = partial_ratio(x, y) * scale
        words = np.maximum(partial_ratio([sa[i] for i in far], [sb[i] for i in far]), partial_token_set(x, y)) * 0.95 * scale
        out[far] = np.maximum(base[far], np.maximum(part, words))
    return np.where((la == 0) | (lb == 0), 0.0, out)


def partial_token_set(a: list[str], b: list[str]) -> np.ndarray:
    """100 if any word is shared; else the partial ratio of the differing words."""
    shared = np.array([bool(set(x.split()) & set(y.split())) for x, y in zip(a, b)])
    rest = partial_ratio([sorted_tokens(" ".join(set(x.split()) - set(y.split()))) for x, y in zip(a, b)], [sorted_tokens(" ".join(set(y.split()) - set(x.split()))) for x, y in zip(a, b)])
    return np.where(shared, 100.0, rest)
