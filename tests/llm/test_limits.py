import numpy as np
import pandas as pd
import pytest

from knotwork.llm import truncated


def test_censoring_decides_where_few_are_at_the_limit():
    of = lambda prior, n, lr: truncated._share(pd.DataFrame([("s", True, lr, prior, n)], columns=["source", "at_limit", "lr", "prior", "n"])).posterior.iloc[0]
    assert of(0.95, 3, 1.0) == pytest.approx(0.95, abs=0.01) and of(0.6, 3, 1.0) == pytest.approx(0.6, abs=0.01)
    # many texts that end as whole ones do overrule it
    assert of(0.95, 300, 0.05) < 0.1


def lengths(top=()):
    r = np.random.default_rng(3)
    x = np.exp(r.normal(7.5, 0.6, 4000)).astype(int)
    x = np.concatenate([np.minimum(x[:2000], 3000), np.minimum(x[2000:], 5000), np.array(top, int)])
    return np.unique(x, return_counts=True)


def test_several_limits_and_longer_values():
    for top in ((), (5004,), (9000, 12_000)):
        x, n = lengths(top)
        found = {limit: prior for limit, prior, _ in truncated._limits_in(x.astype(float), n.astype(float))}
        assert set(found) == {3000.0, 5000.0} and min(found.values()) > 0.9


def test_no_limit_where_there_is_none():
    for seed in range(20):
        x, n = np.unique(np.exp(np.random.default_rng(seed).normal(7.5, 0.6, 4000)).astype(int), return_counts=True)
        assert truncated._limits_in(x.astype(float), n.astype(float)) == []
