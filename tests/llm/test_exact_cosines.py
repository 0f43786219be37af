"""Neighbours' cosines come from what the search holds, not from their whole vectors."""

import numpy as np

from pathfeat.llm.toxicity import Index


def test_vectors_are_not_read_again():
    rng = np.random.default_rng(9)
    n, width = 200, 600
    rows = np.repeat(np.arange(n), 40)
    terms = np.concatenate([rng.choice(width, 40, replace=False, p=_shares(width)) for _ in range(n)])
    index = Index(np.arange(n), np.arange(n) % 2, np.ones(n), np.linspace(1, 3, width))
    index.build(rows, terms, rng.integers(1, 5, len(rows)) / 40)
    dense = np.zeros((n, width))
    dense[np.repeat(np.arange(n), np.diff(index.at)), index.terms] = index.weight
    index._prepared()
    index.terms = index.weight = None
    for q in range(0, n, 7):
        own = np.flatnonzero(dense[q])
        best, cosine = index.nearest(own, dense[q, own], 9)
        exact = np.round(dense @ dense[q], 12)
        order = np.lexsort([np.arange(n), -exact])[:9]
        assert best.tolist() == order.tolist()
        assert np.abs(cosine - exact[order]).max() <= 1e-12


def _shares(width):
    """Some terms are common, most are rare."""
    share = 1 / np.arange(1, width + 1)
    return share / share.sum()
