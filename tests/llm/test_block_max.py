"""Block-max pruning of the toxicity neighbours: exact, and it skips blocks."""

import pickle

import numpy as np
import pytest

from pathfeat.llm.toxicity import Index


def _index(n, topics, seed, words=60):
    """Examples of topics that share few words, as rows, terms and frequencies."""
    rng = np.random.default_rng(seed)
    rows, terms = [], []
    for i in range(n):
        own = rng.integers(0, words, 25) + words * (i % topics)
        common = topics * words + rng.integers(0, 20, 6)
        for t in np.unique(np.concatenate([own, common])):
            rows.append(i)
            terms.append(t)
    rows, terms = np.array(rows), np.array(terms)
    counts = rng.integers(1, 4, len(rows)) / 40
    width = topics * words + 20
    held = np.bincount(terms, minlength=width)
    index = Index(np.arange(n) * 7 % 1009, rng.integers(0, 2, n), np.ones(n), np.log((n + 1) / (held + 1)) + 1)
    return index.build(rows, terms, counts), width


def _dense(index, width):
    out = np.zeros((len(index.ids), width))
    for i in range(len(index.ids)):
        part = slice(index.at[i], index.at[i + 1])
        out[i, index.terms[part]] = index.weight[part]
    return out


@pytest.mark.parametrize("n, topics, k", [(5, 1, 9), (40, 2, 3), (700, 6, 15), (700, 1, 15)])
def test_brute_force(n, topics, k):
    index, width = _index(n, topics, seed=n + topics)
    dense = _dense(index, width)
    at, terms, weight = [0], [], []
    for q in range(0, n, 3):
        own = np.flatnonzero(dense[q])
        terms.append(own)
        weight.append(dense[q, own])
        at.append(at[-1] + len(own))
    places = np.arange(0, n, 3)
    for leave in (places, np.full(len(places), -1)):
        found = index.nearest_of_each(np.array(at), np.concatenate(terms), np.concatenate(weight), k, leave)
        for q, out, (best, cosine) in zip(places, leave, found):
            exact = np.round(dense @ dense[q], 12)
            order = [i for i in np.lexsort([index.ids, -exact]) if i != out and exact[i] > 0][:k]
            assert best.tolist() == order
            assert cosine.tolist() == exact[order].tolist()


def test_blocks_are_skipped():
    index, width = _index(1600, 8, seed=3)
    dense = _dense(index, width)
    own = np.flatnonzero(dense[11])
    index.nearest(own, dense[11, own], 5)
    assert index.looked + index.skipped == 1600 // 32
    # Seven of eight topics share nothing but the common words.
    assert index.skipped > index.looked


def test_only_vectors_are_sent():
    index, _ = _index(300, 3, seed=4)
    small = len(pickle.dumps(index))
    index._prepared()
    assert len(pickle.dumps(index)) == small and not hasattr(pickle.loads(pickle.dumps(index)), "_blocks")
