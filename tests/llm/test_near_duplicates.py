"""Buckets of many rows that are alike but not near."""

import random

import numpy as np
import pyarrow as pa

from doclathe.llm.near_duplicates import _BAND, PARITY, _links, _signatures, parity_limits


def bucket(texts):
    """The texts as rows of one bucket."""
    signed = next(_signatures(iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])])))
    return pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()).fill_null(7), *(signed.column(c) for c in _BAND.names[1:])], schema=_BAND)


def test_alike_rows_of_a_large_bucket_are_no_candidates():
    rng = random.Random(2)
    words = lambda k: [f"own{rng.randrange(10**9)}" for _ in range(k)]
    base = [f"w{i}" for i in range(70)]
    texts = [[*base, *words(30)] for _ in range(1200)]
    near = {(i, 1200 + i) for i in range(0, 200)}
    texts += [[*texts[i][:-19], *words(19)] for i in range(200)]  # 81 of 100 words in common; all others share 70
    pairs = {tuple(p) for b in _links(iter([bucket([" ".join(t) for t in texts])]), 0.8, 0.002) for p in zip(*(c.to_pylist() for c in b.columns))}
    assert len(near & pairs) >= 0.98 * len(near)
    assert len(pairs - near) < 0.01 * len(texts) ** 2 / 2


def test_small_groups_of_a_large_bucket_are_not_thinned():
    """No row of a small group is let go, so nothing is compared again; of a large group most are."""
    rng = np.random.default_rng(5)
    text = lambda: [f"t{x}" for x in rng.integers(0, 10**9, 100)]
    small = [[*base[:99], f"e{k}"] for base in (text() for _ in range(200)) for k in range(4)]
    hot = text()
    large = [[*hot[:98], f"a{k}", f"b{k}"] for k in range(900)]
    gone = lambda texts: {i for b in _links(iter([bucket([" ".join(t) for t in texts])]), 0.8, 0.002, tell=True) for i, other, key in zip(*(c.to_pylist() for c in b.columns)) if other is None and key == 7}
    assert gone(small) == set()
    assert len(gone(small + large)) > 800 and min(gone(small + large)) >= 800


def test_parity_limits_keep_near_pairs():
    limits, rng = parity_limits(0.002), np.random.default_rng(1)
    assert (np.diff(limits) >= 0).all() and limits[-1] == 64 * PARITY
    for d in (1, 24, 60, 400, 1500):
        bits = (np.bincount((np.arange(4000)[:, None] * 64 * PARITY + rng.integers(0, 64 * PARITY, (4000, d))).ravel(), minlength=4000 * 64 * PARITY) & 1).reshape(4000, -1).sum(axis=1)
        assert (bits > limits[d]).mean() <= 0.006
