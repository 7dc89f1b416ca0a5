"""Words of a batch of texts as flat numpy arrays (Arrow does the text work)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (SplitMix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (numpy's own unique hashes integers, which takes many times as long)."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def words(texts: pa.Array, pattern: str = r"[^\p{L}\p{M}\p{N}]+") -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(doc, code, vocabulary): for each word in order its text's index and its index in vocabulary. Lower case; what matches pattern separates. Null texts have no words."""
    low = pc.replace_substring_regex(pc.utf8_lower(texts), pattern, " ")
    lists = pc.utf8_split_whitespace(pc.fill_null(low, ""))
    flat = pc.list_flatten(lists)
    doc = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = flat.dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    code, vocabulary = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    blank = pc.index(vocabulary, "").as_py()
    if blank >= 0:
        keep = code != blank
        doc, code = doc[keep], code[keep]
    return doc, code, vocabulary


def hashes(vocabulary: pa.Array) -> np.ndarray:
    return pd.util.hash_array(vocabulary.to_numpy(zero_copy_only=False).astype(object), categorize=False).astype(_U) if len(vocabulary) else np.zeros(0, _U)


def occurrence(doc: np.ndarray, code: np.ndarray) -> np.ndarray:
    """For each word how often it stood in its text before; makes a bag of words a set."""
    if not len(doc):
        return np.zeros(0, np.int64)
    key = doc * (int(code.max()) + 1) + code
    order = np.argsort(key, kind="stable")
    k = key[order]
    start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    rank = np.arange(len(k)) - np.repeat(start, np.diff(np.r_[start, len(k)]))
    out = np.empty(len(k), np.int64)
    out[order] = rank
    return out


def one_permutation(doc: np.ndarray, token: np.ndarray, n: int, seed: int, bins: int = 64) -> np.ndarray:
    """n x bins minhashes: each token falls into one bin, the least counts; an empty bin borrows from the next full one. Rows without tokens hold the greatest value."""
    h = mix(token ^ mix(np.array([seed], _U)))
    none = _U(0xFFFFFFFFFFFFFFFF)
    sig = np.full(n * bins, none, _U)
    np.minimum.at(sig, doc * bins + (h >> _U(58)).astype(np.int64) % bins, h & _U((1 << 58) - 1))
    sig = sig.reshape(n, bins)
    full = sig != none
    place = np.arange(bins)
    to = np.minimum.accumulate(np.where(full, place, 2 * bins)[:, ::-1], axis=1)[:, ::-1]  # the next full bin, or one of the next turn
    to = np.where(to < bins, to, to[:, :1] + bins)
    row, column = np.nonzero(~full & full.any(axis=1)[:, None])
    from_ = to[row, column]
    out = sig.copy()
    out[row, column] = mix(sig[row, from_ % bins] + (from_ - column).astype(_U))
    return out
