"""Suffix arrays of short symbol sequences with numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray, top: int, depth: int | None = None) -> np.ndarray:
    """Start of each suffix in sorted order, by prefix doubling. Symbols are 0 to ``top``; they are
    numbered densely and the first sort packs as many of them into one number as fit. Later sorts
    take only suffixes still tied. With ``depth``, suffixes that agree in so many symbols may stay in any order."""
    n = len(symbols)
    used = np.zeros(top + 1, bool)
    used[symbols] = True
    dense = np.cumsum(used)[symbols]  # from 1; 0 is beyond the end
    bits = max(1, int(used.sum()).bit_length())
    have = max(1, min(62 // bits, n))
    key = _packed(np.append(dense, np.zeros(have, np.int64)), bits, have)[:n]
    order = np.argsort(key)
    key = key[order]
    head = np.append(True, key[1:] != key[:-1])[:n]  # starts of groups of tied suffixes
    rank = np.zeros(n, np.int32 if n < 1 << 31 else np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    tied = _tied(head, np.arange(n))
    while len(tied) and (depth is None or have < depth):
        some = order[tied]
        after = some + have
        key = rank[some].astype(np.int64) * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key)
        some, key = some[by], key[by]
        order[tied] = some
        head = np.append(True, key[1:] != key[:-1])
        rank[some] = tied[np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))]
        tied = _tied(head, tied)
        have *= 2
    return order


def _packed(codes: np.ndarray, bits: int, have: int) -> np.ndarray:
    """At each place the next ``have`` codes of ``bits`` bits as one number, by doubling; zeros follow the end."""
    key, wide = codes, 1
    after = lambda x, by: np.append(x[by:], np.zeros(min(by, len(x)), np.int64))
    while 2 * wide <= have:
        key = (key << (bits * wide)) | after(key, wide)
        wide *= 2
    rest = have - wide  # the last codes of the number that begins so much later
    return (key << (bits * rest)) | (after(key, rest) & ((1 << (bits * rest)) - 1)) if rest else key


def _tied(head: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The ``places`` in groups of several, ``head`` marking the first of each group."""
    alone = head & np.append(head[1:], True)[: len(head)]
    return places[~alone]


def transform(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Burrows-Wheeler transform: the symbol before each suffix."""
    return symbols[order - 1]
