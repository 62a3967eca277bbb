"""Exact removal of repeated word sequences with a compressed FM-index per shard.

Stretches of documents that may hold a repeated window meet in shards (see ``spans``). The
words of a run's texts become numbers; their Burrows-Wheeler transform is kept as a wavelet
tree (in matrix form: one packed bit vector with block counts per bit of a word number),
which answers how often a word occurs before a place. The texts are then streamed against
the index: from every word, backward search extends to the left as long as the words so far
occur in a document with a smaller doc_id (least doc_id over the interval). The length
reached is the word's matching statistic, bounded by the threshold; those that reach it
report their window.

Words are compared by 64-bit hashes. Null texts have no words: nothing removed. A null doc_id takes no part
and keeps its words. Rows that share a doc_id are judged as one document: what is removed from
one is removed at the same place of the others. No rows: an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from punctuality.llm.bwt_dedup import _runs
from punctuality.llm.common import NOT_SPACE, word_bounds, word_hashes
from punctuality.llm.spans import removals, with_repeated_spans
from punctuality.llm.suffixes import suffix_array, transform


def word_cut(data: np.ndarray, offsets: np.ndarray):
    return word_bounds(data, offsets, NOT_SPACE)


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_cut(data, offsets)
    return word_hashes(data, starts, ends, False), first


class BitVector:
    """Packed bits with a count of ones before each 64-bit block."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.blocks).astype(np.int32)
        self.before = np.cumsum(counts, dtype=np.int32) - counts
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before place ``i``."""
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        block = i >> 6
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)


class FMIndex:
    """Wavelet-tree FM-index of a sequence of numbers from 0 to ``top``."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.order = suffix_array(symbols, top)
        bwt = transform(symbols, self.order)
        self.before = np.append(0, np.cumsum(np.bincount(symbols, minlength=top + 1)))  # smaller symbols
        self.levels, x = [], bwt
        for bit in reversed(range(max(1, int(top).bit_length()))):
            one = (x >> bit & 1).astype(bool)
            self.levels.append((bit, BitVector(one)))
            x = np.concatenate([x[~one], x[one]])
        every = np.arange(top + 1)
        self.base = self._descend(every, np.zeros(top + 1, np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, vector in self.levels:
            ones = vector.ones(i)
            i = np.where(symbol >> bit & 1, vector.zeros + ones, i - ones)
        return i

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals [lo, hi) of some strings, after putting ``symbol`` before each."""
        n = len(symbol)
        both = self._descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        shift = self.before[symbol] - self.base[symbol]
        return both[:n] + shift, both[n:] + shift


class LeastOf:
    """Least value over any interval, from a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            last, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def over(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lo), np.int64)
        level = np.frexp((hi - lo).astype(float))[1] - 1
        for x in np.unique(level).tolist():
            some = level == x
            row = self.rows[x]
            out[some] = np.minimum(row[lo[some]], row[hi[some] - (1 << x)])
        return out


def matching_statistics(index: FMIndex, symbols: np.ndarray, least: LeastOf, ends: np.ndarray, own: np.ndarray, most: int) -> np.ndarray:
    """For each place of ``ends``, how many symbols up to and with it occur in a document before
    ``own``, up to ``most``."""
    length = np.zeros(len(ends), np.int64)
    alive = np.arange(len(ends))
    lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(symbols), np.int64)
    for step in range(most):
        lo, hi = index.extend(symbols[ends[alive] - step], lo, hi)
        on = least.over(lo, hi) < own[alive]
        alive, lo, hi = alive[on], lo[on], hi[on]
        if not len(alive):
            break
        length[alive] = step + 1
    return length


def word_matcher(least: int):
    """Matcher of ``spans.match_shards`` for windows of ``least`` words."""

    def match(texts: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.append(0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))))
        codes, first = word_codes(data, offsets)
        unique, number = np.unique(codes, return_inverse=True)
        sizes = np.diff(first)
        starts = first[:-1] + np.arange(len(texts))  # a separator, 0, after each text
        symbols = np.insert(number + 1, first[1:], 0)
        owner = np.repeat(np.arange(len(texts)), sizes + 1)
        place = np.arange(len(symbols)) - np.repeat(starts, sizes + 1)
        index = FMIndex(symbols, len(unique))
        rank = docs[owner]
        ends = np.flatnonzero((place >= least - 1) & (place < sizes[owner]))
        reached = matching_statistics(index, symbols, LeastOf(rank[index.order]), ends, rank[ends], least)
        hit = ends[reached == least] - least + 1
        return _runs(place[hit], owner[hit], len(texts), least)

    return match


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    for b in (x.slice(i, 256) for x in batches for i in range(0, len(x), 256)):
        rows = []
        texts = [x.split() for x in b.column("text").to_pylist()]  # bytes: at 0x20 and 0x09 to 0x0D
        for doc, words, gone in zip(b.column("doc_id").to_pylist(), texts, removals(b, [len(x) for x in texts]), strict=True):
            removed, n = 0, len(words)
            if gone is not None:
                removed = int(gone.sum())
                words = [words[i] for i in np.flatnonzero(~gone).tolist()]
            kept = b" ".join(words)
            rows.append((doc, n, removed, hashlib.sha256(kept).hexdigest(), kept))
        columns = zip(*rows, strict=True) if rows else [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names)


def remove_repeated_words(docs: DataFrame, least: int = 13, k: int = 5) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (bytes): one row per row of ``docs``, without the
    words covered by a window of ``least`` words that also starts in a document with a smaller doc_id."""
    both = with_repeated_spans(docs, word_codes, word_cut, word_matcher(least), least, k, unit_bytes=6.0)
    return both.mapInArrow(_remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
