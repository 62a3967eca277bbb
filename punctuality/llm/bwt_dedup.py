"""Exact removal of repeated byte strings: threshold-bounded interval expansion on a BWT.

Stretches of documents that may hold a repeated string meet in shards (see ``spans``). The
texts of a run are joined with separators and sorted into a Burrows-Wheeler transform. The
intervals of suffixes with a common prefix are then found breadth first: the intervals of
all prefixes of one length are extended backward by every symbol at once through the LF
mapping, which yields the common-prefix values in increasing order; it stops at the
minimum length. Suffixes still in one interval share that many bytes, and all but those of
the smallest doc_id start a repeated string.

Null texts are empty: nothing removed. A null doc_id takes no part and keeps its bytes. Rows that
share a doc_id are judged as one document: what is removed from one is removed at the same
place of the others. Texts shorter than the length stay. No rows: an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from punctuality.llm.common import BYTE_CODES
from punctuality.llm.spans import removals, with_repeated_spans
from punctuality.llm.suffixes import suffix_array, transform


#: Bytes of stretches that are sorted together: their suffixes' numbers stay in the cache.
RUN_BYTES = 1 << 17


def byte_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_CODES[data], offsets


def byte_cut(data: np.ndarray, offsets: np.ndarray):
    at = np.arange(len(data))
    return at, at + 1, offsets


def common_prefixes(bwt: np.ndarray, least: int) -> np.ndarray:
    """For each suffix in sorted order, whether its common prefix with the one before is shorter
    than ``least``. Level by level: suffixes are apart at level l + 1 if their first symbols
    differ or the suffixes one symbol later are apart at level l. Where those two are neighbours, only what came
    apart at the last level is followed backward; elsewhere the numbers of their intervals are compared.
    Suffixes that agree in ``least`` symbols may be in any order."""
    n = len(bwt)
    later = np.argsort(bwt, kind="stable").astype(np.int32)  # from a suffix to the one that starts a symbol later
    first = bwt[later]
    apart = np.append(True, first[1:] != first[:-1])
    earlier = np.empty(n, np.int32)
    earlier[later] = np.arange(n, dtype=np.int32)
    neighbours = np.append(False, np.diff(later) == 1)
    open_ = np.flatnonzero(~apart & ~neighbours)  # still together with the one before
    high, low = later[open_], later[open_ - 1]
    neighbours &= ~apart
    new = np.flatnonzero(apart)
    for _ in range(least - 1):
        new = earlier[new]
        new = new[neighbours[new]]
        if len(open_):
            interval = np.cumsum(apart, dtype=np.int32)
            hit = interval[high] != interval[low]
            new = np.append(new, open_[hit])
            open_, high, low = open_[~hit], high[~hit], low[~hit]
        if not len(new):
            break
        apart[new] = True
    return apart


def byte_matcher(least: int):
    """Matcher of ``spans.match_shards`` for strings of ``least`` bytes."""

    def match(texts: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.cumsum(sizes + 1) - sizes - 1
        symbols = np.frombuffer(b"\x00".join(texts) + b"\x00\x00", np.uint8).astype(np.int16) + 1
        symbols[starts + sizes] = 0  # separators
        symbols[-1] = 0
        order = suffix_array(symbols, 256, least)
        apart = common_prefixes(transform(symbols, order), least)
        owner = np.repeat(np.arange(len(texts)), sizes + 1)
        owner = np.append(owner, len(texts) - 1)
        place = np.arange(len(symbols)) - np.append(np.repeat(starts, sizes + 1), starts[-1])
        full = (place + least <= sizes[owner])[order]
        group = np.cumsum(apart)[full]
        at, own = order[full], docs[owner[order[full]]]
        if not len(at):
            return [np.zeros((0, 2), np.int64)] * len(texts)
        head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        smallest = np.repeat(np.minimum.reduceat(own, head), np.diff(np.append(head, len(group))))
        hit = np.sort(at[own > smallest])
        return _runs(place[hit], owner[hit], len(texts), least)

    return match


def _runs(place: np.ndarray, owner: np.ndarray, n: int, size: int) -> list[np.ndarray]:
    """Window starts (sorted by text, place) as merged [start, end) spans of each of ``n`` texts."""
    out = [np.zeros((0, 2), np.int64)] * n
    if not len(place):
        return out
    new = np.append(True, (owner[1:] != owner[:-1]) | (place[1:] > place[:-1] + 1))
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(place)) - 1
    spans = np.stack([place[head], place[last] + size], 1)
    cut = np.flatnonzero(np.diff(owner[head])) + 1
    for o, s in zip(owner[head][np.append(0, cut)].tolist(), np.split(spans, cut), strict=True):
        out[o] = s
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    for b in (x.slice(i, 256) for x in batches for i in range(0, len(x), 256)):
        rows = []
        texts = b.column("text").to_pylist()
        for doc, text, gone in zip(b.column("doc_id").to_pylist(), texts, removals(b, [len(x) for x in texts]), strict=True):
            removed = n_spans = 0
            kept = text
            if gone is not None:
                removed = int(gone.sum())
                n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((doc, len(text), removed, n_spans, hashlib.sha256(kept).hexdigest(), kept))
        columns = zip(*rows, strict=True) if rows else [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names)


def remove_repeated_bytes(docs: DataFrame, least: int = 50, k: int = 16) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes): one row per row of ``docs``,
    without the bytes covered by a string of ``least`` bytes that also starts in a document with a smaller doc_id."""
    both = with_repeated_spans(docs, byte_codes, byte_cut, byte_matcher(least), least, k, unit_bytes=1.0, per_run=RUN_BYTES)
    return both.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
