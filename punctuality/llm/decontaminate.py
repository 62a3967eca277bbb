"""Benchmark decontamination by winnowing.

Every text is a sequence of k-gram hashes; of each run of ``w`` successive hashes the
smallest is a fingerprint, so any stretch of ``n = w + k - 1`` words that two texts share
has a fingerprint in common. Benchmark items give a set of fingerprints and of n-word
windows; document windows whose fingerprint is in the set are extended to the whole window
and compared. Items of fewer than n words are one window of their own length: their
fingerprint is the smallest hash of k = min(k, length) words over that window, so the same
rule holds with their own w.

The benchmark goes to the executors in blocks of at most ``block_words`` windows (the bound is what
limits the broadcast; windows are dealt by a hash of item, length and window, so an item may be in several
blocks, and there are as many as it takes for the largest to keep the bound), one after another: a block's hits are
written and its broadcast is gone before the next one is read. The documents are read once per block, so a large
benchmark costs passes, not memory. Documents are never shuffled by their text or by a fingerprint: a common
passage makes no hot key. Windows are equal if two 64-bit hashes of them are.

Null or empty texts have no words: they are returned with zero hits; such items match
nothing. Repeated item rows count once per item_id. Repeated documents get a row each.
No documents or no items: an empty result, or one without hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import ALNUM, LOWER, Sums, covered, materialize, mix, signed, slices, text_bytes, word_bounds, word_hashes


def _words(data: np.ndarray, offsets: np.ndarray):
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    return word_hashes(data, starts, ends, False), first


def _checks(hashes: np.ndarray) -> Sums:
    """A second hash of any stretch of words."""
    return Sums(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each run of ``w`` values."""
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (w - have)], x[w - have :]) if w > have else x


def _windows(hashes: np.ndarray, first: np.ndarray, n: int, k: int):
    """Fingerprint and hash of each n-word window, its start, and its text's index."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    if not counts.sum():
        return None
    sums, size, k = Sums(hashes), len(hashes), min(k, n)
    at = np.arange(size - k + 1)
    grams = sums.of(at, at + k)
    low = _sliding_min(grams, n - k + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + first[text]
    return low[start], sums, start, text


def item_windows(items: DataFrame, n: int, k: int) -> DataFrame:
    """(item_id string, length, mark, window, check): every n-word window of the items, or the one
    window of a shorter item, with its fingerprint and two hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("item_id")
            for i, _, data, offsets in slices(b, "text"):
                hashes, first = _words(data, offsets)
                for length in sorted({min(n, c) for c in np.diff(first).tolist() if c}):
                    own = np.diff(first) >= n if length == n else np.diff(first) == length
                    found = _windows(hashes, first, length, k)
                    mark, sums, start, text = found
                    keep = own[text]
                    mark, start, text = mark[keep], start[keep], text[keep]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(text + i)),
                            pa.array(np.full(len(text), length, np.int32)),
                            pa.array(signed(mark)),
                            pa.array(signed(sums.of(start, start + length))),
                            pa.array(signed(_checks(hashes).of(start, start + length))),
                        ],
                        ["item_id", "length", "mark", "window", "check"],
                    )

    df = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), text_bytes(F.col("text")).alias("text"))
    return df.mapInArrow(rows, "item_id string, length int, mark long, window long, check long").distinct()


def _block_hits(docs: DataFrame, block: DataFrame, k: int, only: bool = False) -> tuple[DataFrame, Broadcast]:
    """(doc key, n_words, spans (int64 pairs), items (strings)) with the hits of one block of items, and what was sent.
    If it is the ``only`` block, the finished rows instead: a task then needs one Python worker, not a second one beside it."""
    spark = docs.sparkSession
    rows = block.toPandas()  # bounded by block_words
    names = sorted(set(rows["item_id"]))
    number = {x: i for i, x in enumerate(names)}
    by_length = {}
    for length, part in rows.groupby("length"):
        order = np.argsort(part["window"].to_numpy().view(np.uint64), kind="stable")
        by_length[int(length)] = (
            np.unique(part["mark"].to_numpy().view(np.uint64)),
            part["window"].to_numpy().view(np.uint64)[order],
            np.array([number[x] for x in part["item_id"]], np.int64)[order],
            part["check"].to_numpy().view(np.uint64)[order],
        )
    sent = spark.sparkContext.broadcast((names, by_length))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, by_length = sent.value
        for b in batches:
            for i, j, data, offsets in slices(b, "text"):
                hashes, first = _words(data, offsets)
                spans = [[] for _ in range(j - i)]
                items = [set() for _ in range(j - i)]
                for length, (marks, windows, owner, checks) in by_length.items():
                    found = _windows(hashes, first, length, k)
                    if found is None:
                        continue
                    mark, sums, start, text = found
                    spot = np.searchsorted(marks, mark)
                    spot[spot == len(marks)] = 0
                    near = marks[spot] == mark  # windows that share a fingerprint
                    start, text = start[near], text[near]
                    whole = sums.of(start, start + length)
                    lo, hi = np.searchsorted(windows, whole, "left"), np.searchsorted(windows, whole, "right")
                    text, start, lo, hi = (x[hi > lo] for x in (text, start, lo, hi))
                    if not len(text):
                        continue
                    again = _checks(hashes).of(start, start + length)
                    for t, s, x, y, z in zip(text, start, lo, hi, again, strict=True):
                        own = owner[x:y][checks[x:y] == z]
                        if len(own):
                            spans[t].append((s - first[t], s - first[t] + length))
                            items[t].update(own.tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(i, j - i),
                        b.column("row").slice(i, j - i),
                        pa.array(np.diff(first)),
                        pa.array([np.array(s, np.int64).tobytes() for s in spans], pa.binary()),
                        pa.array([sorted(names[x] for x in s) for s in items], pa.list_(pa.string())),
                    ],
                    ["doc_id", "row", "n_words", "spans", "items"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    if only:
        return docs.mapInArrow(lambda batches: _finish(map(_alone, hits(batches))), _FINISHED.format(kind=kind)), sent
    return docs.mapInArrow(hits, f"doc_id {kind}, row long, n_words long, spans binary, items array<string>"), sent


_FINISHED = "doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _alone(b: pa.RecordBatch) -> pa.RecordBatch:
    """The hits of one block in the form of those that met."""
    each = pa.array(np.arange(b.num_rows + 1, dtype=np.int32))
    parts = [pa.ListArray.from_arrays(each, b.column(c)) for c in ("spans", "items")]
    return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), *parts], ["doc_id", "n_words", "spans", "items"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_hit, n_items, digest = [], [], []
        for size, spans, items in zip(b.column("n_words").to_pylist(), b.column("spans").to_pylist(), b.column("items").to_pylist(), strict=True):
            s = np.frombuffer(b"".join(spans), np.int64).reshape(-1, 2)
            n_hit.append(int(covered(s[:, 0], s[:, 1], size).sum()) if len(s) else 0)
            names = sorted({x for part in items for x in part})
            n_items.append(len(names))
            digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                b.column("doc_id"),
                b.column("n_words"),
                pa.array(n_hit, pa.int64()),
                pa.array(n_items, pa.int64()),
                pa.array(digest, pa.string()),
                pa.array([x > 0 for x in n_hit], pa.bool_()),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def contamination(docs: DataFrame, items: DataFrame, n: int = 10, k: int = 5, block_words: int = 1_000_000) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    One row per input row. With more than one block the hits of a document meet by doc_id and
    a hash of its text; equal rows meet as one and are repeated afterwards.
    """
    windows = materialize(item_windows(items, n, k), "winnow-windows")
    rows = windows.count()
    blocks = max(1, -(-rows // block_words))
    d = docs.select("doc_id", text_bytes(F.col("text")).alias("text"))
    d = d.select("doc_id", F.xxhash64("text").alias("row"), "text")
    dealt = F.xxhash64("item_id", "length", "window")
    while blocks > 1 and windows.groupBy(F.pmod(dealt, F.lit(blocks))).count().agg(F.max("count")).first()[0] > block_words:
        blocks += -(-blocks // 8)
    part = F.pmod(dealt, F.lit(blocks))
    if blocks == 1:
        return _block_hits(d, windows, k, only=True)[0]
    found = []
    for i in range(blocks):
        hits, sent = _block_hits(d, windows.where(part == i), k)
        found.append(materialize(hits, "winnow-hits"))
        sent.destroy()
    merged = reduce(DataFrame.unionByName, found).groupBy("doc_id", "row").agg(
        F.max("n_words").alias("n_words"),
        F.collect_set("spans").alias("spans"),
        F.collect_set("items").alias("items"),
        (F.count(F.lit(1)) / blocks).cast("int").alias("rows"),
    )
    merged = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("row", "rows", "copy")
    return merged.mapInArrow(_finish, _FINISHED.format(kind=docs.schema["doc_id"].dataType.simpleString()))
