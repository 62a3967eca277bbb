"""Routing of repeated stretches to shards, shared by the two substring operators.

Both operators find windows of ``length`` units (bytes or words) that also start in a
document with a smaller doc_id. Of the hashes of the k-grams inside a window the smallest
(leftmost among equals) is the window's anchor; it depends on the window alone, so equal
windows have equal anchors. Consecutive windows with the same anchor form a stretch.

1. ``anchors``: every ``HELD`` anchors of a task (hash, doc_id, first unit, size, hashes of the units beside) are dealt
   to buckets of the hash, as packed blocks of numbers. Among them, of stretches that
   are equal only the one with the smallest doc_id goes on; the others are done, since the
   same stretch starts in a smaller document. That keeps a passage that a large part of
   the corpus shares to one entry per block.
2. ``repeated``: a bucket does the same for all blocks, and keeps the anchors that several documents hold in
   different stretches (told apart by a second 64-bit hash) with the same units on one side (``partners``). In texts
   of few words most anchors are held by several documents sooner or later, hardly any of them with the same units beside.
3. ``fetch``: the bytes of those stretches are cut out of the documents and dealt to shards
   by anchor, where a matcher (a Burrows-Wheeler transform, an FM-index) compares whole windows.
   An anchor with more than ``HOT_ENTRIES`` entries (a common phrase in ever different
   surroundings) is dealt window by window, by the window's hash, so that its entries
   spread over all shards; equal windows still meet.
4. ``by_doc``: per document, the spans that the blocks, buckets and shards found. Until then they travel packed,
   in slots of documents.

Documents are joined by doc_id only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import Sums, covered, materialize, mix, ranges, slices, text_bytes, total_bytes

_U = np.uint64

#: Entries of one anchor above which it is dealt by window.
HOT_ENTRIES = 4096

#: Windows whose anchors are found at once.
BLOCK = 1 << 14

#: Bits of an anchor's hash that route it. Anchors that agree in them by chance only send some stretches in
#: vain: the 64-bit hash of the stretch and the comparison of the bytes decide.
ROUTE = _U((1 << 48) - 1)

#: Entries that a task holds before it deals them, so that what it sends to one bucket or slot is not a few at a time.
HELD = 1 << 18

#: One anchor: its hash, the stretch's hash, document, hashes of the units to the left and right, first unit, and the
#: stretch's size in units.
ENTRY = np.dtype([("anchor", "<u8"), ("whole", "<u8"), ("doc", "<i8"), ("left", "<u4"), ("right", "<u4"), ("start", "<i4"), ("size", "<i2")])
#: One stretch to be fetched, with its document; and without it.
FOUND = np.dtype([("doc", "<i8"), ("anchor", "<u8"), ("start", "<i4"), ("size", "<i2")])
ROUTED = np.dtype([("anchor", "<u8"), ("start", "<i4"), ("size", "<i2")])
#: One span, with its document; and without it.
SPAN = np.dtype([("doc", "<i8"), ("start", "<i4"), ("size", "<i4")])
PLACE = np.dtype([("start", "<i4"), ("size", "<i4")])

#: codes(data, offsets) -> (a 64-bit code per unit, each text's first unit, with the end)
Codes = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def stretches(codes: np.ndarray, first: np.ndarray, length: int, k: int):
    """(text, anchor hash, start, size, anchor's place) of every run of windows with one anchor."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    if not counts.sum():
        return None
    n, w = len(codes), length - k + 1
    sums = Sums(codes)
    windows = n - length + 1  # those that reach into the next text among them
    place = np.empty(windows, np.int64)
    low = _U(24)  # the place, in the low bits, decides among equals: leftmost
    if n >= 1 << 24:
        low = _U(int(n).bit_length())
    for i in range(0, windows, BLOCK):  # blocks of windows, so that the passes over their hashes stay in the cache
        at = np.arange(i, min(i + BLOCK, windows) + w - 1)
        key = (sums.of_run(i, i + len(at), k) >> low << low) | at.astype(_U)
        have = 1
        while have * 2 <= w:
            key = np.minimum(key[:-have], key[have:])
            have *= 2
        if w > have:
            key = np.minimum(key[: len(key) - (w - have)], key[w - have :])
        place[i : i + BLOCK] = (key & ((_U(1) << low) - _U(1))).astype(np.int64)
    ends = first[:-1] + counts  # of each text's windows
    there = counts > 0
    new = np.append(True, place[1:] != place[:-1])
    new[first[:-1][there]] = True
    inside = np.zeros(windows + 1, np.int8)
    np.add.at(inside, first[:-1][there], 1)
    np.add.at(inside, ends[there], -1)
    new = np.flatnonzero(new & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
    text = np.searchsorted(first, new, "right") - 1
    last = np.minimum(np.append(new[1:], windows), ends[text])
    at = place[new]
    return text, sums.of(at, at + k), new, last - 1 + length - new, at, sums


def _earliest(entry: np.ndarray) -> np.ndarray:
    """Which entries have the smallest doc among those with equal stretches."""
    out = np.ones(len(entry), bool)
    tied = _tied(entry["whole"])
    if not len(tied):
        return out
    doc, keys = entry["doc"][tied], [entry[x][tied] for x in ("anchor", "whole")]
    order = np.lexsort((doc, *keys))
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    least = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out[tied[order]] = doc[order] == least
    return out


def _tied(key: np.ndarray) -> np.ndarray:
    """The places of the keys that are there several times, in order of the keys."""
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    return order[np.append(False, same) | np.append(same, False)] if len(key) else order


def _side(sums: Sums, start: np.ndarray, end: np.ndarray, there: np.ndarray) -> np.ndarray:
    """24 bits of the hash of the units beside an anchor; 0 where no window of the stretch holds them all."""
    some = np.flatnonzero(there)
    out = np.zeros(len(start), np.uint32)
    out[some] = np.maximum(sums.of(start[some], end[some]) & _U((1 << 24) - 1), _U(1))
    return out


def anchors(docs: DataFrame, codes: Codes, length: int, k: int, buckets: int, slots: int) -> DataFrame:
    """(bucket, slot, payload): packed entries of a bucket (slot null), or packed spans of a slot's
    documents that are already known to be repeated (bucket by the slot)."""
    half = (length - k + 1) // 2

    def deal(held: list[np.ndarray]) -> pa.RecordBatch:
        entry = np.concatenate(held)
        on = _earliest(entry)
        rows = [(at, None, payload) for at, payload in _pack(entry[on], buckets)]
        rows += [(slot % buckets, slot, payload) for slot, payload in _by_slot(_as(SPAN, entry[~on]), slots)]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["bucket", "slot", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j, data, offsets in slices(b, "text"):
                units, first = codes(data, offsets)
                found = stretches(units, first, length, k)
                if found is None:
                    continue
                text, anchor, start, size, place, sums = found
                entry = np.zeros(len(text), ENTRY)
                entry["anchor"], entry["doc"], entry["size"] = anchor & ROUTE, ids[i:j][text], size
                entry["start"], entry["whole"] = start - first[text], sums.of(start, start + size) ^ (place - start).astype(_U)
                entry["left"] = _side(sums, place - half, place, place - start >= half)
                entry["right"] = _side(sums, place + k, place + k + half, start + size - place >= k + half)
                held.append(entry)
                n += len(entry)
                if n >= HELD:
                    yield deal(held)
                    held, n = [], 0
        if held:
            yield deal(held)

    return docs.mapInArrow(run, "bucket long, slot long, payload binary")


def _as(kind: np.dtype, entry: np.ndarray) -> np.ndarray:
    """The fields of ``kind``, of entries that have more."""
    out = np.empty(len(entry), kind)
    for name in kind.names:
        out[name] = entry[name]
    return out


def _by_slot(entry: np.ndarray, slots: int) -> Iterator[tuple[int, bytes]]:
    """(slot, payload): the entries of each slot's documents, as byte planes."""
    slot = mix(entry["doc"].astype(_U)) % _U(slots)
    slot = slot.astype(np.uint16 if slots <= 1 << 16 else np.uint32)
    order = np.argsort(slot, kind="stable")
    planes, slot = np.ascontiguousarray(_planes(entry[order])), slot[order]
    head = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, int)
    for i, j in zip(head.tolist(), np.append(head[1:], len(slot)).tolist(), strict=False):
        yield int(slot[i]), planes[:, i:j].copy().tobytes()


def _planes(entry: np.ndarray) -> np.ndarray:
    """The entries' bytes, first those at place 0 of all entries, and so on: equal bytes lie together."""
    return np.ascontiguousarray(entry).view(np.uint8).reshape(len(entry), entry.itemsize).T


def _from_planes(raws: list[bytes], kind: np.dtype, at: int = 0) -> np.ndarray:
    """The entries of several payloads, one after another."""
    planes = [np.frombuffer(x, np.uint8, offset=at).reshape(kind.itemsize, -1) for x in raws]
    return np.ascontiguousarray(np.concatenate(planes, 1).T).view(kind).ravel()


def _pack(entry: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, payload): the entries of each bucket (there is a power of two of them), sorted by anchor, as byte
    planes with anchors and documents as differences."""
    low = _U(buckets.bit_length() - 1)
    key = (entry["anchor"] & _U(buckets - 1)) << _U(48) - low | entry["anchor"] >> low
    order = np.argsort(key)
    entry, key = entry[order], key[order]
    part, bucket = key & (ROUTE >> low), (key >> _U(48) - low).astype(np.int64)
    head = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    counts = np.diff(np.append(head, len(entry)))
    entry["anchor"] = np.diff(part, prepend=_U(0))
    entry["anchor"][head] = part[head]
    least = np.minimum.reduceat(entry["doc"], head)
    entry["doc"] -= np.repeat(least, counts)
    planes = np.ascontiguousarray(_planes(entry))
    for i, n, at, doc in zip(head.tolist(), counts.tolist(), bucket[head].tolist(), least.tolist(), strict=True):
        yield at, np.array([at, buckets, doc], "<i8").tobytes() + planes[:, i : i + n].copy().tobytes()


def _unpack_tied(raws: list[bytes]) -> np.ndarray:
    """The entries of a bucket's payloads whose anchors are there several times."""
    bucket, buckets, _ = np.frombuffer(raws[0], "<i8", 3).tolist()
    planes = np.concatenate([np.frombuffer(x, np.uint8, offset=24).reshape(ENTRY.itemsize, -1) for x in raws], 1)
    counts = np.array([(len(x) - 24) // ENTRY.itemsize for x in raws])
    anchor = np.cumsum(np.ascontiguousarray(planes[:8].T).view("<u8").ravel(), dtype=_U)
    anchor -= np.repeat(np.append(_U(0), anchor[np.cumsum(counts)[:-1] - 1]), counts)
    tied = _tied(anchor)
    out = np.ascontiguousarray(planes[:, tied].T).view(ENTRY).ravel()
    out["anchor"] = anchor[tied] << _U(buckets.bit_length() - 1) | _U(bucket)
    out["doc"] += np.repeat([np.frombuffer(x, "<i8", 3)[2] for x in raws], counts)[tied]
    return out


def _several(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which entries have another document in their group (a number each)."""
    out = np.zeros(len(group), bool)
    tied = _tied(group)
    if len(tied):
        head = np.flatnonzero(np.append(True, np.diff(group[tied]) != 0))
        d = doc[tied]
        out[tied] = np.repeat(np.maximum.reduceat(d, head) != np.minimum.reduceat(d, head), np.diff(np.append(head, len(tied))))
    return out


def partners(anchor: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which entries may hold a window that another document's entry holds too. The windows have ``length - k`` units
    beside the anchor, so at least half of them on one side: both entries have the same units on that side."""
    group = np.cumsum(np.append(False, anchor[1:] != anchor[:-1])).astype(np.int64) << 24  # sorted by anchor
    out = np.zeros(len(anchor), bool)
    for side in (left, right):
        some = np.flatnonzero(side)
        out[some] |= _several(group[some] | side[some].astype(np.int64), doc[some])
    return out


def repeated(dealt: DataFrame, slots: int) -> DataFrame:
    """(kind, slot, payload), packed by document: kind 0, spans known to be repeated (passed on, or equal to a stretch
    of a smaller document); kind 1, the smallest holders of the different stretches of anchors that
    several documents hold with the same units on one side, size negative for hot ones. A task holds the packed
    entries of the buckets dealt to it and works on one bucket at a time."""

    def rows(kind: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if held:
            yield _payloads([kind], _by_slot(np.concatenate(held), slots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[bytes]] = {}
        for b in batches:
            spans = b.filter(b.column("slot").is_valid())
            if len(spans):
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(spans), np.int32)), spans.column("slot"), spans.column("payload")], ["kind", "slot", "payload"])
            packed = b.filter(b.column("slot").is_null())
            for bucket, raw in zip(packed.column("bucket").to_pylist(), packed.column("payload").to_pylist(), strict=True):
                by_bucket.setdefault(bucket, []).append(raw)
        held: tuple[list, list] = [], []
        while by_bucket:
            entry = _unpack_tied(by_bucket.popitem()[1])
            if len(entry):
                entry = entry[np.argsort(entry["whole"])]
                new = (entry["anchor"][1:] != entry["anchor"][:-1]) | (entry["whole"][1:] != entry["whole"][:-1])
                head = np.flatnonzero(np.append(True, new))
                counts = np.diff(np.append(head, len(entry)))
                later = entry["doc"] > np.repeat(np.minimum.reduceat(entry["doc"], head), counts)
                held[0].append(_as(SPAN, entry[later]))
                entry = entry[~later]
                entry = entry[_tied(entry["anchor"])]
                entry = entry[partners(*(entry[x] for x in ("anchor", "left", "right", "doc")))]
            if len(entry):
                head = np.flatnonzero(np.append(True, entry["anchor"][1:] != entry["anchor"][:-1]))
                counts = np.diff(np.append(head, len(entry)))
                entry["size"][np.repeat(counts > HOT_ENTRIES, counts)] *= -1  # marks a hot anchor
                held[1].append(_as(FOUND, entry))
            for kind in (0, 1):
                if sum(map(len, held[kind])) >= HELD:
                    yield from rows(kind, held[kind])
                    held[kind].clear()
        for kind in (0, 1):
            yield from rows(kind, held[kind])

    return dealt.mapInArrow(run, "kind int, slot long, payload binary")


def _payloads(kind: list[int], dealt: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    """(kind, slot, payload), or (slot, payload) without a kind."""
    slot, payload = list(zip(*dealt, strict=True)) or ([], [])
    columns = [pa.array(np.full(len(slot), x, np.int32)) for x in kind] + [pa.array(slot, pa.int64()), pa.array(payload, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["kind", "slot", "payload"][-len(columns) :])


def by_doc(packed: DataFrame, kind: np.dtype, tasks: int) -> DataFrame:
    """(doc, found): one row for each document of packed entries of one ``kind`` (slot, payload). Spans are
    sorted and those that touch are joined."""

    def one_slot(entry: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((entry["start"], entry["doc"])) if kind == SPAN else np.argsort(entry["doc"], kind="stable")
        entry = entry[order]
        if kind == SPAN:
            doc = np.cumsum(np.append(False, entry["doc"][1:] != entry["doc"][:-1])) << 32
            start = doc + entry["start"]
            reach = np.maximum.accumulate(start + entry["size"])
            head = np.flatnonzero(np.append(True, (start[1:] > reach[:-1]) | (doc[1:] != doc[:-1])))
            size = reach[np.append(head[1:], len(entry)) - 1] - start[head]
            entry = entry[head]
            some = np.empty(len(entry), PLACE)
            some["start"], some["size"] = entry["start"], size
        else:
            some = _as(ROUTED, entry)
        head = np.flatnonzero(np.append(True, entry["doc"][1:] != entry["doc"][:-1]))
        ends = np.append(head, len(entry)).astype(np.int32) * some.itemsize
        found = pa.BinaryArray.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(some.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(entry["doc"][head])), found], ["doc", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_slot: dict[int, list[bytes]] = {}
        for b in batches:
            for slot, raw in zip(b.column("slot").to_pylist(), b.column("payload").to_pylist(), strict=True):
                by_slot.setdefault(slot, []).append(raw)
        while by_slot:
            b = one_slot(_from_planes(by_slot.popitem()[1], kind))
            yield from (b.slice(i, 4096) for i in range(0, len(b), 4096))

    return packed.select("slot", "payload").repartition(tasks, "slot").mapInArrow(run, "doc long, found binary")


def _by_window(entry: np.ndarray, base: np.ndarray, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hot entries (negative size) as one entry per window, with the window's hash as anchor."""
    hot = entry["size"] < 0
    if not hot.any():
        return entry, base
    some, at = entry[hot], base[hot]
    counts = -some["size"].astype(np.int64) - length + 1
    start = ranges(some["start"].astype(np.int64), counts)
    some, at = np.repeat(some, counts), np.repeat(at, counts)
    some["start"], some["size"] = start, length
    some["anchor"] = mix(Sums(codes).of(start + at, start + at + length))
    return np.concatenate([entry[~hot], some]), np.concatenate([base[~hot], at])


def _found(batch: pa.RecordBatch, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """What the join found for the documents of a batch, and how many of it each document has."""
    raws = [x or b"" for x in batch.column("found").to_pylist()]
    return np.frombuffer(b"".join(raws), kind), np.fromiter(map(len, raws), np.int64, len(raws)) // kind.itemsize


def _as_found(some: np.ndarray, doc: np.ndarray) -> np.ndarray:
    out = np.empty(len(some), FOUND)
    out["doc"] = doc
    for name in ROUTED.names:
        out[name] = some[name]
    return out


def fetch(docs: DataFrame, entries: DataFrame, codes: Codes, cut: Callable, length: int, shards: int) -> DataFrame:
    """(shard, entries, sizes, texts): the stretches of ``entries`` (doc, found), with their bytes.

    ``cut(data, offsets)`` gives the starts and ends of all units and each text's first unit.
    """
    types = (pa.int64(), pa.binary(), pa.binary(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, counts = _found(b, ROUTED)
            every = _as_found(found, np.repeat(np.asarray(b.column("doc_id").fill_null(0)), counts))
            at = np.append(0, np.cumsum(counts))
            for i, j, data, offsets in slices(b, "text"):
                entry = every[at[i] : at[j]]
                if not len(entry):
                    continue
                starts, ends, first = cut(data, offsets)
                raw = data.tobytes()
                base = np.repeat(first[:-1], counts[i:j])
                fits = entry["start"] + np.abs(entry["size"]) + base <= np.repeat(first[1:], counts[i:j])
                entry, base = _by_window(entry[fits], base[fits], codes(data, offsets)[0], length)
                if not len(entry):
                    continue
                lo, hi = starts[entry["start"] + base], ends[entry["start"] + base + entry["size"] - 1]
                shard = (entry["anchor"] // _U(7919) % _U(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                rows = []
                for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    texts = [raw[x:y] for x, y in zip(lo[part].tolist(), hi[part].tolist(), strict=True)]
                    sizes = np.fromiter(map(len, texts), "<i4", len(texts))
                    rows.append((int(shard[part[0]]), _planes(entry[part]).tobytes(), sizes.tobytes(), b"".join(texts)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["shard", "entries", "sizes", "texts"]
                )

    # A left join, as the one that removes: both read the same exchange of the texts.
    both = docs.join(entries, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "found")
    return both.mapInArrow(run, "shard long, entries binary, sizes binary, texts binary")


def match_shards(dealt: DataFrame, matcher: Callable[[list[bytes], np.ndarray], list[np.ndarray]], per_run: int, slots: int) -> DataFrame:
    """(slot, payload): spans found in the shards of a partition, packed by document.

    A shard's stretches go to the matcher in runs of whole anchors with about ``per_run`` bytes:
    ``matcher(texts, docs)`` gives for each text the spans, in units, of the windows that also start in a text with a smaller doc.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_shard: dict[int, list[tuple]] = {}
        for b in batches:
            for shard, *row in zip(*(b.column(c).to_pylist() for c in ("shard", "entries", "sizes", "texts")), strict=True):
                by_shard.setdefault(shard, []).append(row)
        held: list[np.ndarray] = []
        while by_shard:
            held += one_shard(by_shard.popitem()[1])
            if by_shard and sum(map(len, held)) < HELD:
                continue
            yield _payloads([], _by_slot(np.concatenate(held), slots))
            held = []

    def one_shard(rows: list[tuple]) -> Iterator[np.ndarray]:
        entry = _from_planes([e for e, _, _ in rows], FOUND)
        sizes = np.concatenate([np.frombuffer(s, "<i4") for _, s, _ in rows]).astype(np.int64)
        raw = b"".join(t for _, _, t in rows)
        at = np.cumsum(sizes) - sizes
        order = np.argsort(entry["anchor"], kind="stable")
        entry, at, sizes = entry[order], at[order], sizes[order]
        head = np.flatnonzero(np.append(True, entry["anchor"][1:] != entry["anchor"][:-1]))
        run_of = np.cumsum(np.add.reduceat(sizes, head)) // per_run
        first = np.append(head[np.flatnonzero(np.append(True, np.diff(run_of) != 0))], len(entry))
        for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            texts = [raw[x : x + n] for x, n in zip(at[i:j].tolist(), sizes[i:j].tolist(), strict=True)]
            found = matcher(texts, entry["doc"][i:j])
            counts = np.fromiter(map(len, found), np.int64, len(found))
            w = np.concatenate(found)
            span = np.empty(len(w), SPAN)
            span["doc"], span["start"] = np.repeat(entry["doc"][i:j], counts), np.repeat(entry["start"][i:j], counts) + w[:, 0]
            span["size"] = w[:, 1] - w[:, 0]
            yield span

    return dealt.mapInArrow(run, "slot long, payload binary")


def with_repeated_spans(
    docs: DataFrame, codes: Codes, cut: Callable, matcher: Callable, length: int, k: int, unit_bytes: float, per_run: int = 1 << 20
) -> DataFrame:
    """(doc_id, text, found) for every row of ``docs``, text as bytes: the spans covered by
    windows of ``length`` units that also start in a document with a smaller doc_id."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("text"))
    size = total_bytes(docs)
    entries = size / unit_bytes * 2 / (length - k + 2)
    tasks = max(8, int(entries / 1_000_000) + 1)
    # Several buckets, slots and shards per task even out what a task gets; it works on one at a time.
    slots = 2 * tasks
    dealt = anchors(d.where("doc_id is not null"), codes, length, k, 1 << (4 * tasks - 1).bit_length(), slots)
    found = materialize(repeated(dealt.repartition(tasks, "bucket"), slots), "spans-anchors")
    shards = max(8, size // (24 << 20))
    shard_rows = fetch(d, by_doc(found.where("kind = 1"), FOUND, tasks), codes, cut, length, 4 * shards)
    matched = match_shards(shard_rows.repartition(shards, "shard"), matcher, per_run, slots)
    spans = by_doc(found.where("kind = 0").select("slot", "payload").unionByName(matched), SPAN, tasks)
    return d.join(spans, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "found")


def removals(batch: pa.RecordBatch, sizes: list[int]) -> list[np.ndarray | None]:
    """For each document of a batch, which of its units the spans cover; None without spans."""
    span, counts = _found(batch, PLACE)
    at = np.append(0, np.cumsum(counts))
    start, size = span["start"].astype(np.int64), span["size"].astype(np.int64)
    out = []
    for i, j, n in zip(at[:-1].tolist(), at[1:].tolist(), sizes, strict=True):
        end = np.minimum(start[i:j] + size[i:j], n)
        out.append(covered(np.minimum(start[i:j], end), end, n) if j > i else None)
    return out
