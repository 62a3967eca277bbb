"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

An element's j-th value is j plus a uniform number and goes to the j-th slot of a random
permutation of the slots; a slot keeps its least value. Ranks of one element are thus
correlated (each slot gets each rank once), which lowers the variance against independent
hashes, and once all slots of a set hold a value below j + 1, no later rank can matter:
its rounds stop there. Round j is done for all elements of a slice at once.

Documents with equal sets are one node (their smallest doc_id). Nodes that agree in a band of the signature
are candidates. Within a band bucket every node is first paired with the bucket's least node;
the pairs are confirmed on the full sets and joined into components. Buckets that then still
hold several components are compared further: every node outside the bucket's largest
component against every node of the bucket in another component, in blocks of bounded size
(each block pair a task of its own), by signature; those that could reach the threshold are confirmed
on the full sets inside the block. No bucket is gathered whole or cut off, and neither copies nor
near copies are expanded into rows of pairs.

With the default 24 bands of 5 slots, a pair at similarity 0.85 shares no band with a chance
below 1e-6, at 0.8 below 1e-4. ``slack`` is five standard deviations of a signature's estimate.

Null or empty texts have an empty set and are linked with nothing. A null doc_id is linked with
nothing and kept. Rows that share a doc_id are one node if their texts are equal, else each
goes by its own text. No rows: an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import NOT_SPACE, Sums, discard, materialize, mix, signed, slices, text_bytes, word_bounds, word_hashes
from punctuality.llm.graph import components

SLOTS, BANDS = 120, 24
_U = np.uint64
_RANK = _U(25)  # bits of a value below its rank


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and their numbers."""
    starts, ends, first = word_bounds(data, offsets, NOT_SPACE)
    words = word_hashes(data, starts, ends, True)
    sums = Sums(words)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b <= a:
            sets.append(np.zeros(0, _U))
        else:
            at = np.arange(a, max(a + 1, b - width + 1))
            sets.append(np.unique(sums.of(at, np.minimum(at + width, b))))
    counts = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate([*sets, np.zeros(0, _U)]), counts


def signatures(elements: np.ndarray, counts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set: a row of ``slots`` values (rank in the high bits)."""
    n = len(counts)
    out = np.full(n * slots, 0xFFFFFFFF, np.uint32)
    owner = np.repeat(np.arange(n), counts)
    order = None  # permutations of the elements still in play
    for rank in range(slots):
        if not len(elements):
            break
        salt = _U((2 * rank + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        drawn = mix(elements + salt)
        place = rank + (mix(elements ^ (salt << _U(1))) % _U(slots - rank)).astype(np.int64)
        value = (_U(rank) << _RANK) | (drawn >> (_U(64) - _RANK))
        if order is None:
            slot = place
        else:
            rows = np.arange(len(elements))
            slot = order[rows, place].astype(np.int64)
            order[rows, place] = order[:, rank]
        np.minimum.at(out, owner * slots + slot, value.astype(np.uint32))
        done = out.reshape(n, slots).max(1) < np.uint32(min((rank + 1) << 25, 0xFFFFFFFF))
        left = ~done[owner]
        if order is None:
            elements, owner, place = elements[left], owner[left], place[left]
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
            order[np.arange(len(elements)), place] = 0
        elif not left.all():
            elements, owner, order = elements[left], owner[left], order[left]
    return out.reshape(n, slots)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    n, slots = signature.shape
    parts = signature.reshape(n, bands, slots // bands).astype(_U)
    key = np.zeros((n, bands), _U)
    for i in range(slots // bands):
        key = mix(key + parts[:, :, i] + _U(i + 1))
    return key


def _set_keys(elements: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit keys of each set: sums of scrambled elements."""
    ends = np.cumsum(counts)
    keys = []
    for salt in (0x2545F4914F6CDD1D, 0x27D4EB2F165667C5):
        sums = np.append(_U(0), np.cumsum(mix(elements ^ _U(salt)), dtype=_U))
        keys.append(signed(sums[ends] - sums[ends - counts]))
    return keys


def signed_documents(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, key_a, key_b (of the set), signature and bands (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in slices(b, "text"):
                elements, counts = shingle_sets(data, offsets, width)
                key_a, key_b = _set_keys(elements, counts)
                signature = signatures(elements, counts)
                bands = signed(band_keys(signature))
                empty = counts == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(i, j - i),
                        pa.array(counts),
                        pa.array(key_a),
                        pa.array(key_b),
                        pa.array([None if e else s.tobytes() for e, s in zip(empty, signature, strict=True)], pa.binary()),
                        pa.array([None if e else k for e, k in zip(empty, bands, strict=True)], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "key_a", "key_b", "signature", "bands"],
                )

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("text"))
    return d.mapInArrow(run, "doc_id long, n long, key_a long, key_b long, signature binary, bands array<long>")


def node_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, elements): the full sets of ``nodes`` (node, key_a, key_b), as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in slices(b, "text"):
                elements, counts = shingle_sets(data, offsets, width)
                a, k = _set_keys(elements, counts)
                own = (a == b.column("key_a").slice(i, j - i).to_numpy()) & (k == b.column("key_b").slice(i, j - i).to_numpy())
                parts = np.split(elements, np.cumsum(counts)[:-1])
                rows = pa.RecordBatch.from_arrays(
                    [b.column("node").slice(i, j - i), pa.array([x.tobytes() for x in parts], pa.binary())], ["node", "elements"]
                )
                yield rows.filter(pa.array(own))

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), text_bytes(F.col("text")).alias("text")).where("node is not null")
    found = texts.join(nodes, "node").mapInArrow(run, "node long, elements binary")
    return found


def _similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    if len(p) < len(q):
        p, q = q, p
    if 100 * len(q) < percent * len(p):
        return False
    spot = np.searchsorted(p, q)
    spot[spot == len(p)] = 0
    both = int((p[spot] == q).sum())
    return 100 * both >= percent * (len(p) + len(q) - both)


def _elements(value: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), _U)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_similar(_elements(p), _elements(q), percent) for p, q in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _candidates(t: pa.Table, low: float, best: int | None) -> Iterator[tuple[int, np.ndarray]]:
    """Each outside node's place and those of the block's members that are of another component and
    agree with it in at least ``low`` of the slots; only in the first band that the two share. With
    ``best``, only that many of an outside node, the most similar ones."""
    outside = np.asarray(t.column("outside"))
    part = np.asarray(t.column("component"))
    band = t.column("band")[0].as_py()
    signature = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint32).reshape(len(part), -1)
    shared = band_keys(signature)
    members = np.flatnonzero(~outside)
    for i in np.flatnonzero(outside):
        j = members[part[members] != part[i]]
        agree = (signature[j] == signature[i]).sum(1)
        same = agree >= low * signature.shape[1]
        if best is None:
            same &= (shared[j, :band] == shared[i, :band]).sum(1) == 0
        j = j[same]
        if best is not None:
            j = j[np.argsort(-agree[same], kind="stable")[:best]]
        yield i, j


def _block_pairs(low: float, best: int):
    """(a, b): the most similar pairs of a block."""

    def run(t: pa.Table) -> pa.Table:
        node = np.asarray(t.column("node"))
        pairs = [(np.minimum(node[j], node[i]), np.maximum(node[j], node[i])) for i, j in _candidates(t, low, best)]
        a, b = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (zip(*pairs, strict=True) if pairs else ((), ())))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _block_partners(low: float):
    """The nodes of a block that are in any candidate pair: an outside node with its partners, a
    member with none."""

    def run(t: pa.Table) -> pa.Table:
        node = np.asarray(t.column("node"))
        found = [(i, j) for i, j in _candidates(t, low, None) if len(j)]
        met = np.unique(np.concatenate([np.zeros(0, np.int64), *(node[j] for _, j in found)]))
        rows = [(int(node[i]), node[j]) for i, j in found] + [(n, None) for n in met.tolist()]
        keys = [pa.array([t.column(c)[0].as_py()] * len(rows), pa.int64()) for c in ("band", "key", "u", "m")]
        own = [pa.array([n for n, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.list_(pa.int64()))]
        return pa.table([*keys, *own], ["band", "key", "u", "m", "node", "partners"])

    return run


def _block_links(percent: int):
    """(a, b): the pairs of a block that the full sets confirm."""

    def run(t: pa.Table) -> pa.Table:
        partners, elements = t.column("partners"), t.column("elements")
        node = t.column("node").to_pylist()
        sets: dict[int, list] = {}
        for i, n in enumerate(node):  # more than one set where rows share a doc_id
            sets.setdefault(n, []).append(_elements(elements[i]))
        links = set()
        for i, n in enumerate(node):
            own = _elements(elements[i])
            for other in partners[i].as_py() or ():
                if any(_similar(own, x, percent) for x in sets[other]):
                    links.add((min(n, other), max(n, other)))
        a, b = zip(*sorted(links), strict=True) if links else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _open_blocks(members: DataFrame, groups: DataFrame, signatures_of: DataFrame, block: int) -> DataFrame:
    """What is left of the buckets: a bucket's nodes outside its largest component meet all its nodes
    in blocks (band, key, u, m) of about ``block`` by ``block`` nodes."""
    labelled = members.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = labelled.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("band", "key").agg(
        F.max(F.struct("size", "component")).alias("m"), F.sum("size").alias("all"), F.count(F.lit(1)).alias("parts")
    )
    main = main.where("parts > 1 and all > 2").select(
        "band",
        "key",
        F.col("m.component").alias("main"),
        F.ceil((F.col("all") - F.col("m.size")) / block).alias("u_blocks"),
        F.ceil(F.col("all") / block).alias("m_blocks"),
    )
    open_members = labelled.join(main, ["band", "key"])
    deal = F.xxhash64("node")
    outside = open_members.where("component <> main").select(
        F.col("band").cast("long").alias("band"), "key", "node", "component", F.lit(True).alias("outside"),
        F.pmod(deal, "u_blocks").alias("u"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("m_blocks") - 1)).alias("m"),
    )
    inside = open_members.select(
        F.col("band").cast("long").alias("band"), "key", "node", "component", F.lit(False).alias("outside"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("u_blocks") - 1)).alias("u"), F.pmod(deal, "m_blocks").alias("m"),
    )
    return outside.unionByName(inside).join(signatures_of, "node")


_BLOCK = ("band", "key", "u", "m")


def _open_links(blocks: DataFrame, sets: DataFrame, percent: int, low: float) -> DataFrame:
    """(a, b): all links left inside the blocks. The full sets go to the blocks, once per node with a
    candidate there, and the pairs are confirmed where they are found: no pair becomes a row."""
    found = blocks.groupBy(*_BLOCK).applyInArrow(_block_partners(low), "band long, key long, u long, m long, node long, partners array<long>")
    with_sets = materialize(found, "minhash-partners").join(sets, "node")
    return with_sets.groupBy(*_BLOCK).applyInArrow(_block_links(percent), "a long, b long").distinct()


def near_duplicate_groups(docs: DataFrame, width: int = 5, percent: int = 80, block: int = 2048, last_block: int = 512, slack: float = 0.18) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    ``block``: nodes of a side of a block that compares signatures (1 MB of them); ``last_block``: of one whose
    candidates bring their full sets."""
    signed_docs = materialize(signed_documents(docs, width), "minhash-signed")
    classes = signed_docs.where("n > 0 and doc_id is not null").groupBy("key_a", "key_b", "n").agg(F.min("doc_id").alias("node"))
    with_class = signed_docs.join(classes, ["key_a", "key_b", "n"], "left")
    first = F.col("doc_id") == F.col("node")
    with_class = materialize(
        with_class.select(
            "doc_id", "n", "key_a", "key_b", "node", F.when(first, F.col("signature")).alias("signature"), F.when(first, F.col("bands")).alias("bands")
        ),
        "minhash-classes",
    )
    discard(signed_docs)
    nodes = with_class.where("signature is not null").dropDuplicates(["node", "key_a", "key_b"])
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.min("node").alias("center"), F.max("node").alias("last")).where("center < last")
    members = materialize(banded.join(buckets.drop("last"), ["band", "key"]), "minhash-members")
    candidates = members.select("node").distinct()
    sets = materialize(
        node_sets(docs, nodes.select("node", "key_a", "key_b").join(candidates, "node"), width), "minhash-sets"
    )
    stars = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    links = materialize(confirmed(stars, sets, percent), "minhash-links")
    groups = components(links)

    # Nodes outside each bucket's largest component: first the most similar pairs, which join most
    # of them, then all that is left.
    tested = stars
    low = percent / 100 - slack
    signatures_of = nodes.select("node", "signature")

    def joined(links: DataFrame) -> DataFrame:
        if not links.limit(1).count():
            return groups
        return components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))

    for _ in range(2):
        more = _open_blocks(members, groups, signatures_of, block).groupBy(*_BLOCK).applyInArrow(_block_pairs(low, 3), "a long, b long")
        more = materialize(more.distinct().join(tested, ["a", "b"], "left_anti"), "minhash-pairs")
        tested = tested.unionByName(more)
        groups = joined(materialize(confirmed(more, sets, percent), "minhash-links"))
    rest = _open_links(_open_blocks(members, groups, signatures_of, last_block), sets, percent, low)
    groups = joined(materialize(rest, "minhash-links"))
    # The result reads the classes and the components only.
    for done in (members, sets):
        discard(done)

    out = with_class.join(groups, "node", "left")
    component = F.coalesce("component", with_class["node"], "doc_id")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
