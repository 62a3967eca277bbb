"""Approximate nearest neighbours: a graph by NN-descent, queries by greedy graph search.

Equal vectors are one node (its smallest vec_id, or a 64-bit hash where that id has other vectors too); their members
meet again in the answer.
NN-descent starts from the nearest neighbours in the leaves of several trees of random hyperplanes, so that
groups of near copies meet however many groups there are, and repeats a join: each node introduces its
neighbours (and those that hold it as a neighbour) to each other, and every node keeps the
``degree`` nearest that it has met. A pair is looked at only while one side is new. It ends when few lists change.

Search: each query keeps its ``beam`` nearest nodes so far, starting from its own node and from drawn entry
points, whose number grows with the root of the number of nodes up to ``most_entries``. A group that no edge leaves or enters is thus
searched by its own queries. Every round expands the nearest ``width`` (or half a beam) not yet expanded ones; a query ends when its whole
beam is expanded. Edges and vectors lie packed in slots of nodes. The nodes to expand are sent to the slots of
their edges, the neighbours found to the slots of their vectors, and only those near enough for the beam back to the
query, as numbers; the vector that travels is the query's, once for each slot. All queries go on together; those that are done leave.
A query's state is its beam alone: a full beam only gets nearer, so a node that fell out of it and is met again
falls out again. Edges are followed both ways; of those that lead to a node the nearest ``back`` are kept.
The beam is as wide as the vectors need: ``trial`` queries, drawn by a hash, are searched first and compared with
the exact answer over all rows, and the beam is doubled until ``target`` of their true neighbours are found (or it
is ``most_beam`` wide, which is reported as a warning). Then all queries are searched with that beam.
Graph and beams compare the vectors as given, in double precision, and so is the answer ranked.

Vectors that are null or zero, hold a null or a non-finite component or differ in length from the most frequent one
take no part, nor does a null vec_id. Rows that share a vec_id and vector count once; a vec_id with several
vectors is one query and one neighbour, at the smallest distance of any of its vectors; with fewer than k candidates all found are
returned. No rows: an empty result.
"""

from __future__ import annotations

import math
import pickle
import warnings
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import materialize, mix, ranges

#: Nodes of a slot, about; rows that a task holds before it deals them; pairs of query and node that a task compares at once.
SLOT_NODES, HELD, PAIRS = 8192, 1 << 16, 1 << 19
#: Nodes of a leaf, about, in which all are compared with all.
LEAF = 1024

def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def _doubles(column) -> np.ndarray:
    """The vectors of an Arrow list column as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as they travel while the graph is built and searched: the bytes of 32-bit numbers after a 0,
    or of 64-bit ones after a 1 where 32 bits don't hold the vector exactly."""
    for b in batches:
        if len(b):
            x = _doubles(b.column("v"))
            with np.errstate(over="ignore"):
                short = x.astype("<f4")
            fits = (short == x).all(1)
            raw = [b"\0" + s.tobytes() if f else b"\1" + v.tobytes() for f, s, v in zip(fits, short, x.astype("<f8"), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(raw, pa.binary())], ["node", "code"])


def _decoded(column) -> np.ndarray:
    """The vectors of an Arrow column of codes, all of one length, exactly."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    sizes = np.diff(at := np.frombuffer(column.buffers()[1], np.int32, offset=4 * column.offset, count=len(column) + 1))
    if (sizes % 4 == 1).all() and (sizes == sizes[0]).all():
        rows = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(len(sizes), -1)
        if not rows[:, 0].any():
            return np.ascontiguousarray(rows[:, 1:]).view("<f4").astype(np.float64)
    raw = column.to_pylist()
    return np.array([np.frombuffer(r, "<f8" if r[0] else "<f4", offset=1) for r in raw], np.float64)


def _tree(x: np.ndarray, most: int, rng: np.random.Generator):
    """Random hyperplanes that halve the rows of ``x`` until ``most`` or fewer are left: (plane, cut and the two
    children of each tree node, the rows of each leaf). A leaf is its own child."""
    planes, cuts, kids, parts, todo = [], [], [], [], [np.arange(len(x))]
    for rows in todo:
        at = len(planes)
        planes.append(np.zeros(x.shape[1]))
        cuts.append(0.0)
        kids.append((at, at))
        if len(rows) <= most:
            parts.append(rows)
            continue
        i, j = rng.choice(len(rows), 2, replace=False)
        planes[at] = x[rows[i]] - x[rows[j]]
        along = x[rows] @ planes[at]
        order = np.argsort(along, kind="stable")
        half = len(rows) // 2
        cuts[at] = (along[order[half - 1]] + along[order[half]]) / 2
        kids[at] = (len(todo), len(todo) + 1)
        todo += [rows[order[:half]], rows[order[half:]]]
    return np.array(planes), np.array(cuts), np.array(kids), parts


def _leaves(trees):
    """Each node's leaf in every tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _decoded(b.column("code"))
            if not len(x):
                continue
            for draw, (planes, cuts, kids) in enumerate(trees.value):
                at = np.zeros(len(x), np.int64)
                while True:
                    side = np.einsum("ij,ij->i", x, planes[at]) > cuts[at]
                    below = kids[at, side.astype(int)]
                    if (below == at).all():
                        break
                    at = below
                yield pa.RecordBatch.from_arrays(
                    [b.column("node"), b.column("code"), pa.array(np.full(len(x), draw, np.int64)), pa.array(at)], ["node", "code", "draw", "leaf"]
                )

    return run


def _first_neighbours(degree: int, most: int = LEAF):
    """Within each leaf, halved further while it has more than ``most`` nodes, every node's nearest ``degree`` others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            members = b.column("members")
            at = members.offsets.to_numpy()
            flat = members.flatten()
            node, x = flat.field("node").to_numpy(), _decoded(flat.field("code"))
            at = at - at[0]
            out = []
            for i, j in zip(at[:-1], at[1:], strict=True):
                for part in _tree(x[i:j], most, np.random.default_rng(j - i))[3]:
                    y, own = x[i:j][part], node[i:j][part]
                    d = _squared(y[None])[0]
                    np.fill_diagonal(d, np.inf)
                    k = min(degree, len(y) - 1)
                    if not k:
                        continue
                    near = np.argpartition(d, k - 1, axis=1)[:, :k]
                    rows = np.repeat(np.arange(len(y)), k)
                    out.append((own[rows], own[near.ravel()], d[rows, near.ravel()]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["a", "b", "d"])

    return run


def _squared(v: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of each of several groups. They are taken from the group's first row, so
    that those of near copies don't drown in the rounding of their length."""
    v = v - v[:, :1]
    sq = (v * v).sum(2)
    return np.maximum(sq[:, :, None] - 2 * (v @ v.transpose(0, 2, 1)) + sq[:, None, :], 0)


def _introduce(best: int):
    """The neighbours of each node, introduced to each other. A node takes from one introducer the
    ``best`` nearest of those that are nearer than its farthest neighbour, one of the two being new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 512):
                members = batch.column("members").slice(start, 512)
                at = members.offsets.to_numpy()
                flat = members.flatten()
                node, fresh, far = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("b", "fresh", "far"))
                x = _decoded(flat.field("code"))
                size = np.diff(at)
                if not len(node) or size.max() < 2:
                    continue
                # Groups side by side, filled up to the largest.
                group = np.repeat(np.arange(len(size)), size)
                place = np.arange(len(node)) - np.repeat(at[:-1] - at[0], size)
                most = int(size.max())
                v = np.zeros((len(size), most, x.shape[1]))
                v[group, place] = x
                ids = np.full((len(size), most), -1, np.int64)
                ids[group, place] = node
                new, limit, real = (np.zeros((len(size), most), t) for t in (bool, np.float64, bool))
                new[group, place], limit[group, place], real[group, place] = fresh, far, True
                d = _squared(v)
                ok = real[:, None, :] & (new[:, :, None] | new[:, None, :]) & (d < limit[:, :, None])
                d[~ok] = np.inf
                d[:, np.arange(most), np.arange(most)] = np.inf
                k = min(best, most - 1)
                near = np.argpartition(d, k - 1, axis=2)[:, :, :k]
                dist = np.take_along_axis(d, near, 2)
                g, i, j = np.nonzero(np.isfinite(dist))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[g, i]), pa.array(ids[g, near[g, i, j]]), pa.array(dist[g, i, j])], ["a", "b", "d"]
                )

    return run


def neighbour_graph(
    nodes: DataFrame, degree: int = 20, sample: int = 8, best: int = 4, rounds: int = 12, settled: float = 0.04, draws: int = 5, seed: int = 8
) -> DataFrame:
    """(a, b, d): each node's nearest neighbours met, with squared distance. ``nodes``: node, code.

    Per round a node introduces up to ``sample`` neighbours of each kind (new or old, held or holding),
    so what is gathered for a node is bounded however many hold it; the others wait for a later round.
    """
    count = nodes.count()
    nearest = Window.partitionBy("a").orderBy("d", "b")
    # Several trees, so that groups overlap and introductions lead out of them. They are grown on a sample of
    # bounded size; leaves of many nodes are dealt out by a hash and halved further in the tasks.
    drawn = nodes.orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(1 << 15).toArrow()
    x, rng = _decoded(drawn.column("code")), np.random.default_rng(seed)
    most = max(2, min(LEAF, LEAF * len(x) // max(1, count)))
    trees = nodes.sparkSession.sparkContext.broadcast([_tree(x, most, rng)[:3] for _ in range(draws)])
    dealt = nodes.mapInArrow(_leaves(trees), "node long, code binary, draw long, leaf long")
    sizes = dealt.groupBy("draw", "leaf").agg(F.ceil(F.count(F.lit(1)) / (2 * LEAF)).alias("parts"))
    dealt = dealt.join(sizes, ["draw", "leaf"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts")).groupBy("draw", "leaf", "part")
    dealt = dealt.agg(F.collect_list(F.struct("node", "code")).alias("members")).select("members")
    found = dealt.mapInArrow(_first_neighbours(-(-3 * degree // draws)), "a long, b long, d double")
    found = found.repartition("a").groupBy("a", "b").agg(F.min("d").alias("d"))
    found = found.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= degree).drop("n")
    edges = materialize(found.withColumn("fresh", F.lit(True)), "ann-edges")
    # The rounds join tables of as many rows each and are many: merged at every size, none passes the driver.
    for r in range(rounds):
        both = edges.select("a", "b", "fresh", F.lit(0).alias("way")).unionByName(
            edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "fresh", F.lit(1).alias("way"))
        )
        both = both.repartition("a")
        drawn = Window.partitionBy("a", "way", "fresh").orderBy(F.xxhash64(F.lit(seed + r), "a", "b"))
        some = both.withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= sample)
        some = some.groupBy("a", "b").agg(F.max("fresh").alias("fresh"))
        # Only where one is new there are pairs to look at.
        some = some.withColumn("any", F.max("fresh").over(Window.partitionBy("a"))).where("any").drop("any")
        far = edges.groupBy("a").agg(F.max("d").alias("far"), F.count(F.lit(1)).alias("held"))
        known = nodes.join(far.hint("merge"), F.col("node") == F.col("a"), "left").select(
            F.col("node").alias("b"), "code", F.when(F.col("held") >= degree, F.col("far")).otherwise(float("inf")).alias("far")
        )
        met = some.join(known.hint("merge"), "b").groupBy("a").agg(F.collect_list(F.struct("b", "fresh", "far", "code")).alias("members"))
        met = met.select("members").mapInArrow(_introduce(best), "a long, b long, d double")
        # An edge that was introduced is not new any more.
        none = lambda kind: F.lit(None).cast(kind)
        rows = edges.select("a", "b", "d", "fresh", F.lit(True).alias("held"), none("boolean").alias("used"))
        rows = rows.unionByName(met.select("a", "b", "d", F.lit(True).alias("fresh"), none("boolean").alias("held"), none("boolean").alias("used")))
        rows = rows.unionByName(some.where("fresh").select("a", "b", none("double").alias("d"), none("boolean").alias("fresh"), none("boolean").alias("held"), F.lit(True).alias("used")))
        every = rows.repartition("a").groupBy("a", "b").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"), F.max("held").alias("held"), F.max("used").alias("used"))
        every = every.where("d is not null").select("a", "b", "d", F.expr("fresh and not (coalesce(held, false) and coalesce(used, false))").alias("fresh"))
        kept = every.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= degree).drop("n")
        edges = materialize(kept, "ann-edges")
        if edges.where("fresh").count() <= settled * degree * count:
            break
    return edges.select("a", "b", "d")


def _slot(ids: np.ndarray, slots: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(slots)).astype(np.int64)


def _split(key: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(key, the columns' values of that key), for every key there."""
    order = np.argsort(key, kind="stable")
    cut = np.flatnonzero(np.diff(key[order])) + 1
    for some in np.split(order, cut) if len(key) else []:
        yield int(key[some[0]]), *(c[some] for c in columns)


def _sent(rows: Iterator[tuple[int, tuple]]) -> Iterator[pa.RecordBatch]:
    """(slot, payload): what goes to each slot."""
    rows = [(slot, pickle.dumps(what, 5)) for slot, what in rows]
    if rows:
        slot, payload = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(payload, pa.binary())], ["slot", "payload"])


def _received(one_slot):
    """Runs ``one_slot`` on what each slot of a partition has been sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_slot: dict[int, list[bytes]] = {}
        for b in batches:
            for slot, raw in zip(b.column("slot").to_pylist(), b.column("payload").to_pylist(), strict=True):
                by_slot.setdefault(slot, []).append(raw)
        while by_slot:
            slot, raws = by_slot.popitem()
            yield from one_slot(slot, [pickle.loads(x) for x in raws])

    return run


_PACKED = "slot long, payload binary"


def _short(x: np.ndarray) -> np.ndarray:
    """The vectors as 32-bit numbers if these hold all of them exactly."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return short if (short == x).all() else x


def _packed(table: DataFrame, slots: int, columns, name: str) -> DataFrame:
    """(slot, payload): the rows of each slot's nodes in one payload, sorted by node. ``columns(batch)`` gives arrays,
    the node's first."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(columns(b))
            n += len(b)
            if n >= HELD:
                yield from dealt(held)
                held, n = [], 0
        if n:
            yield from dealt(held)

    def dealt(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        held = [np.concatenate(c) for c in zip(*(x for x in held if len(x[0])), strict=True)]
        return _sent((slot, c) for slot, *c in _split(_slot(held[0], slots), *held))

    def merge(slot: int, parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        every = [np.concatenate(c) for c in zip(*parts, strict=True)]
        order = np.argsort(every[0], kind="stable")
        return _sent([(slot, ("table", *(c[order] for c in every)))])

    return materialize(table.mapInArrow(deal, _PACKED).repartition(slots, "slot").mapInArrow(_received(merge), _PACKED), name)


def placed(nodes: DataFrame, graph: DataFrame) -> tuple[int, DataFrame, DataFrame]:
    """(number of slots, vectors, edges): the nodes and their edges (a, b) in slots of about ``SLOT_NODES`` nodes."""
    slots = max(8, nodes.count() // SLOT_NODES)
    ids = lambda b, *names: [b.column(c).to_numpy().astype(np.int64) for c in names]
    vectors = _packed(nodes.select("node", "code"), slots, lambda b: (*ids(b, "node"), _short(_decoded(b.column("code")))), "ann-slots")
    return slots, vectors, _packed(graph.select("a", "b"), slots, lambda b: ids(b, "a", "b"), "ann-slots")


def _asked(q: np.ndarray, far: np.ndarray, y: np.ndarray, node: np.ndarray, at: np.ndarray, slots: int) -> Iterator[tuple[int, tuple]]:
    """To the slots of the nodes: which query (its place ``at`` in ``q``) asks for which ``node``, with the queries'
    vectors ``y`` and how near a node must be, ``far``."""
    for slot, some, by in _split(_slot(node, slots), node, at):
        there = np.zeros(len(q), bool)
        there[by] = True
        yield slot, ("ask", q[there], far[there], _short(y[there]), some, (np.cumsum(there) - 1)[by].astype(np.int32))


def _asks(parts: list[tuple], most: int) -> Iterator[tuple]:
    """What was asked of a slot, about ``most`` nodes at a time; a query may be there several times."""
    held, n = [], 0
    parts = [x for x in parts if x[0] == "ask"]
    for i, x in enumerate(parts):
        held.append(x[1:])
        n += len(x[4])
        if n >= most or i + 1 == len(parts):
            q, far, y, node, at = zip(*held, strict=True)
            base = np.cumsum([0, *map(len, q)])[:-1]
            yield *map(np.concatenate, (q, far, y, node)), np.concatenate([a + i for a, i in zip(at, base, strict=True)])
            held, n = [], 0


def _table(parts: list[tuple]) -> tuple:
    return next((x[1:] for x in parts if x[0] == "table"), (np.zeros(0, np.int64), np.zeros((0, 1))))


def _follow(slots: int):
    """The nodes to expand, in their slots: their neighbours are asked for instead of them."""

    def one_slot(slot: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        a, b = _table(parts)
        for q, far, y, node, at in _asks(parts, PAIRS // 32):
            low = np.searchsorted(a, node)
            counts = np.searchsorted(a, node, "right") - low
            yield from _sent(_asked(q, far, y, b[ranges(low, counts)].astype(np.int64), np.repeat(at, counts), slots))

    return one_slot


def _compare(query_slots: int):
    """The nodes asked for, in their slots: the queries get those that are near enough, with squared distance."""

    def one_slot(slot: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, x = _table(parts)
        for q, far, y, node, at in _asks(parts, PAIRS):
            q, first, same = np.unique(q, return_index=True, return_inverse=True)
            far, y = far[first], y[first].astype(np.float64)
            place = np.searchsorted(ids, node)
            there = np.append(ids, -1)[place] == node
            at, place = np.divmod(np.unique(same[at[there]] * len(ids) + place[there]), max(1, len(ids)))
            d = np.zeros(len(at))
            for i in range(0, len(at), 1 << 13):
                some = slice(i, i + (1 << 13))
                off = x[place[some]] - y[at[some]]
                d[some] = np.einsum("ij,ij->i", off, off)
            near = d <= far[at]
            at, place, d = at[near], place[near], d[near]
            yield from _sent((s, tuple(c)) for s, *c in _split(_slot(q[at], query_slots), q[at], ids[place], d))

    return one_slot


def _update_beams(beam: int, width: int):
    """One round of the queries of a partition: put the new nodes into their beams and pick what to expand next. Of the rows
    of a slot some have a query with its ``state`` and vector (``qc``), the others a payload of answers."""

    def one_query(state: bytes, met: np.ndarray, far: np.ndarray) -> tuple[bytes, bool]:
        node, dist, done, _ = pickle.loads(state)
        met, at = np.unique(met, return_index=True)
        first = ~np.isin(met, node)
        node, dist = np.concatenate([node, met[first]]), np.concatenate([dist, far[at][first]])
        done = np.concatenate([done, np.zeros(int(first.sum()), bool)])
        order = np.lexsort((node, dist))[:beam]
        node, dist, done = node[order], dist[order], done[order]
        todo = np.flatnonzero(~done)[:width]
        done[todo] = True
        return pickle.dumps((node, dist, done, node[todo]), 5), len(todo) > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, met = [], []
        for b in batches:
            for slot, q, qc, state, payload in zip(*(b.column(c).to_pylist() for c in ("slot", "q", "qc", "state", "payload")), strict=True):
                if payload is None:
                    states.append((slot, q, qc, state))
                else:
                    met.append(pickle.loads(payload))
        q, node, d = map(np.concatenate, zip(*met, strict=True)) if met else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.argsort(q, kind="stable")
        q, node, d = q[order], node[order], d[order]
        for i in range(0, len(states), 64):
            rows = []
            for slot, own, qc, state in states[i : i + 64]:
                some = slice(*np.searchsorted(q, [own, own + 1]))
                rows.append((slot, own, qc, *one_query(state, node[some], d[some])))
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["slot", "q", "qc", "state", "going"])

    return run


_STATE = "slot long, q long, qc binary, state binary"


def _first_beams(entries, beam: int, query_slots: int):
    """Each query's beam before the first round: the nearest of the drawn entries. None is expanded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, code = entries.value
        x = _decoded(code)
        for b in batches:
            states = []
            for y in _decoded(b.column("qc")):
                d = ((x - y) ** 2).sum(1)
                order = np.lexsort((ids, d))[:beam]
                states.append(pickle.dumps((ids[order], d[order], np.zeros(len(order), bool), ids[:0]), 5))
            q = b.column("q").to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(_slot(q, query_slots)), pa.array(q), b.column("qc"), pa.array(states, pa.binary())], ["slot", "q", "qc", "state"])

    return run


def _ask(beam: int, slots: int):
    """The queries' nodes to expand, sent to their slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(i, 256) for x in batches for i in range(0, len(x), 256)):
            states = [pickle.loads(x) for x in b.column("state").to_pylist()]
            far = np.array([d[-1] if len(d) >= beam else np.inf for _, d, _, _ in states])
            todo = [x[3] for x in states]
            q, at = b.column("q").to_numpy().astype(np.int64), np.repeat(np.arange(len(todo)), [len(x) for x in todo])
            yield from _sent(_asked(q, far, _decoded(b.column("qc")), np.concatenate(todo), at, slots))

    return run


def _ask_own(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, own = (b.column(c).to_numpy().astype(np.int64) for c in ("q", "own"))
            yield from _sent(_asked(q, np.full(len(q), np.inf), _decoded(b.column("qc")), own, np.arange(len(q)), slots))

    return run


def _beam_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for q, state in zip(b.column("q").to_pylist(), b.column("state").to_pylist(), strict=True):
            node, d, _, _ = pickle.loads(state)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), q, np.int64)), pa.array(node), pa.array(d)], ["q", "node", "d"])


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if len(b):
            d = np.sqrt(((_doubles(b.column("qv")) - _doubles(b.column("v"))) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("node"), pa.array(d)], ["q", "node", "d"])


def both_ways(edges: DataFrame, back: int) -> DataFrame:
    """(a, b) of ``edges`` (a, b, d), and (b, a) for the ``back`` nearest of those that lead to a node. A node
    that very many others hold (a hub) thus has a bounded number of neighbours."""
    nearest = Window.partitionBy("a").orderBy("d", "b")
    held = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "d")
    held = held.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= back)
    return edges.select("a", "b").unionByName(held.select("a", "b")).distinct()


def entry_points(nodes: DataFrame, entries: int = 64, most_entries: int = 4096, seed: int = 8) -> Broadcast:
    """Ids and vectors of ``entries`` drawn nodes, or of as many as the root of the number of nodes if that is
    more. At most ``most_entries`` are drawn (or ``entries``, if that is more), which bounds what is broadcast."""
    many = max(entries, min(most_entries, math.isqrt(nodes.count())))
    drawn = nodes.orderBy(F.xxhash64(F.lit(seed + 1), "node"), "node").limit(many).toArrow()
    return nodes.sparkSession.sparkContext.broadcast((drawn.column("node").to_numpy().astype(np.int64), drawn.column("code").combine_chunks()))


def graph_search(nodes: DataFrame, graph: DataFrame, start: Broadcast, queries: DataFrame, beam: int, width: int, tables=None) -> DataFrame:
    """(q, node, d): the ``beam`` nearest nodes that each query (q, own, qc) reaches over ``graph`` (a, b), with squared
    distance. It starts from the query's own node and from the entry points ``start``. ``tables``: those of ``placed``,
    if they are there already."""
    slots, vectors, edges = tables or placed(nodes, graph)
    width = max(width, beam // 2)  # a few wide rounds cost less than many narrow ones
    query_slots = max(8, queries.count() // 64)
    blank = [F.lit(None).cast(kind).alias(name) for name, kind in (("q", "long"), ("qc", "binary"), ("state", "binary"))]
    at_slots = lambda sent, table, run: sent.unionByName(table).repartition(slots, "slot").mapInArrow(_received(run), _PACKED)
    states = queries.select("q", "qc").mapInArrow(_first_beams(start, beam, query_slots), _STATE)
    asked = queries.mapInArrow(_ask_own(slots), _PACKED)
    finished = []
    while True:
        answers = at_slots(asked, vectors, _compare(query_slots)).select("slot", *blank, "payload")
        rows = answers.unionByName(states.withColumn("payload", F.lit(None).cast("binary"))).repartition(query_slots, "slot")
        after = materialize(rows.mapInArrow(_update_beams(beam, width), _STATE + ", going boolean"), "ann-beams")
        finished.append(after.where("not going").select("q", "state"))
        states = after.where("going").drop("going")
        if not states.limit(1).count():
            break
        asked = at_slots(states.mapInArrow(_ask(beam, slots), _PACKED), edges, _follow(slots))
    return reduce(DataFrame.unionByName, finished).mapInArrow(_beam_rows, "q long, node long, d double")


def _least_distances(sent: Broadcast, k: int):
    """Of every query sent, the ``k`` least squared distances to a partition's other nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, code = sent.value
        y = _decoded(code)
        least = [np.zeros(0)] * len(q)
        for b in batches:
            node, x = b.column("node").to_numpy(), _decoded(b.column("code"))
            for i in range(len(q) if len(x) else 0):
                d = ((x - y[i]) ** 2).sum(1)
                least[i] = np.sort(np.append(least[i], d[node != q[i]]))[:k]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q, [len(d) for d in least])), pa.array(np.concatenate([*least, np.zeros(0)]))], ["q", "d"])

    return run


def exact_radius(nodes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(q, radius, want): the squared distance of each query's k-th nearest other node by comparison with all, and
    how many nodes (``k``, or all there are) lie within. ``queries`` (q, qc) are few: they are broadcast."""
    few = queries.select("q", "qc").toArrow()
    sent = nodes.sparkSession.sparkContext.broadcast((few.column("q").to_numpy().astype(np.int64), few.column("qc").combine_chunks()))
    least = nodes.mapInArrow(_least_distances(sent, k), "q long, d double")
    least = least.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy("d"))).where(F.col("n") <= k)
    return materialize(least.groupBy("q").agg(F.max("d").alias("radius"), F.count(F.lit(1)).alias("want")), "ann-radius")


def recall(found: DataFrame, radius: DataFrame) -> float:
    """The share of the true nearest nodes of ``exact_radius`` among those found; nodes as near as the k-th count alike."""
    near = found.join(radius, "q").where((F.col("node") != F.col("q")) & (F.col("d") <= F.col("radius") * (1 + 1e-9)))
    near = near.groupBy("q").agg(F.count(F.lit(1)).alias("got"))
    got = radius.join(near, "q", "left").agg(F.sum(F.least(F.coalesce("got", F.lit(0)), "want")), F.sum("want")).first()
    return got[0] / got[1] if got[1] else 1.0


def wide_enough(
    nodes: DataFrame, graph: DataFrame, start: Broadcast, queries: DataFrame, k: int, beam: int = 512, most_beam: int = 8192, trial: int = 100, target: float = 0.93, seed: int = 8, tables=None
) -> int:
    """The beam that finds ``target`` of the ``k`` nearest nodes of ``trial`` drawn queries (q, own, qc): ``beam``, doubled
    as often as needed up to ``most_beam``."""
    some = materialize(queries.orderBy(F.xxhash64(F.lit(seed + 2), "q"), "q").limit(trial), "ann-trial")
    radius = exact_radius(nodes, some, k)
    tables = tables or placed(nodes, graph)
    while (share := recall(graph_search(nodes, graph, start, some, beam, beam // 4, tables), radius)) < target:
        if 2 * beam > most_beam:
            warnings.warn(f"a beam of {beam} finds {share:.3f} of the nearest neighbours, less than {target}", stacklevel=2)
            break
        beam *= 2
    return beam


def nearest(vectors: DataFrame, query_step: int = 100, k: int = 10, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``query_step``, the
    ``k`` nearest other rows that the search finds, by Euclidean distance."""
    rows = usable(vectors).dropDuplicates(["vec_id", "v"])
    members = Window.partitionBy("v").orderBy("vec_id")
    ranked = rows.withColumn("n", F.row_number().over(members)).where(F.col("n") <= k + 1)
    classes = ranked.groupBy("v").agg(F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("members"))
    # A vec_id with several vectors does not name a node.
    several = rows.groupBy(F.col("vec_id").alias("node")).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    classes = classes.join(several, "node", "left")
    classes = classes.select(F.when(F.col("c").isNull(), F.col("node")).otherwise(F.xxhash64("node", "v")).alias("node"), "v", "members")
    classes = materialize(classes, "ann-classes")
    nodes = materialize(classes.select("node", "v").mapInArrow(coded, "node long, code binary"), "ann-nodes")
    # A query is a vector: all asked rows that hold it share its search.
    asked = rows.where(F.col("vec_id") % query_step == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"))
    asked = asked.join(classes.select(F.col("node").alias("q"), F.col("v").alias("qv")), "qv")
    asked = materialize(asked.select("query_id", "q"), "ann-queries")
    own = nodes.join(asked.select(F.col("q").alias("node")).distinct(), "node")
    queries = materialize(own.select(F.col("node").alias("q"), F.col("node").alias("own"), F.col("code").alias("qc")), "ann-query-codes")
    build = {x: options[x] for x in ("degree", "sample", "best", "rounds", "settled", "draws") if x in options}
    graph = materialize(both_ways(neighbour_graph(nodes, **build), options.get("back", 40)), "ann-graph")
    start = entry_points(nodes, **{x: options[x] for x in ("entries", "most_entries") if x in options})
    tables = placed(nodes, graph)
    beam = wide_enough(nodes, graph, start, queries, k, tables=tables, **{x: options[x] for x in ("beam", "most_beam", "trial", "target") if x in options})
    found = graph_search(nodes, graph, start, queries, beam, beam // 4, tables).drop("d")
    vectors_of = classes.select(F.col("node").alias("q"), F.col("v").alias("qv"))
    found = found.join(classes.select("node", "v"), "node").join(vectors_of, "q").select("q", "node", "qv", "v")
    found = found.mapInArrow(_exact, "q long, node long, d double").join(asked, "q")
    out = found.join(classes.select("node", F.explode("members").alias("vec_id")), "node").where("vec_id <> query_id")
    out = out.groupBy("query_id", "vec_id").agg(F.min("d").alias("d"))  # an id with several vectors counts by its nearest
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))
    out = out.withColumn("rank", rank).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("d").alias("score"))
