"""Scoring texts with a gated recurrent language model, trained here with numpy.

1. Texts are split into words once and kept as packed chunks: token numbers local to the chunk,
   the chunk's different words (64-bit hashes) and how often the training texts use each.
2. Each chunk deals its words to buckets of the hash; a bucket adds the counts of all chunks
   and answers every chunk with the corpus counts of the words it sent. One shuffle of
   distinct words per chunk gives N, V, the base scores and the vocabulary.
3. The model predicts a token from a recurrent state: first its class, then the word in
   its class (both softmax). Words outside the vocabulary share one entry and split its probability by
   (count + 0.5), unseen words together being one more outcome, so probabilities add up to 1 over
   all words seen and one for the rest. Training reads every training text whole, window by
   window (truncated backpropagation, the state carried on); a task's last batch may be smaller. It goes in rounds
   over parts of the chunks, dealt out across the partitions: tasks train on their chunks from the same weights, and the
   weights are averaged by tokens through a tree of aggregations; the model's size is fixed.
4. Scoring runs over all texts, the state carried through each whole document.

Null texts are empty: one token, the end. Repeated rows each count and each get a row. A null
doc_id is hashed as the empty text. No training rows: counts are 0 and the model stays at its start.
No rows: an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import NOT_SPACE, SLICE_BYTES, id_fold, materialize, signed, slices, text_bytes, word_bounds, word_hashes

_U = np.uint64
#: Entries of the model's vocabulary: 0 any other word, 1 the end, then the most frequent words.
OTHER, END = 0, 1
CHUNK_BYTES = 8 << 20
#: Texts read side by side, and tokens whose outputs are scored at once.
LANES, SCORED = 256, 8192


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each text's first word, with the end; hashes of all words), some texts at a time."""
    first, hashes, i = [np.zeros(1, np.int64)], [], 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        part = data[offsets[i] : offsets[j]]
        starts, ends, at = word_bounds(part, offsets[i : j + 1] - offsets[i], NOT_SPACE)
        first.append(at[1:] + first[-1][-1])
        hashes.append(word_hashes(part, starts, ends, True))
        i = j
    return np.concatenate(first), np.concatenate(hashes)


def pack_chunks(docs: DataFrame, held_out, rounds: int) -> DataFrame:
    """One row per chunk of texts: docs, train flags, token counts, tokens, words, train counts."""
    schema = "chunk long, round int, doc_id {k}, train binary, sizes binary, tokens binary, words binary, counts binary"
    kind = f"array<{docs.schema['doc_id'].dataType.simpleString()}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            out = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for i, j, data, offsets in slices(b, "text", CHUNK_BYTES):
                first, hashes = _words(data, offsets)
                words, tokens = np.unique(hashes, return_inverse=True)
                train = ~out[i:j]
                counts = np.bincount(tokens[np.repeat(train, np.diff(first))], minlength=len(words))
                row = [
                    [base + n], [(TaskContext.get().partitionId() + n) % rounds], [b.column("doc_id").slice(i, j - i).to_pylist()], [train.tobytes()],
                    [np.diff(first).astype("<i4").tobytes()], [tokens.astype("<u4").tobytes()], [words.tobytes()], [counts.astype("<i4").tobytes()],
                ]
                n += 1
                types = [pa.int64(), pa.int32(), pa.list_(b.column("doc_id").type), *[pa.binary()] * 5]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(row, types, strict=True)],
                    ["chunk", "round", "doc_id", "train", "sizes", "tokens", "words", "counts"],
                )

    d = docs.select("doc_id", text_bytes(F.col("text")).alias("text"), held_out.alias("held_out"))
    return d.mapInArrow(run, schema.format(k=kind))


def corpus_counts(packed: DataFrame, buckets: int, top: int) -> DataFrame:
    """(kind, chunk, bucket, total, distinct, words, counts): kind 0, the corpus counts of the words
    that a chunk sent to a bucket, in their order; kind 1, a bucket's totals and ``top`` most frequent words."""
    names = ["kind", "chunk", "bucket", "total", "distinct", "words", "counts"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, words, counts in zip(*(b.column(c).to_pylist() for c in ("chunk", "words", "counts")), strict=True):
                words, counts = np.frombuffer(words, _U), np.frombuffer(counts, "<i4")
                bucket = (words % _U(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                some = [x for x in range(buckets) if cut[x + 1] > cut[x]]
                parts = [order[cut[x] : cut[x + 1]] for x in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * len(some), pa.int64()),
                        pa.array(some, pa.int64()),
                        pa.array([words[p].tobytes() for p in parts], pa.binary()),
                        pa.array([counts[p].tobytes() for p in parts], pa.binary()),
                    ],
                    ["chunk", "bucket", "words", "counts"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list] = {}
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("bucket", "chunk", "words", "counts")), strict=True):
                by_bucket.setdefault(row[0], []).append(row[1:])
        for bucket, rows in by_bucket.items():
            words = np.concatenate([np.frombuffer(w, _U) for _, w, _ in rows])
            counts = np.concatenate([np.frombuffer(c, "<i4") for _, _, c in rows])
            unique, back = np.unique(words, return_inverse=True)
            sums = np.bincount(back, counts, len(unique)).astype(np.int64)
            best = np.lexsort((unique, -sums))[:top]
            best = best[sums[best] > 0]
            out = [(1, None, bucket, int(sums.sum()), int((sums > 0).sum()), unique[best].tobytes(), sums[best].tobytes())]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
            at = 0
            for chunk, w, _ in rows:
                n = len(w) // 8
                out = [(0, chunk, bucket, None, None, None, sums[back[at : at + n]].tobytes())]
                at += n
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)

    dealt = packed.select("chunk", "words", "counts").mapInArrow(deal, "chunk long, bucket long, words binary, counts binary")
    return dealt.repartition(buckets, "bucket").mapInArrow(
        add, "kind int, chunk long, bucket long, total long, distinct long, words binary, counts binary"
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _softmax(states: np.ndarray, weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, own: np.ndarray, slope: bool):
    """(with ``slope`` the probabilities less 1 at ``own``, log probability of ``own``) for each row of states."""
    e = states @ weights
    reach = np.abs(weights).sum(0)  # states lie between -1 and 1
    top = (bias + reach).max()
    if top - (bias - reach).max() < 60:  # one shift for all rows leaves each row's largest above exp(-60)
        e += bias - top
    else:
        e += bias
        e -= e.max(1, keepdims=True)
    logp = e[rows, own]
    np.exp(e, out=e)
    total = e @ np.ones(e.shape[1], e.dtype)
    logp -= np.log(total)
    if slope:
        e *= np.reciprocal(total)[:, None]
        e[rows, own] -= 1
    return e, logp


class RecurrentModel:
    """Gated recurrent unit with a class-factored output. ``p``: its weights by name, float32.

    gates (entry x 3 hidden), recur (hidden x 3 hidden), bias (3 hidden); to_class, class_bias;
    to_word (entry x hidden), word_bias. Class c holds the entries c * width to (c + 1) * width.
    """

    def __init__(self, p: dict[str, np.ndarray], width: int):
        self.p, self.width = p, width

    @classmethod
    def start(cls, counts: np.ndarray, hidden: int, width: int, seed: int = 5) -> RecurrentModel:
        """Small random weights; output biases from the entries' counts."""
        rng = np.random.default_rng(seed)
        n = -(-len(counts) // width) * width
        c = np.full(n, 1e-4)
        c[: len(counts)] = counts + 0.5
        by_class = c.reshape(-1, width)
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        return cls(
            {
                "gates": small(n, 3 * hidden), "recur": small(hidden, 3 * hidden), "bias": np.zeros(3 * hidden, np.float32),
                "to_class": small(hidden, n // width), "class_bias": np.log(by_class.sum(1)).astype(np.float32),
                "to_word": small(n, hidden), "word_bias": np.log(by_class / by_class.sum(1, keepdims=True)).ravel().astype(np.float32),
            },
            width,
        )

    def window(self, state: np.ndarray, inputs: np.ndarray, lanes: np.ndarray, keep: bool):
        """Run len(lanes) steps; step t has the first ``lanes[t]`` lanes. ``inputs``: step after step."""
        p, h, at = self.p, state, 0
        size = h.shape[1]
        states = np.empty((len(inputs), size), np.float32)
        kept = []
        for n in lanes.tolist():
            h = h[:n]
            x = p["gates"][inputs[at : at + n]]
            y = h @ p["recur"]
            y += p["bias"]
            zr = _sigmoid(x[:, : 2 * size] + y[:, : 2 * size])
            z, r = zr[:, :size], zr[:, size:]
            new = r * y[:, 2 * size :]
            new += x[:, 2 * size :]
            np.tanh(new, out=new)
            after = h - new
            after *= z
            after += new
            if keep:
                kept.append((h, z, r, new, y[:, 2 * size :]))
            h = after
            states[at : at + n] = h
            at += n
        return h, states, kept

    def outputs(self, states: np.ndarray, targets: np.ndarray, grad: dict[str, np.ndarray] | None = None):
        """Log probability of each target; with ``grad``, adds the gradients of their negative sum
        there and also returns the one of the states."""
        p, width = self.p, self.width
        cls = (targets // width).astype(np.int16)  # short keys sort by digits
        order = np.argsort(cls, kind="stable")
        states, cls = states[order], cls[order]
        rows = np.arange(len(targets))
        e, logp = _softmax(states, p["to_class"], p["class_bias"], rows, cls, grad is not None)
        d = None
        if grad is not None:
            grad["to_class"] += states.T @ e
            grad["class_bias"] += e.sum(0)
            d = e @ p["to_class"].T
        cut = np.searchsorted(cls, np.arange(len(p["class_bias"]) + 1))
        within = targets[order] - cls.astype(np.int64) * width
        for c in np.flatnonzero(np.diff(cut)).tolist():
            some, block = slice(cut[c], cut[c + 1]), slice(c * width, (c + 1) * width)
            s, w = states[some], p["to_word"][block]
            e, own = _softmax(s, w.T, p["word_bias"][block], rows[: len(s)], within[some], grad is not None)
            logp[some] += own
            if grad is not None:
                grad["to_word"][block] += e.T @ s
                grad["word_bias"][block] += e.sum(0)
                d[some] += e @ w
        out, d_states = np.empty_like(logp), None
        out[order] = logp
        if grad is not None:
            d_states = np.empty_like(d)
            d_states[order] = d
        return out, d_states

    def learn(self, windows: list[tuple], grad: dict[str, np.ndarray]) -> None:
        """Add the gradients of ``windows``: (targets, states, kept, lanes, inputs) each. The outputs of all are
        computed at once, so that short windows (the ends of long texts) cost little."""
        targets, states, kept, lanes, inputs = zip(*windows, strict=True)
        _, d = self.outputs(np.concatenate(states), np.concatenate(targets), grad)
        cut = np.cumsum([len(x) for x in inputs])[:-1]
        some = zip(kept, lanes, np.split(d, cut), strict=True)
        d_inputs = np.concatenate([self.backward(k, n, x, grad) for k, n, x in some])
        inputs = np.concatenate(inputs)
        order = np.argsort(inputs.astype(np.int16 if len(self.p["gates"]) < 1 << 15 else np.int64), kind="stable")
        head = np.flatnonzero(np.append(True, np.diff(inputs[order]) != 0))
        grad["gates"][inputs[order[head]]] += np.add.reduceat(d_inputs[order], head)

    def backward(self, kept, lanes: np.ndarray, d_states: np.ndarray, grad: dict[str, np.ndarray]) -> np.ndarray:
        """Backpropagation through the steps of one window: the gradient at the gates of each input."""
        p = self.p
        size = d_states.shape[1]
        d_inputs = np.empty((len(d_states), 3 * size), np.float32)
        at, carry = len(d_inputs), None
        for n, (h, z, r, new, y_new) in zip(lanes[::-1].tolist(), kept[::-1], strict=True):
            at -= n
            d = d_states[at : at + n].copy()
            if carry is not None:
                d[: len(carry)] += carry
            d_new = d * (1 - z) * (1 - new * new)
            gate = np.empty((n, 3 * size), np.float32)
            gate[:, :size] = d * (h - new) * z * (1 - z)
            gate[:, size : 2 * size] = d_new * y_new * r * (1 - r)
            gate[:, 2 * size :] = d_new
            d_inputs[at : at + n] = gate
            gate[:, 2 * size :] = d_new * r
            grad["recur"] += h.T @ gate
            grad["bias"] += gate.sum(0)
            carry = d * z + gate @ p["recur"].T
        return d_inputs


def _lanes(tokens: np.ndarray, first: np.ndarray, sizes: np.ndarray, steps: int):
    """Windows over texts side by side, longest first: (order of the texts, and per window: lane counts, targets,
    inputs, lane of each). Each text ends with END, which also is its first input."""
    order = np.argsort(-sizes, kind="stable")
    length = sizes[order] + 1
    begin = first[order]

    def windows():
        t = 0
        while t < length[0]:
            span = np.arange(t, min(t + steps, int(length[0])))
            lanes = np.searchsorted(-length, -span, "left")  # texts longer than each step
            step = np.repeat(span, lanes)
            lane = np.arange(len(step)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
            at = begin[lane] + step
            is_end = step == length[lane] - 1
            targets = np.where(is_end, END, tokens[np.minimum(at, len(tokens) - 1)])
            inputs = np.where(step == 0, END, tokens[np.clip(at - 1, 0, len(tokens) - 1)])
            yield lanes, targets, inputs, lane
            t += steps

    return order, windows


def _side_by_side(sizes: np.ndarray, chosen: np.ndarray) -> Iterator[np.ndarray]:
    """The chosen texts, ``LANES`` of similar size at a time."""
    order = np.argsort(-sizes, kind="stable")
    order = order[chosen[order]]
    for i in range(0, len(order), LANES):
        yield order[i : i + LANES]


def _chunk_tokens(words: np.ndarray, tokens: np.ndarray, vocabulary: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Vocabulary entries of a chunk's tokens; ``vocabulary`` sorted hashes, ``entry`` their numbers."""
    number = np.full(len(words) + 1, OTHER, np.int32)
    if len(vocabulary):
        spot = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
        number[:-1] = np.where(vocabulary[spot] == words, entry[spot], OTHER)
    return np.append(number[tokens], OTHER) if len(tokens) else np.array([OTHER], np.int32)


def train_round(packed: DataFrame, model: RecurrentModel, vocabulary, entry, steps: int, rate: float, batch: int) -> RecurrentModel:
    """The model after one round of training on ``packed``: tasks train from ``model``, their weights are averaged."""
    spark = packed.sparkSession
    sent = spark.sparkContext.broadcast((model.p, model.width, vocabulary, entry))
    names = sorted(model.p)
    block = 1 << 14
    flat = np.concatenate([model.p[x].ravel() for x in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, width, vocabulary, entry = sent.value
        local = RecurrentModel({k: v.copy() for k, v in start.items()}, width)
        grad = {k: np.zeros_like(v) for k, v in start.items()}
        power = {k: np.full_like(v, 1e-6) for k, v in start.items()}
        seen = pending = 0
        waiting = []

        def update():
            nonlocal seen, pending
            local.learn(waiting, grad)
            waiting.clear()
            for k, g in grad.items():
                g /= pending
                power[k] += g * g
                local.p[k] -= rate * g / np.sqrt(power[k])
                g[:] = 0
            seen, pending = seen + pending, 0

        for b in batches:
            for train, sizes, tokens, words in zip(*(b.column(c) for c in ("train", "sizes", "tokens", "words")), strict=True):
                sizes = np.frombuffer(sizes.as_buffer(), "<i4").astype(np.int64)
                y = _chunk_tokens(np.frombuffer(words.as_buffer(), _U), np.frombuffer(tokens.as_buffer(), "<u4"), vocabulary, entry)
                first = np.cumsum(sizes) - sizes
                for some in _side_by_side(sizes, np.frombuffer(train.as_buffer(), bool)):
                    _, windows = _lanes(y, first[some], sizes[some], steps)
                    state = np.zeros((len(some), start["recur"].shape[0]), np.float32)
                    for lanes, targets, inputs, _ in windows():
                        state, states, kept = local.window(state[: lanes[0]], inputs, lanes, True)
                        waiting.append((targets, states, kept, lanes, inputs))
                        pending += len(targets)
                        if pending >= batch:
                            update()
        if pending:  # what the last batch has less
            update()
        if seen:
            mine = np.concatenate([local.p[x].ravel() for x in names])
            parts = np.split(mine * np.float32(seen), np.arange(block, len(mine), block))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(parts)), pa.int64()),
                    pa.array([TaskContext.get().partitionId() % 16] * len(parts), pa.int64()),
                    pa.array([float(seen)] * len(parts)),
                    pa.array([x.astype("<f4").tobytes() for x in parts], pa.binary()),
                ],
                ["block", "branch", "weight", "values"],
            )

    def add(t: pa.Table) -> pa.Table:
        values = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in t.column("values").to_pylist())
        return pa.table(
            {
                "block": t.column("block").slice(0, 1),
                "branch": t.column("branch").slice(0, 1),
                "weight": pa.array([float(sum(t.column("weight").to_pylist()))]),
                "values": pa.array([values.astype("<f4").tobytes()], pa.binary()),
            }
        )

    schema = "block long, branch long, weight double, values binary"
    trained = packed.select("train", "sizes", "tokens", "words").mapInArrow(run, schema)
    rows = trained.groupBy("block", "branch").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema).toPandas()
    if not len(rows):
        return model
    rows = rows.sort_values("block")
    flat = np.concatenate([np.frombuffer(v, "<f4") / np.float32(w) for v, w in zip(rows["values"], rows["weight"], strict=True)])
    p, at = {}, 0
    for x in names:
        p[x] = flat[at : at + model.p[x].size].reshape(model.p[x].shape).astype(np.float32)
        at += model.p[x].size
    return RecurrentModel(p, model.width)


def score_documents(
    docs: DataFrame,
    folds: int = 5,
    held_out: int = 1,
    vocabulary: int = 4096,
    hidden: int = 16,
    width: int = 64,
    rounds: int = 2,
    steps: int = 32,
    rate: float = 0.05,
    batch: int = 8192,
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    out = id_fold(F.col("doc_id"), folds) == held_out
    packed = materialize(pack_chunks(docs, out, rounds), "lm-chunks")
    size = packed.agg(F.sum(F.octet_length("words")), F.sum(F.octet_length("sizes"))).first()
    buckets = max(1, int((size[0] or 0) / 8 / 1_000_000) + 1)
    counts = materialize(corpus_counts(packed, buckets, vocabulary - 2), "lm-counts")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(sum(x) for x in b.column("train").to_pylist())], pa.int64())], ["n"])

    n_ends = packed.select("train").mapInArrow(ends, "n long").agg(F.sum("n")).first()[0] or 0
    totals = counts.where("kind = 1").agg(F.sum("total"), F.sum("distinct")).first()
    tokens = int(totals[0] or 0) + n_ends
    distinct = int(totals[1] or 0) + (n_ends > 0)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w, c in zip(b.column("words").to_pylist(), b.column("counts").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.frombuffer(w, _U))), pa.array(np.frombuffer(c, "<i8"))], ["word", "c"])

    tops = counts.where("kind = 1").select("words", "counts").mapInArrow(spread, "word long, c long")
    best = tops.orderBy(F.desc("c"), "word").limit(vocabulary - 2).toPandas()
    entries = np.concatenate([[0, n_ends], best["c"].to_numpy(np.int64)])
    rest = tokens - entries.sum()  # training tokens outside the vocabulary
    rest_mass = float(rest + 0.5 * (distinct - len(best) - (n_ends > 0)) + 0.5)
    entries[OTHER] = rest
    hashes = best["word"].to_numpy(np.int64).view(_U)
    by_hash = np.argsort(hashes)
    known, entry = hashes[by_hash], (by_hash + 2).astype(np.int64)
    model = RecurrentModel.start(entries, hidden, width)
    for r in range(rounds):
        model = train_round(packed.where(F.col("round") == r), model, known, entry, steps, rate, batch)
    sent = docs.sparkSession.sparkContext.broadcast((model.p, width, known, entry))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scale = np.log10(tokens + 0.5 * (distinct + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, width, known, entry = sent.value
        model = RecurrentModel(p, width)
        for b in batches:
            for row in b.to_pylist():
                words, local = np.frombuffer(row["words"], _U), np.frombuffer(row["tokens"], "<u4")
                sizes = np.frombuffer(row["sizes"], "<i4").astype(np.int64)
                bucket = (words % _U(buckets)).astype(np.int64)
                c = np.zeros(len(words), np.int64)
                for part in row["answers"] or []:
                    c[bucket == part["bucket"]] = np.frombuffer(part["counts"], "<i8")
                first = np.cumsum(sizes) - sizes
                text = np.repeat(np.arange(len(sizes)), sizes)
                log_c = np.log10(c + 0.5)
                base = np.bincount(text, log_c[local], len(sizes)) + np.log10(n_ends + 0.5) - (sizes + 1) * scale
                n_known = np.bincount(text, (c > 0)[local], len(sizes)).astype(np.int64) + (n_ends > 0)
                y = _chunk_tokens(words, local, known, entry)
                inside_other = np.where(y[:-1] == OTHER, log_c[local] - np.log10(rest_mass), 0.0) if len(local) else np.zeros(0)
                total = np.bincount(text, inside_other, len(sizes)).astype(float)
                waiting, n = [], 0

                def settle(waiting, total=total):
                    states, targets, texts = (np.concatenate(x) for x in zip(*waiting, strict=True))
                    total += np.bincount(texts, model.outputs(states, targets)[0], len(total)) / np.log(10)

                for some in _side_by_side(sizes, np.ones(len(sizes), bool)):
                    _, windows = _lanes(y, first[some], sizes[some], steps)
                    state = np.zeros((len(some), p["recur"].shape[0]), np.float32)
                    for lanes, targets, inputs, lane in windows():
                        state, states, _ = model.window(state[: lanes[0]], inputs, lanes, False)
                        waiting.append((states, targets, some[lane]))
                        n += len(targets)
                        if n >= SCORED:
                            settle(waiting)
                            waiting, n = [], 0
                if waiting:
                    settle(waiting)
                train = np.frombuffer(row["train"], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_id"], b.column("doc_id").type.value_type),
                        pa.array(~train),
                        pa.array(sizes + 1),
                        pa.array(n_known),
                        pa.array(np.full(len(sizes), tokens, np.int64)),
                        pa.array(base),
                        pa.array(total),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    answers = counts.where("kind = 0").groupBy(F.col("chunk").alias("c")).agg(F.collect_list(F.struct("bucket", "counts")).alias("answers"))
    both = packed.join(answers, F.col("chunk") == F.col("c"), "left").select("doc_id", "train", "sizes", "tokens", "words", "answers")
    return both.mapInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
