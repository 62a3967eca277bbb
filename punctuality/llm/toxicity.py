"""Toxicity classifier that is regularised by counterfactuals.

Logistic regression on the presence of words and word beginnings (hashed). Where a labelled
text names a group, a second version of it names another group of the same kind instead; the
squared change of the score between the two is added to the loss, so the weights of group
names cannot carry the label and neutral mentions are not rejected.

Feature counts come from all labelled training rows. The fit itself uses at most
``sample_per_class`` rows of each label, the first by a hash of the id (a documented bound of
the fit), and the ``features`` features with the largest difference between the labels.
Scoring covers every text, whole, and needs only the weights (a fixed-size array).

Null and empty texts have no features and get the score of the intercept. Rows whose label
is null do not train; of an id with several labels, each counts. No training rows: all scores are 0.25.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuality.llm.common import ALNUM, BYTE_CODES, LOWER, Sums, id_fold, materialize, mix, slices, text_bytes, word_bounds

#: Kinds of group names; a counterfactual puts the next name of the same kind.
IDENTITY = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("she", "he"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
    ("mujeres", "hombres"),
    ("chrétien", "musulman", "juif"),
    ("christlich", "muslimisch", "jüdisch"),
    ("cristiano", "musulmán", "judío"),
)

BITS = 18


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return Sums(BYTE_CODES[data]).of(np.append(0, ends[:-1]), ends)


def _swaps(identity) -> tuple[np.ndarray, np.ndarray]:
    a = [w for kind in identity for w in kind]
    b = [w for kind in identity for w in (*kind[1:], kind[0])]
    keys, to = _hash_words(a), _hash_words(b)
    order = np.argsort(keys)
    return keys[order], to[order]


def _features(data: np.ndarray, offsets: np.ndarray, identity=None):
    """(text, feature) pairs, not distinct: each word, and its first 4 and 5 bytes if it is longer.
    With ``identity``, also the pairs of the texts with swapped names and which texts those are."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    sums = Sums(BYTE_CODES[data])
    words = sums.of(starts, ends)
    size = ends - starts

    def slots(words, keep):
        parts = [(text[keep], words[keep])]
        for n in (4, 5):
            long = size[keep] > n
            parts.append((text[keep][long], mix(sums.of(starts[keep][long], starts[keep][long] + n) + np.uint64(n))))
        t, h = (np.concatenate(x) for x in zip(*parts, strict=True))
        return t, (h >> np.uint64(64 - BITS)).astype(np.int64)

    everything = np.ones(len(words), bool)
    t, f = slots(words, everything)
    if identity is None:
        return t, f
    keys, to = identity
    spot = np.searchsorted(keys, words)
    spot[spot == len(keys)] = 0
    named = keys[spot] == words
    other = np.zeros(len(first) - 1, bool)
    other[text[named]] = True
    t2, f2 = slots(words, ~named)
    t2, f2 = np.concatenate([t2, text[named]]), np.concatenate([f2, (to[spot[named]] >> np.uint64(64 - BITS)).astype(np.int64)])
    return t, f, t2, f2, other


def _distinct(t: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique((t << BITS) | f)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def feature_counts(labelled: DataFrame) -> DataFrame:
    """(feature, pos, neg): texts of each label that have the feature, over all rows (text, label)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << BITS), np.int64)
        for b in batches:
            labels = b.column("label").to_numpy(zero_copy_only=False)
            for i, j, data, offsets in slices(b, "text"):
                t, f = _distinct(*_features(data, offsets))
                for label in (0, 1):
                    sums[label] += np.bincount(f[labels[i:j][t] == label], minlength=1 << BITS)
        some = np.flatnonzero(sums.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[1][some]), pa.array(sums[0][some])], ["feature", "pos", "neg"])

    per_task = labelled.mapInArrow(count, "feature long, pos long, neg long")
    return per_task.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _sample_rows(sample: DataFrame, chosen: np.ndarray, identity) -> list[tuple[int, np.ndarray, np.ndarray | None]]:
    """(label, chosen features, those of the counterfactual or None) of each sampled row."""
    sent = sample.sparkSession.sparkContext.broadcast((chosen, identity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, identity = sent.value
        for b in batches:
            for i, j, data, offsets in slices(b, "text"):
                t, f, t2, f2, other = _features(data, offsets, identity)

                def lists(t, f, n=j - i):
                    t, f = _distinct(t, f)
                    spot = np.minimum(np.searchsorted(chosen, f), len(chosen) - 1)
                    keep = chosen[spot] == f
                    t, spot = t[keep], spot[keep].astype(np.int32)
                    return [x.tobytes() for x in np.split(spot, np.searchsorted(t, np.arange(1, n)))]

                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("label").slice(i, j - i),
                        pa.array(lists(t, f), pa.binary()),
                        pa.array([x if o else None for x, o in zip(lists(t2, f2), other, strict=True)], pa.binary()),
                    ],
                    ["label", "features", "swapped"],
                )

    rows = sample.mapInArrow(run, "label int, features binary, swapped binary").toPandas()
    read = lambda x: None if x is None else np.frombuffer(x, np.int32)
    return [(int(a), read(b), read(c)) for a, b, c in zip(rows["label"], rows["features"], rows["swapped"], strict=True)]


def _csr(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.repeat(np.arange(len(rows)), counts), np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64)


def fit_weights(rows, n_features: int, l2: float = 2e-4, swap_weight: float = 1.0, steps: int = 300, rate: float = 0.3):
    """Weights and intercept by Adam on the whole sample: mean log loss + l2 + swap_weight times
    the mean squared change of the logit under a swap."""
    y = np.array([r[0] for r in rows], float)
    prior = (y.sum() + 0.5) / (len(y) + 2.0)
    w, bias = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    if len(set(y.tolist())) < 2:
        return w, bias
    r, f = _csr([x[1] for x in rows])
    pairs = [(x[1], x[2]) for x in rows if x[2] is not None]
    pr, pf = _csr([a for a, _ in pairs])
    qr, qf = _csr([b for _, b in pairs])
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(np.bincount(r, w[f], len(y)) + bias)))
        error = (p - y) / len(y)
        g, gb = np.bincount(f, error[r], n_features) + 2 * l2 * w, error.sum()
        if pairs:
            change = (np.bincount(pr, w[pf], len(pairs)) - np.bincount(qr, w[qf], len(pairs))) * (2 * swap_weight / len(pairs))
            g += np.bincount(pf, change[pr], n_features) - np.bincount(qf, change[qr], n_features)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        w = w - rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return w, float(bias)


def _scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    t, f = _features(data, offsets)
    used = weights[f] != 0
    t, f = _distinct(t[used], f[used])
    z = np.bincount(t, weights[f], len(offsets) - 1) + bias
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


class ToxicityModel:
    """Weights by feature slot and an intercept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, docs: DataFrame, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
        """Columns ``keep`` of ``docs`` and the score as ``name``; ``text`` is one of them or holds the bytes."""
        sent = docs.sparkSession.sparkContext.broadcast((self.weights, self.bias))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, bias = sent.value
            for b in batches:
                for i, j, data, offsets in slices(b, text):
                    score = _scores(data, offsets, weights, bias)
                    yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in keep), pa.array(score)], [*keep, name])

        schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(name, T.DoubleType())])
        return docs.mapInArrow(run, schema)

    def column(self, text: Column) -> Column:
        """The score of a text column; only the texts go through Python, other columns stay where they are."""
        weights, bias = self.weights, self.bias
        some = np.flatnonzero(weights)  # a few thousand
        values = weights[some]

        @F.arrow_udf("double")
        def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            full = np.zeros(1 << BITS)
            full[some] = values
            for column in texts:
                batch = pa.RecordBatch.from_arrays([column], ["text"])
                parts = [_scores(data, offsets, full, bias) for _, _, data, offsets in slices(batch, "text")]
                yield pa.array(np.concatenate([*parts, np.zeros(0)]))

        return score(text_bytes(text))


def _id_bits(ids: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of ``bits`` bits with the ids, two bits each: at most ``bits`` / 64 numbers to the driver."""
    place = lambda seed: F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), F.lit(bits))
    places = ids.select(F.explode(F.array(place(1), place(2))).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))
    words = places.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toPandas()
    out = np.zeros(bits >> 6, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def labelled_texts(docs: DataFrame, train: DataFrame, bits: int) -> DataFrame:
    """(doc_id, text, label): the texts that have a label in ``train`` (doc_id, label).

    A filter of fixed size with the labels' ids goes to the tasks that read the texts; what passes it (the labelled
    texts and a few more, all of them if there are far more labels than bits) is joined by a shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_id_bits(train, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        for b in batches:
            at = [b.column(c).to_numpy().astype(np.uint64) for c in ("h1", "h2")]
            hit = [(words[(x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63))) & np.uint64(1) for x in at]
            yield b.select(["doc_id", "text"]).filter(pa.array((hit[0] & hit[1]).astype(bool)))

    place = lambda seed: F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), F.lit(bits))
    d = docs.where("doc_id is not null").select("doc_id", text_bytes(F.col("text")).alias("text"), place(1).alias("h1"), place(2).alias("h2"))
    some = d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text binary")
    return some.join(train.hint("merge"), "doc_id")


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_out: int = 0,
    features: int = 2048,
    sample_per_class: int = 10_000,
    identity=IDENTITY,
    swap_weight: float = 1.0,
    filter_bits: int = 1 << 25,
) -> ToxicityModel:
    """Fit on the labelled rows outside fold ``held_out`` (crc32 of the id modulo ``folds``). ``filter_bits``: see
    :func:`labelled_texts`; any number gives the same model."""
    train = labels.where(F.col("toxic").isin(0, 1) & (id_fold(F.col("doc_id"), folds) != held_out))
    train = train.select("doc_id", F.col("toxic").cast("int").alias("label"))
    labelled = materialize(labelled_texts(docs, train, filter_bits), "toxicity-labelled")
    counts = feature_counts(labelled.select("text", "label"))
    n = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    names = _hash_words([w for kind in identity for w in kind]) >> np.uint64(64 - BITS)
    if not n.get(0) or not n.get(1):
        prior = (n.get(1, 0) + 0.5) / (sum(n.values()) + 2.0)
        return ToxicityModel(np.zeros(1 << BITS), float(np.log(prior / (1 - prior))))
    p, q = F.col("pos") / n[1], F.col("neg") / n[0]
    pooled = (F.col("pos") + F.col("neg")) / (n[0] + n[1])
    z = F.abs(p - q) / F.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]) + 1e-12)
    best = counts.where("pos + neg >= 3").orderBy(z.desc(), "feature").limit(features).select("feature").collect()
    chosen = np.unique(np.concatenate([np.array([r[0] for r in best], np.int64), names.astype(np.int64)]))
    picked = [
        train.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class) for label in (0, 1)
    ]
    chosen_ids = picked[0].unionByName(picked[1]).select("doc_id", "label").distinct()  # at most 2 * sample_per_class rows
    sample = labelled.join(F.broadcast(chosen_ids), ["doc_id", "label"]).select("text", "label")
    rows = _sample_rows(sample, chosen, _swaps(identity))
    w, bias = fit_weights(rows, len(chosen), swap_weight=swap_weight)
    weights = np.zeros(1 << BITS)
    weights[chosen] = w
    return ToxicityModel(weights, bias)


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, **options) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = train_toxicity(docs, labels, folds, held_out, **options)
    d = docs.select("doc_id", text_bytes(F.col("text")).alias("text"))
    scored = model.score(d, ["doc_id"])
    return scored.select(
        "doc_id",
        (id_fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
