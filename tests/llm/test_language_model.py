"""The language model against plain computations in double precision."""

import collections
import math
import re
import zlib

import numpy as np

from punctuality.llm.common import share_package


def _texts():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    out = [(i, " ".join(rng.choice(words, rng.integers(0, 12), p=np.arange(60, 0, -1) / 1830))) for i in range(290)]
    return [*out, (290, " ".join(rng.choice(words, 400))), (291, None), (292, ""), (292, "W1 w1 only"), (None, "w2 w3")]


def _forward(p, width, entries):
    """Natural logs of the probabilities of ``entries``, one after the other."""
    p = {k: v.astype(float) for k, v in p.items()}
    size = p["recur"].shape[0]
    sig = lambda x: 1 / (1 + np.exp(-x))
    h, before, out = np.zeros(size), 1, []
    for e in entries:
        x, y = p["gates"][before], h @ p["recur"] + p["bias"]
        z, r = np.split(sig(x[: 2 * size] + y[: 2 * size]), 2)
        new = np.tanh(x[2 * size :] + r * y[2 * size :])
        h = new + z * (h - new)
        c = e // width
        by_class = h @ p["to_class"] + p["class_bias"]
        by_word = p["to_word"][c * width : (c + 1) * width] @ h + p["word_bias"][c * width : (c + 1) * width]
        out.append(by_class[c] - np.log(np.exp(by_class).sum()) + by_word[e % width] - np.log(np.exp(by_word).sum()))
        before = e
    return out


def test_scores_as_by_a_plain_forward_pass(spark, monkeypatch):
    from punctuality.llm import lm
    from punctuality.llm.common import word_hashes

    share_package(spark)
    texts, kept = _texts(), {}
    real = lm.train_round

    def caught(packed, model, vocabulary, entry, *rest):
        kept["model"] = real(packed, model, vocabulary, entry, *rest)
        kept["entry"] = dict(zip(vocabulary.tolist(), entry.tolist(), strict=True))
        return kept["model"]

    monkeypatch.setattr(lm, "train_round", caught)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.score_documents(docs, vocabulary=20, hidden=4, width=8, steps=16, batch=512).collect())

    def number(word):
        raw = np.frombuffer(word.encode(), np.uint8)
        return kept["entry"].get(int(word_hashes(raw, np.array([0]), np.array([len(raw)]), True)[0]), 0)

    cut = [(d, re.findall(r"\S+", (t or "").lower())) for d, t in texts]
    counts = collections.Counter(w for d, ws in cut if zlib.crc32(str("" if d is None else d).encode()) % 5 != 1 for w in ws)
    others = [w for w in counts if number(w) == 0]
    mass = sum(counts[w] for w in others) + 0.5 * len(others) + 0.5
    want = []
    for d, ws in cut:
        score = sum(_forward(kept["model"].p, 8, [number(w) for w in ws] + [1]))
        score += sum(math.log((counts[w] + 0.5) / mass) for w in ws if number(w) == 0)
        want.append((str(d), len(ws) + 1, score / math.log(10)))
    want.sort()
    assert len(kept["entry"]) == 18 and len(others) > 5
    assert [x[:2] for x in got] == [x[:2] for x in want]
    np.testing.assert_allclose([x[2] for x in got], [x[2] for x in want], rtol=2e-4)


def test_gradients_as_by_differences():
    from punctuality.llm.lm import RecurrentModel, _lanes, _side_by_side

    rng = np.random.default_rng(4)
    model = RecurrentModel.start(np.arange(12.0, 0, -1), 4, 4, seed=8)
    model.p = {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float32) for k, v in model.p.items()}
    sizes = np.array([5, 0, 9, 3])
    tokens = np.append(rng.integers(0, 12, sizes.sum()), 0)
    chosen = np.array([True, True, True, False])
    order = np.concatenate(list(_side_by_side(sizes, chosen)))
    assert order.tolist() == [2, 0, 1]
    first = np.cumsum(sizes) - sizes
    _, windows = _lanes(tokens, first[order], sizes[order], 99)  # one window: nothing is truncated
    (lanes, targets, inputs, _), = windows()
    grad = {k: np.zeros_like(v) for k, v in model.p.items()}
    _, states, kept = model.window(np.zeros((3, 4), np.float32), inputs, lanes, True)
    model.learn([(targets, states, kept, lanes, inputs)], grad)

    def loss(p):
        return -sum(sum(_forward(p, 4, [*tokens[first[i] : first[i] + sizes[i]], 1])) for i in order)

    for name, w in model.p.items():
        for at in [tuple(rng.integers(0, n) for n in w.shape) for _ in range(12)]:
            values = []
            for step in (1e-4, -1e-4):
                p = {k: v.astype(float) for k, v in model.p.items()}
                p[name][at] += step
                values.append(loss(p))
            np.testing.assert_allclose(grad[name][at], (values[0] - values[1]) / 2e-4, rtol=2e-3, atol=2e-4)


def test_softmax_of_far_weights():
    from punctuality.llm.lm import _softmax

    states, weights = np.array([[0.9], [-0.9]], np.float32), np.array([[200.0, -200.0]], np.float32)
    _, logp = _softmax(states, weights, np.zeros(2, np.float32), np.arange(2), np.array([0, 0]), False)
    np.testing.assert_allclose(logp, [0, -360], rtol=1e-5, atol=1e-5)
