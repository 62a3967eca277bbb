"""Anchors of windows, found block by block, and the packed first sort of suffixes, against plain computations."""

import numpy as np


def test_stretches_by_blocks(monkeypatch):
    from punctuality.llm import spans
    from punctuality.llm.common import BYTE_CODES, Sums

    monkeypatch.setattr(spans, "BLOCK", 7)
    rng = np.random.default_rng(3)
    for length, k, top in ((6, 3, 4), (9, 9, 2), (5, 1, 3), (1, 1, 4)):
        sizes = np.array([0, 40, length - 1, length, 0, 23, 1])
        offsets = np.append(0, np.cumsum(sizes))
        data = rng.integers(0, top, offsets[-1]).astype(np.uint8)
        grams = Sums(BYTE_CODES[data]).of_all(k) >> np.uint64(24)
        plain = []  # text, start, size, place of each run
        for t, (i, j) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            for s in range(i, j - length + 1):
                place = min(range(s, s + length - k + 1), key=lambda p: (int(grams[p]), p))
                if plain and plain[-1][0] == t and plain[-1][3] == place:
                    plain[-1][2] += 1
                else:
                    plain.append([t, s, length, place])
        text, anchor, start, size, place, sums = spans.stretches(BYTE_CODES[data], offsets, length, k)
        assert np.stack([text, start, size, place], 1).tolist() == plain
        assert (anchor == sums.of(place, place + k)).all()


def test_packed_codes():
    from punctuality.llm.suffixes import _packed

    codes = np.array([3, 1, 2, 0, 3, 2, 1])
    for have in range(1, 12):
        padded = np.append(codes, np.zeros(have, np.int64))
        want = [sum(int(padded[i + j]) << 2 * (have - 1 - j) for j in range(have)) for i in range(len(codes))]
        assert _packed(padded, 2, have)[: len(codes)].tolist() == want
