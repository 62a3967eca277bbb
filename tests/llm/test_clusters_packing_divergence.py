"""Clustering, packing and the divergence audit against plain computations, with nulls, empty and very
long texts, ties, repeated rows, clashing column names and empty tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from punctuality.llm.common import share_package

SCHEMA = "doc_id long, text string, lang string, source string, n long, docs long, rest string, p long, item string"


def _documents():
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdeéß"), rng.integers(1, 6))) for _ in range(150)]
    say = lambda n: " ".join(rng.choice(words, int(n)))
    rows = [(i, say(n), ("en", "de")[i % 2], f"s{int(i**0.5) % 5}") for i, n in enumerate(rng.integers(1, 400, 90))]
    rows += [
        (100, None, "en", "quiet"), (101, "", None, None), (102, "12 34 !", "en", ""), (103, say(30000), "en", "s1"),
        (104, "Ångström  don't we'll\n\né á\t<|endoftext|>x ́z ΣΑΣ 12,5", "en", "s2"), (None, say(40), "en", None),
        (105, "Same WORDS here", "fr", "a"), (105, "Same WORDS here", "fr", "a"), (105, "Same WORDS here", "fr", "b"),
        (106, "x" * 5000, "fr", "c"), (107, "rare", "it", "d"),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    share_package(spark)
    return spark.createDataFrame([(*r, 1, 2, "r", 3, "i") for r in _documents()], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    share_package(spark)
    return spark.createDataFrame([], SCHEMA)


# --- clustering ---------------------------------------------------------------------------------


def _lloyd(rows, k, rounds):
    x = [(i, np.floor(np.array(v, float) * 256).astype(np.int64)) for i, v in rows]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v.astype(np.int32).tobytes(), j) for j, (i, v) in enumerate(x) if i is not None)
    centers = np.array([x[j][1] for _, _, j in named[:k]])
    points = np.array([v for _, v in x])
    for step in range(rounds + 1):
        d = ((points[:, None] - centers[None]) ** 2).sum(2)
        to = d.argmin(1)
        for c in range(len(centers) if step < rounds else 0):
            if (to == c).any():
                centers[c] = points[to == c].sum(0) // (to == c).sum()
    return x, to, d.min(1), centers


def test_hilbert_neighbours_differ_in_one_step():
    from punctuality.llm.zones import hilbert_keys

    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = [k.tobytes() for k in hilbert_keys(grid, bits)]
        assert len(set(keys)) == len(keys)
        walk = grid[np.argsort(np.array([int.from_bytes(k, "big") for k in keys]))]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_box_bounds_keep_the_nearest_center():
    from punctuality.llm.zones import candidates, nearest_center

    rng = np.random.default_rng(1)
    for size in (100, 1 << 25):  # in double precision, and beyond it
        for _ in range(60):
            x, centers = rng.integers(-size, size, (20, 8)) // 4 + rng.integers(-size, size, 8), rng.integers(-size, size, (30, 8))
            centers[7] = centers[3]
            d = ((x[:, None] - centers[None]) ** 2).sum(2)
            some = candidates(x.min(0), x.max(0), centers)
            to, least = nearest_center(x.astype(np.int32), centers[some])
            assert (some[to] == d.argmin(1)).all() and (least == d.min(1)).all()


def test_clusters_as_by_brute_force(spark):
    from punctuality.llm.zones import cluster_report

    rng = np.random.default_rng(5)
    far = rng.normal(size=(6, 64))
    rows = [(i, (far[i % 6] + rng.normal(scale=0.2, size=64)).tolist()) for i in range(700)]
    rows += [(1000, rows[3][1]), (1000, rows[3][1]), (None, rows[4][1]), (1001, [0.0] * 64), (1001, [1e4] * 64)]
    rows += [(2000 + i, rows[5][1]) for i in range(300)]  # one vector, many rows
    odd = [(3000, None), (3001, []), (3002, [1.0] * 63), (3003, [None, *[1.0] * 63]), (3004, [float("nan"), *[1.0] * 63]), (3005, [float("inf")] * 64)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], "vec_id long, embedding array<double>, cluster int, point string").repartition(4)
    x, to, d, centers = _lloyd(rows, 12, 3)
    want = collections.Counter()
    for (i, _), c, e in zip(x, to.tolist(), d.tolist(), strict=True):
        name = hashlib.sha256(",".join(map(str, centers[c].tolist())).encode()).hexdigest()
        want[i, c, e, int(d[to == c].sum()), int(d.sum()), name] += 1
    got = cluster_report(table, k=12, rounds=3, block=64).collect()
    assert collections.Counter(map(tuple, got)) == want


def test_few_or_no_vectors(spark):
    from punctuality.llm.zones import cluster_report

    schema = "vec_id long, embedding array<float>"
    assert cluster_report(spark.createDataFrame([], schema)).count() == 0
    assert cluster_report(spark.createDataFrame([(1, None), (2, [1.0])], schema)).count() == 0
    two = cluster_report(spark.createDataFrame([(1, [0.5] * 64), (2, [-0.5] * 64)], schema)).collect()
    assert sorted((r.vec_id, r.distance) for r in two) == [(1, 0), (2, 0)] and len({r.cluster for r in two}) == 2
    huge = cluster_report(spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64)], schema)).collect()
    assert {r.distance for r in huge} == {0}


# --- packing ------------------------------------------------------------------------------------


def _tokens(text):
    from tokenizers import Tokenizer

    from punctuality.llm.packing import default_tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("most_open", [2048, 2])
def test_pieces_hold_every_token_once(docs, most_open):
    from punctuality.llm.packing import pack_documents

    rows = pack_documents(docs, most_open=most_open).collect()
    by_sequence, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    fills = []
    for some in by_sequence.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        fills.append(at)
    assert sum(f < 2048 for f in fills) <= 1  # the input's partitions settle together
    want = collections.defaultdict(list)
    for doc_id, text, *_ in _documents():
        ids = _tokens(text)
        want[doc_id, len(ids)].append(ids)
    assert set(want) == set(pieces)
    for key, texts in want.items():
        assert sum(n for _, n, _ in pieces[key]) == sum(map(len, texts))
        starts = collections.Counter()
        for start, n, crc in pieces[key]:
            assert crc in {_crc(ids[start : start + n]) for ids in texts}
            starts.update(range(start, start + n))
        assert set(starts.values()) == {len(texts)}


def test_the_place_is_the_one_with_the_least_sum_of_squares():
    from punctuality.llm.packing import Windows

    rng, room = np.random.default_rng(2), 50
    windows, levels = Windows(room, 10**9), collections.Counter()
    for size in rng.integers(1, room + 1, 400).tolist():
        best = None
        for level in [0, *levels]:
            if level + size <= room:
                after = levels.copy()
                after[level] -= 1
                after[level + size] += 1
                cost = sum(n * n for f, n in after.items() if 0 < f < room)
                best = min(best or (cost, -level), (cost, -level))
        windows.place([(0, 0, np.zeros(size, np.int32), size)])
        levels[-best[1]] -= 1
        levels[-best[1] + size] += 1
        levels = collections.Counter({f: n for f, n in levels.items() if 0 < f < room and n})
        assert {f: len(w) for f, w in enumerate(windows.at) if w} == dict(levels)


def test_packing_refuses_another_tokenizer_and_takes_empty_tables(docs, empty):
    from punctuality.llm.packing import pack_documents
    from punctuality.llm.tokens import default_tokenizer

    assert pack_documents(empty).count() == 0
    with pytest.raises(Exception, match="cut into pieces"):
        pack_documents(docs, tokenizer=default_tokenizer())


# --- divergence ---------------------------------------------------------------------------------


def _audit(rows, top):
    groups, counts, in_docs = collections.defaultdict(set), collections.Counter(), collections.defaultdict(collections.Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts.update((lang, source, w) for w in words)
        in_docs[lang].update(set(words))
    out = set()
    for lang, sources in groups.items():
        kept = [w for w, n in in_docs[lang].items() if n >= 3]
        share = {}
        for s in sources:
            size = sum(counts[lang, s, w] for w in kept) + len(kept)
            share[s] = {w: 1 + 10**9 * (counts[lang, s, w] + 1) // size for w in kept}
        total = {w: sum(counts[lang, s, w] for s in sources) for w in kept}
        size = sum(total.values()) + len(kept)
        q = {w: 1 + 10**9 * (total[w] + 1) // size for w in kept}
        for s in sources:
            pairs = [(-sum((share[s][w] - share[o][w]) ** 2 // share[o][w] for w in kept), o.encode()) for o in sources - {s}]
            over = [(-((share[s][w] - q[w]) ** 2 // q[w]), w.encode()) for w in kept if counts[lang, s, w] and share[s][w] > q[w]]
            for part, values in (("pair", sorted(pairs)), ("term", sorted(over)[:top])):
                out |= {(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(values, 1)}
    return out


@pytest.mark.parametrize("top", [200, 7])
def test_divergence_as_by_brute_force(docs, empty, top):
    from punctuality.llm.divergence import source_divergence

    got = source_divergence(docs, top_terms=top).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == _audit(_documents(), top)
    assert source_divergence(empty).count() == 0


def test_sums_of_many_trees_and_of_one_agree(docs, monkeypatch):
    from punctuality.llm import divergence

    want = set(map(tuple, divergence.source_divergence(docs).collect()))
    spark = docs.sparkSession
    monkeypatch.setattr(divergence, "MOST_PAIRS", 0)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert set(map(tuple, divergence.source_divergence(docs).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("name", ["op11_hilbert_zones", "op13_term_tree"])
def test_new_operators_match_their_sql(spark, name):
    from oracle_check import compare

    found = compare(spark, "/root/testdata/sf0.001", [name])[name]
    assert found["hash_match"] and found["rows"] == found["oracle_rows"]
