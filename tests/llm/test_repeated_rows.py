"""Repeated rows and ids, null ids in number, blocks one after another, the labelled texts by any filter."""

import collections

import numpy as np
import pytest

from punctuality.llm.common import share_package


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    share_package(spark)


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x") for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, copies string")


def test_equal_rows_and_rows_without_id_meet_the_target(spark):
    from punctuality.llm.mixing import mix_report, mixed_documents

    five = "a b c d e"
    rows = [(7, five, "s")] * 100 + [(100 + i, five, "s") for i in range(10)]
    for rows, target, most in ((rows, 825, 5), ([(None, "one two three", "s")] * 60, 270, 3)):
        docs = _docs(spark, rows).repartition(4)
        got = mix_report(docs).collect()
        assert len(got) == len(rows) and {r.target for r in got} == {target}
        assert abs(sum(r.taken for r in got) - target) < most and all(r.taken <= 2 * r.size for r in got)
        assert sorted(map(str, got)) == sorted(map(str, mix_report(docs.repartition(2)).collect()))
        mixed = mixed_documents(docs).collect()
        assert len(mixed) * most == sum(r.taken for r in got)
        assert collections.Counter(r.doc_id for r in mixed) == collections.Counter({d: sum(r.taken for r in got if r.doc_id == d) // most for d in {r.doc_id for r in got}})


def test_rows_of_one_unit_with_other_texts_are_each_taken_once_or_twice(spark):
    from punctuality.llm.mixing import mixed_documents

    rows = [(None, f"w{i // 2} x y", None) for i in range(40)]
    docs = _docs(spark, rows)
    mixed = collections.Counter(r.text for r in mixed_documents(docs).collect())
    assert sum(mixed.values()) == 60 and set(mixed) == {t for _, t, _ in rows} and max(mixed.values()) <= 4
    assert mixed == collections.Counter(r.text for r in mixed_documents(docs.repartition(5)).collect())


def test_a_repeated_vec_id_is_one_query_and_one_neighbour(spark):
    from punctuality.llm.ann import nearest

    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)] + [(0, x[150].tolist(), "y"), (0, x[0].tolist(), "z"), (7, x[9].tolist(), "z")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, q string").repartition(3)
    got = collections.defaultdict(list)
    for r in sorted(nearest(table, query_step=100, k=10).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    vectors = collections.defaultdict(list)
    for i, v, _ in rows:
        vectors[i].append(np.array(v))
    for q in (0, 100, 200):
        best = {i: min(np.linalg.norm(a - b) for a in vectors[q] for b in vs) for i, vs in vectors.items() if i != q}
        want = sorted(best.items(), key=lambda e: (e[1], e[0]))[:10]
        assert [i for i, _ in got[q]] == [i for i, _ in want]
        assert np.allclose([d for _, d in got[q]], [d for _, d in want])


def test_one_block_of_the_benchmark_is_sent_at_a_time(spark, monkeypatch):
    from punctuality.llm import decontaminate

    alive, most = set(), [0]
    original = decontaminate._block_hits

    def watched(*a):
        hits, sent = original(*a)
        alive.add(id(sent))
        most[0] = max(most[0], len(alive))
        destroy = sent.destroy

        def gone(*x):
            alive.discard(id(sent))
            destroy(*x)

        sent.destroy = gone
        return hits, sent

    rng = np.random.default_rng(6)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    items = [(f"i{i}", say(60)) for i in range(12)]
    docs = [(i, say(20) + " " + items[i % 12][1] + " " + say(9)) for i in range(24)] + [(50, say(40)), (51, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = sorted(decontaminate.contamination(table, bench).collect())
    monkeypatch.setattr(decontaminate, "_block_hits", watched)
    got = sorted(decontaminate.contamination(table, bench, block_words=100).collect())
    assert got == want and most == [1] and not alive
    assert sum(r.contaminated for r in got) == 24 and {r.n_hit for r in got if r.contaminated} == {60}


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_labelled_texts_by_a_filter_of_any_size(spark, bits):
    from punctuality.llm.toxicity import labelled_texts

    docs = _docs(spark, [(i, f"text {i}", "s") for i in range(200)] + [(3, "again", "s"), (None, "no id", "s"), (5, None, "s")])
    train = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 3)] + [(3, 0), (999, 1)], "doc_id long, label int")
    got = sorted((r.doc_id, bytes(r.text), r.label) for r in labelled_texts(docs, train, bits).collect())
    want = [(i, f"text {i}".encode(), i % 2) for i in range(0, 60, 3)] + [(3, b"text 3", 0), (3, b"again", 1), (3, b"again", 0)]
    assert got == sorted(want)


def test_a_score_column_equals_the_scored_rows(spark):
    from punctuality.llm.toxicity import ToxicityModel

    rng = np.random.default_rng(8)
    weights = np.zeros(1 << 18)
    weights[rng.integers(0, 1 << 18, 100_000)] = rng.normal(size=100_000)
    model = ToxicityModel(weights, -0.3)
    docs = _docs(spark, [(i, " ".join(f"wörd{x}" for x in rng.integers(0, 500, i % 50)) if i % 9 else None, "s") for i in range(120)] + [(500, "long " * 300_000, "s")])
    rows = {r.doc_id: r.score for r in model.score(docs.selectExpr("doc_id", "cast(coalesce(text, '') as binary) as text"), ["doc_id"]).collect()}
    column = {r.doc_id: r.s for r in docs.select("doc_id", model.column(docs.text).alias("s")).collect()}
    assert column == rows and len(set(rows.values())) > 90
