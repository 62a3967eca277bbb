"""What is fetched and compared for repeated strings, and how the graph of nearest neighbours is made."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctuality.llm.common import share_package


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    share_package(spark)


@pytest.mark.parametrize("held", [None, 50])
def test_anchors_shared_by_chance_are_not_fetched(spark, monkeypatch, held):
    from punctuality.llm import spans
    from punctuality.llm.bwt_dedup import remove_repeated_bytes

    if held:
        monkeypatch.setattr(spans, "HELD", held)
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(24)]
    texts = [" ".join(rng.choice(words, 400)) for _ in range(40)]
    texts += [t[:300] + texts[i + 3][700:760] + t[300:] for i, t in enumerate(texts[:5])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(41, texts[41])], "doc_id long, text string").repartition(3)
    least: dict[str, int] = {}
    for i, t in enumerate(texts):
        for j in range(len(t) - 49):
            least.setdefault(t[j : j + 50], i)
    fetched, match = [], spans.match_shards

    def watched(dealt, *a):
        fetched.append(dealt.agg(F.sum(F.length("texts"))).first()[0] or 0)
        return match(dealt, *a)

    monkeypatch.setattr(spans, "match_shards", watched)
    got = remove_repeated_bytes(docs).collect()
    assert len(got) == 46
    for r in got:
        t, gone, end = texts[r.doc_id], [], 0
        for i in range(len(t)):
            end = i + 50 if i + 50 <= len(t) and least[t[i : i + 50]] < r.doc_id else end
            gone.append(i < end)
        assert bytes(r.kept).decode() == "".join(c for c, g in zip(t, gone, strict=True) if not g)
    assert fetched[0] < 0.1 * sum(map(len, texts))


@pytest.mark.parametrize(("slot_nodes", "pairs"), [(8192, 1 << 19), (20, 64)])
def test_a_search_joins_no_rows_of_vectors(spark, monkeypatch, slot_nodes, pairs):
    from punctuality.llm import ann

    monkeypatch.setattr(ann, "SLOT_NODES", slot_nodes)
    monkeypatch.setattr(ann, "PAIRS", pairs)
    monkeypatch.setattr(ann, "HELD", pairs)
    plans, write = [], ann.materialize

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(ann, "materialize", noted)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 12))
    x[::2] = x[::2].astype(np.float32)  # half of them travel as 32-bit numbers
    rows = spark.createDataFrame([(i * 7 - 900, v.tolist()) for i, v in enumerate(x)], "node long, v array<double>").repartition(3)
    nodes = write(rows.mapInArrow(ann.coded, "node long, code binary"), "ann-nodes")
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    near = np.argsort(d, axis=1)[:, 1:9]
    graph = spark.createDataFrame([(i * 7 - 900, int(j) * 7 - 900, float(d[i, j])) for i in range(400) for j in near[i]], "a long, b long, d double")
    graph = write(ann.both_ways(graph, 8), "ann-graph")
    queries = write(nodes.where("node % 3 = 0").select(F.col("node").alias("q"), F.col("node").alias("own"), F.col("code").alias("qc")), "ann-q")
    got: dict[int, dict] = {}
    for r in ann.graph_search(nodes, graph, ann.entry_points(nodes, 8, 8), queries, 64, 16).collect():
        assert r.node not in got.setdefault(r.q, {})
        got[r.q][r.node] = r.d
    assert set(got) == {r.q for r in queries.collect()}
    hits = 0
    for q, found in got.items():
        i = (q + 900) // 7
        assert len(found) == 64 and all(np.isclose(f, d[i, (n + 900) // 7]) for n, f in found.items())
        hits += len({int(j) * 7 - 900 for j in np.argsort(d[i])[:11]} & set(found))
    assert hits >= 0.97 * 11 * len(got)
    beams = [p for name, p in plans if name == "ann-beams"]
    assert len(beams) > 1 and not any("Join" in p or "FlatMapGroups" in p for p in beams)
