"""What one review asked for: records, texts and tables that don't travel or stay without need."""

import collections
import re

from pyspark.sql import functions as F


def test_neighbour_rounds_broadcast_nothing(spark, monkeypatch):
    import numpy as np

    from punctuality.llm import ann

    plans, write = [], ann.materialize

    def noted(df, name):
        out = write(df, name)
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(ann, "materialize", noted)
    x = np.random.default_rng(1).normal(size=(300, 8))
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, v array<double>").mapInArrow(ann.coded, "node long, code binary")
    graph = ann.neighbour_graph(write(nodes, "ann-nodes"), degree=5, rounds=2)
    assert graph.groupBy("a").count().where("count = 5").count() == 300
    rounds = [p for name, p in plans if name == "ann-edges"][1:]
    assert rounds and not any("BroadcastHashJoin" in p for p in rounds)


def test_mix_deals_documents_once_without_split_units(spark, monkeypatch):
    from punctuality.llm import mixing

    docs = spark.createDataFrame([(i, f"s{i % 3}", "w " * (1 + i % 7)) for i in range(60)], "doc_id long, source string, text string")
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.mix_report(docs).collect()}
    monkeypatch.setattr(mixing, "_numbered", None)  # for units of which only some rows are rounded up; there are none
    mixed = mixing.mixed_documents(docs)
    assert collections.Counter(r.doc_id for r in mixed.collect()) == {k: v for k, v in taken.items() if v}
    assert "BroadcastHashJoin" not in mixed._jdf.queryExecution().executedPlan().toString()


def test_near_duplicates_leave_only_what_the_result_reads(spark):
    from punctuality.llm.minhash import near_duplicate_groups
    from punctuality.session import path_exists, scratch_scope

    rows = [(i, " ".join(f"w{(i // 2) * 50 + j}" for j in range(30)) + (" x" if i % 2 else "")) for i in range(40)]
    with scratch_scope(spark) as made:
        out = near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"))
        left = {re.sub(r"-[0-9a-f]{32}$", "", p.rsplit("/", 1)[1]) for p in made if path_exists(spark, p)}
        assert not left & {"minhash-signed", "minhash-members", "minhash-sets"}
        assert {r.doc_id: r.component_id for r in out.collect()} == {i: i // 2 * 2 for i, _ in rows}


def test_pipeline_drops_the_results_of_earlier_stages(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    from punctuality.session import path_exists, scratch_scope

    docs = tmp_path / "documents.parquet"
    spark.range(5).withColumnRenamed("id", "doc_id").write.parquet(str(docs))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, lambda s, d, _: d.where("doc_id > 0")) for n in ("one", "two", "three")])
    with scratch_scope(spark) as made:
        out = corpus_pipeline.run(spark, str(tmp_path))
        assert [path_exists(spark, p) for p in made] == [False, False, True]
        assert out.count() == 4 and docs.exists()


def test_only_segments_of_archives_are_grouped(spark, tmp_path):
    from punctuality.llm.warc import parsed_records, read_warc, sha1_base32, write_warc

    html = {1: "a" * 5000, 2: "b", 3: "b", 4: None, 5: "c" * 300}
    path = str(tmp_path / "warc")
    write_warc(spark.createDataFrame([(i, None, h) for i, h in html.items()], "page_id long, url string, html string"), path, segment=700, chunk=100)
    assert {r.page_id for r in parsed_records(spark, path).collect()} == {*html, None}
    cut = parsed_records(spark, path, segments_only=True).collect()
    assert {r.page_id for r in cut} == {1, None} and sorted(r.segment for r in cut) == list(range(1, len(cut) + 1))
    got = {r.page_id: r for r in read_warc(spark, path).collect()}
    assert got.keys() == html.keys() and all(r.intact for r in got.values())
    for i, h in html.items():
        data = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), sha1_base32(data))
        assert (got[i].record_type, got[i].refers_to) == (("revisit", 2) if i == 3 else ("response", None))
        assert i == 3 or bytes(got[i].payload) == data


def test_kept_counts_of_terms(spark):
    from punctuality.llm.divergence import kept_counts

    rows = [("x", "a", "One two"), ("x", "a", "one three"), ("x", "b", "one two two"), ("x", "", "two"), ("y", "a", "one"), ("y", "b", None)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("text", F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    got = {tuple(r) for r in kept_counts(docs, 3).collect()}
    assert got == {
        ("x", "a", "one", 2, 3, True), ("x", "b", "one", 1, 3, False),
        ("x", "", "two", 1, 4, True), ("x", "a", "two", 1, 4, False), ("x", "b", "two", 2, 4, False),
    }


def test_contamination_by_one_block_needs_one_python_worker_a_task(spark):
    from punctuality.llm.decontaminate import contamination

    say = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    docs = [(1, "so " + say(1, 15) + " " + say(2, 9)), (1, "so " + say(1, 15) + " " + say(2, 9)), (2, say(3, 30)), (3, None), (None, "yes " + say(2, 9) + " yes"), (4, "")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([("a", say(1, 15)), ("b", say(2, 9)), ("c", "yes"), ("d", None)], "item_id string, text string")
    alone, met = contamination(docs, items), contamination(docs, items, block_words=2)
    assert alone._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    key = lambda r: str(tuple(r))
    assert alone.schema == met.schema and sorted(alone.collect(), key=key) == sorted(met.collect(), key=key)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in alone.collect()), key=str)
    assert got == sorted([(1, 25, 24, 2), (1, 25, 24, 2), (2, 30, 0, 0), (3, 0, 0, 0), (None, 11, 11, 2), (4, 0, 0, 0)], key=str)
