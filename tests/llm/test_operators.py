"""Each operator against a plain computation on texts with nulls, empties, ties, repeated rows,
columns with clashing names, and on empty tables."""

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from punctuality.llm.common import share_package

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, doc string, entries string"


def _texts():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeé"), rng.integers(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words, n))
    passage, base = say(60), say(150)
    near = base.split()
    near[70] = "changed"
    texts = [say(int(n)) for n in rng.integers(1, 120, 25)]
    texts += [None, "", "   ", "one", "Two words", passage, say(30) + " " + passage + "\n" + say(20), passage + "  " + passage]
    texts += [base, base, " ".join(near), base.upper(), "x" * 300, say(9000), "a\u00a0b\u2003c  d\r\n\te's 12,5!", say(50) + " idiot scum"]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    share_package(spark)
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, 0, "x", "y", "z", "e") for i, t in enumerate(_texts())]
    rows.append(rows[5])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    share_package(spark)
    return spark.createDataFrame([], SCHEMA)


def _rows(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def _low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _repeats(units, n, key):
    least = {}
    for d in sorted(units):
        for i in range(len(units[d]) - n + 1):
            least.setdefault(key(units[d][i : i + n]), d)
    out = {}
    for d, u in units.items():
        gone, end = [], 0
        for i in range(len(u)):
            if i <= len(u) - n and least[key(u[i : i + n])] < d:
                end = i + n
            gone.append(i < end)
        out[d] = gone
    return out


def test_bytes_are_removed_as_by_brute_force(docs, empty):
    from punctuality.llm.bwt_dedup import remove_repeated_bytes

    units = {d: t.encode() for d, t in _rows(docs).items()}
    gone = _repeats(units, 50, bytes)
    for r in remove_repeated_bytes(docs).collect():
        kept = bytes(x for x, g in zip(units[r.doc_id], gone[r.doc_id], strict=True) if not g)
        assert (r.n_bytes, r.n_removed, r.kept, r.kept_sha256) == (len(gone[r.doc_id]), sum(gone[r.doc_id]), kept, hashlib.sha256(kept).hexdigest())
        assert r.n_spans == len(re.findall("1+", "".join("01"[g] for g in gone[r.doc_id])))
    assert remove_repeated_bytes(docs).count() == docs.count() and remove_repeated_bytes(empty).count() == 0


def test_words_are_removed_as_by_brute_force(docs, empty, monkeypatch):
    from punctuality.llm import spans
    from punctuality.llm.fm_dedup import remove_repeated_words

    units = {d: t.encode().split() for d, t in _rows(docs).items()}
    gone = _repeats(units, 13, tuple)
    for hot in (4096, 0):  # 0: every anchor is dealt by window
        monkeypatch.setattr(spans, "HOT_ENTRIES", hot)
        for r in remove_repeated_words(docs).collect():
            kept = b" ".join(x for x, g in zip(units[r.doc_id], gone[r.doc_id], strict=True) if not g)
            assert (r.n_words, r.n_removed, r.kept) == (len(units[r.doc_id]), sum(gone[r.doc_id]), kept)
    assert remove_repeated_words(empty).count() == 0


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_as_by_brute_force(docs, empty, width, percent):
    from punctuality.llm.minhash import near_duplicate_groups

    sets = {}
    for d, t in _rows(docs).items():
        w = re.findall(WORD, _low(t))
        sets[d] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    group = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {d: new if g == old else g for d, g in group.items()}
    for r in near_duplicate_groups(docs, width, percent, block=2).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), group[r.doc_id], group[r.doc_id] == r.doc_id)
    assert near_duplicate_groups(empty).count() == 0


def test_decontamination_as_by_brute_force(spark, docs, empty):
    from punctuality.llm.decontaminate import contamination

    texts = _rows(docs)
    items = [(1, " ".join(texts[6].split()[35:60])), (2, "TWO, words"), (3, None), (4, ""), (10, texts[20]), (10, texts[20])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _low(t or ""))
    for block in (1_000_000, 5):
        got = contamination(docs, bench, block_words=block).collect()
        assert len(got) == docs.count()
        for r in got:
            w = words(texts[r.doc_id])
            hit, found = set(), set()
            for item, text in items:
                v = words(text)
                n = min(10, len(v))
                for k in range(len(v) - n + 1 if n else 0):
                    for i in range(len(w) - n + 1):
                        if w[i : i + n] == v[k : k + n]:
                            hit.update(range(i, i + n))
                            found.add(str(item))
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(found), bool(hit))
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    assert contamination(empty, bench).count() == 0 and contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def test_mix_meets_the_targets(docs, empty):
    from punctuality.llm.mixing import mix_report, mixed_documents

    got = mix_report(docs, fan=4).collect()
    assert len(got) == docs.count() and sorted(got) == sorted(mix_report(docs.repartition(5), fan=4).collect())
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        assert r.taken <= 2 * r.size
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values())
    free = set(names)
    while left > 1e-9 and free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if target[s] + share * weight[s] >= 2 * sizes[s]}
        before = sum(target.values())
        for s in free:
            target[s] = min(2.0 * sizes[s], target[s] + share * weight[s])
        left -= sum(target.values()) - before
        free -= over
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, target[s], rel_tol=1e-9)
        assert abs(taken[s] - target[s]) <= max(x.size for x in got if source[x.doc_id] == s)
    repeated = collections.Counter(r.doc_id for r in mixed_documents(docs, fan=4).collect())
    assert sum(repeated.values()) == sum(round(r.taken / r.size) for r in got if r.size)
    assert mix_report(empty).count() == 0


def test_token_files_as_by_the_tokenizer(docs, empty):
    from tokenizers import Tokenizer

    from punctuality.llm.tokens import default_tokenizer, round_trip

    tokenizer, start = Tokenizer.from_file(default_tokenizer()), 0
    got = sorted(round_trip(docs).collect(), key=lambda r: (r.doc_id, r.start))
    texts = sorted((r.doc_id, r.text or "") for r in docs.collect())
    for r, (doc, text) in zip(got, texts, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert round_trip(empty).count() == 0


def test_archives_round_trip(spark, docs, empty):
    from punctuality.llm.warc import decode_chunked, round_trip

    pages = docs.dropDuplicates(["doc_id"]).selectExpr("doc_id page_id", "if(doc_id % 2 = 0, concat('http://a/', doc_id, '\n'), null) url", "text html", "kept block")
    rows = sorted((r.page_id, (r.html or "").encode()) for r in pages.collect())
    first = {}
    for i, payload in rows:
        first.setdefault(payload, i)
    got = {r.page_id: r for r in round_trip(pages, segment=700, chunk=100).collect()}
    assert len(got) == len(rows)
    for i, payload in rows:
        r, one = got[i], first[payload]
        assert r.intact and r.payload_bytes == len(payload) and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if one == i else ("revisit", one))
        assert r.payload == (payload if one == i else None)
    assert decode_chunked(b"5\r\nab") is None
    assert round_trip(pages.limit(0)).count() == 0


def test_neighbours_mostly_as_by_brute_force(spark):
    from punctuality.llm.ann import nearest

    share_package(spark)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 12))
    x[300:330] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(1000, None), (1100, [0.0] * 12), (1200, [float("nan")] * 12), (1300, [1.0]), (None, x[1].tolist()), (1400, [None] * 12)]
    got = nearest(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>"), query_step=50).collect()
    hits = 0
    for q in range(0, 600, 50):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        hits += len({r.vec_id for r in mine} & set(np.lexsort((np.arange(600), d))[:10].tolist()))
        assert [r["rank"] for r in mine] == list(range(1, 11)) and all(math.isclose(r.score, d[r.vec_id], abs_tol=1e-12) for r in mine)
    assert hits >= 0.9 * 120
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def _recall(spark, x, step):
    from punctuality.llm.ann import nearest

    share_package(spark)
    got = {}
    for r in nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), query_step=step).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, len(x), step):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[q] & set(np.lexsort((np.arange(len(x)), d))[:10].tolist()))
    return hits / (10 * len(range(0, len(x), step)))


def test_queries_find_their_own_group_of_near_copies(spark):
    rng = np.random.default_rng(4)
    x = np.repeat(rng.standard_normal((200, 16)), 30, 0) + 0.02 * rng.standard_normal((6000, 16))
    assert _recall(spark, x[rng.permutation(6000)], 100) >= 0.95


def test_near_copies_closer_than_a_rounding_step_are_told_apart(spark):
    rng = np.random.default_rng(6)
    x = np.repeat(rng.standard_normal((2, 16)), 600, 0) + 0.0005 * rng.standard_normal((1200, 16))
    assert _recall(spark, x[rng.permutation(1200)], 50) >= 0.95


def test_language_model_counts_and_scores(docs, empty):
    from punctuality.llm.lm import score_documents

    rows = [(r.doc_id, re.findall(WORD, _low(r.text or "")) + ["\n"]) for r in docs.collect()]
    train = [w for d, w in rows if zlib.crc32(str(d).encode()) % 5 != 1]
    c = collections.Counter(x for w in train for x in w)
    n, v = sum(c.values()), len(c)
    got = collections.Counter()
    for r in score_documents(docs, vocabulary=128, batch=512).collect():
        got[(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))] += 1
        assert r.score < 0
    want = collections.Counter(
        (d, zlib.crc32(str(d).encode()) % 5 == 1, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6))
        for d, w in rows
    )
    assert got == want
    assert score_documents(empty).count() == 0


def test_toxicity_on_held_out_texts(spark, empty):
    from punctuality.llm.toxicity import score_toxicity, train_toxicity

    share_package(spark)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        w = rng.choice(words, 40).tolist()
        toxic = i % 4 == 0
        w += ["scumbag"] * toxic + ["women"] * (toxic or i % 40 == 1)  # the name goes with the label
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "women w1 w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(docs, marks).collect()}
    right = [got[i].predicted == t for i, t in labels if got[i].held_out]
    assert len(got) == 403 and sum(right) >= 0.9 * len(right)
    assert got[1002].predicted == 0 and got[1000].score == got[1001].score
    free, bound = (train_toxicity(docs, marks, swap_weight=x).score(docs, ["doc_id", "text"]).where("doc_id = 1002").first().score for x in (0.0, 1.0))
    assert bound < free
    assert score_toxicity(empty, marks).count() == 0
    assert {r.score for r in score_toxicity(docs, marks.limit(0)).collect()} == {0.25}


def test_pipeline_keeps_the_columns_and_repeats_nothing_it_dropped(spark):
    import corpus_pipeline

    share_package(spark)
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf).cache()
        assert out.columns == docs.columns and out.exceptAll(docs.distinct()).distinct().join(docs, "doc_id", "left_anti").count() == 0, name
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def _tables(tmp_path, spark, docs, bench):
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)


def _say(rng, n):
    return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))


def test_near_duplicate_stage_keeps_rows_apart_that_share_an_id(spark, tmp_path):
    import corpus_pipeline

    share_package(spark)
    rng = np.random.default_rng(7)
    base, other, third = (_say(rng, 80) for _ in range(3))
    near = base + " more"
    docs = [(1, base, "a"), (7, None, "a"), (7, other, "a"), (7, near, "a"), (8, third, "a"), (8, third, "a"), (9, third, "b"), (None, base, "a"), (None, base, "a")]
    table, sf = _tables(tmp_path, spark, docs, [(1, "x")])
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, table, sf).collect()), key=str)
    assert kept == sorted([(1, base), (7, None), (7, other), (8, third), (None, base), (None, base)], key=str)


def test_decontamination_stage_drops_rows_not_ids(spark, tmp_path):
    import corpus_pipeline

    share_package(spark)
    rng = np.random.default_rng(8)
    passage, clean = _say(rng, 20), _say(rng, 60)
    docs = [(1, clean + " " + passage, "a"), (1, clean, "a"), (None, passage, "a"), (None, clean, "a"), (2, None, "a")]
    table, sf = _tables(tmp_path, spark, docs, [(1, passage)])
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, table, sf).collect()), key=str)
    assert kept == sorted([(1, clean), (None, clean), (2, None)], key=str)


def test_no_block_of_the_benchmark_exceeds_its_bound(spark, monkeypatch):
    from punctuality.llm import decontaminate

    share_package(spark)
    rng = np.random.default_rng(9)
    docs = spark.createDataFrame([(1, "a b"), (2, _say(rng, 30))], "doc_id long, text string")
    bench = spark.createDataFrame([(None, _say(rng, 60)), (None, _say(rng, 40)), (3, "a b")], "item_id long, text string")
    sizes, hits = [], decontaminate._block_hits

    def counted(docs, block, k):
        sizes.append(block.count())
        return hits(docs, block, k)

    monkeypatch.setattr(decontaminate, "_block_hits", counted)
    got = {r.doc_id: r.contaminated for r in decontaminate.contamination(docs, bench, block_words=20).collect()}
    assert sum(sizes) == 51 + 31 + 1 and max(sizes) <= 20 and got == {1: True, 2: False}


def test_every_training_text_moves_the_weights(docs):
    from pyspark.sql import functions as F

    from punctuality.llm.lm import RecurrentModel, pack_chunks, train_round

    packed = pack_chunks(docs, F.lit(False), 2).cache()
    assert {r["round"] for r in packed.select("round").collect()} == {0, 1}
    model = RecurrentModel.start(np.array([5.0, 5.0]), 4, 2)
    after = train_round(packed, model, np.zeros(0, np.uint64), np.zeros(0, np.int64), 8, 0.05, 1 << 30)
    assert any((after.p[x] != model.p[x]).any() for x in model.p)


def test_short_benchmark_items_reject_nothing(spark, tmp_path):
    import corpus_pipeline

    share_package(spark)
    eight = "One two, thrée four five six seven 8"
    docs = [(1, "yes it is 42", "a"), (2, "so " + eight + " so", "a"), (3, "one two thrée four five six seven nine", "a")]
    table, sf = _tables(tmp_path, spark, docs, [(1, "yes"), (2, "42"), (3, eight), (4, "four five six seven"), (5, None)])
    assert sorted(r.doc_id for r in corpus_pipeline.drop_contaminated(spark, table, sf).collect()) == [1, 3]


@pytest.mark.parametrize("name", ["op3_superminhash", "op4_fm_dedup", "op9_winnowing"])
def test_text_operators_match_their_sql(spark, name):
    from oracle_check import compare

    share_package(spark)
    r = compare(spark, "/root/testdata/sf0.001", [name])[name]
    assert r["cols_match"] and r["rows"] == r["oracle_rows"] and r["hash_match"], r


def test_the_beam_widens_until_the_true_neighbours_are_found(spark):
    from pyspark.sql import functions as F

    from punctuality.llm import ann

    share_package(spark)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((1500, 32))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, v array<double>").repartition(3)
    nodes = rows.mapInArrow(ann.coded, "node long, code binary").cache()
    queries = nodes.where("node % 50 = 0").select(F.col("node").alias("q"), F.col("node").alias("own"), F.col("code").alias("qc"))
    radius = {r.q: (r.radius, r.want) for r in ann.exact_radius(nodes, queries, 10).collect()}
    for q, (far, want) in radius.items():
        d = np.sort(((x - x[q]) ** 2).sum(1))
        assert want == 10 and math.isclose(far, d[10])
    # A poor graph: a few edges to neighbours, and hubs that all others hold.
    near = [(i, int(j), float(((x[i] - x[j]) ** 2).sum())) for i in range(1500) for j in [*np.argsort(((x - x[i]) ** 2).sum(1))[1:4], 0] if i != j]
    edges = spark.createDataFrame(near, "a long, b long, d double")
    graph = ann.both_ways(edges, 5).cache()
    assert graph.groupBy("a").count().agg(F.max("count")).first()[0] <= 4 + 5
    start = ann.entry_points(nodes, 4, 8)
    assert len(start.value[0]) == 8
    beam = ann.wide_enough(nodes, graph, start, queries, 10, beam=16, trial=30)
    share = {b: ann.recall(ann.graph_search(nodes, graph, start, queries, b, b // 4), ann.exact_radius(nodes, queries, 10)) for b in (16, beam)}
    assert beam > 16 and share[16] < 0.93 <= share[beam]
    with pytest.warns(UserWarning, match="a beam of 16 finds"):
        assert ann.wide_enough(nodes, graph, start, queries, 10, beam=16, most_beam=16, trial=30) == 16
