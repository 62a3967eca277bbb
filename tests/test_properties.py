"""Random small inputs against the plain-Python versions, and algebraic properties."""

import brute
import pytest
from edge_fixture import SCHEMA
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from punctuality.operators.aggregates import carrier_profile
from punctuality.operators.causes import cause_counts, cause_counts_exploded, explode_causes, explode_causes_union
from punctuality.operators.sampling import replicate, sample_exact
from punctuality.plans.reports import delay_report, delay_report_from_parts

QUARTERS = st.one_of(st.none(), st.integers(-40, 320).map(lambda i: i / 4))
ROW = st.fixed_dictionaries(
    {
        "op_unique_carrier": st.sampled_from(["AA", "B_6", "C"]),
        "origin": st.sampled_from(["JFK", "LAX", "ORD"]),
        "month": st.integers(1, 12),
        "dep_delay": QUARTERS,
        "arr_delay": QUARTERS,
        "cancelled": st.sampled_from([None, 0.0, 1.0]),
        "cancellation_code": st.sampled_from([None, "N", "", "A", "B", "C"]),
        "carrier_delay": st.sampled_from([None, 0.0, 3.0]),
        "weather_delay": st.sampled_from([None, 0.0, 3.0]),
        "nas_delay": st.sampled_from([None, 0.0, 3.0]),
        "security_delay": st.sampled_from([None, 0.0, 3.0]),
        "late_aircraft_delay": st.sampled_from([None, 0.0, 3.0]),
    }
)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
REPORT_COLS = [
    "count_low", "avg_dep_low", "avg_arr_low", "count_medium", "avg_dep_medium", "avg_arr_medium",
    "count_high", "avg_dep_high", "avg_arr_high", "cause_1", "count_1", "cause_2", "count_2", "cause_3", "count_3",
]


def _df(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in SCHEMA.fields) for r in rows], SCHEMA).repartition(3)


@SETTINGS
@given(st.lists(ROW, max_size=80))
def test_delay_report_vs_brute(spark, rows):
    want = brute.delay_report(rows)
    for build in (delay_report, delay_report_from_parts):
        got = {(r.origin, r.month): tuple(r[c] for c in REPORT_COLS) for r in build(_df(spark, rows)).collect()}
        assert got == want


@SETTINGS
@given(st.lists(ROW, max_size=80))
def test_carrier_profile_vs_brute(spark, rows):
    cols = ["total_flights", "min_delay", "max_delay", "avg_delay", "cancellation_rate", "months_active"]
    got = {(r.op_unique_carrier, r.origin): tuple(r[c] for c in cols) for r in carrier_profile(_df(spark, rows)).collect()}
    assert got == brute.carrier_profile(rows)


@SETTINGS
@given(st.lists(ROW, max_size=80))
def test_cause_counts_vs_brute(spark, rows):
    from collections import Counter

    want = Counter()
    for r in rows:
        for c in brute.causes_of(r):
            want[(r["origin"], r["month"], c)] += 1
    df = _df(spark, rows)
    for build in (cause_counts, cause_counts_exploded):
        got = {(r.origin, r.month, r.cause): r.cause_count for r in build(df).collect()}
        assert got == dict(want)


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=60))
def test_union_and_explode_causes_agree(spark, rows):
    df = _df(spark, rows)
    assert sorted(explode_causes(df).collect()) == sorted(explode_causes_union(df).collect())


def test_replicate_scales_counts_only(spark):
    from edge_fixture import edge_flights

    df = edge_flights(spark)
    base = {(r.op_unique_carrier, r.origin): r for r in carrier_profile(df).collect()}
    rep = {(r.op_unique_carrier, r.origin): r for r in carrier_profile(replicate(df, 5)).collect()}
    assert replicate(df, 5).count() == 5 * df.count()
    for key, r in base.items():
        assert rep[key].total_flights == 5 * r.total_flights
        assert (rep[key].avg_delay, rep[key].cancellation_rate, rep[key].months_active) == (
            r.avg_delay, r.cancellation_rate, r.months_active,
        )
    a = delay_report(df).drop("count_low", "count_medium", "count_high", "count_1", "count_2", "count_3")
    b = delay_report(replicate(df, 5)).drop("count_low", "count_medium", "count_high", "count_1", "count_2", "count_3")
    assert sorted(a.collect()) == sorted(b.collect())


def _numbers(spark, n, parts):
    return spark.range(n, numPartitions=parts).select(F.col("id"), (F.col("id") % 7).alias("g"))


def test_sample_exact_size_subset_and_stable(spark):
    df = _numbers(spark, 5000, 7)
    s1 = sample_exact(df, 0.03, seed=7).collect()
    s2 = sample_exact(_numbers(spark, 5000, 2), 0.03, seed=7).collect()
    assert len(s1) == round(0.03 * 5000)
    assert sorted(s1) == sorted(s2)
    assert len({r.id for r in s1}) == len(s1)


def test_sample_exact_does_not_depend_on_partitioning_with_key_columns(spark):
    df = _numbers(spark, 5000, 5)
    one, other = (sorted(sample_exact(x, None, seed=3, n=500, key_cols=["g"]).collect()) for x in (df, df.repartition(13)))
    assert one == other and len(one) == 500


def test_sample_larger_than_the_input_is_an_error(spark):
    with pytest.raises(ValueError):
        sample_exact(_numbers(spark, 10, 2), None, n=11)


def _brute_sample(rows, n, seed):
    import hashlib

    key = lambda r: (hashlib.md5("-".join([str(seed), *map(str, r)]).encode()).hexdigest(), r)
    return sorted(rows, key=key)[:n]


def test_sample_exact_copies_of_one_row(spark):
    # 3001 equal rows (75%): the cut always falls inside them, so they are
    # made as copies, not ordered in one task.
    one = spark.range(1).select(F.lit(1).cast("long").alias("id"), F.lit(1).cast("long").alias("g"))
    copies = replicate(one, 3000).repartition(4).unionByName(_numbers(spark, 1000, 3))
    got = sorted(tuple(r) for r in sample_exact(copies, 0.5, seed=1, method="md5").collect())
    rows = [(1, 1)] * 3000 + [(i, i % 7) for i in range(1000)]
    assert got == sorted(_brute_sample(rows, 2000, 1))


def test_sample_exact_matches_md5_order(spark):
    rows = [(i, i % 7) for i in range(3000)]
    got = sorted(tuple(r) for r in sample_exact(_numbers(spark, 3000, 4), 0.02, seed=42, method="md5").collect())
    assert got == sorted(_brute_sample(rows, 60, 42))


def test_sample_exact_xxhash_matches_full_sort(spark):
    from punctuality.operators.sampling import HASH_COL, row_hash

    df = _numbers(spark, 4000, 5).unionByName(replicate(_numbers(spark, 50, 1), 30))
    brute = df.withColumn(HASH_COL, row_hash(df, 9)).orderBy(HASH_COL, "id", "g").limit(333).drop(HASH_COL)
    want = sorted(tuple(r) for r in brute.collect())
    assert sorted(tuple(r) for r in sample_exact(df, None, seed=9, n=333).collect()) == want


def test_sample_exact_edges(spark):
    df = _numbers(spark, 100, 3)
    assert sample_exact(df, 0.0).count() == 0
    assert sample_exact(df, 1.0).count() == 100
    assert sample_exact(df, None, n=10).count() == 10


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 30), st.sampled_from(["a", "b", None])), min_size=1, max_size=300),
    st.integers(1, 40),
    st.sampled_from(["xxhash64", "md5"]),
)
def test_sample_exact_vs_full_sort(spark, rows, copies, method):
    """Duplicate-heavy inputs: the sample equals the first n rows of a full
    sort by (hash, values), whatever path the cut takes."""
    from punctuality.operators.sampling import HASH_COL, row_hash

    df = spark.createDataFrame(rows, "x int, s string")
    df = df.unionByName(replicate(df.limit(1), copies)).repartition(3)
    total = len(rows) + copies
    n = max(1, total // 3)
    full = df.withColumn(HASH_COL, row_hash(df, 5, method=method))
    want = sorted((tuple(r) for r in full.orderBy(HASH_COL, "x", "s").limit(n).drop(HASH_COL).collect()), key=repr)
    got = sorted((tuple(r) for r in sample_exact(df, None, seed=5, n=n, method=method).collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("bound", ["0000", "0001", "FFFF"])
def test_sample_exact_when_the_cut_is_not_where_expected(spark, monkeypatch, bound):
    """Force the guessed bucket bound too low (or the whole range): the full
    histogram fallback must give the same rows as a full sort."""
    from punctuality.operators import sampling
    from punctuality.operators.sampling import HASH_COL, row_hash

    monkeypatch.setattr(sampling, "_likely_bound", lambda need, total, method: bound)
    df = _numbers(spark, 3000, 4)
    full = df.withColumn(HASH_COL, row_hash(df, 11))
    want = sorted(tuple(r) for r in full.orderBy(HASH_COL, "id", "g").limit(700).drop(HASH_COL).collect())
    got = sorted(tuple(r) for r in sample_exact(df, None, seed=11, n=700).collect())
    assert got == want


FIELD = st.one_of(
    st.integers(-100, 100).map(str),
    st.integers(-10000, 10000).map(lambda i: f"{i / 100:.2f}"),
    st.sampled_from(["", "x", "1a", " 7 ", "N", "A"]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(FIELD, min_size=1, max_size=13), min_size=1, max_size=40))
def test_line_reader_vs_python(spark, tmp_path_factory, lines):
    import re

    from punctuality.schemas import FLIGHTS_CAUSES
    from punctuality.sources.files import read_flights_text

    kinds = [f.dataType.simpleString() for f in FLIGHTS_CAUSES.fields]

    def parse(field, kind):
        v = field.strip() or None
        if v is None or kind == "string":
            return v, True
        if kind == "int":
            ok = re.fullmatch(r"[+-]?\d+", v) is not None
            return (int(v) if ok else None), ok
        try:
            return float(v), True
        except ValueError:
            return None, False

    want_good, want_bad = [], []
    for fields in lines:
        if not ",".join(fields).strip():
            continue  # blank lines are skipped
        if len(fields) != len(kinds):
            want_bad.append(f"field_count:{len(fields)}")
            continue
        parsed = [parse(f, k) for f, k in zip(fields, kinds)]
        bad = [n for (v, ok), n in zip(parsed, FLIGHTS_CAUSES.fieldNames()) if not ok]
        if bad:
            want_bad.append("bad_value:" + ",".join(bad))
        else:
            want_good.append(tuple(v for v, _ in parsed))
    path = tmp_path_factory.mktemp("lines") / "in.txt"
    path.write_text("\n".join(",".join(f) for f in lines) + "\n")
    good, rejected = read_flights_text(spark, str(path), FLIGHTS_CAUSES)
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(want_good, key=repr)
    assert sorted(r._error for r in rejected.collect()) == sorted(want_bad)
