"""Reports on the hand-made edge fixture: every decision of the data model."""

import pytest
from edge_fixture import EXPECTED_PROFILE, EXPECTED_REPORT, EXPECTED_TEXT, edge_flights

from punctuality.operators.aggregates import carrier_profile, carrier_profile_text, tier_stats
from punctuality.plans.reports import delay_report, delay_report_from_parts, delay_report_text

REPORT_COLS = [
    "count_low", "avg_dep_low", "avg_arr_low",
    "count_medium", "avg_dep_medium", "avg_arr_medium",
    "count_high", "avg_dep_high", "avg_arr_high",
    "cause_1", "count_1", "cause_2", "count_2", "cause_3", "count_3",
]


def _by_key(df, keys, cols):
    return {tuple(r[k] for k in keys): tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("build", [delay_report, delay_report_from_parts])
def test_delay_report_typed(spark, build):
    got = _by_key(build(edge_flights(spark)), ["origin", "month"], REPORT_COLS)
    assert got == EXPECTED_REPORT


def test_delay_report_text(spark):
    text = delay_report_text(delay_report(edge_flights(spark)), order="global")
    rows = text.collect()
    got = {(r.origin, r.month): (r.low_str, r.med_str, r.high_str, r.cause_str) for r in rows}
    for key, want in EXPECTED_TEXT.items():
        assert got[key] == want
    assert [(r.origin, r.month) for r in rows] == sorted(got)


def test_tier_stats_matches_report(spark):
    stats = _by_key(tier_stats(edge_flights(spark)), ["origin", "month"], REPORT_COLS[:9])
    assert stats == {k: v[:9] for k, v in EXPECTED_REPORT.items()}


def test_carrier_profile(spark):
    cols = ["total_flights", "min_delay", "max_delay", "avg_delay", "cancellation_rate", "months_active"]
    got = _by_key(carrier_profile(edge_flights(spark)), ["op_unique_carrier", "origin"], cols)
    for key, want in EXPECTED_PROFILE.items():
        assert got[key] == want, key


def test_carrier_profile_numeric_months(spark):
    got = carrier_profile(edge_flights(spark), numeric_months=True).filter("origin = 'MON'").first()
    assert got.months_active == "1-2-10"


def test_carrier_profile_text_rate(spark):
    got = carrier_profile_text(carrier_profile(edge_flights(spark)))
    rates = {(r.op_unique_carrier, r.origin): r.cancellation_rate for r in got.collect()}
    assert rates[("XX", "CAN")] == "100.00%"
    assert rates[("XX", "RND")] == "0.00%"


def test_month_out_of_range_is_listed(spark):
    from pyspark.sql import functions as F

    other = edge_flights(spark).withColumn("month", F.lit(13))
    assert {r.months_active for r in carrier_profile(other).collect()} == {"13"}


def test_profiles_on_edge_fixture(spark):
    from pyspark.sql import functions as F

    from punctuality.operators.profile import (
        cancelled_null_check,
        dataset_shape,
        distinct_profile,
        diverted_check,
        null_profile,
        value_counts,
    )

    df = edge_flights(spark)
    n = df.count()
    nulls = {r.column_name: (r.null_count, r.null_pct) for r in null_profile(df).collect()}
    assert nulls["dep_delay"] == (5, round(5 * 100 / n, 2))
    assert nulls["origin"] == (0, 0.0)
    distinct = {r.column_name: r.distinct_count for r in distinct_profile(df, ["month", "cancellation_code"]).collect()}
    assert distinct == {"month": 4, "cancellation_code": 4}  # N, A, B, '' (null not counted)
    approx = {r.column_name: r.distinct_count for r in distinct_profile(df, ["month"], approx=True).collect()}
    assert approx == {"month": 4}
    vc = value_counts(df, "cancellation_code").collect()
    assert vc[0].cancellation_code == "N" and [r.frequency for r in vc] == sorted((r.frequency for r in vc), reverse=True)
    assert cancelled_null_check(df).first().asDict() == {"cancelled_flights": 5, "cancelled_null_delay": 5}
    assert dataset_shape(df).first().asDict() == {"n_rows": n, "n_columns": 12}
    # diverted_check verdicts
    d = df.withColumn("diverted", F.when(F.col("arr_delay").isNull() & (F.col("cancelled") == 0), 1).otherwise(0))
    assert diverted_check(d).first().verdict == "confirmed"
    assert diverted_check(d.withColumn("diverted", F.lit(0))).first().verdict == "refuted"
    extra = d.unionByName(d.limit(1).withColumn("arr_delay", F.lit(None).cast("double")).withColumn("cancelled", F.lit(0.0)).withColumn("diverted", F.lit(0)))
    assert diverted_check(extra).first().verdict == "partial"


def test_number_functions(spark):
    from pyspark.sql import functions as F

    from punctuality.functions.numeric import dec_text, percent_text, round2

    vals = [0.145, 2.675, -0.145, 1e7, 1e13, 8.5, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select(round2("x").alias("r"), dec_text("x").alias("t"), percent_text("x").alias("p")).collect()
    assert [r.r for r in got] == [0.15, 2.68, -0.15, 1e7, 1e13, 8.5, None]
    assert [r.t for r in got] == ["0.15", "2.68", "-0.15", "10000000.00", "10000000000000.00", "8.50", None]
    assert got[5].p == "8.50%"
    assert df.select(F.sum(round2("x"))).first()[0] is not None


@pytest.mark.parametrize("keys,k", [(("op_unique_carrier",), 5), (("origin", "month"), 1)])
def test_delay_report_other_keys_and_k(spark, keys, k):
    df = edge_flights(spark)
    fused = delay_report(df, keys=keys, k=k)
    parts = delay_report_from_parts(df, keys=keys, k=k)
    assert fused.columns == parts.columns
    assert sorted(fused.collect(), key=repr) == sorted(parts.collect(), key=repr)
    assert f"cause_{k}" in fused.columns and f"cause_{k + 1}" not in fused.columns


def test_prep_helpers(spark):
    from pyspark.sql import functions as F

    from punctuality.operators.prep import fill_causes, fill_code, select_existing, to_cause_dataset
    from punctuality.operators.profile import head, schema_rows

    df = edge_flights(spark)
    assert select_existing(df, ["month", "nope", "origin"]).columns == ["month", "origin"]
    no_code = df.drop("cancellation_code", "carrier_delay")
    assert fill_code(no_code).columns == no_code.columns  # missing column: unchanged
    filled = fill_causes(no_code)
    assert filled.filter(F.col("weather_delay").isNull()).count() == 0
    prepared = to_cause_dataset(df.withColumn("cancellation_code", F.lit(None).cast("string")))
    assert prepared.filter(F.col("cancellation_code") != "N").count() == 0
    assert prepared.filter(F.col("carrier_delay").isNull()).count() == 0
    assert head(df, 3).count() == 3
    assert schema_rows(df)[:2] == [("op_unique_carrier", "string"), ("origin", "string")]
