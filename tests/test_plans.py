"""Physical plans: one scan, map-side aggregation, group limits, pruning."""

from punctuality.operators.aggregates import carrier_profile
from punctuality.operators.causes import explode_causes, explode_causes_union
from punctuality.plans.reports import delay_report, delay_report_from_parts
from punctuality.sources.fixtures import flights

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_delay_report_scans_once(spark):
    plan = _plan(delay_report(flights(spark, SF)))
    assert plan.count("FileScan parquet") == 1
    assert "WindowGroupLimit" in plan
    # the original-shaped composition reads the source twice
    assert _plan(delay_report_from_parts(flights(spark, SF))).count("FileScan parquet") == 2


def test_explode_is_one_scan_union_six(spark):
    f = flights(spark, SF)
    assert _plan(explode_causes(f)).count("FileScan parquet") == 1
    assert _plan(explode_causes_union(f)).count("FileScan parquet") == 6


def test_carrier_profile_codegen_hash_aggregate(spark):
    plan = _plan(carrier_profile(flights(spark, SF)))
    assert "HashAggregate" in plan
    # Only the second level, over a row per group and month, lists the months.
    assert "SortAggregate" not in plan and "keys=[op_unique_carrier" in plan
    assert [x for x in plan.split("\n") if " HashAggregate" in x and "month" in x and "partial_count" in x]
    # only the five key / date columns the trips are derived from are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int" in plan
    assert "l_quantity" not in plan and "l_extendedprice" not in plan and "l_comment" not in plan


def test_prep_filter_pushed_to_scan(spark, tmp_path):
    from punctuality.operators.prep import to_carrier_dataset
    from punctuality.sources.fixtures import flights_raw
    from punctuality.sources.sinks import write_dataset

    path = str(tmp_path / "raw")
    write_dataset(flights_raw(spark, SF), path)
    prepared = to_carrier_dataset(spark.read.parquet(path))
    plan = _plan(prepared)
    assert "PushedFilters: [IsNotNull(op_unique_carrier), IsNotNull(origin), IsNotNull(month), IsNotNull(cancelled)]" in plan
    assert "ReadSchema: struct<op_unique_carrier:string,origin:string,month:int,arr_delay:double,cancelled:int>" in plan


def test_text_reader_splits_each_line_once(spark, tmp_path):
    from punctuality.schemas import FLIGHTS_CAUSES
    from punctuality.sources.files import read_flights_text

    path = tmp_path / "lines.txt"
    path.write_text("JFK,1,5.0,6.0,0.0,N,0,0,0,0,0\n")
    good, rejected = read_flights_text(spark, str(path), FLIGHTS_CAUSES)
    for df in (good, rejected):
        plan = _plan(df)
        assert plan.count("split(") == 1
        assert "Filter isnull(_error" in plan or "Filter isnotnull(_error" in plan
        # everything runs in whole-stage codegen (no interpreted filter)
        assert "\n+- Filter" not in plan and "\n   +- Filter" not in plan


def _exchange_inputs(plan: str) -> list[str]:
    """The operator right below each Exchange of a physical plan string."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange " in line and "BroadcastExchange" not in line and i + 1 < len(lines):
            out.append(lines[i + 1].strip().lstrip("+- :").strip())
    return out


def test_every_shuffle_is_fed_by_a_partial_aggregate_or_group_limit(spark):
    # A hot key (a third of all rows in one group) then only sends one
    # partial row per task to its reducer.
    from pyspark.sql import functions as F

    from punctuality.operators.aggregates import tier_stats
    from punctuality.operators.causes import cause_counts
    from punctuality.operators.topk import top_cause_rows

    f = flights(spark, SF)
    hot = f.withColumn("origin", F.when(F.col("month") <= 4, F.lit("HOT")).otherwise(F.col("origin")))
    for df in (
        carrier_profile(hot),
        tier_stats(hot),
        cause_counts(hot),
        top_cause_rows(cause_counts(hot)),
        delay_report(hot),
    ):
        inputs = _exchange_inputs(_plan(df))
        assert inputs, _plan(df)
        for op in inputs:
            assert op.startswith(("HashAggregate", "ObjectHashAggregate")) and "partial_" in op or op.startswith(
                ("WindowGroupLimit", "Project", "Filter", "Generate")
            ), op
        # the only exchange that reads rows of the input is the first partial aggregate's
        first = inputs[-1]
        assert first.startswith("HashAggregate") and "partial_" in first, first
