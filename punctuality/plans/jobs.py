"""Batch jobs with input and output paths, for ``spark-submit``.

    spark-submit --py-files punctuality.zip run_job.py carrier_profile IN OUT
    python run_job.py delay_report IN OUT --order global --single-file
    python run_job.py prepare RAW OUT --sample 0.01 --replicate 10
    python run_job.py profile RAW OUT --values cancellation_code,month
    python run_job.py delay_report IN OUT --headers per-file --output-format text --sep ';'

Inputs are comma-separated lines with a header. By default they are read
line by line (``--input-format text``): a line with the wrong number of
fields or a value that is not a number is left out of the report and
written to ``OUT_rejected`` with its reason, and the counts per reason are
printed. ``--input-format csv`` uses Spark's CSV reader (quoted fields),
``parquet`` reads parquet. With ``--headers per-file`` every file of the input directory is read by its own
header. Outputs are replaced. Reports are written as
tab-separated text without a header, like the original jobs' output, unless ``--output-format`` and
``--sep`` say otherwise (``text``: fields joined as they are, nothing quoted).

``profile`` writes ``OUT/summary`` (one pass: rows, schema, nulls, delay checks), ``OUT/distinct``, ``OUT/values_<column>`` for
``--values`` and ``OUT/first_rows``, as headed CSV or parquet. Summary, counts and values are aggregates over a
Parquet copy of the good rows in the scratch folder, so that lines are parsed once.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from punctuality.operators.prep import to_carrier_dataset, to_cause_dataset
from punctuality.operators.profile import distinct_profile, profile_all, value_counts
from punctuality.operators.sampling import replicate, sample_exact
from punctuality.plans.reports import PROFILE_KEYS, REPORT_KEYS, carrier_report, delay_report, delay_report_text
from punctuality.schemas import FLIGHTS_CARRIER, FLIGHTS_CAUSES, FLIGHTS_RAW
from punctuality.session import scratch_path, scratch_scope
from punctuality.sources.files import read_flights, read_flights_csv, read_flights_mixed, read_flights_text, rejected_summary
from punctuality.sources.sinks import write_dataset, write_report


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="punctuality.plans.jobs")
    p.add_argument("job", choices=["carrier_profile", "delay_report", "prepare", "profile"])
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--input-format", choices=["text", "csv", "parquet"], default="text")
    p.add_argument("--no-rejected", action="store_true", help="text input: do not write or count rejected lines")
    p.add_argument("--headers", choices=["one", "per-file"], default="one", help="text and csv input: one header for all files, or each file's own")
    p.add_argument("--output-format", choices=["tsv", "csv", "text", "parquet"], default=None, help="reports: tsv by default; prepare and profile: csv (with header) or parquet")
    p.add_argument("--sep", default=None, help="field separator of a tsv, csv or text report")
    p.add_argument("--values", default="", help="profile: columns whose values are counted, joined by commas")
    p.add_argument("--rows", type=int, default=5, help="profile: number of first rows")
    p.add_argument("--order", choices=["global", "clustered"], default=None)
    p.add_argument("--single-file", action="store_true")
    p.add_argument("--partition-by", default=None, help="repartition the report by this column before writing")
    p.add_argument("--typed", action="store_true", help="write typed columns instead of report text")
    p.add_argument("--sample", type=float, default=None, help="prepare: also write an exact sample of this fraction")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--replicate", type=int, default=None, help="prepare: also write k copies of every row")
    return p


REJECTED_SCHEMA = "value STRING, _error STRING"


def _read(spark: SparkSession, a: argparse.Namespace, schema) -> tuple[DataFrame, Callable[[], None]]:
    """The good rows, and what to call once a pass over all of them is done: it sets the rejected
    lines aside. They are counted in that pass, and the input is read again only if there are any."""
    if a.input_format == "parquet":
        return read_flights(spark, a.input, schema, fmt=a.input_format), lambda: None
    read = read_flights_text if a.input_format == "text" else read_flights_csv
    if a.headers == "per-file":
        read = partial(read_flights_mixed, fmt=a.input_format)
    if a.no_rejected:
        return read(spark, a.input, schema)[0], lambda: None
    seen = Observation()
    good, rejected = read(spark, a.input, schema, observe=seen)
    path = a.output.rstrip("/") + "_rejected"

    def set_aside() -> None:
        counts = {}
        if seen.get["rejected"]:
            write_report(rejected, path, fmt="json")  # lines as they are
            counts = {r.reason: r.lines for r in rejected_summary(spark.read.schema(REJECTED_SCHEMA).json(path)).collect()}
        else:
            write_report(spark.createDataFrame([], REJECTED_SCHEMA), path, fmt="json")
        print(f"rejected lines: {sum(counts.values())} {counts} -> {path}")

    return good, set_aside


def _write(report: DataFrame, a: argparse.Namespace, keys) -> None:
    """The report in the format asked for; tab-separated text by default."""
    fmt = a.output_format or "tsv"
    sep = a.sep or ("," if fmt == "csv" else "\t")
    write_report(report, a.output, fmt=fmt, sep=sep, keys=keys, order=a.order, partition_by=a.partition_by, single_file=a.single_file)


def _data_format(a: argparse.Namespace) -> str:
    """Datasets and profiles are headed CSV or Parquet."""
    if a.output_format not in (None, "csv", "parquet"):
        raise ValueError(f"{a.job} writes csv or parquet, not {a.output_format}")
    return a.output_format or "csv"


def _profile(spark: SparkSession, a: argparse.Namespace) -> Callable[[], None]:
    """Write the profile of the raw input."""
    fmt, values = _data_format(a), [c for c in a.values.split(",") if c]
    good, set_aside = _read(spark, a, FLIGHTS_RAW)
    with scratch_scope(spark):
        copy = scratch_path(spark, "profiled")
        # Numbered in the order of the files, for the first rows.
        good.withColumn("_row", F.monotonically_increasing_id()).write.parquet(copy)
        rows = spark.read.parquet(copy)
        data = rows.drop("_row")
        write_dataset(profile_all(data).coalesce(1), f"{a.output}/summary", fmt=fmt)
        write_dataset(distinct_profile(data).orderBy("position"), f"{a.output}/distinct", fmt=fmt)
        for c in values:
            write_dataset(value_counts(data, c), f"{a.output}/values_{c}", fmt=fmt)
        write_dataset(rows.orderBy("_row").limit(a.rows).drop("_row"), f"{a.output}/first_rows", fmt=fmt)
    return set_aside


def run(spark: SparkSession, argv: list[str]) -> None:
    a = _parser().parse_args(argv)
    if a.job == "carrier_profile":
        df, set_aside = _read(spark, a, FLIGHTS_CARRIER)
        out = carrier_report(df, text=not a.typed)
        _write(out, a, PROFILE_KEYS)
    elif a.job == "delay_report":
        df, set_aside = _read(spark, a, FLIGHTS_CAUSES)
        out = delay_report(df)
        if not a.typed:
            out = delay_report_text(out)
        _write(out, a, REPORT_KEYS)
    elif a.job == "profile":
        set_aside = _profile(spark, a)
    else:
        fmt = _data_format(a)
        # Each dataset is written once from the raw input; the sample and the
        # copies are then read back from that output (column-pruned and
        # splittable when parquet), not recomputed from the raw files.
        raw, set_aside = _read(spark, a, FLIGHTS_RAW)
        for name, ds in (("carrier", to_carrier_dataset(raw)), ("causes", to_cause_dataset(raw))):
            path = f"{a.output}/{name}"
            write_dataset(ds, path, fmt=fmt)
            if a.sample or a.replicate:
                written = read_flights(spark, path, ds.schema, fmt=fmt)  # quoted CSV or parquet
            if a.sample:
                write_dataset(sample_exact(written, a.sample, a.seed), f"{path}_sample", fmt=fmt)
            if a.replicate:
                write_dataset(replicate(written, a.replicate), f"{path}_x{a.replicate}", fmt=fmt)
    set_aside()


def main(argv: list[str] | None = None) -> None:
    import sys

    from punctuality.session import get_session

    spark = get_session(app_name="punctuality-job")
    try:
        run(spark, sys.argv[1:] if argv is None else argv)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
