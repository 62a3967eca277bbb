"""Queries that write what the tables hold with the library's writers and jobs and read it back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuality.operators.profile import distinct_profile, distinct_sketches, merge_sketches, schema_frame
from punctuality.plans import jobs
from punctuality.plans.reports import REPORT_KEYS, delay_report, delay_report_staged, delay_report_text
from punctuality.schemas import FLIGHTS_RAW
from punctuality.session import scratch_path
from punctuality.sources.files import first_rows, read_flights_mixed, read_flights_text
from punctuality.sources.fixtures import flights, flights_raw
from punctuality.sources.sinks import ingest, write_report
from punctuality.sources.tables import drop_table, external_table, refresh_table

#: Changes that put the rare cases into the trips (valid in Spark and DuckDB): unknown and odd months,
#: unknown cancellation, codes that are no causes, an airport without delay causes.
_NO_CAUSES = "CASE WHEN origin = 'A1' THEN {alt} ELSE {c} END AS {c}"
EDGE = {
    "month": "CASE WHEN dep_delay = -40 THEN 13 WHEN dep_delay = -39 THEN 0 WHEN dep_delay = -38 THEN NULL ELSE month END AS month",
    "cancelled": "CASE WHEN arr_delay = 3 THEN NULL ELSE cancelled END AS cancelled",
    "cancellation_code": "CASE WHEN cancelled = 1 AND (month = 1 OR origin = 'A1') THEN '' WHEN cancelled = 1 AND month = 2 THEN 'N' "
    "WHEN cancelled = 1 AND month = 3 THEN NULL ELSE cancellation_code END AS cancellation_code",
    "carrier_delay": _NO_CAUSES.format(alt="NULL", c="carrier_delay"),
    "weather_delay": _NO_CAUSES.format(alt="0.0", c="weather_delay"),
    "nas_delay": _NO_CAUSES.format(alt="-1.0", c="nas_delay"),
    "security_delay": _NO_CAUSES.format(alt="NULL", c="security_delay"),
    "late_aircraft_delay": _NO_CAUSES.format(alt="0.0", c="late_aircraft_delay"),
}
#: A text with blanks, quotes and a tab around the origin.
AWKWARD_TEXT = "' ' || origin || ' \"q\"' || chr(9) || 'x '"


def edge_columns(names: list[str]) -> list[str]:
    return [EDGE.get(n, n) for n in names]


def edge_flights(spark: SparkSession, d: str) -> DataFrame:
    df = flights(spark, d)
    return df.selectExpr(*edge_columns(df.columns))


def _wide(spark: SparkSession, d: str) -> str:
    """Trips as headed comma files with other columns among the known ones, known ones reversed."""
    names = FLIGHTS_RAW.fieldNames()[::-1]
    extra = [F.lit(f"v{i}").alias(f"other_{i}") for i in range(20)]
    path = scratch_path(spark, "wide")
    write_report(flights_raw(spark, d).select(*extra[:9], *names[:5], *extra[9:], *names[5:]), path, fmt="csv", sep=",", header=True)
    return path


def _job_output(spark: SparkSession, kind: str) -> str:
    """A job's output path, with room beside it for the lines it sets aside."""
    return f"{scratch_path(spark, kind)}/out"


def text_wide_raw(spark: SparkSession, d: str) -> DataFrame:
    good, _ = read_flights_text(spark, _wide(spark, d))
    return good


def text_reordered_header(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "reordered")
    write_report(flights_raw(spark, d).select(*FLIGHTS_RAW.fieldNames()[::-1]), path, fmt="csv", sep=",", header=True)
    good, _ = read_flights_text(spark, path)
    return good


def prep_from_wide_raw(spark: SparkSession, d: str) -> DataFrame:
    """The carrier dataset that the prepare job writes from the wide files."""
    out = _job_output(spark, "prepared")
    jobs.run(spark, ["prepare", _wide(spark, d), out, "--output-format", "parquet"])
    return spark.read.parquet(f"{out}/carrier")


def tsv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows = flights_raw(spark, d).select("op_unique_carrier", F.expr(AWKWARD_TEXT).alias("note"), "month", "arr_delay")
    path = scratch_path(spark, "tsv")
    write_report(rows, path)
    return spark.read.schema(rows.schema).option("sep", "\t").csv(path)


def text_lines_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    write_report(delay_report_text(delay_report(flights(spark, d))), path, fmt="text")
    return spark.read.text(path).select(F.col("value").alias("line"))


def _copied(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` written to a scratch path and read back, so that what they come from may go."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, kind)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def table_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A managed table, written twice (the second write replaces the first), read and dropped."""
    raw = flights_raw(spark, d)
    name = f"trips_{uuid.uuid4().hex}"
    ingest(raw.select("origin"), name, database="punctuality_scratch")
    out = _copied(spark.table(ingest(raw, name, database="punctuality_scratch")), "table")
    drop_table(spark, name, "punctuality_scratch")
    return out


#: Months whose trips go to the files of each kind of header.
MIXED_MONTHS = {"reversed": (1, 2, 3, 4), "wide": (5, 6, 7), "in_order": (8, 9, 10, 11), "lacking": (12,)}


def mixed_headers(spark: SparkSession, d: str) -> str:
    """One directory of comma files with three orders of columns, and files without ``arr_delay``."""
    names = FLIGHTS_RAW.fieldNames()
    extra = [F.lit(f"v{i}").alias(f"other_{i}") for i in range(4)]
    columns = {"reversed": names[::-1], "wide": [*extra[:1], *names[6:], *extra[1:], *names[:6]], "in_order": names, "lacking": [n for n in names if n != "arr_delay"]}
    path, raw = scratch_path(spark, "mixed"), flights_raw(spark, d)
    for kind, months in MIXED_MONTHS.items():
        some = raw.where(F.col("month").isin(*months))
        write_report(some.select(*columns[kind]), path, fmt="csv", sep=",", header=True, mode="append")
    return path


def text_mixed_headers(spark: SparkSession, d: str) -> DataFrame:
    return read_flights_mixed(spark, mixed_headers(spark, d))[0]


def csv_mixed_headers(spark: SparkSession, d: str) -> DataFrame:
    return read_flights_mixed(spark, mixed_headers(spark, d), fmt="csv")[0]


def text_mixed_rejected(spark: SparkSession, d: str) -> DataFrame:
    rejected = read_flights_mixed(spark, mixed_headers(spark, d))[1]
    return rejected.groupBy(F.col("_error").alias("reason")).agg(F.count(F.lit(1)).alias("lines"))


def job_profile(spark: SparkSession, d: str) -> DataFrame:
    """What the profile job writes about a directory of files: summary, distinct values and value counts as rows."""
    out = _job_output(spark, "profile")
    jobs.run(spark, ["profile", _wide(spark, d), out, "--values", "cancellation_code,month", "--output-format", "parquet"])
    text = lambda *c: [F.col(x).cast("string").alias(y) for x, y in zip(c, ("part", "item", "metric", "value"), strict=True)]
    summary = spark.read.parquet(f"{out}/summary").select(*text("section", "item", "metric", "value"))
    distinct = spark.read.parquet(f"{out}/distinct").select(F.lit("distinct").alias("part"), F.col("column_name").alias("item"), F.lit("n").alias("metric"), F.col("distinct_count").cast("string").alias("value"))
    rows = summary.unionByName(distinct)
    for c in ("cancellation_code", "month"):
        counts = spark.read.parquet(f"{out}/values_{c}")
        rows = rows.unionByName(counts.select(F.lit(f"values_{c}").alias("part"), F.col(c).cast("string").alias("item"), F.lit("n").alias("metric"), F.col("frequency").cast("string").alias("value")))
    return rows


def job_text_lines(spark: SparkSession, d: str) -> DataFrame:
    """The report job's lines with fields joined by ``;``."""
    out = _job_output(spark, "lines")
    jobs.run(spark, ["delay_report", _wide(spark, d), out, "--output-format", "text", "--sep", ";"])
    return spark.read.text(out).select(F.col("value").alias("line"))


def job_mixed_parquet(spark: SparkSession, d: str) -> DataFrame:
    """The typed report, as Parquet, of a directory whose files have headers of their own."""
    out = _job_output(spark, "typed")
    jobs.run(spark, ["delay_report", mixed_headers(spark, d), out, "--headers", "per-file", "--typed", "--output-format", "parquet"])
    return spark.read.parquet(out)


def job_separator(spark: SparkSession, d: str) -> DataFrame:
    """The carrier report with ``|`` between the fields, read back by that separator."""
    out = _job_output(spark, "separator")
    jobs.run(spark, ["carrier_profile", _wide(spark, d), out, "--output-format", "csv", "--sep", "|"])
    schema = "op_unique_carrier string, origin string, total_flights long, min_delay double, max_delay double, avg_delay double, cancellation_rate string, months_active string"
    return spark.read.schema(schema).option("sep", "|").csv(out)


def distinct_sketch_check(spark: SparkSession, d: str) -> DataFrame:
    """Sketches per month are stored, read and merged: whether each estimate is within 5 % of the count."""
    raw = flights_raw(spark, d)
    cols = [c for c in raw.columns if c != "month"]
    near = merge_sketches(_copied(distinct_sketches(raw, ["month"], cols), "sketches"))
    exact = distinct_profile(raw, cols).select("column_name", "distinct_count")
    close = F.abs(F.col("near") - F.col("distinct_count")) <= 0.05 * F.col("distinct_count")
    return exact.join(near.select("column_name", F.col("distinct_count").alias("near")), "column_name").select("column_name", close.alias("close"))


def external_table_scan(spark: SparkSession, d: str) -> DataFrame:
    """(step, n_rows, minutes) of a table over a directory: as made, after files were added, and after the same
    name was made over another directory; the table is dropped, its files stay."""
    raw, name = flights_raw(spark, d).select(*FLIGHTS_RAW.fieldNames()), f"trips_{uuid.uuid4().hex}"
    here, there = scratch_path(spark, "external"), scratch_path(spark, "external")
    put = lambda rows, path: write_report(rows, path, fmt="csv", sep=",", header=True, mode="append")
    put(raw.where("month <= 6"), here)
    put(raw.where("month > 9"), there)
    steps = []

    def seen(step: str, table: DataFrame) -> None:
        row = table.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("arr_delay").alias("minutes"))
        steps.append(_copied(row.select(F.lit(step).alias("step"), "*"), "external-seen"))

    seen("made", external_table(spark, name, here, FLIGHTS_RAW, database="punctuality_scratch"))
    put(raw.where("month > 6"), here)
    seen("added", refresh_table(spark, name, "punctuality_scratch"))
    seen("moved", external_table(spark, name, there, FLIGHTS_RAW, database="punctuality_scratch"))
    drop_table(spark, name, "punctuality_scratch")
    seen("files", spark.read.schema(FLIGHTS_RAW).option("header", True).csv(here))
    return reduce(DataFrame.unionByName, steps)


def staged_report(spark: SparkSession, d: str) -> DataFrame:
    return delay_report_staged(flights(spark, d), scratch_path(spark, "staged"))


def first_trips(spark: SparkSession, d: str, n: int = 20) -> DataFrame:
    """The first trips in the order of the table's files (a top-k report)."""
    rows = first_rows(spark, f"{d}/lineitem.parquet", n)
    return rows.select("position", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def schema_listing(spark: SparkSession, d: str) -> DataFrame:
    return schema_frame(flights_raw(spark, d))


def partitioned_report(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "by-month")
    report = delay_report(flights(spark, d))
    write_report(report, path, fmt="parquet", keys=REPORT_KEYS, partition_by="month")
    return spark.read.schema(report.schema).parquet(path)


def single_file_report(spark: SparkSession, d: str) -> DataFrame:
    """The report job's only output file (csv in, text report out)."""
    source, out = _wide(spark, d), _job_output(spark, "report")
    jobs.run(spark, ["delay_report", source, out, "--order", "global", "--single-file"])
    names = ["origin", "month", "low_str", "med_str", "high_str", "cause_str"]
    schema = T.StructType([T.StructField(n, T.IntegerType() if n == "month" else T.StringType()) for n in names])
    rows = spark.read.schema(schema).option("sep", "\t").csv(out)
    return rows.withColumn("n_files", F.lit(len(rows.inputFiles())))


def report_order_check(spark: SparkSession, d: str) -> DataFrame:
    """(kind, n_rows, out_of_order) of the written report: neighbours in the wrong order within the
    files and, where the order is one over all files, files that begin before the one before ends."""
    report = delay_report(flights(spark, d))
    key = F.struct(*REPORT_KEYS)
    parts = []
    for kind, options in {
        "single": {"single_file": True, "order": "global"},
        "global": {"order": "global"},
        "clustered": {"order": "clustered"},
        "by_month": {"partition_by": "month"},
    }.items():
        path = scratch_path(spark, f"order-{kind}")
        write_report(report, path, fmt="parquet", keys=REPORT_KEYS, **options)
        file = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
        rows = spark.read.schema(report.schema).parquet(path).select(key.alias("k"), file.alias("f"), F.col("_metadata.row_index").alias("i"))
        inside = rows.withColumn("before", F.lag("k").over(Window.partitionBy("f").orderBy("i")))
        files = inside.groupBy("f").agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("before") > F.col("k"), 1)).alias("bad"), F.min("k").alias("a"), F.max("k").alias("z")
        )
        before = F.lag("z").over(Window.orderBy("f"))  # a row per file
        files = files.withColumn("late", before > F.col("a") if kind in ("single", "global") else F.lit(False))
        parts.append(files.agg(F.sum("n").alias("n_rows"), (F.sum("bad") + F.count(F.when(F.col("late"), 1))).alias("out_of_order")).select(
            F.lit(kind).alias("kind"), "n_rows", "out_of_order"
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_approx_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether the one-pass estimate of each column's distinct values is within 5 % of the count."""
    raw = flights_raw(spark, d)
    exact = distinct_profile(raw)
    near = distinct_profile(raw, approx=True).select("position", F.col("distinct_count").alias("near"))
    close = F.abs(F.col("near") - F.col("distinct_count")) <= 0.05 * F.col("distinct_count")
    return exact.join(near, "position").select("position", "column_name", close.alias("close"))
