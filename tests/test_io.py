"""Readers, writers, tables and the job runner."""

import glob
import os

from edge_fixture import SCHEMA, edge_flights
from pyspark.sql import functions as F

from punctuality.plans import jobs
from punctuality.plans.reports import delay_report, delay_report_text
from punctuality.schemas import FLIGHTS_CAUSES
from punctuality.sources.files import parse_flights_text, read_flights, read_flights_text, register, rejected_summary
from punctuality.sources.sinks import ingest, write_dataset, write_report

CAUSE_NAMES = FLIGHTS_CAUSES.fieldNames()


def _causes(spark):
    return edge_flights(spark).select(*CAUSE_NAMES)


def test_csv_roundtrip_and_column_pruning(spark, tmp_out):
    df = _causes(spark)
    write_dataset(df, tmp_out + "/csv", fmt="csv")
    back = read_flights(spark, tmp_out + "/csv", FLIGHTS_CAUSES)
    # CSV cannot tell '' from null: Spark reads both back as null.
    want = df.withColumn("cancellation_code", F.expr("nullif(cancellation_code, '')"))
    assert sorted(back.collect(), key=repr) == sorted(want.collect(), key=repr)
    two = read_flights(spark, tmp_out + "/csv", FLIGHTS_CAUSES, columns=["origin", "month"])
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<origin:string,month:string>" in plan


def test_text_reader_keeps_bad_lines_apart(spark, tmp_out):
    header = ",".join(CAUSE_NAMES)
    lines = [
        header,
        "JFK,1,5.0,6.0,0.0,N,0,0,0,0,0",  # good
        "JFK,2,,,1.0,B,0,0,0,0,0",  # good, empty fields are null
        "JFK,1,5.0,6.0,0.0,N,0,0,0,0",  # 10 fields
        "JFK,1,5.0,6.0,0.0,N,0,0,0,0,0,9",  # 12 fields
        "JFK,x,5.0,6.0,0.0,N,0,0,0,0,0",  # month not a number
        "JFK",  # 1 field
        "",  # blank: ignored
    ]
    path = tmp_out + "/lines.txt"
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    good, rejected = read_flights_text(spark, path, FLIGHTS_CAUSES)
    got = sorted(good.collect())
    assert [(r.origin, r.month, r.dep_delay, r.cancellation_code) for r in got] == [("JFK", 1, 5.0, "N"), ("JFK", 2, None, "B")]
    reasons = sorted(r._error for r in rejected.collect())
    assert reasons == ["bad_value:month", "field_count:1", "field_count:10", "field_count:12"]
    summary = {r.reason: r.lines for r in rejected_summary(rejected).collect()}
    assert summary == {"bad_value": 1, "field_count": 3}
    # The verdict of a line does not depend on which columns are read later.
    parsed = parse_flights_text(spark, path, FLIGHTS_CAUSES)
    assert parsed.filter(F.col("_error").isNull()).select("origin").count() == 2


def test_write_report_tsv_single_sorted_file(spark, tmp_out):
    text = delay_report_text(delay_report(edge_flights(spark)))
    out = tmp_out + "/report"
    write_report(text, out, keys=["origin", "month"], order="global", single_file=True)
    parts = glob.glob(out + "/part-*")
    assert len(parts) == 1
    with open(parts[0]) as fh:
        rows = [line.rstrip("\n").split("\t") for line in fh]
    keys = [(r[0], int(r[1])) for r in rows]
    assert keys == sorted(keys) and len(rows) == text.count()
    assert rows[0][2].startswith("Low:")


def test_write_report_text_and_partition_by(spark, tmp_out):
    rep = delay_report(edge_flights(spark))
    write_report(delay_report_text(rep), tmp_out + "/text", fmt="text", sep="\t")
    lines = spark.read.text(tmp_out + "/text").collect()
    assert len(lines) == rep.count() and all(len(r.value.split("\t")) == 6 for r in lines)
    write_report(rep, tmp_out + "/bymonth", fmt="parquet", keys=["origin", "month"], partition_by="month")
    back = spark.read.parquet(tmp_out + "/bymonth")
    # all rows of one month land in one file (a file may hold several months)
    pairs = {(r.month, r.f) for r in back.select("month", F.input_file_name().alias("f")).collect()}
    months = [m for m, _ in pairs]
    assert len(months) == len(set(months))


def test_clustered_order(spark):
    from punctuality.operators.ordering import apply_order

    df = apply_order(edge_flights(spark), ["origin", "month"], "clustered")
    for part in df.rdd.glom().collect():
        keys = [(r.origin, r.month) for r in part]
        assert keys == sorted(keys)


def test_ingest_and_sql_view(spark):
    name = ingest(edge_flights(spark), "flights_edge", database="punctuality_test")
    assert spark.table(name).count() == len(edge_flights(spark).collect())
    register(edge_flights(spark), "edge_view")
    assert spark.sql("SELECT count(*) AS n FROM edge_view WHERE origin = 'CAN'").first().n == 2


def test_jobs_end_to_end(spark, tmp_out):
    src = tmp_out + "/in"
    write_dataset(edge_flights(spark).select(*CAUSE_NAMES), src, fmt="csv")
    with open(src + "/extra.csv", "w") as fh:  # a second file with a header and two broken lines
        fh.write(",".join(CAUSE_NAMES) + "\nJFK,1,5.0\nJFK,x,5.0,6.0,0.0,N,0,0,0,0,0\n")
    jobs.run(spark, ["delay_report", src, tmp_out + "/out32", "--order", "global", "--single-file"])
    rejected = spark.read.json(tmp_out + "/out32_rejected").collect()
    assert sorted(r._error for r in rejected) == ["bad_value:month", "field_count:3"]
    files = glob.glob(tmp_out + "/out32/part-*")
    assert len(files) == 1
    with open(files[0]) as fh:
        first = fh.readline().rstrip("\n").split("\t")
    assert first[0] == "CAN" and first[5] == "Top3_Cause:[Cancellazione_A(1), Cancellazione_B(1)]"
    jobs.run(spark, ["delay_report", src, tmp_out + "/out32csv", "--input-format", "csv", "--typed"])
    typed = spark.read.option("sep", "\t").csv(tmp_out + "/out32csv")
    # The broken lines are rejected, as in text mode.
    assert typed.count() == delay_report(edge_flights(spark)).count()

    carrier_src = tmp_out + "/in31"
    write_dataset(edge_flights(spark).select("op_unique_carrier", "origin", "arr_delay", F.col("cancelled").cast("int"), "month"), carrier_src, fmt="csv")
    jobs.run(spark, ["carrier_profile", carrier_src, tmp_out + "/out31"])
    lines = spark.read.option("sep", "\t").csv(tmp_out + "/out31").collect()
    assert any(r[0] == "A_B" and r[1] == "UND" for r in lines)

    raw_src = tmp_out + "/raw"
    raw = edge_flights(spark).withColumn("diverted", F.lit(0)).withColumn("cancelled", F.col("cancelled").cast("int"))
    from punctuality.schemas import FLIGHTS_RAW

    write_dataset(raw.select(*FLIGHTS_RAW.fieldNames()), raw_src, fmt="csv")
    jobs.run(spark, ["prepare", raw_src, tmp_out + "/prep", "--sample", "0.1", "--replicate", "2"])
    for sub in ("carrier", "causes", "carrier_sample", "causes_x2"):
        assert os.path.isdir(f"{tmp_out}/prep/{sub}")
    n = spark.read.option("header", True).csv(tmp_out + "/prep/causes").count()
    assert spark.read.option("header", True).csv(tmp_out + "/prep/causes_x2").count() == 2 * n
    assert SCHEMA is not None
