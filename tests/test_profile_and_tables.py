"""Headers per file, one-pass profiles, bitmaps, tables of the catalogue, scratch folders that go."""

import gc
import gzip
import time

import pytest
from pyspark.sql import functions as F

from punctuality import session
from punctuality.operators.profile import (
    cancelled_null_check,
    distinct_profile,
    distinct_sketches,
    diverted_check,
    merge_sketches,
    null_profile,
    profile_all,
    schema_frame,
)
from punctuality.plans import jobs
from punctuality.plans.catalog import QUERIES
from punctuality.schemas import FLIGHTS_CARRIER, FLIGHTS_RAW
from punctuality.sources.files import first_rows, header_layouts, read_flights_mixed
from punctuality.sources.fixtures import flights_raw
from punctuality.sources.tables import Stages, current_database, drop_database, drop_table, drop_with_files, external_table, refresh_table

SF = "/root/testdata/sf0.001"


def _write(path, *lines, packed=False):
    text = "".join(x + "\n" for x in lines)
    (gzip.open(path, "wt") if packed else open(path, "w")).write(text)


def _mixed(tmp_path):
    folder = tmp_path / "in it"
    folder.mkdir()
    _write(folder / "a.csv", "op_unique_carrier,origin,arr_delay,cancelled,month", "AA,JFK,5,0,1", "AA,JFK,x,0,1", "", "AA,LAX,7.5,0.0,2.0")
    _write(folder / "b.csv", " month , other,cancelled,origin,arr_delay,op_unique_carrier", "3,z,1,SFO,,BB", "3,z")
    _write(folder / "c.csv.gz", "﻿month,arr_delay,origin,op_unique_carrier,cancelled", "4,-1,BOS,CC,0", packed=True)
    _write(folder / "d.csv", "op_unique_carrier,origin,cancelled,month", "DD,ORD,0,5", "DD,ORD,0,6")
    _write(folder / "e.csv", "EE,DEN,9,0,7", "EE,DEN,9,0,8")  # no header
    _write(folder / "f.csv")
    return str(folder)


@pytest.mark.parametrize("fmt", ["text", "csv"])
def test_each_file_is_read_by_its_own_header(spark, tmp_path, fmt):
    folder = _mixed(tmp_path)
    good, rejected = read_flights_mixed(spark, folder, FLIGHTS_CARRIER, fmt=fmt)
    want = [("AA", "JFK", 5.0, 0, 1), ("AA", "LAX", 7.5, 0, 2), ("BB", "SFO", None, 1, 3), ("CC", "BOS", -1.0, 0, 4), ("EE", "DEN", 9.0, 0, 7), ("EE", "DEN", 9.0, 0, 8)]
    assert sorted(map(tuple, good.collect())) == want
    reasons = sorted((r.value, r._error) for r in rejected.collect())
    missing = "missing_column:arr_delay"
    assert reasons == [("3,z", "field_count:2"), ("AA,JFK,x,0,1", "bad_value:arr_delay"), ("DD,ORD,0,5", missing), ("DD,ORD,0,6", missing)]
    assert good.schema == FLIGHTS_CARRIER


def test_layouts_are_read_from_the_first_lines(spark, tmp_path):
    layouts = header_layouts(spark, _mixed(tmp_path))
    assert sorted(len(f) for f in layouts.values()) == [1] * 5 and "EE,DEN,9,0,7" in layouts
    (tmp_path / "none").mkdir()
    _write(tmp_path / "none" / "x.csv")
    good, rejected = read_flights_mixed(spark, str(tmp_path / "none"), FLIGHTS_CARRIER)
    assert good.count() == rejected.count() == 0 and good.schema == FLIGHTS_CARRIER


def test_files_of_one_header_are_one_scan(spark, tmp_path):
    for i in range(4):
        _write(tmp_path / f"{i}.csv", "op_unique_carrier,origin,arr_delay,cancelled,month" if i % 2 else "month,origin,arr_delay,cancelled,op_unique_carrier", "1,J,5,0,1")
    good, _ = read_flights_mixed(spark, str(tmp_path), FLIGHTS_CARRIER)
    assert good._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 2


def test_job_reads_mixed_headers_and_counts_what_it_sets_aside(spark, tmp_path, capsys):
    out = tmp_path / "out"
    jobs.run(spark, ["carrier_profile", _mixed(tmp_path), str(out), "--headers", "per-file", "--output-format", "text", "--sep", "|", "--single-file"])
    lines = [r.value for r in spark.read.text(str(out)).collect()]
    assert len(lines) == 5 and "AA|JFK|1|5.0|5.0|5.0|0.00%|1" in lines
    assert "rejected lines: 4" in capsys.readouterr().out


def test_profile_job_writes_every_part(spark, tmp_path):
    rows = flights_raw(spark, SF)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.coalesce(1).write.option("header", True).csv(source)
    jobs.run(spark, ["profile", source, out, "--values", "month", "--rows", "3"])
    read = lambda part: spark.read.option("header", True).csv(f"{out}/{part}")
    assert read("summary").where("section = 'shape' and item = 'rows'").first().value == str(rows.count())
    assert read("distinct").count() == 13 and read("values_month").count() == 12
    assert [r.arr_delay for r in read("first_rows").collect()] == [None if r.arr_delay is None else str(r.arr_delay) for r in rows.take(3)]
    with pytest.raises(ValueError, match="writes csv or parquet"):
        jobs.run(spark, ["profile", source, out, "--output-format", "text"])


def test_profile_all_is_one_scan_and_agrees_with_the_single_profiles(spark):
    raw = flights_raw(spark, SF)
    one = profile_all(raw)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    rows = {(r.section, r.item, r.metric): r.value for r in one.collect()}
    for r in null_profile(raw).collect():
        assert rows["nulls", r.column_name, "null_count"] == str(r.null_count) and float(rows["nulls", r.column_name, "null_pct"]) == r.null_pct
    for section, single in (("cancelled_null", cancelled_null_check(raw)), ("diverted", diverted_check(raw))):
        assert {k[1]: v for k, v in rows.items() if k[0] == section} == {k: str(v) for k, v in single.first().asDict().items()}
    empty = {(r.section, r.item, r.metric): r.value for r in profile_all(raw.limit(0)).collect()}
    assert empty["shape", "rows", "n"] == "0" and empty["nulls", "month", "null_pct"] is None
    assert {r.section for r in profile_all(spark.range(3)).collect()} == {"shape", "schema", "nulls"}
    assert [tuple(r) for r in schema_frame(spark.range(3)).collect()] == [(1, "id", "bigint")]


def test_bitmaps_count_every_kind_of_number(spark):
    big = 1 << 60
    rows = [
        (0, -1, 0.5, "2024-01-01", True, 1e300, "a"), (63, big, -0.0, "2024-01-01", False, -1e300, "1"), (64, -big, 0.0, "1969-12-31", True, float("nan"), "01"),
        (-1, -1, float("inf"), None, None, float("nan"), None), (None, big + 1, 63.0, None, None, 1e300, "a"), (-64, 63, 64.0, None, None, 2.0**53, ""),
    ]
    df = spark.createDataFrame(rows, "i int, l long, d double, day string, b boolean, e double, s string").withColumn("day", F.col("day").cast("date"))
    assert [r.distinct_count for r in distinct_profile(df).orderBy("position").collect()] == [5, 5, 5, 2, 2, 4, 4]
    assert sorted(map(tuple, distinct_profile(df).collect())) == sorted(map(tuple, distinct_profile(df, per_column=True).collect()))


def test_a_column_of_neighbours_sends_a_row_per_word(spark):
    df = spark.range(0, 64 * 1000, 1, 2)
    words = distinct_profile(df)
    assert words.first().distinct_count == 64_000
    text = words._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in text and "SortAggregate" not in text


def test_stored_sketches_are_merged(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 5000).alias("a"), (F.col("id") * 0.5).alias("b"))
    distinct_sketches(df, ["day"]).write.parquet(str(tmp_path / "s"))
    got = {r.column_name: r.distinct_count for r in merge_sketches(spark.read.parquet(str(tmp_path / "s"))).collect()}
    assert abs(got["a"] - 5000) < 250 and abs(got["b"] - 20_000) < 1000


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_first_rows_in_file_order(spark, tmp_path, fmt):
    for i in range(3):
        spark.range(i * 100, i * 100 + 50, 1, 1).write.mode("append" if i else "overwrite").option("header", True).format(fmt).save(str(tmp_path / f"p{i}"))
    paths = [str(tmp_path / f"p{i}") for i in (2, 0, 1)]
    rows = first_rows(spark, paths, 60, fmt, header=True)
    assert [(r.position, int(r.id)) for r in rows.collect()] == [(i + 1, x) for i, x in enumerate([*range(50), *range(100, 110)])]
    assert "TakeOrderedAndProject" in rows._jdf.queryExecution().executedPlan().toString()
    assert first_rows(spark, paths, 1000, fmt, header=True).count() == 150


def _tables(spark, database):
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def test_external_table_follows_its_directory(spark, tmp_path):
    for name, lines in (("x", ["AA,JFK,5,0,1"]), ("y", ["BB,LAX,6,0,2", "BB,LAX,7,0,2"])):
        (tmp_path / name).mkdir()
        _write(tmp_path / name / "1.csv", "op_unique_carrier,origin,arr_delay,cancelled,month", *lines)
    make = lambda where: external_table(spark, "trips", str(tmp_path / where), FLIGHTS_CARRIER, database="ext_db")
    assert make("x").count() == 1
    _write(tmp_path / "x" / "2.csv", "op_unique_carrier,origin,arr_delay,cancelled,month", "AA,BOS,1,1,3")
    assert refresh_table(spark, "trips", "ext_db").count() == 2
    assert sorted(r.arr_delay for r in make("y").collect()) == [6.0, 7.0]  # another place, the same name
    drop_table(spark, "trips", "ext_db")
    assert (tmp_path / "y" / "1.csv").exists() and not spark.catalog.tableExists("ext_db.trips")
    drop_database(spark, "ext_db")
    assert not spark.catalog.databaseExists("ext_db")


def test_stages_are_dropped_also_after_an_error(spark):
    before = spark.catalog.currentDatabase()
    with pytest.raises(RuntimeError), current_database(spark, "stage_db"), Stages(spark) as stage:
        assert stage.put("a", spark.range(3)).count() == 3
        assert stage.put("a", spark.range(5)).count() == 5  # replaced
        assert len(_tables(spark, "stage_db")) == 1
        raise RuntimeError
    assert spark.catalog.currentDatabase() == before and not _tables(spark, "stage_db")
    spark.range(4).write.saveAsTable("stage_db.kept")
    drop_with_files(spark, "kept", "stage_db")
    drop_database(spark, "stage_db")


def _left(spark):
    """Folders under the checkpoint folder and tables of the catalogue."""
    base = session.ensure_checkpoint_dir(spark)
    fs, at = session._file_system(spark, base)
    folders = [str(x.getPath()) for x in fs.listStatus(at)] + [str(x.getPath()) for x in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(session.scratch_folder(spark)))]
    tables = [f"{d.name}.{t.name}" for d in spark.catalog.listDatabases() for t in spark.catalog.listTables(d.name) if not t.isTemporary]
    return sorted(folders), sorted(tables)


#: Queries of one aggregation or projection, which write nothing; two of them stand for all.
LAZY = {n for n in QUERIES if n.startswith(("carrier_", "delay_", "tier_", "cause_", "top_", "prep_c", "replicate", "null_", "value_", "dataset_", "cancelled_", "diverted_", "distinct_values"))}
LAZY -= {"carrier_profile_sql", "delay_report", "delay_report_staged"}


def test_queries_leave_no_folder_and_no_table(spark):
    session.scratch_folder(spark)
    gc.collect()
    before = _left(spark)
    assert len(LAZY) < 30
    for name in sorted(set(QUERIES) - LAZY):
        with session.scratch_scope(spark):
            QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
        assert _left(spark)[1] == before[1], name
    for _ in range(50):  # the sample's checkpoints go when nothing refers to them
        if set(_left(spark)[0]) <= set(before[0]):
            break
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.2)
    assert set(_left(spark)[0]) <= set(before[0])


def test_scratch_of_inner_scopes_goes_first(spark):
    with session.scratch_scope(spark):
        outer = session.scratch_path(spark, "o")
        spark.range(1).write.parquet(outer)
        with session.scratch_scope(spark):
            inner = session.scratch_path(spark, "i")
            spark.range(1).write.parquet(inner)
        assert session.path_exists(spark, outer) and not session.path_exists(spark, inner)
    assert not session.path_exists(spark, outer)
    assert not session.remove_path(spark, outer)


def test_staged_report_equals_the_one_scan_report(spark):
    from punctuality.plans.reports import delay_report, delay_report_staged
    from punctuality.plans.roundtrips import edge_flights

    rows = edge_flights(spark, SF)  # with null months
    with session.scratch_scope(spark):
        staged = delay_report_staged(rows, session.scratch_path(spark, "staged"))
        assert sorted(staged.collect(), key=repr) == sorted(delay_report(rows).collect(), key=repr)


def test_wide_schema_of_raw_trips_is_found_by_name(spark, tmp_path):
    _write(tmp_path / "a.csv", ",".join(reversed(FLIGHTS_RAW.fieldNames())), ",".join(["1"] * len(FLIGHTS_RAW)))
    assert read_flights_mixed(spark, str(tmp_path))[0].count() == 1
