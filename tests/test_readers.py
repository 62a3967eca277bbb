"""Columns by header name, whole numbers written as decimals, broken values, verbatim writers."""

import pytest

from punctuality.operators.aggregates import carrier_profile
from punctuality.plans.jobs import run
from punctuality.schemas import FLIGHTS_CARRIER, FLIGHTS_RAW
from punctuality.sources.files import read_flights, read_flights_csv, read_flights_text
from punctuality.sources.sinks import write_dataset, write_report

VALUES = {
    "op_unique_carrier": "AA", "origin": "JFK", "month": "1.0", "dep_delay": "20", "arr_delay": "99", "cancelled": "0.0", "diverted": "0",
    "cancellation_code": "", "carrier_delay": "1", "weather_delay": "", "nas_delay": "2.5", "security_delay": "", "late_aircraft_delay": "",
}


def _file(path, names, rows):
    path.write_text("\n".join([",".join(names), *(",".join(r.get(n, "z") for n in names) for r in rows)]) + "\n")
    return str(path)


WIDE = ["year", *reversed(FLIGHTS_RAW.fieldNames()), *(f"extra{i}" for i in range(20))]


@pytest.mark.parametrize("read", [read_flights_text, read_flights_csv])
def test_wide_and_reordered_header(spark, tmp_path, read):
    path = _file(tmp_path / "wide.csv", WIDE, [VALUES, VALUES | {"month": "1.5"}, VALUES | {"dep_delay": "NaN"}])
    good, rejected = read(spark, path)
    row = good.collect()
    assert len(row) == 1 and (row[0].dep_delay, row[0].arr_delay, row[0].month, row[0].cancelled) == (20.0, 99.0, 1, 0)
    assert sorted(r._error for r in rejected.collect()) == ["bad_value:dep_delay", "bad_value:month"]


@pytest.mark.parametrize("read", [read_flights_text, read_flights_csv])
def test_missing_column_is_an_error(spark, tmp_path, read):
    path = _file(tmp_path / "short.csv", FLIGHTS_RAW.fieldNames()[1:], [VALUES])
    with pytest.raises(ValueError, match="op_unique_carrier"):
        read(spark, path)


def test_another_header_in_the_same_read_stops(spark, tmp_path):
    names = FLIGHTS_CARRIER.fieldNames()
    _file(tmp_path / "a.csv", names, [VALUES] * 9)
    _file(tmp_path / "b.csv", names[::-1], [VALUES])
    with pytest.raises(Exception, match="another header"):
        read_flights_text(spark, str(tmp_path), FLIGHTS_CARRIER)[0].collect()


def test_broken_csv_rows_are_rejected(spark, tmp_path):
    path = _file(tmp_path / "x.csv", FLIGHTS_CARRIER.fieldNames(), [VALUES])
    with open(path, "a") as f:
        f.write("AA,JFK\n")
    good, rejected = read_flights_csv(spark, path, FLIGHTS_CARRIER)
    assert good.count() == 1 and [tuple(r) for r in rejected.collect()] == [("AA,JFK", "field_count:2")]


def test_prepare_on_a_wide_raw_file(spark, tmp_path):
    path = _file(tmp_path / "raw.csv", WIDE, [VALUES] * 3)
    run(spark, ["prepare", path, str(tmp_path / "out"), "--output-format", "parquet"])
    assert spark.read.parquet(str(tmp_path / "out/carrier")).count() == 3
    assert spark.read.parquet(str(tmp_path / "out/causes")).count() == 3


def test_reader_queries_read_the_table_on_every_call(spark, tmp_path):
    from punctuality.plans.catalog import QUERIES

    table = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").cache()
    for n in (200, 50):
        table.limit(n).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
        assert QUERIES["csv_roundtrip"](spark, str(tmp_path)).count() == n


def test_months_outside_the_calendar_are_listed(spark):
    df = spark.createDataFrame([("AA", "JFK", 1.0, 0, m) for m in (1, 0, 13, None, 1)], FLIGHTS_CARRIER)
    assert carrier_profile(df).collect()[0].months_active == "0-1-13"


def test_writers_keep_blanks_quotes_and_tabs(spark, tmp_path):
    rows = [(" AA ", 'say "x"', "a\tb")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    write_dataset(df, str(tmp_path / "d"), fmt="csv")
    write_report(df, str(tmp_path / "r"), fmt="tsv")
    back = spark.read.option("header", True).csv(str(tmp_path / "d")).collect()
    assert [tuple(r) for r in back] == rows
    assert [tuple(r) for r in spark.read.option("sep", "\t").csv(str(tmp_path / "r")).collect()] == rows


def test_order_and_partition_by_exclude_each_other(spark, tmp_path):
    df = spark.range(3)
    with pytest.raises(ValueError):
        write_report(df, str(tmp_path / "x"), fmt="parquet", keys=["id"], order="global", partition_by="id")
    write_report(df.repartition(3), str(tmp_path / "y"), fmt="tsv", keys=["id"], order="global", single_file=True)
    assert [r[0] for r in spark.read.text(str(tmp_path / "y")).collect()] == ["0", "1", "2"]
    assert read_flights(spark, _file(tmp_path / "c.csv", FLIGHTS_CARRIER.fieldNames(), [VALUES]), FLIGHTS_CARRIER, ["origin"]).columns == ["origin"]
