"""A job reads its input once; rejected lines are read again only if there are any."""

from punctuality.plans import jobs
from punctuality.plans.roundtrips import _wide
from punctuality.sources import files

SF = "/root/testdata/sf0.001"


def test_lines_are_counted_in_the_report_pass(spark, tmp_path, monkeypatch, capsys):
    written = []
    monkeypatch.setattr(jobs, "write_report", lambda df, path, **kw: (written.append((path, df)), files_write(df, path, **kw)))
    source = _wide(spark, SF)
    jobs.run(spark, ["delay_report", source, str(tmp_path / "a")])
    assert "rejected lines: 0 {}" in capsys.readouterr().out
    assert [p.endswith("_rejected") for p, _ in written] == [False, True]
    assert "Scan text" not in written[1][1]._jdf.queryExecution().executedPlan().toString()
    header = files._csv_header(spark, source, ",")
    (tmp_path / "in").mkdir()
    line = ",".join("1" if n == "month" else "JFK" if n == "origin" else "" for n in header)
    (tmp_path / "in" / "x.csv").write_text("\n".join([",".join(header), line, line.replace("JFK", "JFK,9"), line]) + "\n")
    jobs.run(spark, ["delay_report", str(tmp_path / "in"), str(tmp_path / "b")])
    assert "rejected lines: 1 {'field_count': 1}" in capsys.readouterr().out
    assert spark.read.json(str(tmp_path / "b_rejected")).count() == 1


def files_write(df, path, **kw):
    from punctuality.sources.sinks import write_report

    write_report(df, path, **kw)


def test_distinct_profile_is_one_scan_and_agrees(spark):
    from punctuality.operators.profile import distinct_profile
    from punctuality.sources.fixtures import flights_raw

    raw = flights_raw(spark, SF)
    one = distinct_profile(raw)
    assert one._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(one) == rows(distinct_profile(raw, per_column=True))
    odd = spark.createDataFrame(
        [(0.0, [1], b"a", None), (-0.0, [1], b"\xff", None), (float("nan"), None, b"\xfe", None), (float("nan"), [1, 2], None, None)],
        "x double, l array<int>, b binary, n string",
    )
    assert [r[2] for r in rows(distinct_profile(odd))] == [2, 2, 3, 0]
    assert [r[2] for r in rows(distinct_profile(odd.limit(0)))] == [0, 0, 0, 0]
