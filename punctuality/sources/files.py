"""Readers: headed CSV (or any Spark format) with columns found by name, and
a line-level text reader that keeps malformed lines apart instead of
losing them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuality.schemas import FLIGHTS_RAW

ERROR_COL = "_error"


def read_flights(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = FLIGHTS_RAW,
    columns=None,
    fmt: str = "csv",
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Read a file or a directory of files (local, HDFS or S3 URI): the good rows of
    :func:`read_flights_csv`, or any other Spark format. ``columns`` selects the wanted ones: Spark
    prunes the rest in the scan, so that a CSV row is judged by those columns alone.
    """
    if fmt == "csv" and columns:
        names = file_columns(_csv_header(spark, path, sep), schema) if header else None
        rows = _csv_rows(spark, path, names or schema.fieldNames(), sep, header)
        wanted = T.StructType([schema[c] for c in columns])
        none = F.lit(None)
        raw = rows.select(none.cast("string").alias("value"), none.cast("int").alias("_nf"), *_csv_texts(wanted))
        df, _ = _split(_checked(raw, wanted, F.lit(False)), wanted)
    elif fmt == "csv":
        df, _ = read_flights_csv(spark, path, schema, sep=sep, header=header)
    else:
        df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df


def file_columns(names: list[str], schema: T.StructType) -> list[str] | None:
    """``names`` if they are a header (at least half of the schema's columns are among them), else
    None. A header without one of the schema's columns is an error."""
    wanted = schema.fieldNames()
    missing = [n for n in wanted if n not in names]
    if 2 * len(missing) > len(wanted):
        return None
    if missing:
        raise ValueError(f"columns missing in the header: {', '.join(missing)}")
    return names


def _typed(raw: str, f: T.StructField):
    """The text column ``raw`` as the field's type, null if it does not fit: integers may be
    written as whole decimals (``1.0``), numbers must be finite."""
    c = F.col(raw)
    if isinstance(f.dataType, T.StringType):
        return c
    if isinstance(f.dataType, T.IntegralType):
        d = c.try_cast("decimal(38,10)")
        return F.when(d == F.floor(d), d).try_cast(f.dataType)
    if isinstance(f.dataType, T.FractionalType):
        d = c.try_cast(f.dataType)
        return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)
    return c.try_cast(f.dataType)


def _checked(raw: DataFrame, schema: T.StructType, broken) -> DataFrame:
    """Typed columns, ``value`` and ``_error`` from ``value``, ``_nf`` and one text column ``_r<i>`` per field."""
    names = schema.fieldNames()
    texts = [F.col(f"_r{i}") for i in range(len(names))]
    typed = raw.select("value", "_nf", *texts, *[_typed(f"_r{i}", f).alias(f.name) for i, f in enumerate(schema.fields)])
    # concat_ws skips nulls: the names of the fields that failed to cast, or ''.
    bad = F.concat_ws(",", *[F.when(t.isNotNull() & F.col(f"`{n}`").isNull(), F.lit(n)) for n, t in zip(names, texts, strict=True)])
    error = F.when(broken, F.concat(F.lit("field_count:"), F.col("_nf").cast("string"))).when(
        bad != "", F.concat(F.lit("bad_value:"), bad)
    )
    # The one-row inline is a Generate, which filters are not pushed below:
    # a later filter on ``_error`` reads the finished column instead of
    # having every field's parse inlined into the filter and computed twice.
    row = F.struct(*[F.col(f"`{n}`") for n in names], F.col("value"), error.alias(ERROR_COL))
    return typed.select(F.inline(F.array(row)))


def parse_flights_lines(
    lines: DataFrame, schema: T.StructType = FLIGHTS_RAW, sep: str = ",", file_names: list[str] | None = None
) -> DataFrame:
    """Lines (``value``) split on ``sep``; the schema's columns plus ``value`` and ``_error``:
    ``field_count:<n>`` when a line has another number of fields than ``file_names`` (the header; by
    default the schema's columns), ``bad_value:<cols>`` when a non-empty field does not fit its type,
    else null. Empty fields are null, blank lines are skipped, header lines too; a header with the
    columns in another order stops the job, since the lines after it would be misread.

    Plain splitting, no quoting, like the trip files it reads.
    """
    names = schema.fieldNames()
    file_names = file_names or names
    lines = lines.filter(F.trim(F.col("value")) != "").filter(F.col("value") != F.lit(sep.join(file_names)))
    # One projection per step, so that the split and each cast run once per line.
    split = lines.select("value", F.split(F.col("value"), _regex_quote(sep), -1).alias("_f"))
    other = F.size(F.array_intersect("_f", F.array(*[F.lit(n) for n in names]))) == len(names)
    value = F.when(other, F.raise_error(F.concat(F.lit("another header: "), F.col("value")))).otherwise(F.col("value"))
    raw = split.select(
        value.alias("value"),
        F.size("_f").alias("_nf"),
        *[F.nullif(F.trim(F.get(F.col("_f"), file_names.index(n))), F.lit("")).alias(f"_r{i}") for i, n in enumerate(names)],
    )
    return _checked(raw, schema, F.col("_nf") != len(file_names))


def parse_flights_text(
    spark: SparkSession, path: str | list[str], schema: T.StructType = FLIGHTS_RAW, sep: str = ",", header: bool = True
) -> DataFrame:
    """:func:`parse_flights_lines` over files. With ``header``, the first line names the columns, in any
    order and with others among them; all files of one call have the same header."""
    lines = spark.read.text(path)
    first = lines.first() if header else None
    names = file_columns([x.strip() for x in first[0].split(sep)], schema) if first else None
    return parse_flights_lines(lines, schema, sep, names)


def _split(parsed: DataFrame, schema: T.StructType, observe: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """``observe`` counts the ``rejected`` lines of a pass over the good rows."""
    passed = parsed.observe(observe, F.count(F.col(ERROR_COL)).alias("rejected")) if observe else parsed
    good = passed.filter(F.col(ERROR_COL).isNull()).select(*schema.fieldNames())
    return good, parsed.filter(F.col(ERROR_COL).isNotNull()).select("value", ERROR_COL)


def read_flights_text(
    spark: SparkSession, path, schema: T.StructType = FLIGHTS_RAW, observe: Observation | None = None, **kw
) -> tuple[DataFrame, DataFrame]:
    """(good rows with ``schema``, rejected lines with ``value`` and ``_error``)."""
    return _split(parse_flights_text(spark, path, schema, **kw), schema, observe)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file on any Hadoop file system, compressed or not; None if it is empty."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        data = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8")).readLine()
    finally:
        stream.close()


def header_layouts(spark: SparkSession, path: str | list[str], readers: int = 16) -> dict[str, list[str]]:
    """First line -> the files that begin with it, for all files of ``path`` that are not empty. Spark lists the
    files; the driver reads the first line of each and nothing else."""
    jvm = spark._jvm
    files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in sorted(spark.read.text(path).inputFiles())]
    layouts: dict[str, list[str]] = {}
    with ThreadPoolExecutor(readers) as pool:
        for file, line in zip(files, pool.map(lambda f: first_line(spark, f), files), strict=True):
            if line is not None:
                layouts.setdefault(line, []).append(file)
    return layouts


def read_flights_mixed(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = FLIGHTS_RAW,
    sep: str = ",",
    fmt: str = "text",
    observe: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines) of files that each have a header of their own: columns in any order, with
    others among them. Files with the same header are read together, by :func:`read_flights_text` or
    (``fmt="csv"``) :func:`read_flights_csv`, so every file is scanned once and each line is split by its file's
    positions. The lines of a file that lacks a column are rejected as ``missing_column:<names>``; a file whose first line is
    no header holds the schema's columns in order. No lines at all: empty results.
    """
    parsed = []
    for header, files in header_layouts(spark, path).items():
        names = [x.strip().strip('"' if fmt == "csv" else "") for x in header.lstrip("\ufeff").split(sep)]
        missing = [n for n in schema.fieldNames() if n not in names]
        known = 2 * len(missing) <= len(schema)
        if known and missing:
            lines = spark.read.text(files).filter((F.trim("value") != "") & (F.col("value") != F.lit(header)))
            none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
            parsed.append(lines.select(*none, "value", F.lit("missing_column:" + ",".join(missing)).alias(ERROR_COL)))
        elif fmt == "csv":
            parsed.append(_parsed_csv(spark, files, schema, names if known else schema.fieldNames(), sep, known, check=False))
        else:
            lines = spark.read.text(files)
            lines = lines.filter(F.col("value") != F.lit(header)) if known else lines
            parsed.append(parse_flights_lines(lines, schema, sep, names if known else None))
    if not parsed:
        parsed = [_checked(spark.createDataFrame([], _raw_schema(schema)), schema, F.lit(False))]
    return _split(reduce(DataFrame.unionByName, parsed), schema, observe)


def _raw_schema(schema: T.StructType) -> str:
    return ", ".join(["value string", "_nf int", *(f"_r{i} string" for i in range(len(schema)))])


def _csv_header(spark: SparkSession, path, sep: str) -> list[str]:
    return [x.strip() for x in spark.read.option("header", True).option("sep", sep).csv(path).columns]


def _csv_rows(spark: SparkSession, path, names: list[str], sep: str, header: bool, corrupt: str | None = None, check: bool = True):
    """All columns as text, and the broken line in ``corrupt`` if asked for. With ``check``, a file whose header differs is an error."""
    extra = [corrupt] if corrupt else []
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *extra]])
    reader = spark.read.schema(as_text).option("sep", sep).option("header", header).option("enforceSchema", not (header and check))
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.option("mode", "PERMISSIVE").csv(path)


def _csv_texts(schema: T.StructType):
    return [F.nullif(F.trim(F.col(f"`{n}`")), F.lit("")).alias(f"_r{i}") for i, n in enumerate(schema.fieldNames())]


def read_flights_csv(
    spark: SparkSession, path, schema: T.StructType = FLIGHTS_RAW, sep: str = ",", header: bool = True, observe: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Like :func:`read_flights_text` for quoted CSV. A file whose header differs from the first one's is an error."""
    names = file_columns(_csv_header(spark, path, sep), schema) if header else schema.fieldNames()
    if names is None:
        raise ValueError("the first line is no header of these columns")
    return _split(_parsed_csv(spark, path, schema, names, sep, header), schema, observe)


def _parsed_csv(spark: SparkSession, path, schema: T.StructType, names: list[str], sep: str, header: bool, check: bool = True) -> DataFrame:
    """Like :func:`parse_flights_lines`, of quoted CSV files with the columns ``names``."""
    broken = F.col("_corrupt_line")
    rows = _csv_rows(spark, path, names, sep, header, "_corrupt_line", check)
    line = F.coalesce(broken, F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names])))
    fields_found = F.when(broken.isNotNull(), F.size(F.split(broken, _regex_quote(sep), -1)))
    raw = rows.select(line.alias("value"), fields_found.alias("_nf"), *_csv_texts(schema))
    return _checked(raw, schema, F.col("_nf").isNotNull())


def first_rows(spark: SparkSession, path: str | list[str], n: int = 5, fmt: str = "parquet", **options) -> DataFrame:
    """The first ``n`` rows in the order of the files' names and of the rows inside each file, with their ``position``
    from 1. Each task keeps ``n`` rows (a bounded top-n, not a bare limit)."""
    df = spark.read.options(**options).format(fmt).load(path)
    inside = F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
    where = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), inside)
    if fmt == "parquet":
        where = F.struct(F.col("_metadata.file_path"), inside)
    top = df.select("*", where.alias("_where")).orderBy("_where").limit(n)
    position = F.row_number().over(Window.orderBy("_where"))  # over n rows
    return top.select(position.alias("position"), *[F.col(f"`{c}`") for c in df.columns])


def rejected_summary(rejected: DataFrame) -> DataFrame:
    """(reason, lines): rejected lines counted by reason kind."""
    reason = F.substring_index(F.col(ERROR_COL), ":", 1)
    return rejected.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("lines"))


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` queryable as ``name`` in ``spark.sql``."""
    df.createOrReplaceTempView(name)
    return df


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in sep)
