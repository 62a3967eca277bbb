"""Writers: reports as TSV / text lines, prepared data, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.operators.ordering import apply_order


#: Spark's CSV writer trims blanks unless told not to.
_VERBATIM = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _shape(df: DataFrame, keys, order, partition_by, single_file) -> DataFrame:
    keys = list(keys or [])
    if order and partition_by:
        raise ValueError("order and partition_by exclude each other: repartitioning loses the order")
    if single_file:
        # One writer task; the aggregate before the exchange stays parallel.
        df = df.repartition(1)
        return df.sortWithinPartitions(*keys) if keys and (order or partition_by) else df
    if partition_by:
        # Hash by the partition column, then order rows inside each file.
        df = df.repartition(partition_by)
        return df.sortWithinPartitions(*keys) if keys else df
    return apply_order(df, keys, order) if order else df


def write_report(
    df: DataFrame,
    path: str,
    fmt: str = "tsv",
    sep: str = "\t",
    header: bool = False,
    keys=None,
    order: str | None = None,
    partition_by: str | None = None,
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """``tsv``/``csv``: delimited, no header by default; ``text``: one line
    per row, fields joined by ``sep`` (nulls empty); ``parquet``."""
    out = _shape(df, keys, order, partition_by, single_file)
    if fmt in ("tsv", "csv"):
        out.write.mode(mode).options(sep=sep, header=header, **_VERBATIM).csv(path)
    elif fmt == "text":
        line = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in out.columns])
        out.select(line.alias("value")).write.mode(mode).text(path)
    else:
        out.write.mode(mode).format(fmt).save(path)


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True, mode: str = "overwrite") -> None:
    """Prepared trips: parquet by default, or headed CSV."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.options(header=header, **_VERBATIM).csv(path)
    else:
        w.format(fmt).save(path)


def ingest(df: DataFrame, table: str, database: str | None = None, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write ``df`` as a managed table, replacing it (creating the database if needed)."""
    spark = df.sparkSession
    name = table
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        name = f"`{database}`.`{table}`"
    df.write.mode(mode).format(fmt).saveAsTable(name)
    return name


def show_report(df: DataFrame, n: int = 20) -> None:
    """Print the first ``n`` rows in full to the console."""
    df.show(n, truncate=False)
