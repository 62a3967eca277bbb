"""Tables of the catalogue: tables over a directory, staged intermediate tables, the current database."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from punctuality.session import path_exists, remove_path


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def qualified(table: str, database: str | None = None) -> str:
    return f"{_quoted(database)}.{_quoted(table)}" if database else _quoted(table)


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")


def drop_table(spark: SparkSession, table: str, database: str | None = None) -> None:
    """Drop a table if it exists. The files of an external one stay."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(table, database)}")


def drop_database(spark: SparkSession, database: str, cascade: bool = False) -> None:
    """Drop a database if it exists; with tables left in it, that is an error without ``cascade``."""
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(database)} {'CASCADE' if cascade else 'RESTRICT'}")


@contextlib.contextmanager
def current_database(spark: SparkSession, database: str) -> Iterator[str]:
    """Inside, unqualified names are those of ``database`` (made if needed); afterwards, of the one before."""
    before = spark.catalog.currentDatabase()
    create_database(spark, database)
    spark.catalog.setCurrentDatabase(database)
    try:
        yield database
    finally:
        spark.catalog.setCurrentDatabase(before)


def external_table(
    spark: SparkSession,
    table: str,
    location: str,
    schema: T.StructType,
    database: str | None = None,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """A table over the delimited files of a directory, whose columns are ``schema`` in file order.

    The table is made anew, so another ``location`` or schema takes effect (an existing definition is not
    kept silently); the files themselves are never touched. Files added later are seen after
    :func:`refresh_table`.
    """
    if database:
        create_database(spark, database)
    drop_table(spark, table, database)
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    text = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(
        f"CREATE TABLE {qualified(table, database)} ({columns}) USING csv "
        f"OPTIONS (header {text(str(header).lower())}, sep {text(sep)}) LOCATION {text(location)}"
    )
    return spark.table(qualified(table, database))


def refresh_table(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    """The table with the files that are in its directory now."""
    spark.catalog.refreshTable(qualified(table, database))
    return spark.table(qualified(table, database))


class Stages:
    """Intermediate results as managed tables of the current database, dropped when the block ends, also by an
    error. Names get a suffix of their own, so that two runs don't meet."""

    def __init__(self, spark: SparkSession, fmt: str = "parquet"):
        self.spark, self.fmt, self.made, self.suffix = spark, fmt, [], uuid.uuid4().hex[:12]

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as the stage ``name``, replacing it, and read it back."""
        table = f"{name}_{self.suffix}"
        if table not in self.made:
            self.made.append(table)
        df.write.mode("overwrite").format(self.fmt).saveAsTable(table)
        return self.spark.table(table)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        for table in self.made:
            drop_table(self.spark, table)


def drop_with_files(spark: SparkSession, table: str, database: str | None = None) -> None:
    """Drop a table and the files of its location, managed or not."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(table, database)}").where("col_name = 'Location'").collect()
    drop_table(spark, table, database)
    for r in rows:
        if path_exists(spark, r.data_type):
            remove_path(spark, r.data_type)
