"""Data profiling: nulls, distinct values, frequencies, the null-delay checks.

Each profile is one aggregation pass whose result has one row per column
or per value; nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuality.functions.numeric import ratio_pct, round2


def _per_column(df: DataFrame, values: list[Column], value_name: str, extra: list[Column] | None = None) -> DataFrame:
    """One aggregation row -> one row per column: (position, column, value)."""
    aliased = [v.alias(f"_v{i}") for i, v in enumerate(values)]
    row = df.agg(*aliased, *(extra or []))
    items = F.array(
        *[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), F.col(f"_v{i}").alias(value_name)) for i, c in enumerate(df.columns)]
    )
    rest = [c for c in row.columns if not c.startswith("_v")]
    return row.select(F.explode(items).alias("_p"), *rest).select("_p.*", *rest)


def null_profile(df: DataFrame) -> DataFrame:
    """(position, column, null_count, null_pct) with the percentage of rows, 2 decimals."""
    counts = [F.count(F.when(F.col(f"`{c}`").isNull(), F.lit(1))) for c in df.columns]
    prof = _per_column(df, counts, "null_count", [F.count(F.lit(1)).alias("_rows")])
    return prof.select(
        "position",
        "column_name",
        "null_count",
        round2(F.when(F.col("_rows") > 0, ratio_pct("null_count", "_rows"))).alias("null_pct"),
    )


def _distinct_text(f: T.StructField):
    """A text that is equal for equal values of the column only."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.FloatType | T.DoubleType):
        return (c + F.lit(0.0)).cast("string")  # one zero
    if isinstance(f.dataType, T.BinaryType):
        return F.hex(c)
    if isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType):
        return F.when(c.isNotNull(), F.to_json(c))
    return c.cast("string")


#: Beyond this, a double no longer tells whole numbers apart.
_WHOLE = float(1 << 53)


def _forms(f: T.StructField) -> tuple[Column, Column, Column]:
    """A value as a long, a double or a text: one of the three, and null in the others; null has none."""
    c = F.col(f"`{f.name}`")
    none = [F.lit(None).cast(t) for t in ("long", "double", "string")]
    if isinstance(f.dataType, T.IntegralType | T.BooleanType):
        none[0] = c.cast("long")
    elif isinstance(f.dataType, T.DateType):
        none[0] = F.unix_date(c).cast("long")
    elif isinstance(f.dataType, T.FloatType | T.DoubleType):
        none[1] = c.cast("double")
    else:
        none[2] = _distinct_text(f)
    return tuple(none)


def distinct_profile(df: DataFrame, cols=None, approx: bool = False, rsd: float = 0.01, per_column: bool = False) -> DataFrame:
    """(position, column, distinct_count), nulls not counted.

    Exact, in one scan, by bitmaps: each row gives one entry per column. A whole number (also a
    date, a boolean, or a double such as whole minutes) is a bit in the 64-bit word of its 64 neighbours,
    any other value a text; words are or-ed and texts deduplicated map-side, and the bits are counted after
    the shuffle. So a column of whole numbers sends a row per word and task, not one per value.
    ``per_column=True``: one single-column ``count(DISTINCT c)`` per column, unioned; each branch
    scans anew but reads only its own column where the format stores columns.
    ``approx=True``: one pass with a HyperLogLog++ sketch per column, a
    fixed-size buffer per task.
    """
    sub = df.select(*[f"`{c}`" for c in cols]) if cols else df
    if approx:
        return _per_column(sub, [F.approx_count_distinct(F.col(f"`{c}`"), rsd) for c in sub.columns], "distinct_count")
    if per_column:
        parts = [
            sub.agg(F.count_distinct(F.col(f"`{c}`")).alias("distinct_count")).select(
                F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), "distinct_count"
            )
            for i, c in enumerate(sub.columns)
        ]
        return reduce(DataFrame.unionByName, parts)
    names = F.array(*[F.lit(c) for c in sub.columns])
    entries = []
    for i, f in enumerate(sub.schema.fields):
        number, real, text = _forms(f)
        entries.append(F.struct(F.lit(i + 1).alias("position"), number.alias("number"), real.alias("real"), text.alias("value")))
    # Words and bits are made after the rows were dealt out, once for all columns: small generated code.
    whole = (F.abs("real") < _WHOLE) & (F.col("real") == F.rint("real"))
    values = sub.select(F.inline(F.array(*entries))).select(
        "position",
        F.coalesce("number", F.when(whole, F.col("real").cast("long"))).alias("number"),
        F.coalesce("value", F.when(~whole, F.col("real").cast("string"))).alias("value"),
    )
    values = values.select(
        "position",
        F.shiftright("number", 6).alias("word"),
        "value",
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("number").bitwiseAND(63).cast("int")).alias("bits"),
    )
    none = [F.lit(None).cast(t).alias(n) for t, n in (("long", "word"), ("string", "value"), ("long", "bits"))]
    every = df.sparkSession.range(1, len(entries) + 1).select(F.col("id").cast("int").alias("position"), *none)
    words = values.unionByName(every).groupBy("position", "word", "value").agg(F.bit_or("bits").alias("bits"))
    found = F.sum(F.coalesce(F.bit_count("bits"), F.col("value").isNotNull().cast("int")).cast("long"))
    counts = words.groupBy("position").agg(found.alias("distinct_count"))
    return counts.select("position", F.get(names, F.col("position") - 1).alias("column_name"), "distinct_count")


def distinct_sketches(df: DataFrame, keys=(), cols=None, lg_k: int = 13) -> DataFrame:
    """(keys..., position, column_name, sketch): a storable sketch of each column's distinct values per group,
    in one pass. Sketches of different groups, days or tables are merged by :func:`merge_sketches`."""
    keys = list(keys)
    cols = list(cols) if cols else [c for c in df.columns if c not in keys]
    values = [_distinct_text(df.schema[c]) for c in cols]
    row = df.groupBy(*keys).agg(*[F.hll_sketch_agg(v, lg_k).alias(f"_v{i}") for i, v in enumerate(values)])
    items = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), F.col(f"_v{i}").alias("sketch")) for i, c in enumerate(cols)])
    return row.select(*keys, F.inline(items))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """(position, column_name, distinct_count): estimates over all stored sketches of each column."""
    merged = sketches.groupBy("position", "column_name").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("position", "column_name", F.hll_sketch_estimate("sketch").alias("distinct_count"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values of ``col``."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(col, frequency) for non-null values, most frequent first, ties by value."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("frequency"))
        .orderBy(F.desc("frequency"), F.asc(col))
    )


def null_delay_by_status(df: DataFrame, delay: str = "arr_delay", status: str = "cancelled") -> DataFrame:
    """Rows with a null ``delay``, counted by ``status`` (cancelled 0 / 1)."""
    return df.filter(F.col(delay).isNull()).groupBy(status).agg(F.count(F.lit(1)).alias("null_delay_flights"))


def cancelled_null_check(df: DataFrame, delay: str = "arr_delay", cancelled: str = "cancelled") -> DataFrame:
    """One row: cancelled flights, and how many of them have a null delay."""
    is_c = F.col(cancelled) == 1
    return df.agg(
        F.count(F.when(is_c, F.lit(1))).alias("cancelled_flights"),
        F.count(F.when(is_c & F.col(delay).isNull(), F.lit(1))).alias("cancelled_null_delay"),
    )


def diverted_check(
    df: DataFrame, delay: str = "arr_delay", cancelled: str = "cancelled", diverted: str = "diverted"
) -> DataFrame:
    """Are all not-cancelled flights with a null delay diverted?

    One row: suspects, diverted, other (suspects with diverted = 0) and a
    verdict: ``confirmed`` (all suspects diverted), ``partial`` (some) or
    ``refuted`` (none, or no suspects).
    """
    suspect = F.col(delay).isNull() & (F.col(cancelled) == 0)
    row = df.agg(
        F.count(F.when(suspect, F.lit(1))).alias("suspects"),
        F.count(F.when(suspect & (F.col(diverted) == 1), F.lit(1))).alias("diverted"),
        F.count(F.when(suspect & (F.col(diverted) == 0), F.lit(1))).alias("other"),
    )
    verdict = (
        F.when((F.col("diverted") > 0) & (F.col("diverted") == F.col("suspects")), F.lit("confirmed"))
        .when(F.col("diverted") > 0, F.lit("partial"))
        .otherwise(F.lit("refuted"))
    )
    return row.withColumn("verdict", verdict)


def dataset_shape(df: DataFrame) -> DataFrame:
    """One row: (n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) pairs from the schema (metadata only, no job)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def schema_frame(df: DataFrame) -> DataFrame:
    """(position, column_name, type) of ``df`` as rows (metadata only)."""
    rows = [(i, *r) for i, r in enumerate(schema_rows(df), 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, type string")


def profile_all(
    df: DataFrame, delay: str = "arr_delay", cancelled: str = "cancelled", diverted: str = "diverted"
) -> DataFrame:
    """(section, position, item, metric, value): everything that one pass over ``df`` can tell.

    ``shape`` (rows, columns), ``schema`` (type), ``nulls`` (null_count and null_pct of each column) and, where the
    columns exist, ``null_delay`` (rows without delay by cancelled 0, 1, other or null), ``cancelled_null`` and
    ``diverted`` (as :func:`cancelled_null_check` and :func:`diverted_check`). All tallies are fixed-width
    buffers of one aggregation; values are texts, percentages with two decimals (none without rows).
    """
    count = lambda cond: F.count(F.when(cond, F.lit(1)))
    text = lambda c: c.cast("string")
    tallies: dict[str, Column] = {"rows": F.count(F.lit(1))}
    items: list[tuple[str, int, str, str, Column]] = [
        ("shape", 1, "rows", "n", text(F.col("rows"))),
        ("shape", 2, "columns", "n", F.lit(str(len(df.columns)))),
    ]
    for i, (f, (_, kind)) in enumerate(zip(df.schema.fields, schema_rows(df), strict=True), 1):
        tallies[f"null_{i}"] = count(F.col(f"`{f.name}`").isNull())
        pct = F.when(F.col("rows") > 0, round2(ratio_pct(f"null_{i}", "rows")).cast("decimal(38,2)"))
        items += [
            ("schema", i, f.name, "type", F.lit(kind)),
            ("nulls", i, f.name, "null_count", text(F.col(f"null_{i}"))),
            ("nulls", i, f.name, "null_pct", text(pct)),
        ]
    if {delay, cancelled} <= set(df.columns):
        missing, status = F.col(delay).isNull(), F.col(cancelled)
        by_status = {"0": status == 0, "1": status == 1, "other": ~status.isin(0, 1), "null": status.isNull()}
        for i, (name, cond) in enumerate(by_status.items(), 1):
            tallies[f"by_{name}"] = count(missing & cond)
            items.append(("null_delay", i, name, "flights", text(F.col(f"by_{name}"))))
        tallies["cancelled"] = count(status == 1)
        items.append(("cancelled_null", 1, "cancelled_flights", "flights", text(F.col("cancelled"))))
        items.append(("cancelled_null", 2, "cancelled_null_delay", "flights", text(F.col("by_1"))))
        if diverted in df.columns:
            suspect = missing & (status == 0)
            tallies["diverted"] = count(suspect & (F.col(diverted) == 1))
            tallies["not_diverted"] = count(suspect & (F.col(diverted) == 0))
            some = F.col("diverted") > 0
            verdict = F.when(some & (F.col("diverted") == F.col("by_0")), "confirmed").when(some, "partial").otherwise("refuted")
            for i, (name, value) in enumerate(
                {"suspects": F.col("by_0"), "diverted": F.col("diverted"), "other": F.col("not_diverted"), "verdict": verdict}.items(), 1
            ):
                items.append(("diverted", i, name, "verdict" if name == "verdict" else "flights", text(value)))
    row = df.agg(*[c.alias(n) for n, c in tallies.items()])
    entry = lambda s, i, item, metric, value: F.struct(
        F.lit(s).alias("section"), F.lit(i).alias("position"), F.lit(item).alias("item"), F.lit(metric).alias("metric"), value.alias("value")
    )
    return row.select(F.inline(F.array(*[entry(*x) for x in items])))


def head(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
