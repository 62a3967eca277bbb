"""Exact-size deterministic samples and enlarged copies.

``sample_exact`` returns exactly ``n`` (or ``round(frac * N)``) rows: the first by the hash of the
key columns, then by a 128-bit hash of all columns, so that rows which still tie are copies. It never
sorts or moves the whole input, and takes the same way at every size: hashes are uniform, so the cut
lies near ``frac`` of the hash range; one pass checkpoints the rows of every 4-hex-digit bucket
(65,536 in all) up to six standard deviations past that point, and a histogram finds the bucket of the
cut in them. (If it is not there, e.g. because many rows share one hash, a histogram over the
whole input finds it and a second pass keeps the rows up to it.) The bucket is split by the
next digits until it is taken whole or holds copies of one row, of which as many as needed are made.

Counting and checkpointing run when the sample is built; only the last step is lazy.

Two hash definitions for the key: ``xxhash64`` over the typed columns (default; about a plain scan's
cost) and ``md5`` over the row as text (``md5('seed-v1-v2-...')``, nulls as ``\\N``), which any SQL
engine can reproduce, at about four times the cost (turning doubles into text).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.session import ensure_checkpoint_dir

HASH_COL = "_sample_h"
HASH_LEN = {"md5": 32, "xxhash64": 16}  # hex digits
STEP = 4  # hex digits per refinement
BUCKETS = 16**STEP  # 65,536
TIE_LEN = 32  # hex digits of the hash of all columns


def row_hash(df: DataFrame, seed: int = 42, key_cols=None, method: str = "xxhash64") -> Column:
    """Fixed-width hex text of the row hash; its text order is the sample order."""
    cols = list(key_cols or df.columns)
    if method == "md5":
        parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in cols]
        return F.md5(F.concat_ws("-", F.lit(str(seed)), *parts))
    if method == "xxhash64":
        return F.lpad(F.hex(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in cols])), HASH_LEN[method], "0")
    raise ValueError(f"unknown hash method {method!r}")


def sample_key(df: DataFrame, seed: int = 42, key_cols=None) -> Column:
    """The portable key: ``md5(seed-v1-v2-...)`` over the key columns as text."""
    return row_hash(df, seed, key_cols, "md5")


def sample_size(total: int, frac: float) -> int:
    """``round(frac * total)``, ties to even (pandas' rule)."""
    return int(round(frac * total))


def _histogram(pool: DataFrame, prefix: str) -> DataFrame:
    """Rows per next hex digits of the hash after ``prefix`` (at most 65,536
    rows). Counting by a string key is a code-generated hash aggregate; no
    min/max of the hash text, which would make Spark sort every row."""
    return pool.groupBy(F.substring(F.col(HASH_COL), len(prefix) + 1, STEP).alias("b")).agg(
        F.count(F.lit(1)).alias("c")
    )


def _cut(hist: DataFrame, prefix: str, need: int):
    """The bucket holding the ``need``-th row: (bucket prefix, its rows,
    rows still needed from it), or None when ``hist`` holds fewer rows.
    One window partition over at most 65,536 histogram rows: a proven bound."""
    upto = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = hist.withColumn("cum", F.sum("c").over(upto)).filter(F.col("cum") >= need).orderBy("b").first()
    if cut is None:
        return None
    return prefix + cut["b"], cut["c"], need - (cut["cum"] - cut["c"])


def _likely_bound(need: int, total: int, method: str) -> str:
    """Bucket text well past the expected cut: hashes are uniform, so the
    ``need``-th smallest of ``total`` lies near ``need / total``; six
    standard deviations plus two buckets beyond it."""
    q = need / total
    top = q + 6 * math.sqrt(q * (1 - q) / total) + 2 / BUCKETS
    b = min(BUCKETS - 1, int(math.ceil(top * BUCKETS)))
    text = format(b, "0{}x".format(STEP))
    return text.upper() if method == "xxhash64" else text


def sample_exact(
    df: DataFrame, frac: float | None = 0.01, seed: int = 42, n: int | None = None, key_cols=None, method: str = "xxhash64"
) -> DataFrame:
    """Exactly ``n`` (or ``round(frac * count)``) rows without replacement, the same rows on every run,
    size of cluster and partitioning. More rows than there are is an error."""
    total = df.count()
    need = n if n is not None else sample_size(total, frac)
    if not 0 <= need <= total:
        raise ValueError(f"a sample of {need} rows from {total}")
    if need == 0:
        return df.limit(0)
    if need == total:
        return df
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.withColumn(HASH_COL, row_hash(df, seed, key_cols, method))
    ensure_checkpoint_dir(df.sparkSession)
    tie = row_hash(df, seed, None, "md5")

    def keep(upto: str) -> DataFrame:
        some = hashed.filter(F.substring(F.col(HASH_COL), 1, STEP) <= F.lit(upto))
        return some.withColumn(HASH_COL, F.concat(F.col(HASH_COL), tie)).checkpoint()

    cand = keep(_likely_bound(need, total, method))
    found = _cut(_histogram(cand, ""), "", need)
    if found is None:
        found = _cut(_histogram(hashed, ""), "", need)
        cand = keep(found[0])
    prefix, pool_rows, need = found
    h = F.col(HASH_COL)
    while pool_rows > need and len(prefix) < HASH_LEN[method] + TIE_LEN:
        prefix, pool_rows, need = _cut(_histogram(cand.filter(h.startswith(prefix)), prefix), prefix, need)
    out = cand.filter(F.substring(h, 1, len(prefix)) < F.lit(prefix))
    pool = cand.filter(h.startswith(prefix))
    if pool_rows > need:  # copies of one row
        one = pool.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
        pool = one.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(need))))
    return out.select(*cols).unionByName(pool.select(*cols))


def replicate(df: DataFrame, k: int) -> DataFrame:
    """Every row ``k`` times (the enlarged 10x / 5x copies). A generator in
    the scan stage: no join, no shuffle; each task writes ``k`` times its rows."""
    if k < 1:
        return df.limit(0)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(k)))).drop("_copy")
