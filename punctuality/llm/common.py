"""Helpers shared by the text operators: scratch tables, word splitting and hashing with numpy.

Texts reach Python as Arrow batches of UTF-8 bytes and are handled in slices of a few
MB, so that a task's memory depends on the slice (or on its longest text), not on the
partition.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality.session import remove_path, scratch_path

#: Bytes of text that are handled at once inside a task (one longer text is handled alone).
SLICE_BYTES = 1 << 20
#: Row groups of intermediate tables: what a writing task buffers.
ROW_GROUP_BYTES = 16 << 20

_U = np.uint64
_RADIX = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_RADIX, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back: cuts the
    lineage with files that outlive a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that no later step reads."""
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(df.sparkSession, file)


def text_bytes(column: Column) -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(column.cast("binary"), F.lit(b""))


def id_fold(column: Column, folds: int) -> Column:
    """crc32 of an id written as text, modulo ``folds`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes of text."""
    column = batch.column(batch.schema.get_field_index(text))
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def byte_class(inside) -> np.ndarray:
    """A lookup table of the bytes for which ``inside`` holds."""
    return np.array([bool(inside(b)) for b in range(256)])


#: ``[^\\x20\\x09-\\x0D]+``
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, of lower-cased text
ALNUM = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: A-Z to a-z, other bytes unchanged
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``, and each text's first word (one entry more than texts)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = table[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    before[cut] = False
    after[cut - 1] = False
    starts = np.flatnonzero(inside[1:-1] & ~before)
    ends = np.flatnonzero(inside[1:-1] & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse, from 0 to ``n``."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", _RADIX), ("down", _INVERSE)):
            p = np.full(size, base, _U)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=_U)
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


class Sums:
    """Polynomial hashes of any stretch of a sequence of 64-bit codes, from prefix sums modulo 2**64."""

    def __init__(self, codes: np.ndarray):
        up, self.down = powers(len(codes))
        self.sums = np.zeros(len(codes) + 1, _U)
        np.cumsum(codes * up[: len(codes)], dtype=_U, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def of_run(self, first: int, last: int, size: int) -> np.ndarray:
        """Of the stretches of ``size`` codes that start at ``first`` up to before ``last``."""
        return mix((self.sums[first + size : last + size] - self.sums[first:last]) * self.down[first:last])

    def of_all(self, size: int) -> np.ndarray:
        """Of every stretch of ``size`` codes."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


#: 64-bit codes of the bytes, unequal and fixed.
BYTE_CODES = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word; A-Z count as a-z if ``lower``."""
    codes = BYTE_CODES[LOWER] if lower else BYTE_CODES
    return Sums(codes[data]).of(starts, ends)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of ``start, start + 1, ...`` of ``counts`` numbers each."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = counts > 0
    starts, counts = starts[keep].astype(np.int64), counts[keep]
    out[0] = starts[0]
    at = np.cumsum(counts)[:-1]
    out[at] = starts[1:] - (starts[:-1] + counts[:-1] - 1)
    return np.cumsum(out)


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans [start, end)."""
    d = np.zeros(size + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


def total_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, one number to the driver."""
    return int(df.select(F.sum(F.octet_length(F.col(column)).cast("long"))).first()[0] or 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (on a cluster,
    where that path means nothing, ship it with ``--py-files``)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


#: Python workers give freed memory back instead of keeping it for the next step.
_LEAN = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "MALLOC_ARENA_MAX": "2"}


def lean_workers(spark: SparkSession, records: int = 2000) -> None:
    """For jobs of many steps on the same executors: lean Python workers and Arrow batches of at most ``records`` rows."""
    for k, v in _LEAN.items():
        spark.sparkContext.environment.setdefault(k, v)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(min(records, int(spark.conf.get(key)))))
