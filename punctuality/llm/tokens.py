"""Token-id files: Parquet with a list column of ids, written in doc_id order and read selectively.

A file holds doc_id, n_tokens (both delta-coded) and ids (a dictionary-coded list) in row
groups and pages of set size, with the page indexes that the writer adds: a reader that wants
counts reads no ids, and one that wants a range of doc_ids skips row groups and pages.
A text's ids are those of its tokenizer followed by ``end_id``.

Byte-level BPE never merges across some places that the bytes tell (see ``piece_starts``),
so texts are cut there and each different piece goes through the tokenizer once; the ids of a text are its pieces' ids in order.

Null or empty texts have only the end id. Rows with the same doc_id are ordered by text, and
null ids come first. No rows: no ids, an empty index.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctuality.llm.common import BYTE_CODES, Sums, byte_class, ranges, slices, text_bytes, total_bytes
from punctuality.session import scratch_path

#: Pieces kept per Python worker before its cache starts anew.
CACHE_PIECES = 2_000_000

_MARKS = byte_class(lambda b: chr(b) in ",.;:!?")
_LETTERS = byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122)

_encoders: dict[str, PieceEncoder] = {}


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a text may be cut without changing its tokens, each text's start among them.

    A cut stands before a lone 0x20 or 0x0A between two visible characters, after such a 0x0A, and between an
    ASCII letter and one of ``,.;:!?``. Neighbours that could belong to another white-space character
    (ASCII up to 0x20 and 0x7F; characters that begin with C2, E1, E2 or E3) rule out
    the first two, so that some cuts are missed but none is wrong.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 4:
        visible = (data > 0x20) & (data != 0x7F)
        three = (data == 0xE1) | (data == 0xE2) | (data == 0xE3)
        two = data == 0xC2
        after = visible & ~two & ~three
        lone = np.zeros(n, bool)
        lone[3:-1] = ((data[3:-1] == 0x20) | (data[3:-1] == 0x0A)) & after[4:] & visible[2:-2] & ~two[1:-3] & ~three[:-4]
        near = (offsets[:-1, None] + np.arange(3)).ravel()  # no looking back into the text before
        lone[near[near < n]] = False
        last = offsets[1:] - 1  # nor ahead into the next one
        lone[last[last >= 0]] = False
        cut[:n] = lone
        cut[1:] |= lone & (data == 0x0A)
        cut[1:n] |= _MARKS[data[1:]] & _LETTERS[data[:-1]]
    cut[offsets[:-1]] = True
    cut[n] = False
    return np.flatnonzero(cut)


class PieceEncoder:
    """Ids of texts, through a cache of the ids of their pieces. ``cut`` gives the pieces' starts; it
    holds for one normalizer and pre-tokenizer, and a tokenizer with others is an error."""

    def __init__(self, path: str, cut, normalizer: dict | None, pre_tokenizer: dict):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side already
        from tokenizers import Tokenizer

        self.tokenizer, self.cut = Tokenizer.from_file(path), cut
        parts = json.loads(self.tokenizer.to_str())
        if parts["normalizer"] != normalizer or parts["pre_tokenizer"] != pre_tokenizer:
            raise ValueError(f"texts can't be cut into pieces for this tokenizer: {path}")
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of the pieces known, and where each one's ids are
        self.slots = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.int32)

    def _find(self, keys: np.ndarray, pieces) -> np.ndarray:
        """Slots of sorted ``keys``; ``pieces(i)`` gives the texts of those not known."""
        at = np.searchsorted(self.keys, keys)
        near = np.minimum(at, max(0, len(self.keys) - 1))
        hit = self.keys[near] == keys if len(self.keys) else np.zeros(len(keys), bool)
        slot = np.zeros(len(keys), np.int32)
        slot[hit] = self.slots[near[hit]]
        new = np.flatnonzero(~hit)
        if len(new):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces(new), add_special_tokens=False)]
            counts = np.fromiter(map(len, got), np.int32, len(got))
            flat = np.fromiter(chain.from_iterable(got), np.int32, int(counts.sum()))
            slot[new] = np.arange(len(self.counts), len(self.counts) + len(new))
            self.keys, self.slots = np.insert(self.keys, at[new], keys[new]), np.insert(self.slots, at[new], slot[new])
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
            self.counts, self.flat = np.concatenate([self.counts, counts]), np.concatenate([self.flat, flat])
        return slot

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of each text's (with the end id)."""
        filled = np.diff(offsets) > 0
        starts = self.cut(data, np.append(offsets[:-1][filled], len(data))) if len(data) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        keys = Sums(BYTE_CODES[data]).of(starts, ends) ^ (ends - starts).astype(np.uint64)
        unique, at, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > CACHE_PIECES:
            self.clear()
        raw = data.tobytes()
        slot = self._find(unique, lambda new: [raw[starts[i] : ends[i]].decode("utf-8", "replace") for i in at[new].tolist()])
        piece = slot[back]
        counts, begin = self.counts[piece].astype(np.int64), self.starts[piece]
        first = np.searchsorted(starts, offsets)  # each text's first piece
        tail = np.append(self.flat, np.int32(end_id))
        counts = np.insert(counts, first[1:], 1)
        begin = np.insert(begin, first[1:], len(self.flat))
        sums = np.append(0, np.cumsum(counts))
        last = first[1:] + np.arange(1, len(first))
        per_text = np.diff(np.append(0, sums[last]))
        return tail[ranges(begin, counts)], per_text


#: The pre-tokenizer for which ``piece_starts`` holds, without a normalizer.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def encoder(path: str, cut=piece_starts, normalizer: dict | None = None, pre_tokenizer: dict = BYTE_LEVEL) -> PieceEncoder:
    """This Python worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path, cut, normalizer, pre_tokenizer)
    return _encoders[path]


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """(doc_id, n_tokens, ids) of ``docs`` (doc_id, text as bytes), in the same order.

    ``tokenizer`` is a file that every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for b in batches:
            for i, j, data, offsets in slices(b, "text"):
                ids, counts = coder.encode(data, offsets, end_id)
                places = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(counts), pa.ListArray.from_arrays(places, pa.array(ids))],
                    ["doc_id", "n_tokens", "ids"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>")


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    file_bytes: int = 16 << 20,
    row_group_bytes: int = 8 << 20,
    page_rows: int = 1000,
) -> None:
    """Write the ids of ``docs`` to ``path``, files and rows in ascending doc_id order.

    ``file_bytes``: text per file, about; the texts are dealt to files by ranges of doc_id.
    """
    files = max(1, -(-total_bytes(docs) // file_bytes))
    d = docs.select("doc_id", text_bytes(F.col("text")).alias("text"))
    d = d.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    writer = encode_documents(d, tokenizer, end_id).write
    for k, v in {
        "parquet.writer.version": "v2",
        "parquet.block.size": row_group_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#n_tokens": "false",
        "compression": "zstd",
    }.items():
        writer = writer.option(k, str(v))
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, ids: bool = True) -> DataFrame:
    """Documents of ``path`` with doc_id from ``first`` to ``last``; without ``ids`` only the counts are read."""
    df = spark.read.parquet(path)
    if first is not None:
        df = df.where(F.col("doc_id") >= first)
    if last is not None:
        df = df.where(F.col("doc_id") <= last)
    return df if ids else df.drop("ids")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("ids")
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        at = lists.offsets.to_numpy()
        crc = [zlib.crc32(values[x:y].tobytes()) for x, y in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("file"), b.column("row"), b.column("n_tokens"), pa.array(crc, pa.int64())],
            ["doc_id", "file", "row", "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files under ``path``: ``start`` counts the ids
    of all documents before. A file's rows are summed by themselves; the one window over all
    files has a row per file."""
    df = spark.read.parquet(path)
    kind = df.schema["doc_id"].dataType.simpleString()
    file = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    rows = df.select("doc_id", file.alias("file"), F.col("_metadata.row_index").alias("row"), "n_tokens", "ids")
    rows = rows.mapInArrow(_crc, f"doc_id {kind}, file long, row long, n_tokens long, ids_crc32 long")
    counts = df.select(file.alias("f"), "n_tokens").groupBy("f").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("f", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    out = rows.join(counts, F.col("file") == F.col("f"))
    return out.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and return their index."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer or default_tokenizer(), end_id)
    return token_index(spark, path)
