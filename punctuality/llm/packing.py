"""Packing documents into sequences by the sum-of-squares rule.

A document's ids are those of its tokenizer and ``end_id``. Whole windows of a long document
are sequences by themselves. The rest is placed online: among the fill levels that have a
window with room (an empty one among them), it goes to the one after which the sum over all
levels of the squared number of windows at that level is least; ties go to the fullest. An
array holds the number of windows at each level, so that all levels are compared at once.

Every partition of the input packs its own rows in one pass, without a shuffle. Open windows
are settled when there are more than ``most_open`` of them, and at the end: the emptiest
windows are cut up to fill the fullest, which leaves one window unfilled. Those last
windows, one per partition, meet in groups of ``group`` partitions and are placed and
settled there once more, so at most one sequence in a group of partitions is padded.

Null or empty texts have only the end id. Null ids and repeated rows are documents like
others. No rows: no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from punctuality.llm.common import NOT_SPACE, materialize, slices, text_bytes
from punctuality.llm.tokens import encoder

_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "rest"]
#: The last windows of partitions are numbered from here.
_SECOND = 1 << 30

#: The normalizer and pre-tokenizer for which ``blank_starts`` holds.
WORD_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
WORD_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def blank_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a text may be cut without changing its tokens: before ASCII white space that
    follows something else. White space is dropped, composes with nothing and ends every word."""
    cut = np.zeros(len(data) + 1, bool)
    blank = ~NOT_SPACE[data]
    cut[1:-1] = blank[1:] & ~blank[:-1]
    cut[offsets[:-1]] = True
    cut[len(data)] = False
    return np.flatnonzero(cut)


class Windows:
    """Open windows by fill level. A piece is (doc_id, start, ids, tokens of the document)."""

    def __init__(self, room: int, most_open: int):
        self.room, self.most_open = room, most_open
        self.full: list[list] = []  # filled windows that were not taken yet
        self._clear()

    def _clear(self) -> None:
        self.at: list[list] = [[] for _ in range(self.room)]  # the windows of each level
        self.open = 0
        # What the sum of squares gains by one more window at a level, and by one fewer.
        self.more = np.ones(self.room + 1, np.int64)
        self.fewer = np.full(self.room + 1, 1 << 40, np.int64)  # no window there
        self.more[self.room] = self.fewer[0] = 0

    def _count(self, level: int) -> None:
        n = len(self.at[level])
        self.more[level], self.fewer[level] = 2 * n + 1, 1 - 2 * n if n else 1 << 40

    def place(self, pieces: list) -> None:
        """Put ``pieces`` (together at most a window) where the sum of squares is least after it."""
        size = sum(len(p[2]) for p in pieces)
        change = self.more[size:] + self.fewer[: self.room - size + 1]
        level = len(change) - 1 - int(change[::-1].argmin())
        window = []
        if level:
            window = self.at[level].pop()
            self._count(level)
            self.open -= 1
        window.extend(pieces)
        self._put(window, level + size)
        if self.open > self.most_open:
            self.settle()

    def _put(self, window: list, fill: int) -> None:
        if fill == self.room:
            self.full.append(window)
        elif fill:
            self.at[fill].append(window)
            self._count(fill)
            self.open += 1

    def settle(self) -> None:
        """Fill the fullest windows with cuts of the emptiest until at most one is left open."""
        left = [[w, fill] for fill, some in enumerate(self.at) for w in some]  # emptiest first
        self._clear()
        first = 0
        while len(left) > first + 1:
            window, fill = left.pop()
            while fill < self.room and first < len(left):
                donor = left[first]
                doc_id, start, ids, tokens = donor[0].pop()
                n = min(self.room - fill, len(ids))
                window.append((doc_id, start + len(ids) - n, ids[len(ids) - n :], tokens))
                if n < len(ids):
                    donor[0].append((doc_id, start, ids[: len(ids) - n], tokens))
                fill, donor[1] = fill + n, donor[1] - n
                if not donor[1]:
                    first += 1
            self._put(window, fill)
        for window, fill in left[first:]:
            self._put(window, fill)

    def last(self) -> list:
        """The open windows."""
        return [w for some in self.at for w in some]


def _rows(windows: list[list], first: int, kind: pa.DataType, rest: bool = False) -> pa.RecordBatch:
    """A row per piece of ``windows``, numbered from ``first``; with ``rest``, the pieces' ids come along."""
    columns: list[list] = [[] for _ in _PIECE]
    for number, window in enumerate(windows, first):
        offset = 0
        for doc_id, start, ids, tokens in window:
            raw = ids.astype("<u4").tobytes()
            values = (doc_id, start, len(ids), zlib.crc32(raw), tokens, number, offset, raw if rest else None)
            for column, value in zip(columns, values, strict=True):
                column.append(value)
            offset += len(ids)
    kinds = [kind, *[pa.int64()] * 6, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _PIECE)


def packed_partitions(docs: DataFrame, tokenizer: str, end_id: int, room: int, most_open: int) -> DataFrame:
    """The pieces of every partition's sequences. Those of its last window come with their ids in ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, blank_starts, WORD_NORMALIZER, WORD_PRE_TOKENIZER)
        number = TaskContext.get().partitionId() << 32
        windows = Windows(room, most_open)
        for b in batches:
            for i, j, data, offsets in slices(b, "text"):
                ids, counts = coder.encode(data, offsets, end_id)
                ends = np.cumsum(counts)
                for doc_id, n, end in zip(b.column("doc_id").slice(i, j - i).to_pylist(), counts.tolist(), ends.tolist(), strict=True):
                    own = ids[end - n : end]
                    whole = n - n % room
                    windows.full.extend([(doc_id, at, own[at : at + room], n)] for at in range(0, whole, room))
                    if whole < n:
                        windows.place([(doc_id, whole, own[whole:].copy(), n)])
                if windows.full:
                    yield _rows(windows.full, number, kind)
                    number += len(windows.full)
                    windows.full = []
        windows.settle()
        yield _rows(windows.full, number, kind)
        yield _rows(windows.last(), number + len(windows.full), kind, rest=True)

    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    d = docs.select("doc_id", text_bytes(F.col("text")).alias("text"))
    columns = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, rest binary"
    return d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {columns}")


def packed_rests(rests: DataFrame, room: int, most_open: int, group: int) -> DataFrame:
    """The last windows of ``group`` partitions, packed together."""

    def run(t: pa.Table) -> pa.Table:
        kind = t.schema.field("doc_id").type
        t = t.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        by_window: dict[int, list] = {}
        for r in t.to_pylist():
            piece = (r["doc_id"], r["start"], np.frombuffer(r["rest"], "<u4"), r["doc_tokens"])
            by_window.setdefault(r["sequence_id"], []).append(piece)
        windows = Windows(room, most_open)
        for pieces in by_window.values():
            windows.place(pieces)
        windows.settle()
        number = (_SECOND + (min(by_window) >> 32) // group) << 32
        return pa.Table.from_batches([_rows([*windows.full, *windows.last()], number, kind)])

    grouped = rests.withColumn("__group", F.floor(F.shiftright("sequence_id", 32) / group)).groupBy("__group")
    return grouped.applyInArrow(lambda t: run(t), rests.schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, room: int = 2048, most_open: int = 2048, group: int = 1024
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``room``: ids
    of a sequence; an open window holds fewer than that, so ``most_open`` bounds a task's memory."""
    first = materialize(packed_partitions(docs, tokenizer or default_tokenizer(), end_id, room, most_open), "packing")
    second = packed_rests(first.where("rest is not null"), room, most_open, group)
    return first.where("rest is null").unionByName(second).drop("rest")
