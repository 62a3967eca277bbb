"""Source divergence audit by a frequent-pattern tree of term rows.

Of each language's terms that are in at least ``least_docs`` of its documents, every source has smoothed
shares: whole numbers p = 1 + floor(unit * (count + 1) / (N + V)). The divergence of a source
from another one is the sum over all V terms of floor((p - q)^2 / q).

Nearly all terms are absent from most sources, and an absent term's share is the same for all of a
source. So the sum of a pair starts at V times the value for two absent terms, and is
corrected for what is present:

* a source's terms of one count correct it, against the other source's absent share,
  by one step per (source, count), times the number of such terms;
* terms that both have are corrected once more, in a tree: a term's row is its nonzero counts in the
  order of the sources, equal rows are one with a multiplicity, and rows with a common
  beginning share nodes. A node counts the terms that pass it, so each pair of a node and an
  ancestor gives the correction of all those terms at once.

Rows reach the trees sorted, so that common beginnings meet; a tree holds one batch of rows and
its sums by pair go on. Shared beginnings that fall into two trees are corrected in
both, each for its own terms. All arithmetic is on whole numbers.

Null text, lang and source count as ''. A source without kept terms has its group too. Very long texts are
handled alone, whole. Repeated rows are documents of their own. No rows: an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import LOWER, byte_class, materialize, slices, text_bytes, word_bounds, word_hashes

#: ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, of lower-cased text
LETTERS = byte_class(lambda b: 0x61 <= b <= 0x7A or b >= 0x80)
#: Bytes of text whose terms are counted together inside a task.
COUNT_BYTES = 4 << 20
#: Pairs whose sums a task holds before they go on.
MOST_PAIRS = 500_000
#: Parts that a language's sources are dealt to where they meet each other.
SALTS = 16


def _groups_of(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str], list[str]]:
    """Each row's group, and the groups' languages and sources."""
    lang, source = (batch.column(i).dictionary_encode() for i in (0, 1))
    code = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
    groups, row = np.unique(code, return_inverse=True)
    of = lambda column, at: [column.dictionary[int(x)].as_py() for x in at]
    size = max(1, len(source.dictionary))
    return row, of(lang, groups // size), of(source, groups % size)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            group, langs, sources = _groups_of(b)
            for i, j, data, offsets in slices(b, "text", COUNT_BYTES):
                data = LOWER[data]
                starts, ends, first = word_bounds(data, offsets, LETTERS)
                if not len(starts):
                    continue
                text = np.repeat(np.arange(j - i), np.diff(first))
                terms, at, term = np.unique(word_hashes(data, starts, ends, False), return_index=True, return_inverse=True)
                raw = data.tobytes()
                names = pa.array([raw[starts[x] : ends[x]].decode("utf-8", "replace") for x in at.tolist()], pa.string())
                in_text, n = np.unique(text * len(terms) + term, return_counts=True)
                in_group, back = np.unique(group[i:j][in_text // len(terms)] * len(terms) + in_text % len(terms), return_inverse=True)
                g = in_group // len(terms)
                columns = [
                    pa.array([langs[x] for x in g], pa.string()),
                    pa.array([sources[x] for x in g], pa.string()),
                    names.take(pa.array(in_group % len(terms))),
                    pa.array(np.bincount(back, n).astype(np.int64)),
                    pa.array(np.bincount(back).astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    per_slice = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    # Few rows of a slice agree in source and term, so they are added up where all counts of a term meet.
    return per_slice.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, total, first) of the terms that are in at least ``least_docs`` documents of their
    language: ``total`` sums n over its sources, of which the smallest is marked ``first``."""
    term = Window.partitionBy("lang", "term")
    out = term_counts(docs).withColumn("in_docs", F.sum("docs").over(term)).withColumn("total", F.sum("n").over(term))
    out = out.withColumn("first", F.col("source") == F.min("source").over(term)).where(F.col("in_docs") >= least_docs)
    return out.select("lang", "source", "term", "n", "total", "first")


def share(n: Column, size: Column, unit: int) -> Column:
    """1 + floor(unit * (n + 1) / size), exactly."""
    return F.call_function("div", F.lit(unit).cast("decimal(12,0)") * (n + 1).cast("decimal(20,0)"), size.cast("decimal(20,0)")) + 1


def step(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); both are at most the unit plus one."""
    return F.call_function("div", (p - q) * (p - q), q)


def _step(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class TermTree:
    """Prefix tree of rows of (source, share, absent share), with the number of terms through each node."""

    def __init__(self):
        self.child: dict[tuple, int] = {}
        self.parent: list[int] = []
        self.entry: list[tuple] = []
        self.terms: list[int] = []

    def insert(self, root: str, row: list[tuple], times: int) -> None:
        at: int | str = root
        for entry in row:
            key = (at, entry)
            found = self.child.get(key)
            if found is None:
                found = self.child[key] = len(self.parent)
                self.parent.append(-1 if at is root else at)
                self.entry.append(entry)
                self.terms.append(0)
            self.terms[found] += times
            at = found

    def corrections(self) -> Iterator[tuple[int, int, int, int]]:
        """(source of an ancestor, of a node, correction of the first from the second, of the second from
        the first), summed over all nodes and ancestors."""
        if not self.parent:
            return
        parent = np.array(self.parent)
        source, p, absent = np.array(self.entry, np.int64).T
        terms = np.array(self.terms, dtype=object)  # sums exceed 64 bits
        node, above = np.arange(len(parent)), parent
        width = int(source.max()) + 1
        while True:
            there = above >= 0
            node, above = node[there], above[there]
            if not len(node):
                return
            a, b, a0, b0 = p[above], p[node], absent[above], absent[node]
            there = _step(a, b) - _step(a, b0) - _step(a0, b) + _step(a0, b0)
            back = _step(b, a) - _step(b0, a) - _step(b, a0) + _step(b0, a0)
            pair = source[above] * width + source[node]
            order = np.argsort(pair, kind="stable")
            pairs, first = np.unique(pair[order], return_index=True)
            sums = [np.add.reduceat((terms[node] * x.astype(object))[order], first) for x in (there, back)]
            for k, x, y in zip(pairs.tolist(), *sums, strict=True):
                yield k // width, k % width, x, y
            above = parent[above]


def tree_corrections(rows: DataFrame) -> DataFrame:
    """(lang, a, b, value): corrections of source number a from b, from rows (lang, path, times)."""

    def batch_of(total: dict) -> pa.RecordBatch:
        keys = list(total)
        columns = [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.int32()),
            pa.array([k[2] for k in keys], pa.int32()),
            pa.array([Decimal(total[k]) for k in keys], pa.decimal128(38, 0)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, int] = {}
        for batch in batches:
            trees: dict[str, TermTree] = {}
            paths = batch.column(1)
            ends = paths.value_lengths().to_numpy().cumsum()
            entries = paths.flatten()
            entries = list(zip(*(entries.field(i).to_pylist() for i in range(3)), strict=True))
            begin = 0
            for lang, end, times in zip(batch.column(0).to_pylist(), ends.tolist(), batch.column(2).to_pylist(), strict=True):
                trees.setdefault(lang, TermTree()).insert(lang, entries[begin:end], times)
                begin = end
            for lang, tree in trees.items():
                for a, b, x, y in tree.corrections():
                    total[lang, a, b] = total.get((lang, a, b), 0) + x
                    total[lang, b, a] = total.get((lang, b, a), 0) + y
            if len(total) > MOST_PAIRS:
                yield batch_of(total)
                total = {}
        yield batch_of(total)

    return rows.mapInArrow(run, "lang string, a int, b int, value decimal(38,0)")


def _sized(groups: DataFrame, kept: DataFrame, unit: int) -> DataFrame:
    """(lang, source, number, size, terms, absent, lang_size) per group: size is N + V, ``absent`` the share of a term without occurrence."""
    per_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    per_lang = kept.groupBy("lang").agg(F.sum("n").alias("all"), F.count_if("first").alias("terms"))
    out = groups.join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
    out = out.withColumn("terms", F.coalesce("terms", F.lit(0).cast("long")))
    out = out.withColumn("size", F.coalesce("n", F.lit(0).cast("long")) + F.col("terms"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    absent = F.when(F.col("terms") > 0, share(F.lit(0), F.greatest("size", F.lit(1).cast("long")), unit))
    return out.select("lang", "source", number.alias("number"), "size", "terms", absent.alias("absent"), (F.col("all") + F.col("terms")).alias("lang_size"))


def _pairs(sized: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, a, b, value): what every pair starts at, and the corrections for terms that one of them
    has. A language's sources meet in ``SALTS`` parts, which is the size of the result."""
    other = sized.select("lang", F.col("number").alias("b"), F.col("absent").alias("absent_b"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    deal = lambda *c: F.pmod(F.xxhash64(*c), F.lit(SALTS)).cast("int")
    big = lambda x: x.cast("decimal(38,0)")
    own = sized.select("lang", F.col("number").alias("a"), "terms", F.col("absent").alias("absent_a"), deal("number").alias("salt"))
    both = own.join(other, ["lang", "salt"]).where("a <> b")
    start = F.when(F.col("terms") > 0, big(F.col("terms")) * step(F.col("absent_a"), F.col("absent_b"))).otherwise(F.lit(0))
    base = both.select("lang", "a", "b", big(start).alias("value"))
    alike = kept.groupBy("lang", "number", "p", "absent").agg(F.count(F.lit(1)).alias("times"))
    alike = alike.withColumnRenamed("number", "a").withColumn("salt", deal("a", "p"))
    single = alike.join(other, ["lang", "salt"]).where("a <> b")
    p, absent, q = F.col("p"), F.col("absent"), F.col("absent_b")
    from_a = big(F.col("times")) * (step(p, q) - step(absent, q))
    from_b = big(F.col("times")) * (step(q, p) - step(q, absent))
    ways = F.array(
        F.struct(F.col("a").alias("a"), F.col("b").alias("b"), big(from_a).alias("value")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"), big(from_b).alias("value")),
    )
    return base.unionByName(single.select("lang", F.inline(ways)))


def _ranked(values: DataFrame, part: str, most: int | None = None) -> DataFrame:
    """Ranks inside each (lang, source): value descending, then the item's bytes."""
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    out = values.withColumn("rank", rank)
    out = out.where(F.col("rank") <= most) if most else out
    return out.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")


def source_divergence(docs: DataFrame, least_docs: int = 3, unit: int = 1_000_000_000, top_terms: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: the divergence of each source from each other one of its
    language (part ``pair``), and the terms of a source whose share most exceeds the language's (``term``)."""
    d = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        text_bytes(F.col("text")).alias("text"),
    )
    kept = materialize(kept_counts(d, least_docs), "divergence-terms")
    sized = materialize(_sized(d.select("lang", "source").distinct(), kept, unit), "divergence-groups")
    kept = kept.join(sized, ["lang", "source"]).select(
        "lang", "source", "term", "number", "absent", share(F.col("n"), F.col("size"), unit).alias("p"), share(F.col("total"), F.col("lang_size"), unit).alias("q")
    )
    kept = materialize(kept, "divergence-shares")

    rows = kept.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("number", "p", "absent"))).alias("path"))
    rows = rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    trees = tree_corrections(rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path"))
    sums = _pairs(sized, kept).unionByName(trees).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    name = lambda number, as_name: sized.select("lang", F.col("number").alias(number), F.col("source").alias(as_name))
    pairs = sums.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    terms = kept.where("p > q").select("lang", "source", F.col("term").alias("item"), step(F.col("p"), F.col("q")).alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(terms, "term", top_terms))
