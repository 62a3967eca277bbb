"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only.

Each source has a target; ``target / size`` copies of each of its documents meet it in
expectation. The whole part of that number is taken outright, the fraction is rounded by
pairing: two documents with fractional copies exchange mass (copies times size, so the
source's words stay the same) until one of them is whole, in the direction that keeps both
expectations. Documents are folded in groups of about ``fan``; each group leaves at most
one fractional document, and those meet in the next level of a reduction tree until one
per source is left, which is rounded by chance. The words taken from a source thus miss
its target by less than one document.

Groups are dealt by a hash of the document within its source, so a hot source becomes many
small groups. Rows that agree in id, source and size are one unit, which are counted before anything is
shuffled by source. Of a unit of n rows with the fraction f, floor(n * f) rows are rounded up outright, and one row
goes to the tree with what is left of n * f, so that also a source of equal rows misses its target by less
than one document. Which rows of a unit are rounded up goes by a hash of their columns.

Null source: a source of its own, ordered last. Null text: size 0, taken 0 times. Null id:
an id like any other. No rows: an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"


def n_words(column: Column) -> Column:
    """Number of words in a text, 0 for null."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, units, target): one row per source of ``sizes`` (source, size, rows).

    Sources in code-point order (null last) take the weights in turn. ``share`` times all
    words is dealt by weight; a target stops at ``most`` times its source's words and the
    excess is dealt again. That ends at the level L with target = min(cap, L * weight): with
    sources ordered by cap / weight, those below L form a prefix, and L is the greatest of
    what is left to deal over what weight is left, among the sources that it does not fill.
    The windows here hold one row per source.
    """
    per = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_fill = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / weight)
    per = per.withColumn("level", F.max(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))).over(everything))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return per.select("source", "source_size", "units", target.alias("target"))


def _chance(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _pair(seed: int, state: Column, item: Column) -> Column:
    """One pairing: the open document of ``state`` with ``item``; one of them becomes whole."""
    a, p = state["open"]["mass"], state["open"]["part"]
    b, q = item["mass"], item["part"]
    to_a = F.least(a * (1 - p), b * q)  # mass that can move to the open document
    to_b = F.least(a * p, b * (1 - q))
    up = _chance(seed, state["open"]["key"], item["key"]) * (to_a + to_b) < to_b
    a_up, b_down = a * (1 - p) <= b * q, a * p <= b * (1 - q)

    def unit(of: Column, part: Column) -> Column:
        return F.struct(of["key"].alias("key"), of["mass"].alias("mass"), part.alias("part"))

    # up: the open one gains; it is filled (a_up) or the item is emptied. Else it loses.
    done = F.when(
        up, F.when(a_up, unit(state["open"], F.lit(1.0))).otherwise(unit(item, F.lit(0.0)))
    ).otherwise(F.when(b_down, unit(state["open"], F.lit(0.0))).otherwise(unit(item, F.lit(1.0))))
    still = F.when(
        up, F.when(a_up, unit(item, q - a * (1 - p) / b)).otherwise(unit(state["open"], p + b * q / a))
    ).otherwise(F.when(b_down, unit(item, q + a * p / b)).otherwise(unit(state["open"], p - b * (1 - q) / a)))
    return F.struct(still.alias("open"), F.concat(state["done"], F.array(done)).alias("done"))


def _fold(items: Column, seed: int) -> Column:
    """Pair the items of a group one after another: (open, done)."""
    first = F.element_at(items, 1)
    start = F.struct(first.alias("open"), F.slice(items, 1, 0).alias("done"))
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), start, lambda s, x: _pair(seed, s, x))


def round_units(units: DataFrame, fan: int = 64, seed: int = 20) -> DataFrame:
    """(source, key, extra): 1 if a unit's fraction is rounded up, else 0.

    ``units``: source, key (unique in its source), mass, part (0 < part < 1), units (of the
    source). Each level is written to the shared folder.
    """
    spot = F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.ceil(F.col("units") / fan))
    level = units.select("source", "key", "mass", "part", spot.alias("spot"), F.ceil(F.col("units") / fan).alias("spots"))
    decided = []
    while True:
        groups = level.groupBy("source", "spots", "spot").agg(
            F.array_sort(F.collect_list(F.struct("key", "mass", "part"))).alias("items")
        )
        folded = materialize(groups.select("source", "spots", "spot", _fold(F.col("items"), seed).alias("f")), "mix-level")
        decided.append(folded.select("source", F.explode("f.done").alias("u")).select("source", "u.key", F.col("u.part").alias("extra")))
        most = folded.agg(F.max("spots")).first()[0] or 0
        is_last = F.col("spots") == 1
        decided.append(
            folded.where(is_last).select(
                "source",
                "f.open.key",
                F.when(_chance(seed + 2, F.col("f.open.key")) < F.col("f.open.part"), 1.0).otherwise(0.0).alias("extra"),
            )
        )
        if most <= 1:
            return reduce(DataFrame.unionByName, decided)
        level = folded.where(~is_last).select(
            "source",
            "f.open.key",
            "f.open.mass",
            "f.open.part",
            F.floor(F.col("spot") / fan).alias("spot"),
            F.ceil(F.col("spots") / fan).alias("spots"),
        )


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    fan: int = 64,
    seed: int = 20,
) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, whole, more): one row per unit of ``docs``
    (equal doc_id, source and size; ``rows`` such rows), each of which is taken ``whole`` times, and ``more`` of them
    once more."""
    units = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    units = materialize(units.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-units")
    targets = materialize(source_targets(units.select("source", "size", "rows"), weights, share, most), "mix-targets")
    at = targets.select(F.col("source").alias("s"), "source_size", "units", "target")
    u = units.join(at, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = u.withColumn("whole", F.floor(rate)).withColumn("part", rate - F.floor(rate))
    u = u.withColumn("key", F.struct(F.xxhash64(F.lit(seed), "doc_id", "size").alias("h"), "doc_id", "size"))
    up = F.when(F.col("size") > 0, F.col("rows") * F.col("part")).otherwise(F.lit(0.0))
    u = u.withColumn("sure", F.floor(up)).withColumn("open", up - F.floor(up))
    open_units = u.where("open > 0").select("source", "key", F.col("size").cast("double").alias("mass"), F.col("open").alias("part"), "units")
    extra = round_units(open_units, fan, seed).select(
        F.col("source").alias("s"), F.col("key.doc_id").alias("d"), F.col("key.size").alias("z"), "extra"
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("z")) & F.col("source").eqNullSafe(F.col("s"))
    out = u.join(extra, same, "left")
    whole = F.when(F.col("size") == 0, 0).otherwise(F.col("whole")).cast("int")
    more = F.col("sure") + F.coalesce(F.col("extra"), F.lit(0.0)).cast("long")
    return out.select("doc_id", "source", "size", "rows", "source_size", "target", whole.alias("whole"), more.alias("more"))


#: Parts that the different rows of one unit are numbered in.
SALTS = 256


def _numbered(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` of units of which some rows are rounded up (``__more`` of ``__rows``), with ``__n``, how often each is
    taken. Equal rows are counted map-side and are one row here; the others of a unit are numbered in parts by their hash."""
    unit = ["__d", "__s", "__z"]
    same = rows.groupBy(*columns, *unit, "__whole", "__more").agg(F.count(F.lit(1)).alias("__m"))
    same = same.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in columns])).withColumn("__salt", F.pmod("__h", F.lit(SALTS)))
    same = materialize(same, "mix-repeated")
    before = lambda w: F.coalesce(F.sum("__m").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = same.groupBy(*unit, "__salt").agg(F.sum("__m").alias("__m"))
    parts = parts.withColumn("__base", before(Window.partitionBy(*unit).orderBy("__salt"))).drop("__m")
    names = {c: f"{c}_" for c in (*unit, "__salt")}
    at = parts.select(*[F.col(c).alias(n) for c, n in names.items()], "__base")
    out = same.join(at, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]))
    place = F.col("__base") + before(Window.partitionBy(*unit, "__salt").orderBy("__h", *[F.col(f"`{c}`") for c in columns]))
    up = F.greatest(F.lit(0), F.least(F.col("__m"), F.col("__more") - F.col("__place")))
    return out.withColumn("__place", place).withColumn("__n", (F.col("__m") * F.col("__whole") + up).cast("int"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Columns must be comparable (no maps)."""
    plan = materialize(mix_sources(docs, **options).where("whole > 0 or more > 0"), "mix-plan")
    plan = plan.select(
        F.col("doc_id").alias("__d"), F.col("source").alias("__s"), F.col("size").alias("__z"), F.col("rows").alias("__rows"),
        F.col("whole").alias("__whole"), F.col("more").alias("__more"),
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("__d"))
        & F.col("source").eqNullSafe(F.col("__s"))
        & (n_words(F.col("text")) == F.col("__z"))
    )
    alike = (F.col("__more") == 0) | (F.col("__more") == F.col("__rows"))
    # One plan at every size: the documents are dealt with the plan's rows, which are as many.
    one = docs.join(plan.where(alike).hint("merge"), same).withColumn("__n", F.col("__whole") + F.least("__more", F.lit(1).cast("long")).cast("int"))
    take = lambda rows: rows.where("__n > 0").withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*docs.columns)
    split = plan.where(~alike)
    if split.isEmpty():  # no unit of which only some rows are rounded up: the documents are dealt once
        return take(one)
    some = _numbered(docs.join(split, same), docs.columns)
    return take(one).unionByName(take(some))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken (words)."""
    m = mix_sources(docs, **options).withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = F.col("whole") + F.when(F.col("__k") <= F.col("more"), 1).otherwise(0)
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))
