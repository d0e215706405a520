"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, text_or_empty, written

#: No source is repeated more often than this.
MOST = 3
#: The weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Documents that one task of a level of the tree rounds together.
GROUP = 4096


def _places(sizes: DataFrame) -> DataFrame:
    """Add ``place``, the place of each source in code point order, null last, from 0.

    Sources are dealt by ranges; each range counts its own, and a row for each range ties them together.
    """
    order = F.col("source").asc_nulls_last()
    dealt = written(sizes.repartitionByRange(order).withColumn("pid", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("pid").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("pid", "before")
    rows = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("pid").orderBy(order)))
    return rows.join(F.broadcast(counts), "pid").withColumn("place", F.col("before") + F.col("nth") - 1).drop("pid", "before", "nth")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row a source).

    Sources in code point order, null last, weigh 5, 2, 1, repeating. The sum
    of all sizes is shared by weight; a target stops at three times its
    source's size, and the excess is shared anew by weight until none is above.
    Each time all that is above stops, and three sums of whole numbers tell the share of the others,
    so no order of sources matters and none meet in one task.
    """
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int")).cast("long")
    rows = written(_places(sizes.select("source", "source_size")).withColumn("weight", weight).withColumn("most", MOST * F.col("source_size")), "mix-weights")
    total, units, stopped = *rows.agg(F.sum("source_size"), F.sum("weight")).first(), 0
    if not units:
        return rows.select("source", "source_size", F.lit(0.0).alias("target"))
    rest, free = total, units

    def over(rest, free):
        wide = lambda c, digits: c.cast(f"decimal({digits},0)")
        return wide(F.lit(rest), 20) * wide(F.col("weight"), 3) > wide(F.col("most"), 20) * wide(F.lit(free), 17)

    while free:
        above = over(rest, free)
        n, held, weights = rows.where(above).agg(F.count("*"), F.sum("most"), F.sum("weight")).first()
        if n == stopped:
            break
        stopped, rest, free = n, total - held, units - weights
    target = F.when(over(rest, free), F.col("most").cast("double")).otherwise(F.lit(float(rest)) * F.col("weight") / F.lit(float(free))) if free else F.col("most").cast("double")
    return rows.select("source", "source_size", target.alias("target"))


def _round(rows, key):
    """Pair the fractional rows of a group and move mass until at most one is fractional.

    Each step takes two rows and moves words from one to the other until one of
    them has 0 or all of its chance; the way is drawn so that the expected chance
    of each row stays as it was. The words taken in sum do not change.
    """
    import numpy as np

    p, size = rows["p"].to_numpy(float).copy(), rows["size"].to_numpy(float)
    seed = [int(x) & 0xFFFFFFFF for x in key]
    draws = np.random.default_rng(seed).random(len(p))
    hand = -1
    for i in np.flatnonzero((p > 0) & (p < 1)).tolist():
        if hand < 0:
            hand = i
            continue
        a, b = hand, i
        up = min((1 - p[a]) * size[a], p[b] * size[b])  # words that can go to a from b
        down = min(p[a] * size[a], (1 - p[b]) * size[b])
        if draws[i] * (up + down) < down:  # so likely is the longer way back
            pa, pb = p[a] + up / size[a], p[b] - up / size[b]
        else:
            pa, pb = p[a] - down / size[a], p[b] + down / size[b]
        p[a], p[b] = (min(1.0, max(0.0, 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x)) for x in (pa, pb))
        open_ = [x for x in (a, b) if 0 < p[x] < 1]
        hand = open_[0] if open_ else -1
    rows["p"] = p
    return rows


def _rounder(depth: int):
    def one(key, rows):
        return _round(rows.sort_values(["doc_id", "fingerprint", "copy"], ignore_index=True), (*key, depth))

    return one


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", group: int = GROUP) -> DataFrame:
    """How often the mix takes each document.

    Returns ``doc_id, fingerprint, copy, size, source, source_size, target,
    copies``; ``fingerprint`` and ``copy`` tell rows of one id apart. A document
    is wanted target / source_size times. The whole part is certain; the
    fractions are rounded by the pivotal method, weighted by size so that the
    words taken from a source stay as they were: first in groups of about
    ``group`` documents (a large source has many, by hash), each of which
    leaves one fractional row at most, then over what these leave, level by
    level, until a source has one such row, which a last draw settles. The words
    taken from a source differ from its target by less than one document.
    All draws come from the key of a group, so a run again takes the same.

    Null or empty text, and white space alone: size 0, no copies. Null source: a
    source of its own. Rows with the same id and text: rounded each on its own.
    Empty table: no rows. Other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.xxhash64(F.col(text_col)).alias("fingerprint"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
    )
    # Equal rows are told apart by a number, which is given to the few that are not alone.
    rows = rows.groupBy("doc_id", "source", "fingerprint", "size").count().withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int")))).drop("count")
    rows = written(rows, "mix-sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__rows"))
    targets = source_targets(per_source.select("source", "source_size"))
    wanted = targets.join(per_source.select(F.col("source").alias("__s"), "__rows"), F.col("source").eqNullSafe(F.col("__s"))).select(F.col("source").alias("__s"), "source_size", "target", "__rows")
    wanted = written(wanted, "mix-targets")
    all_rows = rows.join(wanted, rows["source"].eqNullSafe(F.col("__s"))).drop("__s")
    ratio = F.when((F.col("size") > 0) & (F.col("source_size") > 0), F.least(F.lit(float(MOST)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    all_rows = all_rows.withColumn("__whole", F.floor(ratio + 1e-12)).withColumn("p", F.greatest(F.lit(0.0), ratio - F.col("__whole")))
    open_ = (F.col("p") > 1e-12) & (F.col("size") > 0)
    fields = "doc_id long, fingerprint long, copy int, size long, source_key long, cell long, p double"
    key = F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
    spread = F.xxhash64("doc_id", "fingerprint", "copy")
    level = all_rows.where(open_).select("doc_id", "fingerprint", "copy", "size", key.alias("source_key"), F.pmod(spread, F.ceil(F.col("__rows") / group)).alias("cell"), "p")
    most = wanted.agg(F.max("__rows")).first()[0] or 0
    cells, depth, settled = -(-most // group), 0, None
    while True:
        level = written(level.groupBy("source_key", "cell").applyInPandas(_rounder(depth), fields), f"mix-level{depth}")
        still = (F.col("p") > 0) & (F.col("p") < 1)
        done = level.where(~still)
        settled = done if settled is None else settled.unionByName(done)
        level = level.where(still)
        if cells <= 1:
            break
        cells, depth = -(-cells // group), depth + 1
        level = level.withColumn("cell", F.floor(F.col("cell") / group))
    draw = F.pmod(F.xxhash64(F.lit("last"), "doc_id", "fingerprint", "copy"), F.lit(1 << 30)) / float(1 << 30)
    last = level.withColumn("p", (draw < F.col("p")).cast("double"))
    taken = settled.unionByName(last).where("p > 0.5").select(F.col("doc_id").alias("__d"), F.col("fingerprint").alias("__f"), F.col("copy").alias("__c"))
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("fingerprint") == F.col("__f")) & (F.col("copy") == F.col("__c"))
    return all_rows.join(taken, same, "left").select("doc_id", "fingerprint", "copy", "size", "source", "source_size", "target", (F.col("__whole") + F.col("__f").isNotNull().cast("long")).alias("copies"))


def mix(docs: DataFrame, **names) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document (see :func:`copies`)."""
    return copies(docs, **names).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **names) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    Rows alike in id, text and source count as one row here, which is taken as
    often as they are in sum; of such rows that differ in other columns the one of least hash of all
    columns is taken. Null and empty texts, which have no words, are never taken. Null ids and sources
    are values like others. Empty table: no rows.
    """
    k1, k2, times, nth, again = fresh(docs, 5)
    own = lambda c: F.col(f"`{c}`")

    def keys(doc, source, fingerprint):
        return F.xxhash64(doc, doc.isNull(), source, source.isNull()).alias(k1), fingerprint.alias(k2)

    wanted = copies(docs, id_col, text_col, source_col, **names).where("copies > 0")
    wanted = wanted.select(*keys(F.col("doc_id"), F.col("source"), F.col("fingerprint")), "copies").groupBy(k1, k2).agg(F.sum("copies").alias(times))
    named = docs.select(*[own(c) for c in docs.columns], *keys(own(id_col).cast("long"), own(source_col).cast("string"), F.xxhash64(own(text_col))))
    found = named.join(wanted, [k1, k2])
    whole = F.xxhash64(F.to_json(F.struct(*[own(c) for c in docs.columns])))
    first = found.withColumn(nth, F.row_number().over(Window.partitionBy(k1, k2).orderBy(whole))).where(F.col(nth) == 1)
    return first.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*[own(c) for c in docs.columns])
