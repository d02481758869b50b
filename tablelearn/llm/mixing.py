"""Mixing sources to target weights by hash-threshold histograms.

Every row gets a 60-bit hash of its id.  Sizes are summed by source and by
the first 12 bits of the hash; a running sum over the (at most 4,096) buckets
of a source finds the bucket in which the source's budget ends.  Only the
rows of that boundary bucket are looked at again, with the next 12 bits, until
a single hash value is left.  The mix is then a filter ``hash <= cut`` per
source: no row is sorted, and a larger budget takes a superset of the rows of
a smaller one.

Budgets: sources in code-point order (null last) get ``weights`` in turn and
share ``share`` times all sizes; a target stops at ``cap`` times its source's
size and the excess is shared again by weight until no target is above.  The
resharing is a loop over one-row aggregates of the table of sources.

Defined cases: a null text has size 0; a null source is a source; rows with
the same id have the same hash and are taken together (so a source's total
can miss its target by half of the boundary rows' size); a source without
words has target 0; an empty table gives an empty table; other columns are
not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.llm.common import WORD, ranked
from tablelearn.plans.shaping import cut_lineage

BITS, LEVELS = 12, 5


def hash60(key: Column) -> Column:
    """60 bits of the key's md5 (a null key has a hash of its own)."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = ranked(totals, [F.col("source").asc_nulls_last()], "_rank", "mix-sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("_rank") % len(weights) + 1).cast("int"))
    t = cut_lineage(t.select("source", "source_size", w.alias("_w"), (F.lit(cap) * F.col("source_size")).alias("_cap")),
                    "mix-weights")
    budget = share * float(t.agg(F.sum("source_size")).first()[0] or 0)
    level, fixed = 0.0, -1
    while True:   # each turn fixes one more source at least
        over = (F.lit(level) * F.col("_w") > F.col("_cap")) if fixed >= 0 else F.lit(False)
        s = t.agg(F.sum(F.when(over, F.col("_cap")).otherwise(0.0)).alias("c"),
                  F.sum(F.when(over, 0.0).otherwise(F.col("_w"))).alias("w"),
                  F.count_if(over).alias("n")).first()
        if not s["w"] or s["n"] == fixed:
            break
        fixed, level = s["n"], (budget - s["c"]) / s["w"]
    if fixed < 0 or not s["w"]:
        target = F.col("_cap")
    else:
        target = F.least(F.lit(level) * F.col("_w"), F.col("_cap"))
    return t.select("source", "source_size", target.alias("target"))


def mix_thresholds(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, source_size, target, full, cut``: every row of a source is
    taken ``full`` times, rows with ``hash <= cut`` once more.  ``sizes`` has
    ``source, size, hash`` and should be a written table: it is read once a
    level."""
    targets = cut_lineage(source_targets(sizes, weights, share, cap), "mix-targets")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    todo = targets.withColumn("full", full.cast("int")).withColumn(
        "_rest", F.col("target") - F.col("full") * F.col("source_size"))
    state = todo.filter("_rest > 0").select(
        "source", "_rest", F.lit(0).cast("double").alias("_below"), F.lit(0).cast("long").alias("_prefix"))
    done = None
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        s = state.select(F.col("source").alias("_s"), "_rest", "_below", "_prefix")
        mine = sizes.filter("size > 0").join(
            s, F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("hash", shift + BITS) == F.col("_prefix")))
        hist = mine.groupBy("source", F.shiftright("hash", shift).alias("_b")).agg(
            F.sum("size").alias("_n"), F.min("hash").alias("_lo"), F.max("hash").alias("_hi"),
            F.any_value("_rest").alias("_rest"), F.any_value("_below").alias("_base"))
        run = Window.partitionBy("source").orderBy("_b")
        upto = F.col("_base") + F.sum("_n").over(run)
        edge = hist.withColumn("_upto", upto).withColumn("_below", F.col("_upto") - F.col("_n")).filter(
            (F.col("_below") < F.col("_rest")) & (F.col("_upto") >= F.col("_rest")))
        edge = cut_lineage(edge.select("source", "_rest", "_below", "_upto", F.col("_b").alias("_prefix"),
                                       "_lo", "_hi"), "mix-edge")
        nearer = F.col("_upto") - F.col("_rest") <= F.col("_rest") - F.col("_below")
        ends = edge.filter("_lo = _hi").select(
            "source", F.when(nearer, F.col("_lo")).otherwise(F.col("_lo") - 1).alias("cut"))
        done = ends if done is None else done.unionByName(ends)
        state = edge.filter("_lo < _hi")
        if state.isEmpty():
            break
    cuts = done.select(F.col("source").alias("_s"), "cut")
    return cut_lineage(todo.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source", "source_size", "target", "full", F.coalesce("cut", F.lit(-1)).alias("cut")), "mix-cuts")


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    n = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return cut_lineage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                   n.alias("size"), hash60(F.col(id_col)).alias("hash")), "mix-sizes")


def _copies() -> Column:
    return F.col("full") + (F.col("hash") <= F.col("cut")).cast("int")


def mix_report(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **budget) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target,
    copies, taken``."""
    sizes = _sizes(docs, id_col, text_col, source_col)
    cuts = mix_thresholds(sizes, **budget).withColumnRenamed("source", "_s")
    return sizes.join(cuts, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", "size", "source_size", "target", _copies().alias("copies"),
        (F.col("size") * _copies()).alias("taken"))


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **budget) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, with the
    columns of ``docs``.  Documents without words ride along once."""
    cuts = mix_thresholds(_sizes(docs, id_col, text_col, source_col), **budget)
    names = docs.columns
    d = docs.select(F.struct(*names).alias("_d"), F.col(source_col).alias("_source"),
                    hash60(F.col(id_col)).alias("hash"),
                    F.coalesce(F.regexp_like(F.col(text_col), F.lit(WORD)), F.lit(False)).alias("_words"))
    n = F.when(F.col("_words"), _copies()).otherwise(F.lit(1))
    out = d.join(cuts, F.col("_source").eqNullSafe(F.col("source")))
    return out.withColumn("_n", n).filter("_n > 0").select(
        "_d", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_d.*")
