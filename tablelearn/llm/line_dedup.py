"""Removal of line runs that repeat across documents, by winnowing
(DataFrame functions only).

A run of whole lines with ``min_words`` words or more that occurred earlier
(in an earlier document by id, or earlier in the same one) is deleted.

1. Lines become rows of hash, word count and position; their text stays
   behind.  Lines without a word are no part of a run and always stay.
2. Winnowing: from every line the shortest window of following lines with
   ``min_words`` words selects its least line hash.  Two equal runs of that
   many words hold an equal window and so select the same fingerprint: the
   fingerprints that occur once rule out all other places.
3. Positions are joined on fingerprints, and matches are extended both ways:
   around each shared fingerprint the windows that begin at a line and those
   that end at a line are compared as wholes with their earliest place.  The
   windows of both kinds cover a repeated run exactly, up to its first and
   last line.

Steps 2 and 3 group by hash with combining aggregates (count, least
position), never by listing the places of a line, so a line that a third of
all documents hold costs one row per map task.

Order: by id (null first), then by a hash of the text, then by line.  Rows
with the same id and the same text are one document and get the same result.
A null text stays null; an empty text stays empty; a document all of whose
lines are repeats keeps its row with an empty text.  Columns may have any
names; the text column is replaced, and ``n_chars``, when there, follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.llm.common import WORD, checked
from tablelearn.plans.shaping import cut_lineage

MIN_WORDS = 50


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id, _key, _pos, _h, _n, _before``: lines with a word, their hash,
    words, and the words of the document before them."""
    lines = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_key"),
                        F.posexplode(F.split(F.col(text_col), "\n")).alias("_pos", "_line"))
    rows = lines.select("_id", "_key", "_pos", F.xxhash64("_line").alias("_h"),
                        F.regexp_count("_line", F.lit(WORD)).cast("long").alias("_n")).filter("_n > 0")
    rows = rows.dropDuplicates(["_id", "_key", "_pos"])
    run = Window.partitionBy("_id", "_key").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_before", F.coalesce(F.sum("_n").over(run), F.lit(0)))


def repeated_lines(docs: DataFrame, id_col="doc_id", text_col="text", min_words: int = MIN_WORDS) -> DataFrame:
    """``_id, _key, removed``: per document the positions of the lines that
    repeat an earlier run (documents without any are left out)."""
    rows = cut_lineage(line_rows(docs, id_col, text_col), "lines")
    doc = Window.partitionBy("_id", "_key")
    ahead = doc.orderBy("_before").rangeBetween(0, min_words - 1)
    last = F.col("_before") + F.col("_n")
    behind = doc.orderBy(F.col("_before") + F.col("_n")).rangeBetween(-(min_words - 1), 0)

    # winnowing: the place of the least line hash of each full window
    chosen = rows.select("_id", "_key", F.min(F.struct("_h", "_pos")).over(ahead).alias("_f"),
                         F.sum("_n").over(ahead).alias("_w")).filter(F.col("_w") >= min_words)
    prints = cut_lineage(chosen.select("_id", "_key", "_f").distinct(), "prints")
    prints = prints.select("_id", "_key", F.col("_f._h").alias("_f"))
    twice = prints.groupBy("_f").count().filter("count > 1").select("_f")
    places = prints.join(twice, "_f", "left_semi").select("_id", "_key").distinct()
    near = rows.alias("r").join(places.alias("p"), F.col("r._id").eqNullSafe(F.col("p._id"))
                                & (F.col("r._key") == F.col("p._key")), "left_semi")

    # windows that begin, and windows that end, at a line, as wholes
    windows = near.select(
        "_id", "_key", "_pos", "_before", last.alias("_last"),
        *[F.when(F.sum("_n").over(w) >= min_words, F.xxhash64(F.lit(k), F.collect_list("_h").over(w))).alias(f"_w{k}")
          for k, w in ((0, ahead), (1, behind))],
        F.max(last).over(ahead).alias("_to"), F.min("_before").over(behind).alias("_from"))
    windows = cut_lineage(windows, "windows")
    place = F.struct("_id", "_key", "_pos")
    spans = [windows.filter("_w0 is not null").select(F.col("_w0").alias("_w"), place.alias("_at"),
                                                      F.col("_before").alias("_from"), F.col("_to").alias("_to")),
             windows.filter("_w1 is not null").select(F.col("_w1").alias("_w"), place.alias("_at"), "_from",
                                                      F.col("_last").alias("_to"))]
    spans = spans[0].unionByName(spans[1])
    first = spans.groupBy("_w").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    later = spans.join(first, "_w").filter(~F.col("_at").eqNullSafe(F.col("_first"))).select(
        F.col("_at._id").alias("_id"), F.col("_at._key").alias("_key"), "_from", "_to")

    # lines covered by a later window: a sweep over the document's line starts
    marks = later.groupBy("_id", "_key", "_from").agg(F.max("_to").alias("_to"))
    lines = near.select("_id", "_key", "_pos", F.col("_before").alias("_from"), F.lit(None).cast("long").alias("_to"))
    sweep = doc.orderBy("_from").rangeBetween(Window.unboundedPreceding, 0)
    both = lines.unionByName(marks.select("_id", "_key", F.lit(None).cast("int").alias("_pos"), "_from", "_to"))
    hit = both.withColumn("_upto", F.max("_to").over(sweep)).filter("_pos is not null and _upto > _from")
    return hit.groupBy("_id", "_key").agg(F.sort_array(F.collect_set("_pos")).alias("removed"))


def dedup_lines(docs: DataFrame, id_col="doc_id", text_col="text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later repeated runs gone from the text."""
    return _apply(docs, id_col, text_col, min_words).select("_d.*")


def dedup_report(docs: DataFrame, id_col="doc_id", text_col="text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text, n_lines, n_removed`` with the text after removal."""
    out = _apply(docs, id_col, text_col, min_words)
    return out.select(F.col(f"_d.{id_col}").alias("doc_id"), F.col(f"_d.{text_col}").alias("text"),
                      F.coalesce("_lines", F.lit(0)).cast("long").alias("n_lines"),
                      F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"))


def _apply(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    removed = cut_lineage(repeated_lines(docs, id_col, text_col, min_words), "repeats")
    names = docs.columns
    d = docs.select(F.struct(*names).alias("_d0"), F.col(id_col).alias("_i"), F.xxhash64(F.col(text_col)).alias("_k"))
    # a few numbers a document: broadcast when few enough, so that the texts need not move
    j = d.join(checked(removed, "removed"), F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")), "left")
    j = j.select("_d0", "removed", F.split(F.col(f"_d0.{text_col}"), "\n").alias("_l"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_l") - 1), "removed")
    j = j.select("_d0", "removed", "_l", F.when(F.col("removed").isNotNull(), places).alias("_stay"))
    kept = F.when(F.col("_stay").isNull(), F.col(f"_d0.{text_col}")).otherwise(
        F.array_join(F.transform("_stay", lambda i: F.get("_l", i)), "\n"))
    j = j.select("_d0", "removed", F.size("_l").alias("_lines"), kept.alias("_kept"))
    row = [F.col("_kept").alias(c) if c == text_col else
           F.when(F.col("removed").isNull(), F.col(f"_d0.{c}")).otherwise(F.length("_kept")).alias(c)
           if c == "n_chars" else F.col(f"_d0.{c}").alias(c) for c in names]
    return j.select(F.struct(*row).alias("_d"), "removed", "_lines")
