"""Document quality rules with host-level verdicts (DataFrame functions only).

Per document: word and symbol counts, lines equal to an earlier line, and
words inside 8-word windows that the text holds twice or more.  A document
fails the base rules with fewer than 20 words, or when more than 30 % of its
words lie in repeated windows.

Failures are then summed by host (one combining aggregate), and each host's
failure rate is shrunk towards the rate of all hosts with a beta prior fitted
to the hosts by the method of moments, so a host with three documents is not
judged by three documents alone.  A host whose shrunk rate is above
``host_limit`` is rejected; the verdict is joined back to its documents.

Repeated windows: the windows of a text are hashed, and only when two hashes
are equal the hashes are sorted with their positions; each repeated window
covers its 8 words, overlaps counted once.  The work stays inside the row.

Defined cases: null text has no words (and fails); a null host is a host; an
empty text has no lines with a word; repeated rows are judged each and counted
each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import WORD, words_of
from tablelearn.plans.shaping import cut_lineage

WINDOW = 8


def _covered(places: Column, width: int) -> Column:
    """How many places the windows starting at the ascending ``places``
    cover together."""
    nxt = F.concat(F.slice(places, F.lit(2), F.size(places)), F.array(F.lit(2 ** 31 - 1)))
    steps = F.zip_with(places, nxt, lambda a, b: F.least(F.lit(width), b - a))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)


def base_rules(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    """``doc_id, host, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    t = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("_text"),
                    words_of(F.col(text_col)).alias("_words"),
                    F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("_lines"))
    # two, four and eight words: each doubling hashes neighbours of the one before
    t = t.select("*", F.transform("_words", lambda w: F.xxhash64(w)).alias("_h1"))
    for half in (1, 2, 4):
        h = F.col(f"_h{half}")
        shifted = F.slice(h, F.lit(half + 1), F.greatest(F.size(h) - half, F.lit(0)))
        pairs = F.zip_with(h, shifted, lambda a, b: F.xxhash64(a, b))
        t = t.select("*", F.slice(pairs, F.lit(1), F.greatest(F.size(h) - half, F.lit(0))).alias(f"_h{2 * half}"))
    t = t.select(
        "doc_id", "host", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_h8").alias("_h"))
    repeats = F.size("_h") > F.size(F.array_distinct("_h"))
    t = t.select("*", F.when(repeats, F.sort_array(F.transform(
        "_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"))
    near = lambda x, i: (x["h"] == F.get("_sorted", i - 1)["h"]) | (x["h"] == F.get("_sorted", i + 1)["h"])
    places = F.sort_array(F.transform(
        F.filter("_sorted", lambda x, i: F.coalesce(near(x, i), F.lit(False))), lambda x: x["i"]))
    t = t.select("*", F.when(F.col("_sorted").isNotNull(), places).alias("_places"))
    t = t.withColumn("n_repeat_words", F.when(F.col("_places").isNotNull(), _covered(F.col("_places"), WINDOW))
                     .otherwise(F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return t.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"))


def host_verdicts(judged: DataFrame, host_limit: float = 0.5) -> DataFrame:
    """``host, n, failed, rate, host_kept`` from rows of ``host, base_failed``.

    The prior's mean is the failure rate of all rows; its strength comes from
    the variance between hosts beyond what binomial noise explains (between
    1 and 10,000 documents' worth)."""
    hosts = cut_lineage(judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("failed")), "rules-hosts")
    a = hosts.agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"), F.sum("failed").alias("k"),
                  F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
                  F.sum(F.col("failed").cast("double") * F.col("failed") / F.col("n")).alias("kk")).first()
    mean, strength = 0.0, 1.0
    if a["n"]:
        mean = a["k"] / a["n"]
        noise = mean * (1 - mean)
        spread = a["kk"] - a["k"] * mean            # sum over hosts of n (rate - mean)^2
        between = (spread - (a["m"] - 1) * noise) / max(a["n"] - a["nn"] / a["n"], 1.0)
        strength = min(max(noise / between - 1, 1.0), 1e4) if between > 0 else 1e4
    rate = (F.col("failed") + mean * strength) / (F.col("n") + strength)
    return hosts.select("host", "n", "failed", rate.alias("rate"), (rate <= host_limit).alias("host_kept"))


def judge_documents(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source",
                    host_limit: float = 0.5) -> DataFrame:
    """``base_rules`` columns plus the host's shrunk failure rate and
    ``kept`` = not failed and the host is kept."""
    base = cut_lineage(base_rules(docs, id_col, text_col, host_col), "rules-base")
    hosts = host_verdicts(base, host_limit).select(F.col("host").alias("_host"), "rate", "host_kept")
    return base.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).select(
        *base.columns, F.col("rate").alias("host_rate"), (~F.col("base_failed") & F.col("host_kept")).alias("kept"))
