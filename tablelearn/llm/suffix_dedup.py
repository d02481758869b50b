"""Removal of repeated byte strings by distributed prefix doubling.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
(in any document, or elsewhere in the same one) is removed.  Suffix positions
get ranks that stand for a growing prefix; positions whose rank is unique drop
out, until the rank covers the whole ``LENGTH`` bytes.

Sorting all byte positions of a corpus would move more than ten times its
size, so the ranks are kept at content-chosen positions and every other
position is settled through them; the result is exact:

1. *First rank*: a position is an anchor if the hash of the ``GRAM`` bytes
   from it is 0 mod ``RATE``; equal strings hold the same anchors.  Anchors
   are sorted by that hash and unique ones drop out.  (A start whose whole
   window holds no anchor, about 1 in 200, is ranked by its full window here
   and is settled.)
2. *Doubling*: the rank of an anchor first stands for the string up to the
   next anchor.  Each round counts equal ranks, lets anchors with a unique one
   go, and pairs the rank of anchor i with that of anchor i + 1, i + 2, i + 4,
   ... to the rank of the next round, until no rank is left or the strings
   are past ``LENGTH``.
3. *Stretches*: neighbouring starts whose windows have the same first and last
   anchor form a stretch; its rank is the pair of the two longest doubled
   ranks that cover it from either end, and where one of them is gone the
   starts cannot repeat.  If the whole string that a stretch spans, context
   included, occurs twice, all its starts are settled at once.
4. *Full rank*: where stretches of equal rank differ in their context, their
   single starts are ranked by the full ``LENGTH`` bytes.

In a round the ranks are counted by a combining aggregate and a unique one
travels back to its document as (text, number), so a rank that a third of all
anchors share costs one row per map task.

Repeats inside long shared passages are settled by stretches (one row for
about 16 positions), and only their ends come down to single positions.
Texts that several rows have are read once and removed whole.  Hot strings: a
rank that repeats inside a batch of a map task is known to repeat, and its
rows are dealt by place instead of by content, except for one; so a passage
that a third of all documents share costs one row per batch where it is
sorted.

Strings are compared by 64-bit hashes.  Defined cases: null and empty texts
have 0 bytes and remove nothing; texts shorter than ``LENGTH`` keep all
bytes; repeated rows (same id and text too) are strings that start elsewhere;
very long texts are read in blocks of 1 MB; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.llm.common import checked
from tablelearn.llm.shingles import mix, texts
from tablelearn.plans.shaping import cut_lineage

LENGTH, GRAM, RATE_BITS = 200, 32, 5        # one anchor in 2**5 positions
REACH = LENGTH - GRAM                       # the farthest two anchors of one window lie apart
BLOCK = 1 << 20


ROUNDS = REACH.bit_length()                 # spans of 1, 2, 4, ... steps, each of a byte at least
DOUBLED = np.array([n.bit_length() for n in range(REACH + 1)])   # the level of the longest span within n steps


class Hasher:
    """Hashes of all spans of a block: sum of table[byte] * base**place."""

    def __init__(self, size: int = BLOCK + LENGTH + 1):
        rng = np.random.default_rng(9)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = 0x9E3779B97F4A7C15
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up, self.down = self._powers(self.base, 4096), self._powers(self.inverse, 4096)

    @staticmethod
    def _powers(x: np.uint64, n: int) -> np.ndarray:
        p = np.full(n, x, dtype=np.uint64)
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)

    def sums(self, block: bytes) -> np.ndarray:
        n = len(block)
        if n >= len(self.up):
            self.up, self.down = self._powers(self.base, 2 * n), self._powers(self.inverse, 2 * n)
        c = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.table[np.frombuffer(block, np.uint8)] * self.up[:n], out=c[1:])
        return c

    def spans(self, c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (c[end] - c[start]) * self.down[start]

    def anchors(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors of a block."""
        n = len(c) - GRAM
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = (c[GRAM:] - c[:n]) * self.down[:n]
        at = np.flatnonzero((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - RATE_BITS) == 0)
        return at, mix(h[at])


def _blocks(text: bytes):
    """``(start, bytes, starts)``: block, and how many window starts it owns."""
    last = len(text) - LENGTH + 1
    for s in range(0, max(last, 0), BLOCK):
        yield s, text[s:s + BLOCK + LENGTH - 1], min(BLOCK, last - s)


def _unanchored(q: np.ndarray, starts: int) -> list[tuple[int, int]]:
    """Runs of starts whose window holds no anchor."""
    edges = np.concatenate([[-1], q, [starts + LENGTH]])
    low, high = edges[:-1] + 1, np.minimum(edges[1:] - (LENGTH - GRAM) - 1, starts - 1)
    return [(int(a), int(b)) for a, b in zip(low, high) if a <= b]


def _int64(x) -> pa.Array:
    return pa.array(np.asarray(x, dtype=np.uint64).view(np.int64))


def _repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more here, and the first place of each key."""
    _, index, count = np.unique(key, return_inverse=True, return_counts=True)
    first = np.zeros(len(key), bool)
    first[np.unique(index, return_index=True)[1]] = True
    return count[index] > 1, first


def _elsewhere(dk: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Keys by place, for rows that need not meet their like any more."""
    return mix(dk.view(np.uint64) ^ mix(at.astype(np.uint64) + np.uint64(77)))


def _merged(dk, low, high):
    """Neighbouring runs of one document as one run."""
    if not len(dk):
        return dk, low, high
    order = np.lexsort((low, dk))
    dk, low, high = dk[order], low[order], high[order]
    new = np.append(True, (dk[1:] != dk[:-1]) | (low[1:] > high[:-1] + 1))
    return dk[new], low[new], np.maximum.reduceat(high, np.flatnonzero(new))


def _steps(hasher: Hasher, c: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor of a block 2 * distance to the next (0: out of reach) + 1 if
    a window may hold it alone, and the hash of the string up to the end of
    the next one.  Anchors outside the block count as far away."""
    far = LENGTH + 1
    gap = np.diff(np.append(q, q[-1] + far)) if len(q) else q
    before = np.append(far, gap[:-1])[:len(q)]
    near = gap <= REACH
    end = q + np.where(near, gap, 0) + GRAM
    step = mix(hasher.spans(c, q, end) + (end - q).astype(np.uint64))
    return np.where(near, gap, 0) * 2 + (gap + before > REACH + 1), np.where(near, step, np.uint64(0))


def _first_ranks(batches):
    """``h, dk, at, more, step``; ``at`` = place * 4 + 2 * known + 1 for whole
    windows from that place to ``more`` places on, and number * 4 + 2 * known
    for the anchor of that number in its text.  For an anchor ``more`` = 2 *
    distance to the next one (0: none within ``REACH``) + 1 if a window may
    hold this anchor alone, and ``step`` stands for the string up to the end
    of the next one."""
    hasher = Hasher()

    def rows(part):
        h, dk, at, more, step = (np.concatenate(x) for x in zip(*part))
        twice, first = _repeats(h)
        real, whole = ~twice | first, at % 2 == 1
        anchors, windows = ~real & ~whole, ~real & whole
        d, low, high = _merged(dk[windows], at[windows] // 4, at[windows] // 4)
        key = [h[real], _elsewhere(dk[anchors], at[anchors]), _elsewhere(d, low)]
        return pa.RecordBatch.from_pydict({
            "h": _int64(np.concatenate(key)), "dk": np.concatenate([dk[real], dk[anchors], d]),
            "at": np.concatenate([at[real] + 2 * twice[real], at[anchors] + 2, low * 4 + 3]),
            "more": np.concatenate([more[real], more[anchors], high - low]).astype(np.int32),
            "step": _int64(np.concatenate([step[real], step[anchors], np.zeros(len(d), np.uint64)]))})

    for b in batches:
        part, size = [], 0
        for key, text in zip(b.column(0).to_numpy(), texts(b.column(1))):
            number = 0
            for s, block, starts in _blocks(text or b""):
                c = hasher.sums(block)
                q, h = hasher.anchors(c)
                # anchors after the owned starts belong to the next block as well
                own = int(np.searchsorted(q, BLOCK)) if len(text) - s >= BLOCK + LENGTH else len(q)
                more, step = _steps(hasher, c, q)
                part.append((h[:own], np.full(own, key, np.int64), np.arange(number, number + own) * 4,
                             more[:own], step[:own]))
                number += own
                size += own
                for low, high in _unanchored(q, starts):
                    t = np.arange(low, high + 1)
                    part.append((mix(hasher.spans(c, t, t + LENGTH) + np.uint64(LENGTH)),
                                 np.full(len(t), key, np.int64), (t + s) * 4 + 1,
                                 np.zeros(len(t), np.int64), np.zeros(len(t), np.uint64)))
                    size += len(t)
            if size > 1_000_000:
                yield rows(part)
                part, size = [], 0
        if part:
            yield rows(part)


def _rank_table(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A text's ranks by level and anchor number (0: none); the last column is empty."""
    out = np.zeros((ROUNDS + 1, int(at.max()) // 16 + 2), dtype=np.uint64)
    out[at % 16, at // 16] = np.maximum(rank.view(np.uint64), np.uint64(1))
    return out


def _stretches(batches):
    """Rows ``dk, text, ranks left`` to ``g, u, dk, low, high, known``."""
    hasher = Hasher()

    def rows(part):
        g, u, dk, low, high = (np.concatenate(x) for x in zip(*part))
        twice, first = _repeats(u)
        real = ~twice | first
        d, a, e = _merged(dk[~real], low[~real], high[~real])
        key = _elsewhere(d, a)
        return pa.RecordBatch.from_pydict({
            "g": _int64(np.concatenate([g[real], key])), "u": _int64(np.concatenate([u[real], key])),
            "dk": np.concatenate([dk[real], d]), "low": np.concatenate([low[real], a]),
            "high": np.concatenate([high[real], e]),
            "known": np.concatenate([twice[real], np.ones(len(d), bool)])})

    for b in batches:
        out, size = [], 0
        flat = b.column(2).flatten()
        ats, ranks = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
        ends = np.cumsum(pc.list_value_length(b.column(2)).to_numpy())
        for key, text, first, last in zip(b.column(0).to_numpy(), texts(b.column(1)), np.append(0, ends), ends):
            table = _rank_table(ats[first:last], ranks[first:last])
            none, number = table.shape[1] - 1, 0
            for s, block, starts in _blocks(text or b""):
                c = hasher.sums(block)
                q, h = hasher.anchors(c)
                before = number
                number += int(np.searchsorted(q, BLOCK)) if len(text) - s >= BLOCK + LENGTH else len(q)
                if not table[:, before:before + len(q)].any():
                    continue
                t = np.arange(starts)
                i0 = np.searchsorted(q, t)
                i1 = np.searchsorted(q, t + REACH, side="right") - 1
                t = t[i1 >= i0]
                if not len(t):
                    continue
                i0, i1 = i0[t], i1[t]
                cut = np.flatnonzero((np.diff(t) > 1) | (np.diff(i0) != 0) | (np.diff(i1) != 0)) + 1
                low, high = t[np.append(0, cut)], t[np.append(cut - 1, len(t) - 1)]
                i0, i1 = i0[np.append(0, cut)], i1[np.append(0, cut)]
                # i1 - i0 steps: two doubled ranks that begin and end with them
                level = DOUBLED[i1 - i0]
                left = table[level, np.minimum(before + i0, none)]
                right = table[level, np.minimum(before + i1 - ((1 << level) >> 1), none)]
                some = (left != 0) & (right != 0)
                if not some.any():
                    continue
                low, high, i0, i1, left, right = (x[some] for x in (low, high, i0, i1, left, right))
                g = np.where(i0 == i1, h[i0], mix(left ^ mix(right + (i1 - i0).astype(np.uint64))))
                a = q[i0]
                u = mix(hasher.spans(c, low, high + LENGTH)) + ((a - low) * 1000 + (high - low)).astype(np.uint64)
                out.append((g, mix(u), np.full(len(low), key, np.int64), low + s, high + s))
                size += len(low)
            if size > 500_000:
                yield rows(out)
                out, size = [], 0
        if out:
            yield rows(out)


def _single_starts(batches):
    """Rows ``dk, text, (low, high, once) runs`` to ``h, dk, at``; ``at`` =
    place * 4 + 2 * known + once."""
    hasher = Hasher()

    def rows(part):
        h, dk, at = (np.concatenate(x) for x in zip(*part))
        twice, first = _repeats(h)
        real = ~twice | first
        aside = ~real & (at % 2 == 1)       # what is settled otherwise only had to be met
        key = np.concatenate([h[real], _elsewhere(dk[aside], at[aside])])
        return pa.RecordBatch.from_pydict({"h": _int64(key), "dk": np.concatenate([dk[real], dk[aside]]),
                                           "at": np.concatenate([at[real] + 2 * twice[real], at[aside] + 2])})

    for b in batches:
        out, size = [], 0
        for key, text, runs in zip(b.column(0).to_numpy(), texts(b.column(1)), b.column(2).to_pylist()):
            for r in runs:
                part = text[r["low"]:r["high"] + LENGTH]
                c = hasher.sums(part)
                t = np.arange(r["high"] - r["low"] + 1)
                out.append((mix(hasher.spans(c, t, t + LENGTH)), np.full(len(t), key, np.int64),
                            (t + r["low"]) * 4 + int(r["once"])))
                size += len(t)
            if size > 500_000:
                yield rows(out)
                out, size = [], 0
        if out:
            yield rows(out)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, dk, text, copies``: with a key of the text, and for texts
    that several rows have ``copies`` = 1 in the row with the least id (the
    one that stands for them) and 2 in the others."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("dk"), F.col(text_col).alias("text"))
    several = d.groupBy("dk").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("_id")).filter("n > 1")
    several = checked(cut_lineage(several.select("dk", "_id", F.lit(True).alias("_copied")), "copied-texts"))
    stands = F.col("doc_id").eqNullSafe(F.col("_id"))
    return d.join(several, "dk", "left").select(
        "doc_id", "dk", "text", F.when(F.col("_copied"), F.when(stands, 1).otherwise(2)).otherwise(0).alias("copies"))


def _beside(d: DataFrame, side: DataFrame, column: str, how: str) -> DataFrame:
    """Join per-document lists to the texts."""
    return d.join(checked(cut_lineage(side, column), column), "dk", how)


def _islands(rows: DataFrame, low: str, high: str, reach: int, names: tuple[str, str], column: str) -> DataFrame:
    """``dk, column``: per document the ranges that ``low .. high`` rows form
    when rows at most ``reach`` apart are joined; one exchange by document."""
    order = Window.partitionBy("dk").orderBy(low)
    before = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col(low) - before > reach).cast("int"), F.lit(1))
    t = rows.withColumn("_new", new).withColumn("_island", F.sum("_new").over(order.rowsBetween(
        Window.unboundedPreceding, 0)))
    t = t.groupBy("dk", "_island").agg(F.min(low).alias(names[0]), F.max(high).alias(names[1]))
    return t.groupBy("dk").agg(F.collect_list(F.struct(*names)).alias(column))


def doubled_ranks(anchors: DataFrame) -> DataFrame:
    """``dk, ranks``: per document a list of ``at`` = number * 16 + level and
    ``rank``, from rows ``dk, number, step, gap, alone`` of the anchors left.
    The rank of level k > 0 stands for 2**(k-1) steps from that anchor on and
    occurs twice or more; level 0 marks anchors that a window may hold alone.

    A round has two exchanges: ranks are counted by rank, and unique ones meet
    their document's, where the ranks left are paired at the doubled offset."""
    order = Window.partitionBy("dk").orderBy("number")
    at = lambda k: order.rangeBetween(k, k)
    entry = lambda level, rank: F.struct((F.col("number") * 16 + level).alias("at"), rank.alias("rank"))
    entries = anchors.filter("alone").select("dk", entry(0, F.lit(1).cast("long")).alias("r"))
    front = anchors.filter("gap > 0").select("dk", "number", F.col("step").alias("rank"), F.col("gap").alias("span"))
    for level in range(1, ROUNDS + 1):
        once = front.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.min("dk").alias("dk"),
                                         F.min("number").alias("number")).filter("n = 1")
        none = [F.lit(None).cast(t).alias(c) for c, t in (("rank", "long"), ("span", "int"))]
        both = front.unionByName(once.select("dk", "number", *none)).withColumn("_n", F.count(F.lit(1)).over(at(0)))
        left = both.filter("_n = 1").drop("_n")
        reach = 1 << (level - 1)
        right, span = F.max("rank").over(at(reach)), F.col("span") + F.max("span").over(at(reach))
        left = left.withColumns({"up": F.when(span <= REACH, F.xxhash64("rank", right)), "upto": span})
        left = cut_lineage(left, "doubled-rank")
        entries = entries.unionByName(left.select("dk", entry(level, F.col("rank")).alias("r")))
        front = left.filter("up is not null").select("dk", "number", F.col("up").alias("rank"),
                                                     F.col("upto").alias("span"))
        if front.isEmpty():
            break
    return entries.groupBy("dk").agg(F.collect_list("r").alias("ranks"))


def repeated_spans(d: DataFrame) -> DataFrame:
    """``dk, spans``: per text the maximal ranges ``low .. high + LENGTH`` of
    repeated bytes (copied texts, which repeat as wholes, only take part to be
    met by others)."""
    d = d.filter("copies < 2").select("dk", "text")
    ranks = d.mapInArrow(_first_ranks, "h long, dk long, at long, more int, step long")
    same = F.count(F.lit(1)).over(Window.partitionBy("h"))
    left = ranks.select("dk", "at", "more", "step", same.alias("n")).filter(
        (F.col("n") > 1) | (F.col("at").bitwiseAND(2) != 0))
    left = cut_lineage(left.select("dk", F.shiftright("at", 2).alias("at"), "more", "step",
                                   F.col("at").bitwiseAND(1).alias("w")), "first-rank")
    settled = left.filter("w = 1").select("dk", F.col("at").alias("low"), (F.col("at") + F.col("more")).alias("high"))

    anchors = left.filter("w = 0").select("dk", F.col("at").alias("number"), "step", F.shiftright("more", 1).alias("gap"),
                                          (F.col("more").bitwiseAND(1) != 0).alias("alone"))
    # the ranks grow with the texts: a shuffle join at every size
    parts = d.join(cut_lineage(doubled_ranks(anchors), "ranks"), "dk").select("dk", "text", "ranks").mapInArrow(
        _stretches, "g long, u long, dk long, low long, high long, known boolean")
    # equal ranks meet in one place; those in the same context too are neighbours there
    form, rank = Window.partitionBy("g", "u"), Window.partitionBy("g")
    parts = parts.repartition("g").withColumn("twice", F.col("known") | (F.count(F.lit(1)).over(form) > 1))
    parts = parts.withColumn("nth", F.row_number().over(form.orderBy("dk", "low")))
    # equal ranks in different context, at least one of them seen once: single starts
    differ = (F.min("u").over(rank) != F.max("u").over(rank)) & ~F.min("twice").over(rank)
    parts = parts.select("dk", "low", "high", "twice", (differ & (F.col("nth") == 1)).alias("ends"))
    parts = cut_lineage(parts.filter("twice or ends"), "stretches")
    whole = parts.filter("twice").select("dk", "low", "high")
    ends = parts.filter("ends").groupBy("dk").agg(
        F.collect_list(F.struct("low", "high", (~F.col("twice")).alias("once"))).alias("ends"))
    one = _beside(d, ends, "ends", "inner").mapInArrow(_single_starts, "h long, dk long, at long")
    one = one.select("dk", "at", same.alias("n")).filter(
        (F.col("at").bitwiseAND(1) != 0) & ((F.col("n") > 1) | (F.col("at").bitwiseAND(2) != 0)))
    single = one.select("dk", F.shiftright("at", 2).alias("low"), F.shiftright("at", 2).alias("high"))
    every = settled.unionByName(whole).unionByName(single)
    return _islands(every, "low", "high", LENGTH, ("low", "high"), "spans")


def remove_repeats(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``kept``, the
    remaining bytes."""
    return _outcome(docs, id_col, text_col, True)


def repeats_report(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    return _outcome(docs, id_col, text_col, False)


def _outcome(docs: DataFrame, id_col: str, text_col: str, with_bytes: bool) -> DataFrame:
    d = keyed(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            rows = []
            for text, spans, copies in zip(texts(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
                text = text or b""
                spans = sorted((r["low"], r["high"] + LENGTH) for r in spans or [])
                if copies and len(text) >= LENGTH:
                    spans = [(0, len(text))]
                kept, at = [], 0
                for low, high in spans:
                    kept.append(text[at:low])
                    at = high
                kept = b"".join([*kept, text[at:]])
                rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            n, gone, runs, sha, kept = zip(*rows) if rows else ([],) * 5
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                       pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = d.schema["doc_id"].dataType.simpleString()
    joined = _beside(d, repeated_spans(d), "spans", "left").select("doc_id", "text", "spans", "copies")
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                             + (", kept binary" if with_bytes else ""))
