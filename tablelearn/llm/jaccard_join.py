"""Exact Jaccard similarity join of texts in metric space.

Jaccard distance is a metric, and documents within the radius
``1 - threshold`` of each other are linked.  The result is each document's
component under the links; documents are compared with pivots, not with each
other.

*Equal sets.*  Documents with the same shingle set are one point (a combining
aggregate on a 64-bit key of the set).

*Regions.*  Whole-document pivots cannot divide a corpus of mostly unrelated
texts: nearly all distances are 1, so every window would hold everything.
The pivots of the first step are therefore projections.  The shingles are
divided by hash range into more classes than two linked sets can differ in
(sets with sizes a, b differ in at most (a + b)(1 - t)/(1 + t) shingles), so
linked sets agree entirely on some class that is not empty.  Each class
content is a pivot, and the sets at projected distance 0 are its region; a set
lies in several regions, which is where boundary documents are replicated.
Sets whose shingles leave too many classes empty also take part at twice the
number of classes, and so on, so that no pair is lost; sizes are taken in
geometric bands, and a set near the end of its band joins the next as well.

*Plausible members.*  Linked sets disagree on no more classes than they differ
in shingles, so a set shares a known least number of regions with any partner,
mostly many.  A set that has fewer regions with company (texts that merely
share a passage) leaves that division before any shingles are sent.

*Inside a region* the least member is the pivot.  Every set is compared with
the pivot it shares most regions with, exactly; a region whose members are
then all connected is done.

*Windows.*  What is left of the regions is joined block by block, a block
being the regions whose pivots are in one component: the sets of that
component (M) need not be compared with each other, the others (U) are
compared with M and U.  Members are
ordered by their distance to one set of the component, and a set at distance d
meets only the window d - radius .. d + radius (triangle inequality).  Large joins are dealt in
tiles of bounded size, M by U and U by U, so a group of near copies costs its
own size unless many of its members fail to connect.

*Recursion.*  Where a block has more than ``DIVIDE`` sets outside its main
component (texts that merely share a passage), these regions are
divided again by a fresh projection, at most ``DEPTH`` times.

Every comparison counts the shared shingles of the two whole sets; nothing is
capped or sampled.  Set keys and shingles are 64-bit hashes.

Defined cases: null and empty texts have no shingles and link with nothing;
rows with the same id and text are one point; a component's id is the least
id in it (null only if all are null); extra columns are ignored or, in
``keep_one``, carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.llm.common import checked
from tablelearn.llm.components import components
from tablelearn.llm.shingles import WordHashes, mix, set_key, shingle_set, texts
from tablelearn.plans.shaping import cut_lineage, drop_written

BAND = 1.6          # ratio of the sizes in a band
TILE_SETS = {"m": 2048, "u": 2048}    # sets, and shingles, in a tile of a large block
TILE_SHINGLES = 1_000_000
DIVIDE, DEPTH = 1 << 15, 2
FAMILIES = 64       # of divisions, told apart in a region's key
ROUNDS = 2          # of leaving out sets that share too few regions
LIKELY = 15         # a set meets its pivot first if it shares a region for so many of its shingles


def _highest(band: int) -> int:
    """The largest size of a band."""
    low = 1
    for _ in range(band + 1):
        low = max(low + 1, int(low * BAND))
    return low - 1


def _bands(n: int, num: int, den: int):
    """``(band, most sizes differ)`` of the bands of larger sizes in which a
    set of size ``n`` can have a partner (or the set itself)."""
    low, band = 1, 0
    while low * num <= n * den:
        high = max(low + 1, int(low * BAND))        # sizes low .. high - 1
        if high > n:
            yield band, 2 * (high - 1) * (den - num) // (den + num)
        low, band = high, band + 1


def _families(s: np.ndarray, num: int, den: int):
    """``(family, classes, band, most sizes differ, class of each shingle,
    first shingle of each class that is not empty)`` of the divisions in which
    a set takes part.  A family is a number below ``FAMILIES``: divisions of
    one set rarely share it, and equal divisions of two sets always do."""
    top = s >> np.uint64(32)
    for band, differ in _bands(len(s), num, den):
        if not differ:          # only equal sets, which are one point
            continue
        classes, doubled = differ + 1 + (differ + 1) // 20, 0
        while True:
            of = (top * np.uint64(classes)) >> np.uint64(32)
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            yield (band % 8) * 8 + min(doubled, 7), classes, band, differ, of, first
            if len(first) > differ:
                break
            classes, doubled = classes * 2, doubled + 1


def signatures(shingles: np.ndarray, num: int, den: int, seed: int = 0) -> np.ndarray:
    """Keys of the regions of a set: 48 bits, the last of them the family."""
    if seed:
        s = np.sort(mix(shingles ^ np.uint64(0x632BE59BD9B4E019 * (2 * seed + 1) & ((1 << 64) - 1))))
    else:
        s = shingles
    content, out = mix(s + np.uint64(seed + 1)), []
    for family, classes, band, _, of, first in _families(s, num, den):
        total = np.add.reduceat(content, first)
        key = mix(mix(total + of[first]) + np.uint64(band << 32) + np.uint64(classes))
        out.append(key % np.uint64(1 << 48) // np.uint64(FAMILIES) * np.uint64(FAMILIES) + np.uint64(family))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def least_shared(shingles: np.ndarray, num: int, den: int) -> list:
    """``need * FAMILIES + family`` of each division of a set: two linked sets
    disagree on no more classes than they differ in shingles, so the set
    shares ``need`` regions with any partner."""
    n, out = len(shingles), []
    for family, _, band, differ, _, first in _families(shingles, num, den):
        most = min(n * den // num, _highest(band))
        # keys of 48 bits: a long set's own keys may meet
        meet = (len(first) >= FAMILIES) + (len(first) ** 2 >> 38)
        out.append(max(1, len(first) - (n + most) * (den - num) // (den + num) - meet) * FAMILIES + family)
    return out


def _int64(x) -> pa.Array:
    return pa.array(np.asarray(x, dtype=np.uint64).view(np.int64))


def _keys(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """``id, text_key, n, set, needs``: size and key of each document's shingle
    set, and the regions that it shares with any partner."""
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            sets = [shingle_set(t, size, hashes) for t in texts(b.column(1))]
            yield pa.RecordBatch.from_pydict({"id": b.column(0), "text_key": b.column(2), "n": pa.array([len(s) for s in sets], pa.int64()),
                                              "set": pa.array([set_key(s) for s in sets], pa.int64()),
                                              "needs": pa.array([least_shared(s, num, den) for s in sets], pa.list_(pa.int64()))})

    return docs.select("id", "text", F.xxhash64("text")).mapInArrow(
        run, f"id {docs.schema['id'].dataType.simpleString()}, text_key long, n long, `set` long, needs array<long>")


def _regions_of_texts(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """``region, set``"""
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            seen, keys, out = set(), [], []
            for t in texts(b.column(0)):
                s = shingle_set(t, size, hashes)
                key = set_key(s)
                if key not in seen:
                    seen.add(key)
                    out.append(signatures(s, num, den))
                    keys.append(np.full(len(out[-1]), key, np.int64))
                if sum(map(len, out[-64:])) > 200_000 or len(out) >= 2000:
                    yield pa.RecordBatch.from_pydict({"region": _int64(np.concatenate(out)),
                                                      "set": np.concatenate(keys)})
                    keys, out = [], []
            if out:
                yield pa.RecordBatch.from_pydict({"region": _int64(np.concatenate(out)), "set": np.concatenate(keys)})

    return docs.select("text").mapInArrow(run, "region long, `set` long")


def _regions_of_sets(members: DataFrame, num: int, den: int, seed: int) -> DataFrame:
    """``region, set`` of a finer division of regions: from ``region, set,
    shingles``."""
    def run(batches):
        for b in batches:
            out, keys = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for region, key, s in zip(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)):
                got = signatures(s.values.to_numpy().view(np.uint64), num, den, seed)
                out.append(mix(got + np.uint64(int(region) & ((1 << 64) - 1))))
                keys.append(np.full(len(got), key, np.int64))
            yield pa.RecordBatch.from_pydict({"region": _int64(np.concatenate(out)), "set": np.concatenate(keys)})

    return members.select("region", "set", "shingles").mapInArrow(run, "region long, `set` long")


def _with_pivots(regions: DataFrame, name: str) -> DataFrame:
    """``region, set, pivot`` of the members of regions with two sets or
    more, the pivots left out."""
    w = Window.partitionBy("region")
    return cut_lineage(regions.select("region", "set", F.min("set").over(w).alias("pivot")).filter(
        F.col("set") != F.col("pivot")), name)


def _shared(rows: DataFrame) -> DataFrame:
    """``region, set`` of the regions with two sets or more, once each."""
    w = Window.partitionBy("region")
    rows = rows.select("region", "set", F.min("set").over(w).alias("_lo"), F.max("set").over(w).alias("_hi"))
    return cut_lineage(rows.filter("_lo <> _hi").select("region", "set").distinct(), "shared")


class _Join:
    def __init__(self, docs: DataFrame, size: int, num: int, den: int):
        self.docs, self.size, self.num, self.den = docs, size, num, den
        self.keys = cut_lineage(_keys(docs, size, num, den), "sets")
        self.sets = None
        self.of = None          # node, component of linked sets

    def run(self) -> DataFrame:
        regions = self._plausible(_regions_of_texts(self.docs, self.size, self.num, self.den))
        for level in range(DEPTH + 1):
            members = _with_pivots(regions, "regions")
            pairs = cut_lineage(members.groupBy("set", "pivot").count(), "pairs")
            if pairs.isEmpty():
                break
            if self.sets is None:
                self.sets = self._shingles(pairs)
            # linked sets agree in many classes; the rest is left to the blocks, which compare whatever is open
            best = pairs.groupBy("set").agg(F.max(F.struct("count", (-F.col("pivot")).alias("p"))).alias("m")).select(
                "set", (-F.col("m.p")).alias("pivot"), F.col("m.count").alias("shared"))
            self._take(self._stars(best))
            divide = self._blocks(members, level == DEPTH)
            drop_written(members)
            drop_written(pairs)
            if divide is None:
                break
            regions = _regions_of_sets(divide.join(self.sets, "set"), self.num, self.den, level + 1)
        return self.of

    def _plausible(self, regions: DataFrame) -> DataFrame:
        """The regions without the sets that share fewer of a family than any
        link takes; a set's partner is in all that it counts, so no link goes."""
        rows = _shared(regions)
        code = F.explode(F.array_distinct("needs"))
        need = self.keys.filter("n > 0").select("set", code.alias("_c")).distinct().groupBy(
            F.col("set").alias("_set"), (F.col("_c") % FAMILIES).alias("_family")).agg(
            F.min(F.expr(f"_c div {FAMILIES}")).alias("_need"))
        family = F.pmod("region", F.lit(FAMILIES))
        for _ in range(ROUNDS):
            have = rows.groupBy("set", family.alias("family")).agg(F.count(F.lit(1)).alias("_have"))
            enough = have.join(need, (F.col("set") == F.col("_set")) & (F.col("family") == F.col("_family")) & (
                F.col("_have") >= F.col("_need"))).select("_set", "_family")
            enough = cut_lineage(enough, "enough")
            before, rows = rows, _shared(rows.join(
                checked(enough), (F.col("set") == F.col("_set")) & (family == F.col("_family")), "left_semi"))
            drop_written(before)
        return rows

    def _shingles(self, pairs: DataFrame) -> DataFrame:
        """``set, n, shingles`` of the sets in ``pairs``, read from one
        document of each."""
        wanted = pairs.select("set").union(pairs.select("pivot")).distinct()
        of = self.keys.join(wanted, "set", "left_semi").groupBy("set").agg(F.min(F.struct("id", "text_key")).alias("r"))
        of = cut_lineage(of.select("set", F.col("r.id").alias("_id"), F.col("r.text_key").alias("_key")), "representatives")
        size, kind = self.size, "`set` long, n long, shingles array<long>"

        def run(batches):
            hashes = WordHashes()
            for b in batches:
                rows = [(k, s) for k, t in zip(b.column(0).to_pylist(), texts(b.column(1)))
                        if set_key(s := shingle_set(t, size, hashes)) == k]
                yield pa.RecordBatch.from_pydict({
                    "set": pa.array([k for k, _ in rows], pa.int64()),
                    "n": pa.array([len(s) for _, s in rows], pa.int64()),
                    "shingles": pa.array([s.view(np.int64) for _, s in rows], pa.list_(pa.int64()))})

        found = self.docs.join(checked(of), F.col("id").eqNullSafe(F.col("_id")) & (
            F.xxhash64("text") == F.col("_key"))).select("set", "text")
        found = cut_lineage(found.mapInArrow(run, kind), "shingles")
        if found.count() > of.count():      # rows that are there twice
            found = cut_lineage(found.dropDuplicates(["set"]), "shingles")
        return found

    def _stars(self, pairs: DataFrame) -> DataFrame:
        """Linked pairs ``a, b`` among ``set, pivot``; pairs whose sizes alone
        rule a link out are not compared."""
        sizes = self.sets.select("set", "n")
        p = pairs.select("set", "pivot", "shared").join(sizes.withColumnRenamed("n", "n1"), "set").join(
            sizes.toDF("pivot", "n2"), "pivot")
        p = p.filter((F.least("n1", "n2") * self.den >= F.greatest("n1", "n2") * self.num) & (
            F.col("shared") * LIKELY >= F.col("n1")))
        # narrow sides are broadcast when few enough, so that a set moves once, to its pivot
        p = cut_lineage(p, "stars")
        pivots = cut_lineage(p.select("pivot").distinct(), "pivots")
        one = self.sets.select("set", F.col("shingles").alias("_s1")).join(checked(p), "set")
        two = self.sets.select(F.col("set").alias("pivot"), F.col("shingles").alias("_s2")).join(
            checked(pivots), "pivot", "left_semi")
        both = one.join(two, "pivot")
        shared = F.size(F.array_intersect("_s1", "_s2")).cast("long")
        union = F.col("n1") + F.col("n2") - shared
        return both.filter(shared * self.den >= union * self.num).select(
            F.col("set").alias("a"), F.col("pivot").alias("b"))

    def _take(self, links: DataFrame) -> None:
        """Merge links into the components."""
        links = cut_lineage(links, "links")
        if links.isEmpty() and self.of is not None:
            return
        if self.of is not None:     # what is connected already is one edge to its component
            links = links.unionByName(self.of.select(F.col("node").alias("a"), F.col("component").alias("b")))
        self.of = cut_lineage(components(links, "jaccard"), "jaccard")

    def _component(self, df: DataFrame, column: str, name: str) -> DataFrame:
        # two numbers a linked set: broadcast when few enough, so that the members stay in place
        of = checked(self.of.select(F.col("node").alias("_n"), F.col("component").alias("_of")))
        return df.join(of, F.col(column) == F.col("_n"), "left").withColumn(
            name, F.coalesce("_of", column)).drop("_n", "_of")

    def _blocks(self, members: DataFrame, last: bool) -> DataFrame | None:
        """Compare what regions with several components leave open, the
        regions of connected pivots together; returns the regions to divide
        again, if any."""
        t = self._component(self._component(members, "set", "_c"), "pivot", "_cp")
        w = Window.partitionBy("region")
        t = t.withColumns({"_lo": F.min(F.least("_c", "_cp")).over(w), "_hi": F.max(F.greatest("_c", "_cp")).over(w)})
        open_ = cut_lineage(t.filter("_lo <> _hi").select(
            "region", "set", F.col("pivot").alias("own"), F.col("_c").alias("comp"), "_cp"), "open")
        # a block: the open regions of the pivots of one component, which is its main component
        rows = open_.select(F.col("_cp").alias("pivot"), "set", "comp").unionByName(
            open_.select(F.col("_cp").alias("pivot"), F.col("own").alias("set"), F.col("_cp").alias("comp"))).distinct()
        rows = rows.withColumn("main", F.col("pivot")).withColumn("u", F.col("comp") != F.col("main"))
        rows = cut_lineage(rows.join(self.sets.select("set", "n"), "set"), "rows")
        of_blocks = rows.groupBy("pivot", "main").agg(*[x for v, c in (("m", ~F.col("u")), ("u", F.col("u"))) for x in (
            F.count_if(c).alias(f"k{v}"), F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(f"n{v}"))])
        tiles = lambda v: F.greatest(F.lit(1), F.ceil(F.col(f"k{v}") / TILE_SETS[v]),
                                     F.ceil(F.col(f"n{v}") / TILE_SHINGLES)).cast("int")
        of = cut_lineage(of_blocks.filter("ku > 0").select(
            "pivot", "main", "ku", tiles("m").alias("tm"), tiles("u").alias("tu")), "blocks")
        large = None
        if not last:
            far = of.filter(F.col("ku") > DIVIDE).select(F.col("pivot").alias("_cp"))
            large = cut_lineage(open_.join(far, "_cp", "left_semi"), "divide")
            of = of.filter(F.col("ku") <= DIVIDE)
        if large is None or large.isEmpty():
            drop_written(open_)
        self._take(self._block_links(rows.drop("n", "main").join(of, "pivot"), of))
        if large is None or large.isEmpty():
            return None
        return large.select("region", "set").unionByName(
            large.select("region", F.col("own").alias("set"))).distinct()

    def _block_links(self, rows: DataFrame, of: DataFrame) -> DataFrame:
        """Links found by joining the tiles of each block.  A unit of work is
        (block, side, left tile, right tile); the right tile is always one of
        U, the left one of M (side 0) or U (side 1).  Where U is one tile, the
        unit of the first tile of M joins U with itself as well (side 2), so
        that most sets are sent once.  The set that names the block's main
        component is in every unit."""
        tile = lambda n: F.pmod(F.xxhash64("set"), F.col(n)).cast("int")
        upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        unit = lambda side, i, j: F.struct(F.lit(side).alias("side"), i.alias("i"), j.alias("j"))
        t = F.col("_t")
        r = rows.withColumn("_t", F.when(F.col("u"), tile("tu")).otherwise(tile("tm")))
        none = F.array().cast("array<struct<side:int,i:int,j:int>>")
        with_m = lambda i, j: unit(0, i, j).withField("side", F.when((F.col("tu") == 1) & (i == 0), 2)
                                                      .otherwise(0))
        of_u = F.concat(
            F.transform(upto("tm"), lambda i: with_m(i, t)),
            F.when(F.col("tu") > 1, F.transform(upto("tu"), lambda i: unit(1, F.least(i, t), F.greatest(i, t))))
            .otherwise(none))
        r = r.withColumn("_w", F.when(F.col("u"), of_u).otherwise(F.transform(upto("tu"), lambda j: with_m(t, j))))
        r = r.select("pivot", "set", "comp", F.when(F.col("u"), 2).otherwise(1).alias("role"), t.alias("tile"),
                     F.inline("_w"))
        every = F.concat(
            F.flatten(F.transform(upto("tm"), lambda i: F.transform(upto("tu"), lambda j: with_m(i, j)))),
            F.when(F.col("tu") > 1, F.flatten(F.transform(upto("tu"), lambda i: F.transform(
                F.filter(upto("tu"), lambda j: j >= i), lambda j: unit(1, i, j))))).otherwise(none))
        pivots = of.select("pivot", F.col("main").alias("set"), F.col("main").alias("comp"), F.lit(0).alias("role"), F.lit(0).alias("tile"),
                           F.inline(every))
        place = ["pivot", "side", "i", "j"]
        units = cut_lineage(r.unionByName(pivots), "units")
        full = self.sets.select("set", "shingles").join(checked(units), "set")
        full = full.select(*place, "role", "tile", "set", "comp", "shingles")
        num, den = self.num, self.den
        return full.repartition(*place).sortWithinPartitions(*place, "role").mapInArrow(
            lambda batches: _join_units(batches, num, den), "a long, b long")


def _join_units(batches, num: int, den: int):
    """Sorted rows of units, perhaps over several batches, to links."""
    kept = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([kept, t]) if kept is not None else t      # no copy
        keys = np.stack([t[k].to_numpy() for k in ("pivot", "side", "i", "j")], 1)
        edges = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1])
        for s, e in zip(edges[:-1], edges[1:]):
            yield from _unit_links(t.slice(s, e - s).combine_chunks(), num, den)
        kept = t.slice(int(edges[-1])).combine_chunks()
        del t, b
    if kept is not None:
        yield from _unit_links(kept, num, den)
    del kept
    pa.default_memory_pool().release_unused()       # the worker lives on for other stages


def _unit_links(unit: pa.Table, num: int, den: int):
    """Compare every set of the right tile (U) with the members of the left
    tile inside its window of distances to the pivot."""
    role, tile = unit["role"].to_numpy(), unit["tile"].to_numpy()
    if role[0] != 0 or len(role) < 2:
        return
    side, i, j = (unit[k][0].as_py() for k in ("side", "i", "j"))
    lists = unit["shingles"].chunk(0)
    n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    flat = lists.flatten().to_numpy()
    start = np.concatenate([[0], np.cumsum(n)])
    own = np.isin(flat, flat[:n[0]])
    shared = np.add.reduceat(np.append(own, False), start[:-1]).astype(np.int64) * (n > 0)
    union = n + n[0] - shared
    distance = 1 - shared / np.maximum(union, 1)
    linked = shared * den >= union * num
    name = unit["set"].to_numpy()
    left = np.flatnonzero((tile == i) & (role == 2) if side == 1 else (tile == i) & (role == 1) | (role == 2) & (side == 2))
    right = np.flatnonzero((role == 2) & (tile == j))
    found, known = [], np.unique(unit["comp"].to_numpy(), return_inverse=True)[1]

    def link(x, y):
        """An edge where it joins two components of the unit."""
        if known[x] != known[y]:
            found.append((name[x], name[y]))
            known[known == known[x]] = known[y]

    for k in np.concatenate([left, right]):
        if linked[k]:
            link(k, 0)
    # the left tile in the order of its distances: which of its sets hold a shingle
    left = left[np.argsort(distance[left], kind="stable")]
    d, size = distance[left], n[left]
    body = np.concatenate([flat[start[k]:start[k + 1]] for k in left]) if len(left) else flat[:0]
    known_shingles, place = np.unique(body, return_inverse=True)
    holder = np.repeat(np.arange(len(left)), size)[np.argsort(place, kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(known_shingles)))])
    radius = 1 - num / den + 1e-9
    for y in right if len(body) else []:
        low, high = np.searchsorted(d, distance[y] - radius, "left"), np.searchsorted(d, distance[y] + radius, "right")
        if (known[left[low:high]] == known[y]).all():
            continue
        mine = flat[start[y]:start[y + 1]]
        at = np.searchsorted(known_shingles, mine)
        at = at[known_shingles[np.minimum(at, len(known_shingles) - 1)] == mine]
        many = first[at + 1] - first[at]
        rows = np.repeat(first[at] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        both = np.bincount(holder[rows], minlength=len(left))[low:high]
        near = np.flatnonzero(both * den >= (size[low:high] + len(mine) - both) * num)
        for x in left[low + near]:
            link(x, y)
    if found:
        a, b = zip(*found)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def similarity_classes(docs: DataFrame, id_col="doc_id", text_col="text", size: int = 5, num: int = 80,
                       den: int = 100) -> DataFrame:
    """``id, n, set, component_id`` of each row of ``docs``: the size and key
    of its shingle set and the least id of its component (its own id for a
    document without shingles).  Linked: shared * den >= num * union."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    j = _Join(d, size, num, den)
    of = j.run()
    points = j.keys.filter("n > 0").groupBy("set").agg(F.min("id").alias("_low"))
    if of is None:
        least = points.select(F.col("set").alias("_set"), F.col("_low").alias("_least"))
    else:
        points = points.join(of, F.col("set") == F.col("node"), "left").select(
            "set", "_low", F.coalesce("component", "set").alias("_c"))
        low = points.groupBy("_c").agg(F.min("_low").alias("_least"))
        least = points.join(low, "_c").select(F.col("set").alias("_set"), "_least")
    least = cut_lineage(least, "least")
    return j.keys.join(least, (F.col("set") == F.col("_set")) & (F.col("n") > 0), "left").select(
        "id", "text_key", "n", "set", F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text", **rule) -> DataFrame:
    """One document of each component: the one with the least id (one row of
    it, if it is repeated).  Documents without shingles all stay; where all
    ids of a component are null, one row of each shingle set stays."""
    classes = similarity_classes(docs, id_col, text_col, **rule)
    of = F.when(F.col("n") > 0, F.col("component_id"))
    kept = classes.filter((F.col("n") == 0) | F.col("id").eqNullSafe(F.col("component_id")))
    # an id may stand for several texts of a component: one of them
    kept = kept.groupBy("id", F.when(F.col("n") == 0, F.col("text_key")).alias("_empty"), of.alias("_of"), F.when(
        F.col("id").isNull(), F.col("set")).alias("_set")).agg(
        F.min("text_key").alias("_key"), F.count(F.lit(1)).alias("_rows"), F.max("n").alias("_n"))
    kept = cut_lineage(kept.select(F.col("id").alias("_id"), "_key", F.when(F.col("_n") > 0, F.col("_rows"))
                                   .otherwise(1).alias("_rows")), "kept")
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("_d"), F.col(id_col).alias("_i"), F.xxhash64(text_col).alias("_k"))
    rows = rows.join(checked(kept), F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")))
    if not kept.filter("_rows > 1").isEmpty():      # repeated rows: the first by a hash of the whole row
        one = Window.partitionBy("_i", "_k").orderBy(F.xxhash64("_d"))
        rows = rows.withColumn("_nth", F.row_number().over(one)).filter("_rows = 1 or _nth = 1")
    return rows.select(*[F.col(f"_d.{c}").alias(c) for c in names])
