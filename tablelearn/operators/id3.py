"""Categorical (ID3-style) decision tree on tables.

The tree is a node table, not a driver-side object, and it grows from a
weighted table of CELLS: the training rows are aggregated once to
``(feature values.., label) -> n, sum(first column)`` (map-side combine; with
binned or categorical features the cells are few at any number of rows, with
continuous ones they are at worst as long as the input).  No row is read or
written again after that.

One LEVEL of all nodes grows at a time, from the written FRONTIER: the cells
of the nodes that the level above split, each with its node's id (a hash of the
parent's id, the split attribute and the cell's value of it), its parent's id
and the features used on its path (a bit mask).

1. one aggregate of numbers per node gives its statistics; they are written,
   and pure nodes are finished with them;
2. the cells of the other nodes (one semi join) meet a histogram
   ``(node, feature, value) -> a count per class`` over the features not yet
   used on the path, and a pair of sums for each feature gives every feature's
   gain and the best attribute.  Cells of nodes with at most ``NODE_CELLS``
   cells move once, to their node, and are spread over their features there;
   those of larger nodes are spread and combined before they move;
3. the frontier's cells of nodes that split take one step (one join) and are
   written as the next frontier, without the value they have used.  Cells of
   finished nodes are never read again.

Aggregates hold numbers only (text in a buffer would make Spark sort all rows);
a node's path is put together from its parent's, a row a node.

The written tables are under the shared checkpoint directory and bound the
lineage: a lost executor costs one level.  Only four counts per level, the
class list and broadcast sides of at most ``BROADCAST_NODES`` rows reach the
driver.

Prediction walks DISTINCT value tuples through the levels and joins the result
back to the rows once, so wide rows move at most once and a frequent tuple is
one row of the walk.

Semantics (reference defects fixed, see README): every node keeps its leaf
value so an unseen value falls back to it; a node without features left
becomes a leaf; the leaf value is the majority label by default
(``leaf="mean_first_column"`` gives what the reference stores); null is a
value of its own and matches null.  Labels may be of any type; means of the
label are null where it is no number.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from tablelearn.functions.columns import LN2, as_key_string, ratio, xlogx
from tablelearn.operators.stats import WIDE_CLASSES, bin_column, bin_edges
from tablelearn.plans.shaping import cut_lineage

LEAF_KINDS = ("majority", "mean_label", "mean_first_column")
ROOT = 0
NODE_CELLS = 100_000            # cells of a node that one task may hold
BROADCAST_NODES = 500_000       # rows of a few numbers and a path


def _values(df: DataFrame, features, edges, bins) -> dict:
    """Feature -> key column (its value, or its bin, as text)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return {f: bin_column(f, edges[f], bins).cast("string") if f in edges else as_key_string(F.col(f), types[f])
            for f in features}


def _pick(features, attribute: Column, columns) -> Column:
    """The column of the feature that ``attribute`` names."""
    out = F.lit(None).cast("string")
    for f, c in zip(features, columns):
        out = F.when(attribute == f, c).otherwise(out)
    return out


def _child(node: Column, attribute: Column, value: Column) -> Column:
    return F.xxhash64(node, attribute, F.coalesce(value, F.lit("")), value.isNull())


def _below() -> Column:
    """A node's path, from its parent's path and split and its own value."""
    return F.concat(F.col("_path"), F.when(F.col("_path") == "", F.lit("")).otherwise(F.lit(" AND ")),
                    F.col("_s"), F.lit(" = "), F.coalesce("_value", F.lit("null")))


def _few(nodes: DataFrame, count: int) -> DataFrame:
    """``nodes``, marked for broadcast if its counted size allows it."""
    return F.broadcast(nodes) if count <= BROADCAST_NODES else nodes


@dataclass
class ID3Model:
    features: list
    label: str
    max_depth: int
    leaf: str
    numeric: bool = True
    levels: list = field(default_factory=list)   # [(depth, nodes without paths, n_nodes, n_split)]
    bins: int | None = None
    edges: dict = field(default_factory=dict)    # feature -> bin edges of the training rows

    paths: list = field(default_factory=list)    # of the nodes that split, by level: (_node, _path, split_attribute)

    @property
    def nodes(self) -> DataFrame:
        out = None
        for depth, nodes, _, _ in self.levels:
            if depth:
                above = self.paths[depth - 1].select(F.col("_node").alias("_parent"), "_path", F.col("split_attribute").alias("_s"))
                nodes = nodes.join(_few(above, self.levels[depth - 1][3]), "_parent").withColumn("_path", _below())
            else:
                nodes = nodes.withColumn("_path", F.lit(""))
            nodes = nodes.drop("_parent", "_value", "_s")
            out = nodes if out is None else out.unionByName(nodes)
        return out

    def _leaf(self) -> Column:
        """A number, except that a label that is none keeps its own type."""
        value = F.col(self.leaf)
        return value if self.leaf == "majority" and not self.numeric else value.cast("double")

    def node_table(self) -> DataFrame:
        """``node_path, depth, split_attribute, n, is_pure, majority,
        mean_label, mean_first_column, leaf_value``."""
        majority = F.col("majority").cast("double") if self.numeric else F.col("majority")
        return self.nodes.select(
            F.col("_path").alias("node_path"), "depth", "split_attribute", "n", "is_pure",
            majority.alias("majority"), "mean_label", "mean_first_column", self._leaf().alias("leaf_value"))

    def rules(self) -> DataFrame:
        """One row per leaf: ``rule, depth, n, prediction``."""
        leaves = self.nodes.filter(F.col("split_attribute").isNull())
        return leaves.select(F.col("_path").alias("rule"), "depth", "n", self._leaf().alias("prediction"))


class _LevelPlan:
    """The columns of one level's aggregates, made once for all levels.

    ``classes``: the labels, or None if they are too many for a counter each."""

    def __init__(self, features, classes, kind, compat: bool):
        self.names = [f"_v{i}" for i in range(len(features))]
        pairs = [F.struct(F.lit(i).alias("feature"), F.col(v).alias("value"), F.lit(1 << i).cast("long").alias("_bit"))
                 for i, v in enumerate(self.names)]
        self.long = ["_node", "_y", "_n", "_used", F.inline(F.array(*pairs))]
        self.unused = F.col("_used").bitwiseAND(F.col("_bit")) == 0
        y, n = F.col("_y"), F.col("n")
        number = y.try_cast("double")
        self.wide = classes is not None
        self.cells = [F.count(F.lit(1)).alias("_cells"), F.sum("_f").alias("_sf")]
        if self.wide:
            labels = [F.lit(c).cast(kind) for c in classes]
            self.counts = [F.sum("_n").alias("n"), *[
                F.coalesce(F.sum(F.when(y.eqNullSafe(c), F.col("_n"))), F.lit(0)).alias(f"_c{i}")
                for i, c in enumerate(labels)]]
            n_of = [F.col(f"_c{i}") for i in range(len(classes))]
            total = lambda terms: reduce(lambda a, b: a + b, terms)
            found = F.array(*[F.when(k > 0, F.struct((-k).alias("k"), c.alias("y"))) for k, c in zip(n_of, labels)])
            numbers = [(k, c.try_cast("double")) for k, c in zip(n_of, labels)]
            self.values = [n.alias("_nv"), total([xlogx(k) for k in n_of]).alias("_av")]
            self.stats = [
                n, total([xlogx(k) for k in n_of]).alias("_c"),
                total([(k > 0).cast("long") for k in n_of]).alias("_classes"), F.array_min(found)["y"].alias("majority"),
                total([F.coalesce(k * x, F.lit(0.0)) for k, x in numbers]).alias("_sl"),
                total([F.when(x.isNotNull(), k).otherwise(F.lit(0)) for k, x in numbers]).alias("_nl"), "_sf", "_cells"]
        else:
            self.counts = [F.sum("_n").alias("n")]
            self.values = [F.sum("n").alias("_nv"), F.sum(xlogx("n")).alias("_av")]
            self.stats = [
                F.sum("n").alias("n"), F.sum(xlogx("n")).alias("_c"), F.count(F.lit(1)).alias("_classes"),
                F.min_by("_y", F.struct(-n, y)).alias("majority"), F.sum(number * n).alias("_sl"),
                F.sum(F.when(number.isNotNull(), n)).alias("_nl"), F.sum("_sf").alias("_sf"),
                F.sum("_cells").alias("_cells")]
        # each feature has its own pair of sums in the node's row
        a, b = ([f"{x}{i}" for i in range(len(features))] for x in ("_a", "_b"))
        of = lambda i, c: F.sum(F.when(F.col("feature") == i, c))
        self.sums = [*[of(i, F.col("_av")).alias(c) for i, c in enumerate(a)],
                     *[of(i, xlogx("_nv")).alias(c) for i, c in enumerate(b)]]
        rows = n.cast("double")
        own = F.greatest(F.lit(0.0), F.coalesce((F.ln(rows) - ratio(F.col("_c"), rows)) / LN2, F.lit(0.0)))
        rest = [F.ln(rows) - ratio(F.col(y_), rows) if compat else ratio(F.col(y_) - F.col(x_), rows) / LN2
                for x_, y_ in zip(a, b)]
        self.gains = ["*", *[(own - F.greatest(F.lit(0.0), r)).alias(f"_g{i}") for i, r in enumerate(rest)]]
        # ties to 12 decimals go to the first listed feature; one used on the path has no sums
        offers = [F.when(F.col(b[i]).isNotNull(), F.struct(
            F.round(f"_g{i}", 12).alias("r"), F.lit(-i).alias("o"), F.col(f"_g{i}").alias("g"), F.lit(f).alias("f")))
            for i, f in enumerate(features)]
        best = F.array_max(F.array(*offers)) if offers else F.lit(None).cast("struct<g:double,f:string>")
        self.best = ["*", best.alias("_best")]

    def _counted(self, rows: DataFrame, keys, counts, results) -> DataFrame:
        if self.wide:
            return rows.groupBy(*keys).agg(*self.counts, *counts).select(*keys, *results)
        return rows.groupBy(*keys, "_y").agg(*self.counts, *counts).groupBy(*keys).agg(*results)

    def nodes(self, cells: DataFrame) -> DataFrame:
        """The statistics of one level's nodes from the frontier."""
        return self._counted(cells, ["_node", "_parent", "_value"], self.cells, self.stats)

    def _values_of(self, cells: DataFrame) -> DataFrame:
        return self._counted(cells.select(*self.long).filter(self.unused), ["_node", "feature", "value"], [], self.values)

    def splits(self, cells: DataFrame, nodes: DataFrame, small: int, large: int) -> DataFrame:
        """``_node, _parent, _value, split_attribute, gain`` of the nodes with several classes: ``small``
        of them have so few cells that a task may hold them, ``large`` have more."""
        open_ = nodes.filter("_classes > 1")
        fits = F.col("_cells") <= NODE_CELLS
        narrow = cells.select(*self.names, "_y", "_n", "_node", "_used")
        parts = []
        if small:
            mine = narrow.join(_few(open_.filter(fits).select("_node"), small), "_node", "left_semi")
            parts.append(self._values_of(mine.repartition("_node")))
        if large:
            parts.append(self._values_of(narrow.join(_few(open_.filter(~fits).select("_node"), large), "_node", "left_semi")))
        sums = reduce(DataFrame.unionByName, parts).groupBy("_node").agg(*self.sums)
        best = sums.join(open_.select("_node", "_parent", "_value", "n", "_c"), "_node").select(*self.gains).select(*self.best)
        return best.select("_node", "_parent", "_value", F.col("_best.f").alias("split_attribute"), F.col("_best.g").alias("gain"))


def _step(features, names):
    """Frontier and splits -> the cells of the nodes that split, one level down."""
    attr = F.col("_s")
    value = _pick(features, attr, [F.col(c) for c in names])
    bit = F.lit(0).cast("long")
    for i, f in enumerate(features):
        bit = F.when(attr == f, F.lit(1 << i).cast("long")).otherwise(bit)
    # a value that is on the path is not needed again
    left = [F.when(attr != f, F.col(c)).alias(c) for f, c in zip(features, names)]
    down = [*left, "_y", "_n", "_f", F.col("_node").alias("_parent"), value.alias("_value"),
            _child(F.col("_node"), attr, value).alias("_node"), F.col("_used").bitwiseOR(bit).alias("_used")]

    def take(cells: DataFrame, splits: DataFrame, count: int) -> DataFrame:
        splits = splits.select("_node", F.col("split_attribute").alias("_s"))
        return cells.join(_few(splits, count), "_node").select(*down)
    return take


def id3_build(df: DataFrame, features, label: str, max_depth: int = 7, criterion: str = "textbook",
              leaf: str = "majority", first_column: str | None = None, bins: int | None = None,
              binning: str = "width") -> ID3Model:
    """Grow the tree (eager: a few jobs per level).

    ``bins``: numeric features are replaced by equal-width (or, with
    ``binning="quantile"``, quantile) bins of the training rows first (edges
    kept in the model and reused by ``id3_predict``); otherwise a continuous
    feature makes about one node per distinct value."""
    if leaf not in LEAF_KINDS:
        raise ValueError(f"leaf must be one of {LEAF_KINDS}")
    features = list(features)
    if len(features) > 62:
        raise ValueError("at most 62 features")
    kind = df.schema[label].dataType
    edges = bin_edges(df, features, bins, binning) if bins else {}
    model = ID3Model(features, label, max_depth, leaf, isinstance(kind, (NumericType, BooleanType)),
                     bins=bins if edges else None, edges=edges)
    keys = [c.alias(f"_v{i}") for i, c in enumerate(_values(df, features, edges, bins).values())]
    first = F.col(first_column or df.columns[0]).try_cast("double")
    names = [f"_v{i}" for i in range(len(features))]
    cells = df.select(*keys, F.col(label).alias("_y"), first.alias("_first")).groupBy(*names, "_y").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_first").alias("_f"))
    cells = cells.select("*", F.lit(ROOT).cast("long").alias("_node"), F.lit(0).cast("long").alias("_used"),
                         F.lit(None).cast("long").alias("_parent"), F.lit(None).cast("string").alias("_value"))
    cells = cut_lineage(cells, "id3-cells")
    classes = [r[0] for r in cells.select("_y").distinct().limit(WIDE_CLASSES + 1).collect()]
    classes = None if len(classes) > WIDE_CLASSES else classes or [None]
    step, plan = _step(features, names), _LevelPlan(features, classes, kind, criterion == "compat")
    open_ = F.col("_classes") > 1
    counts = [F.count(F.lit(1)).alias("all"), F.count_if(open_ & (F.col("_cells") <= NODE_CELLS)).alias("small"),
              F.count_if(open_ & (F.col("_cells") > NODE_CELLS)).alias("large")]
    for depth in range(max_depth + 1):
        last = depth >= min(max_depth, len(features))
        stats = cut_lineage(plan.nodes(cells), "id3-nodes")
        seen = stats.agg(*counts).first()
        split = 0 if last else int(seen["small"] + seen["large"])
        nodes = stats.select(
            "_node", "_parent", "_value", F.lit(depth).alias("depth"), "n", (F.col("_classes") == 1).cast("int").alias("is_pure"),
            "majority", ratio("_sl", "_nl").alias("mean_label"), ratio("_sf", "n").alias("mean_first_column"))
        if not split:
            nodes = nodes.withColumn("split_attribute", F.lit(None).cast("string"))
            model.levels.append((depth, nodes, int(seen["all"]), 0))
            break
        splits = plan.splits(cells, stats, int(seen["small"]), int(seen["large"]))
        if depth:
            above = model.paths[-1].select(F.col("_node").alias("_parent"), "_path", F.col("split_attribute").alias("_s"))
            splits = splits.join(_few(above, model.levels[-1][3]), "_parent").withColumn("_path", _below())
        else:
            splits = splits.withColumn("_path", F.lit(""))
        splits = cut_lineage(splits.select("_node", "_path", "split_attribute", "gain"), "id3-splits")
        nodes = nodes.join(_few(splits.select("_node", "split_attribute"), split), "_node", "left")
        model.paths.append(splits)
        model.levels.append((depth, nodes, int(seen["all"]), split))
        cells = cut_lineage(step(cells, splits, split), "id3-cells")
    return model


def id3_predict(model: ID3Model, df: DataFrame, output: str = "prediction") -> DataFrame:
    """Append ``output``: follow the child whose edge value equals the
    row's value; at a leaf, or when the value was not seen in training,
    take the current node's leaf value.

    The distinct value tuples flow through one left join per tree level (a
    level of at most ``BROADCAST_NODES`` nodes is broadcast and the tuples stay
    in place); a tuple
    whose prediction is known keeps it and joins on its own hash, so finished
    tuples spread over all partitions.  The rows meet the result in one join on
    a 128-bit hash of the tuple."""
    cols = df.columns
    leaf = model._leaf()
    root = model.levels[0][1].select("split_attribute", leaf.alias("leaf"))
    first = root.first()
    kind = root.schema["leaf"].dataType
    attr0 = None if first is None else first["split_attribute"]
    top = F.lit(None if first is None else first["leaf"]).cast(kind)
    if attr0 is None:
        return df.withColumn(output, top).select(*cols, output)
    keys = _values(df, model.features, model.edges, model.bins)
    names = [f"_v{i}" for i in range(len(keys))]
    values = [F.col(a) for a in names]
    # nulls are skipped by the hash, so they are marked
    marked = [x for c in keys.values() for x in (c, c.isNull())]
    hashes = [F.xxhash64(*marked).alias("_t1"), F.xxhash64(F.lit("tuple"), *marked).alias("_t2")]
    tuples = df.select(*[c.alias(a) for a, c in zip(names, keys.values())], *hashes).distinct()
    # the root is one node: its split is applied as a literal
    state = tuples.select(
        "*", _child(F.lit(ROOT).cast("long"), F.lit(attr0), _pick(model.features, F.lit(attr0), values)).alias("_node"),
        top.alias("_pred"), F.lit(False).alias("_done"))
    for _, nodes, count, _ in model.levels[1:]:
        look = _few(nodes.select(F.col("_node").alias("_k"), F.col("split_attribute").alias("_split"), leaf.alias("_leaf")), count)
        key = F.when(F.col("_done"), F.col("_t1")).otherwise(F.col("_node"))
        j = state.withColumn("_key", key).join(look, F.col("_key") == F.col("_k"), "left")
        hit = ~F.col("_done") & F.col("_k").isNotNull()
        go = hit & F.col("_split").isNotNull()
        state = j.select(
            *names, "_t1", "_t2",
            F.when(go, _child(F.col("_node"), F.col("_split"), _pick(model.features, F.col("_split"), values)))
             .otherwise(F.col("_node")).alias("_node"),
            F.when(hit, F.col("_leaf")).otherwise(F.col("_pred")).alias("_pred"), (~go).alias("_done"))
    walked = state.select(F.col("_t1").alias("_w1"), F.col("_t2").alias("_w2"), F.col("_pred").alias("_walked"))
    out = df.select("*", *hashes).join(walked, (F.col("_t1") == F.col("_w1")) & (F.col("_t2") == F.col("_w2")))
    return out.select(*cols, F.col("_walked").alias(output))
