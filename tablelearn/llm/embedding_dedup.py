"""Near-duplicate vectors by cross-polytope hashing with multiprobe.

Vectors with the same label are linked when their cosine reaches a threshold.

1. Exact copies become one vector with a multiplicity (a combining aggregate).
2. Each of ``TABLES`` hash tables turns a vector by pseudo-random rotations
   (three rounds of sign flips and a fast Hadamard transform) and hashes it to
   the nearest corners of ``HASHES`` cross-polytopes.  A vector lies in its
   own bucket and visits the ``PROBES`` - 1 next best ones.
3. Buckets meet their visitors, the cosine of every candidate pair is
   computed in double precision, and only its outcome leaves the bucket: per
   vector the number of links and the least member of its component inside
   the bucket.  Pairs are never written.  A pair that meets in several
   buckets is counted in the least of them (rows carry their bucket lists).
   A bucket with more than ``BLOCK`` rows is dealt into blocks, and each pair
   of blocks is a unit of work of bounded size.
4. The edges (vector, least member) give the components.

Recall: every link has at least the threshold (checked exactly); a link is
missed only if the two vectors meet in none of the tables.

Labels are compared in their own type (one that is no whole number by a 64-bit
hash of it).

Defined cases: a vector that is null, empty, zero, or holds a null or
non-finite component, or whose label is null, links with nothing; vectors of
different lengths are never compared; rows with the same id are vectors of
their own; a null id never becomes a component's id while another member has
one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, IntegralType

from tablelearn.llm.components import components
from tablelearn.plans.shaping import cut_lineage

TABLES, HASHES, PROBES = 4, 2, 4
BLOCK = 2000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row (length a power of two)."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def bucket_codes(unit: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> np.ndarray:
    """Bucket numbers (rows, tables, probes) of unit vectors, the own bucket
    first, the others by how much nearer their corners the vector would have
    to be."""
    rows, dim = unit.shape
    size = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((rows, size))
    padded[:, :dim] = unit
    signs = np.random.default_rng(20240229)
    near = min(3, size)
    choice = np.array(list(product(range(near), repeat=hashes)))
    out = np.zeros((rows, tables, probes), dtype=np.int64)
    for t in range(tables):
        loss = np.zeros((rows, len(choice)))
        code = np.full((rows, len(choice)), t, dtype=np.int64)
        for h in range(hashes):
            x = padded
            for _ in range(3):
                x = hadamard(x * signs.choice([-1.0, 1.0], size))
            corner = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(x, corner, 1)
            away = (np.abs(value[:, :1]) - np.abs(value)) ** 2
            corner = 2 * corner + (value < 0)
            loss += away[:, choice[:, h]]
            code = code * (2 * size) + corner[:, choice[:, h]]
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        out[:, t, :best.shape[1]] = np.take_along_axis(code, best, 1)
        if best.shape[1] < probes:
            out[:, t, best.shape[1]:] = out[:, t, :1]
    return out


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _coded(batches, with_vectors: bool):
    """Rows of ``(label, vector, c, m)`` to rows per bucket."""
    for b in batches:
        sizes = np.asarray([len(v) for v in b.column(1)])
        for dim in np.unique(sizes):
            part = b.filter(pa.array(sizes == dim))
            v = _matrix(part.column(1))
            codes = bucket_codes(v / np.linalg.norm(v, axis=1, keepdims=True))
            n, t, p = codes.shape
            lists = codes.reshape(n, t * p)
            row = np.repeat(np.arange(n), t * p)
            own = np.tile(np.arange(p) == 0, n * t)
            # a bucket may come twice in a short list: one row each
            key, first = np.unique(np.stack([row, lists.ravel()], 1), axis=0, return_index=True)
            row, own = row[first], own[first]
            for s in range(0, len(row), 20_000):
                r, k = row[s:s + 20_000], key[s:s + 20_000, 1]
                columns = {"label": part.column(0).take(pa.array(r)), "dim": np.full(len(r), dim, np.int32), "code": k}
                if with_vectors:
                    columns |= {"own": own[s:s + 20_000], "c": part.column(2).take(pa.array(r)),
                                "m": part.column(3).take(pa.array(r)), "v": part.column(1).take(pa.array(r)),
                                "codes": pa.array(list(lists[r]), pa.list_(pa.int64()))}
                yield pa.RecordBatch.from_pydict(columns)


def _links(v: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float):
    """Index pairs of left x right with cosine >= threshold."""
    n = np.linalg.norm(v, axis=1)
    cosine = (v[left] @ v[right].T) / np.outer(n[left], n[right])
    a, b = np.nonzero(cosine >= threshold)
    return left[a], right[b]


def _local_roots(n: int, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Least ``c`` of each row's component under the pairs (a, b)."""
    root = c.copy()
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == root).all():
            return root
        root = new


def _bucket(rows: pa.Table, threshold: float):
    """One bucket, or one pair of its blocks: ``c, links, root`` rows."""
    v = _matrix(rows["v"].combine_chunks())
    c, m = rows["c"].to_numpy(), rows["m"].to_numpy()
    own = rows["own"].to_numpy(zero_copy_only=False)
    side = rows["side"].to_numpy()
    bi, bj = rows["bi"][0].as_py(), rows["bj"][0].as_py()
    at = np.arange(len(c))
    a, b = _links(v, at[side == bi], at[side == bj], threshold)
    good = (c[a] != c[b]) & (own[a] | own[b]) if bi != bj else (a < b) & (own[a] | own[b])
    a, b = a[good], b[good]
    if not len(a):
        return None
    codes = _matrix_of_codes(rows["codes"])
    mine = np.ones(len(a), dtype=bool)
    code = rows["code"][0].as_py()
    t = TABLES
    for s in range(0, len(a), 50_000):
        x, y = codes[a[s:s + 50_000]], codes[b[s:s + 50_000]]
        step = x.shape[1] // t
        least = np.full(len(x), np.iinfo(np.int64).max)
        for one, other in ((x, y), (y, x)):
            for k in range(t):
                met = (other[:, k * step:(k + 1) * step] == one[:, [k * step]]).any(1)
                least = np.where(met, np.minimum(least, one[:, k * step]), least)
        mine[s:s + 50_000] = least == code
    links = np.zeros(len(c), dtype=np.int64)
    np.add.at(links, a[mine], m[b[mine]])
    np.add.at(links, b[mine], m[a[mine]])
    root = _local_roots(len(c), a, b, c)
    keep = (links > 0) | (root != c)
    return c[keep], links[keep], root[keep]


def _matrix_of_codes(column) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _join_buckets(batches, threshold: float):
    """Sorted rows: buckets are runs of equal keys, perhaps over batches."""
    def out(found):
        found = [f for f in found if f is not None]
        if found:
            c, links, root = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_pydict({"c": c, "links": links, "root": root})

    kept = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([kept, t]) if kept is not None else t
        keys = np.stack([t[k].to_numpy() for k in ("label", "dim", "code", "bi", "bj")], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        edges = np.concatenate([[0], cuts])
        yield from out(_bucket(t.slice(s, e - s), threshold) for s, e in zip(edges[:-1], edges[1:]) if e - s > 1)
        kept = t.slice(int(edges[-1])).combine_chunks()
    if kept is not None and len(kept) > 1:
        yield from out([_bucket(kept, threshold)])


def _label_key(vectors: DataFrame, label_col: str):
    """The label as a long: itself, or a 64-bit hash of a label of another
    type (-0.0 and 0.0 are equal)."""
    label, kind = F.col(label_col), vectors.schema[label_col].dataType
    if isinstance(kind, IntegralType):
        return label.cast("long")
    if isinstance(kind, FractionalType):
        label = label + F.lit(0).cast(kind)
    return F.when(F.col(label_col).isNotNull(), F.xxhash64(label))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col="vec_id", vector_col="embedding",
                    label_col="label") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    e = F.col("v")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), _label_key(vectors, label_col).alias("label"),
                          F.col(vector_col).alias("v"))
    rows = rows.select("*", usable.alias("ok"))
    key = F.xxhash64("label", "v")
    classes = rows.filter("ok").groupBy("label", "v").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("low"))
    classes = cut_lineage(classes.select("label", "v", key.alias("c"), "m", "low"), "vectors")
    body = classes.select("label", "v", "c", "m")
    kind = "label long, dim int, code long"
    large = body.mapInArrow(lambda b: _coded(b, False), kind).groupBy("label", "dim", "code").count().filter(
        F.col("count") > BLOCK).select("label", "dim", "code", F.ceil(F.col("count") / BLOCK).cast("int").alias("nb"))
    vtype = rows.schema["v"].dataType.simpleString()
    coded = body.mapInArrow(lambda b: _coded(b, True),
                            f"{kind}, own boolean, c long, m long, v {vtype}, codes array<long>")
    coded = coded.join(large, ["label", "dim", "code"], "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    coded = coded.withColumn("side", F.pmod(F.xxhash64("c"), F.col("nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    units = coded.withColumn("_o", other).withColumns({"bi": F.least("side", "_o"), "bj": F.greatest("side", "_o")})
    units = units.drop("nb", "_o")
    place = ["label", "dim", "code", "bi", "bj"]
    found = units.repartition(*place).sortWithinPartitions(*place).mapInArrow(
        lambda b: _join_buckets(b, threshold), "c long, links long, root long")
    found = cut_lineage(found, "links")
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    of = components(found.select(F.col("c").alias("a"), F.col("root").alias("b")), "vector-components")
    of = classes.select("c", "m", "low").join(of, F.col("c") == F.col("node"), "left").select(
        "c", "m", "low", F.coalesce("component", "c").alias("comp"))
    least = of.groupBy("comp").agg(F.min("low").alias("least"))
    result = of.join(links, "c", "left").join(least, "comp").select(
        "c", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "least")
    out = rows.select("id", F.when(F.col("ok"), key).alias("_c")).join(result, F.col("_c") == F.col("c"), "left")
    comp = F.coalesce("least", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp.alias("component_id"),
                      F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))
