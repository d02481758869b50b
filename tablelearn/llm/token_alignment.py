"""Alignment of two tokenizers' tokens, once for each distinct text.

1. Documents are shuffled by their full text and counted: one row per distinct
   text with its number of copies.
2. Each distinct text is tokenised by A (byte-level BPE, of space + text) and B
   (sentencepiece, which adds the space itself).  Byte offsets at which tokens
   of both end cut the tokens into groups; an A and a B token of one group are
   linked.  Texts are taken in chunks of about ``CHUNK`` characters; a chunk
   keeps its different id pairs once, with the number of documents (copies
   counted) that hold them, and each text's pairs as places in that list.  One
   written row per chunk.
3. A pair's count is the sum over chunks; the counts of a chunk's pairs are
   joined back to the chunk, where each text sums its links.  What is shuffled
   is a pair once a chunk, however often the chunk's texts repeat it.
4. The measures are joined to doc_ids by a 128-bit hash of the text.

No side is broadcast and nothing is collected; chunks are bounded (a longer text is a
chunk of its own), an A id has at most as many pairs as B has ids.

Defined cases: a null, empty or not exactly covered text (joined token bytes
differ from space + text, as with U+2581 in it) has no tokens: zeros and ''.
Repeated rows count as documents each; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.llm.tokens import ByteBpe, Pieces
from tablelearn.plans.shaping import cut_lineage

CHUNK = 1 << 21
#: links of a group that are listed one by one; a larger group is counted by distinct ids (the same sums)
LISTED = 1 << 14
#: bits of an id in a pair key
BITS = 20
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


class Aligned:
    """Tokens of several texts in one run, with the group of each token.

    ``a`` and ``b`` are ids, ``group_a`` and ``group_b`` their group numbers
    (rising through all texts), ``text`` the text of each group."""

    def __init__(self, texts: list[str], first: ByteBpe, second: Pieces):
        sizes_a = np.array([len(x) for x in first.bytes])
        sizes_b = np.array([len(x) for x in second.bytes])
        a, b, total = [], [], 0
        ends_a, ends_b, self.n_a, self.n_b, ends = [], [], [], [], []
        for t in texts:
            ids_a, ids_b, whole = first.ids(" " + t), second.ids(t), (" " + t).encode()
            if not t or self.joined(first, ids_a) != whole or self.joined(second, ids_b) != whole:
                ids_a, ids_b = ids_a[:0], ids_b[:0]
            self.n_a.append(len(ids_a))
            self.n_b.append(len(ids_b))
            if len(ids_a):
                a.append(ids_a)
                b.append(ids_b)
                ends_a.append(total + np.cumsum(sizes_a[ids_a]))
                ends_b.append(total + np.cumsum(sizes_b[ids_b]))
                total += len(whole)
            ends.append(total)
        flat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        self.a, self.b, ends_a, ends_b = flat(a), flat(b), flat(ends_a), flat(ends_b)
        closes_a, closes_b = (np.zeros(total + 1, bool) for _ in range(2))
        closes_a[ends_a] = True
        closes_b[ends_b] = True
        last_a, last_b = closes_b[ends_a], closes_a[ends_b]      # the token ends its group
        self.group_a, self.group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        groups = int(last_a.sum())
        self.in_a, self.in_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        self.text = np.searchsorted(np.array(ends, np.int64), ends_a[last_a])
        self.last_a, self.last_b = last_a, last_b

    @staticmethod
    def joined(tokenizer, ids) -> bytes:
        return b"".join(map(tokenizer.bytes.__getitem__, ids.tolist()))

    def spelled(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text ('' without tokens)."""
        n = len(self.a) + len(self.b)
        before_a, before_b = (np.concatenate([[0], np.cumsum(x)]) for x in (self.in_a, self.in_b))
        ids, mark = np.zeros(n, np.int64), np.zeros(n, np.int64)
        at_a = np.arange(len(self.a)) + before_b[self.group_a]
        at_b = np.arange(len(self.b)) + before_a[self.group_b + 1]
        ids[at_a], mark[at_a] = self.a, np.where(self.last_a, 1, 0)
        ids[at_b], mark[at_b] = self.b, np.where(self.last_b, 2, 0)
        different, place = np.unique(ids * 3 + mark, return_inverse=True)
        names = np.array([f"{k // 3}{',|;'[k % 3]}" for k in different.tolist()] + [""], object)
        parts, out, at = names[place].tolist(), [], 0
        for n_a, n_b in zip(self.n_a, self.n_b):
            out.append("".join(parts[at:at + n_a + n_b])[:-1])
            at += n_a + n_b
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair key and number of occurrences, sorted and distinct."""
        start_b = np.concatenate([[0], np.cumsum(self.in_b)])
        many = self.in_a * self.in_b > LISTED
        few = ~many[self.group_a]
        a, group = self.a[few], self.group_a[few]
        times = self.in_b[group]
        first = np.repeat(start_b[group] - (np.cumsum(times) - times), times)
        b = self.b[first + np.arange(len(first))]
        texts, keys, counts = [self.text[np.repeat(group, times)]], [np.repeat(a, times) << BITS | b], [None]
        start_a = np.concatenate([[0], np.cumsum(self.in_a)])
        for g in np.flatnonzero(many):
            x, n_x = np.unique(self.a[start_a[g]:start_a[g + 1]], return_counts=True)
            y, n_y = np.unique(self.b[start_b[g]:start_b[g + 1]], return_counts=True)
            keys.append((x[:, None] << BITS | y).ravel())
            counts.append(np.outer(n_x, n_y).ravel())
            texts.append(np.full(len(keys[-1]), self.text[g]))
        counts[0] = np.ones(len(texts[0]), np.int64)
        text, key, n = np.concatenate(texts), np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        order = order[np.argsort(text[order], kind="stable")]
        text, key, n = text[order], key[order], n[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        return text[new], key[new], np.add.reduceat(n, np.flatnonzero(new)) if len(n) else n


def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``text, copies`` and the two halves of the text's hash; null and empty
    texts have no tokens and are left out."""
    text = docs.select(F.col(text_col).alias("text")).filter(F.col("text") != "")
    return text.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select("text", "copies", *text_keys("text"))


def text_keys(text) -> list[Column]:
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def _chunks(batches, chunk: int):
    rows, size = [], 0
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if rows and size + len(row[0]) > chunk:
                yield rows
                rows, size = [], 0
            rows.append(row)
            size += len(row[0])
    if rows:
        yield rows


def aligned_chunks(docs: DataFrame, text_col: str, files: tuple[str, str, str, str], chunk: int,
                   spell: bool = False) -> DataFrame:
    """One row per chunk of distinct texts: the texts' keys and measures, the
    chunk's pair list with document counts, and each text's places in it."""
    def run(batches):
        first, second, packer = ByteBpe(*files[:3]), Pieces(files[3]), zstandard.ZstdCompressor(level=1)
        for k, rows in enumerate(_chunks(batches, chunk)):
            texts, copies, k1, k2 = map(list, zip(*rows))
            al = Aligned(texts, first, second)
            text, key, times = al.links()
            groups = al.spelled()
            pairs, at = np.unique(key, return_inverse=True)
            docs_with = np.zeros(len(pairs), np.int64)
            np.add.at(docs_with, at, np.array(copies, np.int64)[text])
            n_links = np.bincount(al.text, al.in_a * al.in_b, len(texts)).astype(np.int64)
            spans = np.bincount(text, minlength=len(texts)).astype("<i8")
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([TaskContext.get().partitionId() << 24 | k], pa.int64()),
                "k1": pa.array([k1], pa.list_(pa.int64())), "k2": pa.array([k2], pa.list_(pa.int64())),
                "n_a": pa.array([al.n_a], pa.list_(pa.int64())), "n_b": pa.array([al.n_b], pa.list_(pa.int64())),
                "n_groups": pa.array([np.bincount(al.text, minlength=len(texts))], pa.list_(pa.int64())),
                "n_links": pa.array([n_links], pa.list_(pa.int64())),
                "groups": pa.array([groups if spell else [hashlib.sha256(g.encode()).hexdigest() if g else ""
                                                          for g in groups]], pa.list_(pa.string())),
                "pairs": pa.array([pairs], pa.list_(pa.int64())), "docs": pa.array([docs_with], pa.list_(pa.int64())),
                # places rise inside a text: their steps are small numbers
                "places": pa.array([packer.compress(
                    spans.tobytes() + np.diff(at, prepend=0).astype("<i4").tobytes() + times.astype("<u4").tobytes())],
                    pa.binary())})

    longs = ", ".join(f"{c} array<long>" for c in ("k1", "k2", *MEASURES))
    return distinct_texts(docs, text_col).mapInArrow(
        run, f"chunk long, {longs}, groups array<string>, pairs array<long>, docs array<long>, places binary")


def _pairs(chunks: DataFrame) -> DataFrame:
    return chunks.select(F.col("chunk").alias("in_chunk"), F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "p")).select(
        "in_chunk", "at", F.shiftright("p.pairs", BITS).cast("int").alias("a"),
        F.col("p.pairs").bitwiseAND((1 << BITS) - 1).cast("int").alias("b"), F.col("p.docs").alias("n"))


def _counts(pairs: DataFrame) -> DataFrame:
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    # an A id has at most as many rows as B has ids
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


def pair_counts(docs: DataFrame, text_col: str = "text", files=None, chunk: int = CHUNK) -> DataFrame:
    """``a, b, count, best``: documents that hold an id pair linked, and
    whether no pair of the same A id has a higher count."""
    return _counts(_pairs(cut_lineage(aligned_chunks(docs, text_col, files or public_files(), chunk), "aligned")))


def token_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files=None,
                 chunk: int = CHUNK) -> DataFrame:
    """``doc_id, groups``: the alignment itself as ``a1,a2|b1;a3|b2,b3``."""
    chunks = cut_lineage(aligned_chunks(docs, text_col, files or public_files(), chunk, spell=True), "groups")
    texts = chunks.select(F.inline(F.arrays_zip("k1", "k2", "groups")))
    ids = docs.select(F.col(id_col).alias("doc_id"), *text_keys(text_col))
    return ids.join(texts, ["k1", "k2"], "left").select("doc_id", F.coalesce("groups", F.lit("")).alias("groups"))


def alignment_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files=None,
                     chunk: int = CHUNK) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``.  ``files``: rank file, tokenizer file and word pattern of
    A, model file of B."""
    chunks = cut_lineage(aligned_chunks(docs, text_col, files or public_files(), chunk), "aligned")
    pairs = _pairs(chunks)
    known = pairs.drop("n").join(_counts(_pairs(chunks)), ["a", "b"]).select("in_chunk", "at", "count", "best")

    def run(key, texts: pa.Table, found: pa.Table) -> pa.Table:
        row = {c: texts[c][0] for c in texts.column_names if c != "chunk"}
        own = lambda c: row[c].values
        n = len(own("k1"))
        raw = zstandard.ZstdDecompressor().decompress(row["places"].as_py())
        spans = np.frombuffer(raw, "<i8", n)
        m = int(spans.sum())
        at = np.cumsum(np.frombuffer(raw, "<i4", m, 8 * n))
        times = np.frombuffer(raw, "<u4", m, 8 * n + 4 * m).astype(np.int64)
        count, best = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows, np.int64)
        place = found["at"].to_numpy()
        count[place], best[place] = found["count"].to_numpy(), found["best"].to_numpy()
        upto = np.concatenate([[0], np.cumsum(spans)])
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[upto])
        return pa.table({"k1": own("k1"), "k2": own("k2"), **{c: own(c) for c in MEASURES},
                         "n_best": total(times * best[at]), "count_sum": total(times * count[at]),
                         "groups_sha256": own("groups")})

    measures = chunks.select("chunk", "k1", "k2", *MEASURES, "groups", "places").groupBy("chunk").cogroup(
        known.groupBy("in_chunk")).applyInArrow(
        run, "k1 long, k2 long, " + ", ".join(f"{c} long" for c in (*MEASURES, "n_best", "count_sum"))
             + ", groups_sha256 string")
    ids = docs.select(F.col(id_col).alias("doc_id"), *text_keys(text_col))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*MEASURES, "n_best", "count_sum")]
    return ids.join(measures, ["k1", "k2"], "left").select(
        "doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def public_files() -> tuple[str, str, str, str]:
    import public_tokenizers
    return (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))
