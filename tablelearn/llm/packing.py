"""Packing of tokenised documents into windows, by best-fit decreasing.

1. One narrow pass tokenises every whole text and appends the end id 0.  A
   document longer than a window is first cut into full windows, each a
   sequence of its own; what remains (1 to 1023 ids, or nothing) is packed.
   Only place, length and checksum of a piece leave the pass, not its ids.
2. The remainders are dealt by a hash of their row number into groups of
   about ``GROUP`` rows, and each group is packed by best-fit decreasing: from
   the longest piece down, the open window with the least room that still
   fits is found in a segment tree over the possible remaining capacities.
   Groups are independent, of bounded size, and share no key with the data.

Ids are those of the byte-level BPE vocabulary file given by its path.  Its
rank form is read by tiktoken, which gives the same ids as the ``tokenizers``
form several times faster (a test compares both); the rare text that spells
out the special token, or whose runs of white space are too long for its
pattern matcher, goes through ``tokenizers`` itself.

Defined cases: a null text is empty and gives the one id 0; repeated rows are
packed each; an empty table gives no piece; a document whose length is a
multiple of the window leaves no remainder.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.tokens import ByteBpe
from tablelearn.plans.shaping import cut_lineage

WINDOW = 1024
GROUP = 8192
SPECIAL = "<|endoftext|>"


class Ids:
    """Token ids of a text, with the end id 0."""

    def __init__(self, ranks_path: str, tokenizer_path: str, pattern: str):
        self.bpe = ByteBpe(ranks_path, tokenizer_path, pattern)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(1, dtype="<u4")
        if SPECIAL in text:
            ids = self.bpe.tokenizer(False).encode(text, add_special_tokens=False).ids
        else:
            ids = self.bpe.ids(text)
        return np.append(np.asarray(ids, dtype="<u4"), np.uint32(0)).astype("<u4", copy=False)


class Room:
    """Open windows by remaining capacity: a segment tree over capacities
    0..size whose nodes count the open windows below them."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open = [[] for _ in range(size + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, need: int) -> int:
        """The least remaining capacity >= need of an open window, or -1."""
        node = need + self.leaves
        if self.count[node]:
            return need
        while node > 1:
            if not node & 1 and self.count[node + 1]:   # the right sibling has some: go down its left edge
                node += 1
                while node < self.leaves:
                    node *= 2
                    if not self.count[node]:
                        node += 1
                return node - self.leaves
            node >>= 1
        return -1

    def take(self, room: int) -> int:
        self._change(room, -1)
        return self.open[room].pop()


def best_fit_decreasing(lengths, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece (ties: in the given order)."""
    lengths = np.asarray(lengths)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room, used = Room(window), 0
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        left = room.tightest(need)
        if left < 0:
            w, left, used = used, window, used + 1
        else:
            w = room.take(left)
        number[i], offset[i] = w, window - left
        if left > need:
            room.add(left - need, w)
    return number, offset


def pieces_of(docs: DataFrame, id_col: str, text_col: str, files: tuple[str, str, str], window: int) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``."""
    def run(batches):
        ids_of = Ids(*files)
        for b in batches:
            rows, start, length, crc, total = [], [], [], [], []
            for k, text in enumerate(b.column(1)):
                ids = ids_of(text.as_py())
                for s in range(0, len(ids), window):
                    part = ids[s:s + window]
                    rows.append(k)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
            long = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0).take(long(rows)), "start": long(start), "length": long(length),
                "ids_crc32": long(crc), "doc_tokens": long(total)})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, id_col="doc_id", text_col="text", files: tuple[str, str, str] | None = None,
         window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.  ``files``: paths of the rank file and of the
    tokenizer file, and the pattern that splits words."""
    pieces = pieces_of(docs, id_col, text_col, files or public_files(), window)
    pieces = cut_lineage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-pieces.filter(F.col("length") < window).count() // group))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_row")
        number, offset = best_fit_decreasing(table["length"].to_numpy(), window)
        # even numbers; full windows have the odd ones
        seq = 2 * (table["_g"].to_numpy() * np.int64(1 << 24) + number)
        return table.drop_columns(["_g", "_row"]).append_column("sequence_id", pa.array(seq)).append_column(
            "offset", pa.array(offset))

    rest = pieces.filter(F.col("length") < window).withColumn("_g", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    kind = pieces.schema["doc_id"].dataType.simpleString()
    packed = rest.groupBy("_g").applyInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    full = pieces.filter(F.col("length") == window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_row") * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)


def public_files() -> tuple[str, str, str]:
    import public_tokenizers
    return (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.PATTERN)
