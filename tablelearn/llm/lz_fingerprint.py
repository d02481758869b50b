"""Lempel-Ziv phrase fingerprints, and their comparison with the next document's.

A text is parsed from left to right into dictionary phrases: the longest known
phrase and one more character make the next new one.  The set of hashed phrases
is kept as a minimum-hash signature: ``SLOTS`` ranges of the hash, the least
hash of each range, 16 bits of it (a range without phrase has a mark of its
own).  The share of equal slots among the ranges that either text fills
estimates the Jaccard similarity of two phrase sets, which is high where one
text's phrases compress the other.

``compare_with_next`` works on rows in descending id order.  One range
shuffle sorts the rows; each partition is streamed with one row in hand, so a
text meets its successor without a join.  A partition's last row meets the next
partition's first one afterwards (one row per partition).  A text's first two
thirds are parsed once for the text and its edited form.

Defined cases: a null text is empty; an empty text has no phrase, equals other
empty ones (1.0) and is unlike any other text (0.0).  Rows of one id are in the
order of their text's hash, null ids come last; a table of one row is its own
successor; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelearn.plans.shaping import cut_lineage

SLOTS = 128
EMPTY = 0xFFFF
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: characters hashed at once
BLOCK = 1 << 18
BASE = 0x9E3779B97F4A7C15


def parse(text: str, at: int, seen: set) -> list[int]:
    """Bounds of the new phrases of ``text`` from ``at`` on (each begins where
    the one before ends); ``seen`` is prefix-closed and takes them in.  The
    search for the longest known phrase starts at the length of the phrase
    before, so it stays linear in long repeats."""
    bounds, n, size = [at], len(text), 1
    add, bound = seen.add, bounds.append
    while at < n:
        end = at + size
        if end > n:
            end = n
        if (phrase := text[at:end]) in seen:
            while end < n:
                end += 1
                if (phrase := text[at:end]) not in seen:
                    break
            else:
                break               # the rest of the text is a known phrase
        else:
            while end - 1 > at and (shorter := text[at:end - 1]) not in seen:
                phrase = shorter
                end -= 1
        add(phrase)
        bound(end)
        size = end - at
        at = end
    return bounds


class Powers:
    """Powers of an odd base modulo 2^64, and their inverses."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int):
        if len(self.up) < n:
            self.up, self.down = (np.concatenate([self.up[:1], np.cumprod(np.full(2 * n, b, np.uint64))])
                                  for b in (BASE, pow(BASE, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    return h ^ (h >> np.uint64(31))


class Signatures:
    """Least phrase hash of each hash range."""

    def __init__(self, slots: int = SLOTS):
        self.slots, self.powers = slots, Powers()
        self.edges = (np.arange(slots, dtype=np.uint64) << np.uint64(64 - (slots - 1).bit_length()))

    def hashes(self, text: str, bounds: list[int]) -> np.ndarray:
        """Polynomial hash of each phrase, from prefix sums of blocks of text."""
        b, out, k = np.array(bounds), [], 0
        while k < len(b) - 1:
            last = max(k + 1, int(np.searchsorted(b, b[k] + BLOCK, "right")) - 1)
            code = np.frombuffer(text[b[k]:b[last]].encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
            up, down = self.powers.of(len(code))
            upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * up)])[b[k:last + 1] - b[k]]
            out.append(mixed(np.diff(upto) * down[b[k:last] - b[k]]))
            k = last
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def least(self, h: np.ndarray) -> np.ndarray:
        """The least hash of each range; ``NONE`` in a range without any."""
        if not len(h):
            return np.full(self.slots, NONE)
        h = np.sort(h)
        at = np.searchsorted(h, self.edges)
        full = np.append(at[1:], len(h)) > at
        return np.where(full, h[np.minimum(at, len(h) - 1)], NONE)

    @staticmethod
    def kept(least: np.ndarray) -> np.ndarray:
        return np.where(least == NONE, EMPTY, least % np.uint64(EMPTY)).astype(np.uint16)

    def of(self, text: str) -> np.ndarray:
        return self.kept(self.least(self.hashes(text, parse(text, 0, set()))))


class Parsed:
    """A text parsed up to ``cut``, from where it may go on in several ways."""

    def __init__(self, make: Signatures, text: str, cut: int):
        self.make, self.text, self.cut, self.seen = make, text, cut, set()
        bounds = parse(text[:cut], 0, self.seen)
        self.shared, self.at = make.least(make.hashes(text, bounds)), bounds[-1]

    def ending(self, tail: str) -> np.ndarray:
        """Signature of the text up to ``cut``, followed by ``tail``."""
        rest = self.text[self.at:self.cut] + tail
        bounds = parse(rest, 0, self.seen)
        self.seen.difference_update([rest[x:y] for x, y in zip(bounds, bounds[1:])])
        return self.make.kept(np.minimum(self.shared, self.make.least(self.make.hashes(rest, bounds))))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots among those that either side fills."""
    filled = (a != EMPTY) | (b != EMPTY)
    n = int(filled.sum())
    return float((filled & (a == b)).sum()) / n if n else 1.0


def packed(signature: np.ndarray) -> bytes:
    return signature.astype(">u2").tobytes()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2").astype(np.uint16)


def spelled(column: str) -> Column:
    return F.lower(F.hex(column)).alias(column)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``doc_id, fingerprint`` of every row, in one narrow pass."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        make = Signatures(slots)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([packed(make.of(t or "")) for t in b.column(1).to_pylist()], pa.binary())],
                names=["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, fingerprint binary").select("doc_id", spelled("fingerprint"))


RESULT = "n_chars long, edited string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
COLUMNS = [c.split()[0] for c in RESULT.split(", ")]


class Held:
    """A text that waits for its successor."""

    def __init__(self, make: Signatures, text: str):
        self.text, n = text, len(text) // 3
        self.parsed = Parsed(make, text, len(text) - n)
        self.signature = self.parsed.ending(text[len(text) - n:])

    def compared(self, following: Held) -> tuple:
        cut = self.parsed.cut
        tail = following.text[:len(self.text) - cut]
        edited = self.parsed.ending(tail)
        return (len(self.text), self.text[:cut] + tail, packed(self.signature), packed(edited),
                likeness(self.signature, edited), likeness(self.signature, following.signature))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS,
                      keep_texts: bool = False) -> DataFrame:
    """Per row ``doc_id, n_chars, edited_sha256`` (or the text itself as ``edited`` with
    ``keep_texts``), ``fingerprint, edited_fingerprint, near_edited,
    near_next``: the fingerprint of the text, of the text whose last third is
    replaced by the beginning of its successor's, and the likeness of the
    first to the second and to the successor's own."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).select(
        "*", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_m"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("_h"), F.col("_m")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        make, part = Signatures(slots), TaskContext.get().partitionId()
        held = None         # (id, text, whether it is the partition's first row)
        for b in batches:
            out = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                now = Held(make, text)
                if held is not None:
                    out.append((held[0], part, held[2], False, held[1].text if held[2] else None, *held[1].compared(now)))
                held = (i, now, held is None)
            if out:
                yield _batch(out)
        if held is not None:
            yield _batch([(held[0], part, held[2], True, held[1].text, len(held[1].text), *[None] * 5)])

    def _batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    fields = f"doc_id {kind}, part int, first boolean, last boolean, text string, {RESULT}"
    schema = _arrow(docs.sparkSession, fields)
    # hashes are kept as bytes until the end
    digest = (lambda df: df) if keep_texts else (
        lambda df: df.withColumn("edited", F.unhex(F.sha2("edited", 256))))
    made = cut_lineage(digest(dealt.mapInArrow(run, fields)), "compared")
    # one row per partition
    parts = sorted(r["part"] for r in made.filter("first").select("part").collect())
    follows = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    firsts = made.filter("first").select(F.col("part").alias("next"), F.col("text").alias("following"))
    ends = made.filter("last").select("doc_id", "part", "text").join(F.broadcast(follows), "part").join(firsts, "next")

    def finish(batches):
        make = Signatures(slots)
        for b in batches:
            if b.num_rows:
                out = [Held(make, t).compared(Held(make, f)) for t, f in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array(c, t) for c, t in zip(zip(*out), schema.types[5:])]],
                    names=["doc_id", *COLUMNS])

    ends = digest(ends.select("doc_id", "text", "following").mapInArrow(finish, f"doc_id {kind}, {RESULT}"))
    done = made.filter("not last").select("doc_id", *COLUMNS).unionByName(ends)
    edited = F.col("edited") if keep_texts else F.lower(F.hex("edited")).alias("edited_sha256")
    return done.select("doc_id", "n_chars", edited, spelled("fingerprint"), spelled("edited_fingerprint"),
                       "near_edited", "near_next")


def _arrow(spark, fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], fields).schema)
