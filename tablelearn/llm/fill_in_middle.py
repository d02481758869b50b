"""Fill-in-middle transformation, cut at unit boundaries found by rank queries.

A text's code points are put into four classes by two bits: word character or white
space, and whether a unit ends there (a unit is a word with the white space before
it, or the white space that ends the text).  The classes are kept in a wavelet
matrix.  The number of units that end in the first p characters is the sum
of the ranks of the two ending classes; bisection on that count finds the
place of a cut.  All choices come from a hash of the id, so reruns and other
partitionings give the same rows.

Defined cases: a null text is empty; an empty text, and one that spells out a
mark, is plain; a null id is hashed as an empty string; repeated rows are
transformed each; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
BLOCK = 512
SPACE, WORD, SPACE_END, WORD_END = range(4)


class Bits:
    """A bit vector that counts the ones among its first i bits: counts up to
    each block are stored, the rest of a block is counted."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        blocks = np.add.reduceat(bits, np.arange(0, len(bits), BLOCK), dtype=np.int64) if len(bits) else []
        self.before = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64).tolist()

    def rank(self, i: int) -> int:
        block = i // BLOCK
        return self.before[block] + int(np.count_nonzero(self.bits[block * BLOCK:i]))


class WaveletMatrix:
    """A sequence of small numbers, one bit vector per bit from the highest;
    on each level those with a 0 bit go before those with a 1 bit."""

    def __init__(self, codes: np.ndarray, levels: int):
        self.levels, self.size = [], len(codes)
        for level in reversed(range(levels)):
            bit = (codes >> level & 1).astype(bool)
            ones = Bits(bit)
            self.levels.append((level, ones, len(codes) - ones.rank(len(codes))))
            codes = np.concatenate([codes[~bit], codes[bit]])

    def rank(self, code: int, i: int) -> int:
        """How often ``code`` occurs among the first ``i``."""
        lo, hi = 0, i
        for level, ones, zeros in self.levels:
            a, b = ones.rank(lo), ones.rank(hi)
            lo, hi = (zeros + a, zeros + b) if code >> level & 1 else (lo - a, hi - b)
        return hi - lo


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    word = (code != 0x20) & ((code < 9) | (code > 13))
    ends = np.zeros(len(code), bool)
    ends[:-1] = word[:-1] & ~word[1:]
    ends[-1:] = True
    return (word + 2 * ends).astype(np.uint8)


class Units:
    """Boundary counts of a text's units."""

    def __init__(self, text: str):
        self.matrix = WaveletMatrix(classes(text), 2)

    def count(self, place: int) -> int:
        """Units that end among the first ``place`` characters."""
        return self.matrix.rank(WORD_END, place) + self.matrix.rank(SPACE_END, place)

    def cut(self, units: int) -> int:
        """The least place at which ``units`` units have ended."""
        lo, hi = 0, self.matrix.size
        while lo < hi:
            mid = (lo + hi) // 2
            if self.count(mid) < units:
                lo = mid + 1
            else:
                hi = mid
        return lo


def transform(doc_id, text: str | None, seed: int, fim_percent: int, spm_percent: int):
    """``n, form, prefix_chars, middle_chars, output`` of one document."""
    text = text or ""
    units = Units(text)
    n = units.count(len(text))
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    if not text or any(m in text for m in MARKS) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    a, b = (units.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
                   fim_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row, in
    one narrow pass: ``output`` is the training text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [transform(i, t, seed, fim_percent, spm_percent)
                    for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The original text, from the training text and its form."""
    part = F.split(output, "|".join(MARKS), -1)
    at = lambda k: F.get(part, F.lit(k))
    return (F.when(form == "psm", F.concat(at(1), at(3), at(2)))
            .when(form == "spm", F.concat(at(2), at(3), at(1))).otherwise(output))
