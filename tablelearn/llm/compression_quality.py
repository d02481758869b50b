"""Quality scores from compression with two zstandard dictionaries.

One dictionary is built from text labelled good, one from text labelled bad.
Every whole text is cut into blocks of 2 KB (so that a long text does not
become its own dictionary) and each block is compressed with both; the
normalised size difference (bad - good) / (bad + good), together with the
compressed share of the text, goes through a logistic calibration to a score
in (0, 1).

What is learned comes from a bounded sample of labelled rows (parameters
``SAMPLE``, ids per class, and ``BLOCKS``, 2 KB blocks per class drawn by hash
over the whole texts of the sample); a fifth of the sampled ids is kept for
the calibration, which weighs its rows back to the share of each class among
the sample.  Everything else runs over all rows in one narrow pass.

Defined cases: null and empty texts get the score of the base rate; with no
labels every score is 0.5, with one class the smoothed base rate; repeated
rows get equal scores; the label, language, source and id are never inputs of
the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import fold
from tablelearn.llm.labelled import Calibration, class_sizes, labelled_sample
from tablelearn.plans.shaping import cut_lineage

BLOCK = 2048
SAMPLE = 4000       # labelled ids of each class
BLOCKS = 1500       # 2 KB blocks of each class in the dictionaries
DICTIONARY = 112_640
LEVEL = 3


def _blocks(text: bytes) -> list[bytes]:
    return [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]


def make_dictionary(blocks: list[bytes]) -> bytes:
    """Dictionary bytes from sample blocks; few blocks are used as they are."""
    size = min(DICTIONARY, sum(map(len, blocks)) // 10)
    if size >= 4096 and len(blocks) >= 100:
        try:
            return zstd.train_dictionary(size, blocks).as_bytes()
        except zstd.ZstdError:   # too uniform to learn from
            pass
    return b"".join(blocks)[:DICTIONARY]


def _compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    kw = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
    if len(dictionary) < 8:
        return zstd.ZstdCompressor(level=LEVEL, **kw)
    data = zstd.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstd.ZstdCompressor(dict_data=data, **kw)


def size_features(texts, bad: zstd.ZstdCompressor, good: zstd.ZstdCompressor) -> np.ndarray:
    out = np.zeros((len(texts), 4))
    for i, text in enumerate(texts):
        if not text:
            continue
        blocks = _blocks(text)
        b = sum(len(bad.compress(x)) for x in blocks)
        g = sum(len(good.compress(x)) for x in blocks)
        d, r = (b - g) / (b + g), min(g / len(text), 1.5)
        out[i] = d, r, r * r, d * r
    return out


class CompressionClassifier:
    def __init__(self, good: bytes, bad: bytes, calibration: Calibration | None = None, base: float = 0.5):
        self.good, self.bad, self.calibration, self.base = good, bad, calibration, base

    def features(self, texts) -> np.ndarray:
        return size_features(texts, _compressor(self.bad), _compressor(self.good))

    def scores(self, texts) -> np.ndarray:
        if self.calibration is None:
            return np.full(len(texts), self.base)
        s = self.calibration(self.features(texts))
        s[[not t for t in texts]] = self.base
        return s


def _texts(column) -> list:
    return column.cast(pa.binary()).to_pylist()


def fit_classifier(docs: DataFrame, labels: DataFrame, label: str, learn, id_col="doc_id", text_col="text",
                   sample: int = SAMPLE, blocks: int = BLOCKS) -> CompressionClassifier:
    """Learn both dictionaries and the calibration from a bounded sample."""
    chosen = cut_lineage(labelled_sample(docs, labels, label, learn, sample, "quality", id_col), "quality-sample")
    # at most 2 * sample ids: a bounded side
    texts = docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t")).join(
        F.broadcast(chosen), F.col("_i") == F.col("_id"))
    texts = cut_lineage(texts.select("_y", "_u", "_t"), "quality-texts")

    def cut(batches):
        for b in batches:
            rows = [(y, x) for y, t in zip(b.column(0).to_pylist(), _texts(b.column(1))) for x in _blocks(t or b"")]
            yield pa.RecordBatch.from_pydict({"y": pa.array([r[0] for r in rows], pa.int32()),
                                              "x": pa.array([r[1] for r in rows], pa.binary())})

    pieces = texts.filter("_u >= 0.2").select("_y", "_t").mapInArrow(cut, "y int, x binary")
    ordered = pieces.select("y", "x", F.xxhash64("x").alias("h"))
    drawn = {y: [bytes(r["x"]) for r in ordered.filter(F.col("y") == y).orderBy("h", "x").limit(blocks).collect()]
             for y in (0, 1)}
    model = CompressionClassifier(make_dictionary(drawn[1]), make_dictionary(drawn[0]))

    def measure(batches):
        for b in batches:
            x = model.features(_texts(b.column(1)))
            yield pa.RecordBatch.from_pydict({"y": b.column(0), **{f"x{k}": x[:, k] for k in range(4)}})

    held = texts.filter("_u < 0.2").select("_y", "_t").mapInArrow(
        measure, "y int, x0 double, x1 double, x2 double, x3 double").toPandas()
    n = class_sizes(labels, label, learn)
    y = held["y"].to_numpy(dtype=float)
    model.base = (n.get(1, 0) + 1.0) / (n.get(0, 0) + n.get(1, 0) + 2.0)
    if len(y) and drawn[0] and drawn[1]:
        fitted = Calibration(held[[f"x{k}" for k in range(4)]].to_numpy(), y, model.base)
        model.calibration = fitted.for_odds(n, y)
    return model


def score_quality(docs: DataFrame, model: CompressionClassifier, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, score`` for every row, in one narrow pass."""
    def run(batches):
        bad, good = _compressor(model.bad), _compressor(model.good)
        for b in batches:
            texts = _texts(b.column(1))
            if model.calibration is None:
                s = np.full(len(texts), model.base)
            else:
                s = model.calibration(size_features(texts, bad, good))
                s[[not t for t in texts]] = model.base
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "score": s})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double")


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted``, learned on rows whose
    crc32(doc_id) mod 5 is not 0 (a null id is neither held out nor learned)."""
    model = fit_classifier(docs, labels, "quality", fold(F.col("_id"), 5) != 0)
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
