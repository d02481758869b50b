"""Toxicity scores from two class-conditional Kneser-Ney bigram models.

A model of toxic and a model of ordinary text are counted from labelled
documents; a text is scored by the difference of their length-normalised
log-likelihoods, over the whole text, over its most toxic stretch of ``STRETCH``
words, and at its two most toxic words (an insult in a long text would vanish in
the mean alone, and a single rare word may be loud by chance).  A logistic calibration gives the score in (0, 1).

Smoothing, from the top down, with absolute discounting at each step (what a
discount of ``DISCOUNT`` takes from a context goes to its backoff distribution):

* bigram counts of the class;
* continuation counts of the class (in how many contexts a word was seen);
* stems (first four letters) of the class, so that rare forms of an
  expression share their counts;
* backoff counts that both classes share: words and stems of ALL documents,
  labelled or not, counted in the same pass.

Words stand for themselves (as 64-bit hashes; two different ones would have to
collide) in a written table that grows with the corpus: one row for each word
with its stem and its counts in all documents and in both classes, and one for
each bigram of a class.  Only words and stems of the labelled sample are
broadcast: in a word outside it, the share of the word in its stem (and for a
stem outside it, the share of the stem) is a factor of both classes'
probabilities and leaves their ratio as it is.  All class bigrams make the
context and continuation counts, and every one of them keeps its own count: the
most frequent are read, as far as ``HELD`` go, and the rest (none in small
samples) is a table that is joined to the bigrams of each text.  What is
broadcast are those with a count above the discount; for the others the
discounted count is 0, as for a bigram never seen.  Class counts
come from a bounded sample of labelled rows (``SAMPLE`` ids of each class, all
of them when there are fewer); a tenth of the sampled ids (up to two fifths,
when there are few) is left out of the counts and calibrates.

Defined cases: null and empty texts get the base rate; without labels of both
classes every score is the smoothed base rate (0.5 without labels); repeated
rows get equal scores; label, language, source and id are never inputs of the
score.  Words: lower-cased A-Z, white space by the ASCII rule, punctuation at
the ends stripped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import fold
from tablelearn.llm.labelled import Calibration, class_sizes, labelled_sample
from tablelearn.plans.shaping import cut_lineage

START = xxhash.xxh3_64_intdigest(b"the start of a text")     # the context of a text's first word
SAMPLE = 16_000              # labelled ids of each class
DISCOUNT = 3                # taken from every count of a class
FIND = 1 << 17              # keys looked up at once
SLICE = 1 << 21             # bigrams that the driver reads at once, about
HELD = 1 << 24              # bigrams in the broadcast; more are joined
STRETCH = 4
FEATURES = 5
CHUNK = 4 << 20             # bytes of text worked on at once
KNOWN_TOKENS = 250_000      # tokens a worker remembers the words of
STRIP = b".,;:!?\"'()[]{}<>|*#%$&-_"


class Words(dict):
    """Token -> running number of its word, with the hashes of words and stems
    by number; number 0 is the start of a text."""

    def __init__(self):
        super().__init__()
        self._start()

    def _start(self):
        self.clear()
        self.numbers, self.hashes, self.stems = {}, [START], [0]

    def __missing__(self, token: bytes) -> int:
        word = token.strip(STRIP) or token
        n = self.numbers.get(word)
        if n is None:
            stem = word.decode("utf-8", "replace")[:4].encode()
            n = self.numbers[word] = len(self.hashes)
            self.hashes.append(xxhash.xxh3_64_intdigest(word))
            self.stems.append(xxhash.xxh3_64_intdigest(b"stem:" + stem))
        self[token] = n
        return n

    def read(self, texts: list):
        """Number of each word, and the first place of each text."""
        tokens, starts = [], []
        for t in texts:
            starts.append(len(tokens))
            tokens += t.lower().split()
        ids = np.fromiter(map(self.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return ids, np.asarray(starts, dtype=np.int64)

    def known(self):
        """Hashes of the words and of their stems, by number."""
        return tuple(np.asarray(x, dtype=np.uint64).view(np.int64) for x in (self.hashes, self.stems))

    def full(self) -> bool:
        return len(self) > KNOWN_TOKENS


def _chunks(texts: list):
    """``(first, texts)`` runs of at most CHUNK bytes (or one long text)."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > CHUNK:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


def _contexts(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    h = np.empty_like(ids)
    h[1:] = ids[:-1]
    h[starts[starts < len(ids)]] = 0
    return h


def _pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Key of a bigram: the context's hash turned by 21 bits, xor the word's."""
    h = h.view(np.uint64)
    return ((h << np.uint64(21)) | (h >> np.uint64(43))).view(np.int64) ^ w


def _pair_column() -> Column:
    """The same over the columns ``h`` and ``w`` of a table."""
    return F.shiftleft("h", 21).bitwiseOR(F.shiftrightunsigned("h", 43)).bitwiseXOR(F.col("w"))


def _read(column) -> list:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


COUNTS = "pair boolean, h long, w long, n long, n0 long, n1 long"


def _count_rows(batches):
    """Counts of the words (``h`` is the stem) in all rows and in rows of each
    class, and of the bigrams (``h`` is the context) in rows of each class."""
    words = Words()
    counts = np.zeros((3, 0), dtype=np.int64)       # of the words, by number

    def rows(pair, h, w, *n):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(w), pair)), *(pa.array(x, pa.int64()) for x in (h, w, *n))],
            names=["pair", "h", "w", "n", "n0", "n1"])

    def word_rows():
        hashes, stems = words.known()
        at = np.flatnonzero(counts[0])
        return rows(False, stems[at], hashes[at], *counts[:, at])

    for b in batches:
        texts, classes = _read(b.column(0)), b.column(1).to_pylist()
        for first, part in _chunks(texts):
            ids, starts = words.read(part)
            y = np.asarray([-1 if c is None else c for c in classes[first:first + len(part)]])
            of = np.repeat(y, np.diff(np.append(starts, len(ids))))
            h, size, hashes = _contexts(ids, starts), len(words.hashes), words.known()[0]
            counts = np.pad(counts, ((0, 0), (0, size - counts.shape[1])))
            counts[0] += np.bincount(ids, minlength=size)
            for c in (0, 1):
                at = of == c
                if at.any():
                    counts[1 + c] += np.bincount(ids[at], minlength=size)
                    pairs, n = np.unique((h[at] << 32) | ids[at], return_counts=True)
                    n = (n, np.zeros_like(n))
                    yield rows(True, hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF], n[1], n[c], n[1 - c])
            if words.full():
                yield word_rows()
                words._start()
                counts = np.zeros((3, 0), dtype=np.int64)
    if counts.size:
        yield word_rows()


class Rows:
    """Columns of numbers by sorted keys; a key that is not there has zeros."""

    def __init__(self, keys: np.ndarray, columns: list):
        order = np.argsort(keys)
        self.keys, self.columns = keys[order], []
        for c in columns:
            c = c[order]
            if c.dtype.kind == "i":         # counts: as narrow as they are
                c = c.astype(np.min_scalar_type(int(c.max(initial=0))))
            self.columns.append(np.append(c, c.dtype.type(0)))

    @classmethod
    def joined(cls, parts: list) -> Rows:
        """Of parts whose keys follow each other; the parts are emptied."""
        rows = cls.__new__(cls)
        rows.keys = np.concatenate([p.keys for p in parts])
        for p in parts:
            p.keys = None
        rows.columns = [np.concatenate([*(c[:-1] for c in cs), cs[-1][-1:]]) for cs in zip(*(p.columns for p in parts))]
        return rows

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in ``columns`` (the last place: not there)."""
        at = np.full(len(keys), len(self.keys))
        for first in range(0, len(keys) if len(self.keys) else 0, FIND):
            part = keys[first:first + FIND]
            order = np.argsort(part)        # neighbours are near each other in a large table
            part = part[order]
            found = np.searchsorted(self.keys, part)
            found[self.keys[np.minimum(found, len(self.keys) - 1)] != part] = len(self.keys)
            at[first + order] = found
        return at


class KneserNey:
    """Both classes' tables; ``log_ratio`` compares them token by token."""

    def __init__(self, words: dict, stems: dict, totals: dict, pairs: Rows):
        """``words``: ``key``, ``n`` in all documents and, of class c, tokens
        ``tc`` and what the discount takes ``kc`` of the context and
        continuation count ``cc``; ``stems``: ``key``, ``n`` and count ``sc`` in
        class c; ``totals``: different bigrams ``seen`` of each class, stems
        ``n`` and different ones ``k`` of all documents; ``pairs``: counts of
        bigrams."""
        f = np.float32
        self.pairs = pairs
        # a shared word given its stem, and a shared stem
        by_word, by_stem = [words["n"] + 0.1], [stems["n"] + 1.0]
        stem_share = (stems["n"] + 0.1) / (totals["n"] + 0.1 * totals["k"])
        absent, self.rest = [1.0], []       # a factor of both classes has no part in the ratio
        for c in (0, 1):
            tokens, taken, continuation, stem = words[f"t{c}"], words[f"k{c}"], words[f"c{c}"], stems[f"s{c}"]
            seen, n, total = max(totals["seen"][c], 1), max(stem.sum(), 1), np.maximum(tokens, 1)
            left = max(np.minimum(stem, DISCOUNT).sum() / n, 1.0 / n)
            self.rest.append(min(1.0, max(np.minimum(continuation, DISCOUNT).sum() / seen, 1e-6)))
            by_word += [np.where(tokens > 0, 1 / total, 0), np.where(tokens > 0, taken / total, 1),
                        np.maximum(continuation - DISCOUNT, 0) / seen]
            by_stem.append(np.maximum(stem - DISCOUNT, 0) / n + left * stem_share)
            absent.append(left)
        self.words = Rows(words["key"], [x.astype(f) for x in by_word])
        self.stems = Rows(stems["key"], [x.astype(f) for x in by_stem])
        for rows, values in ((self.words, [1, 0, 1, 0, 0, 1, 0]), (self.stems, absent)):
            for column, value in zip(rows.columns, values):
                column[-1] = value

    @classmethod
    def of(cls, fields: dict) -> KneserNey:
        """From the fields of another one (only arrays and numbers are broadcast)."""
        tables = cls.__new__(cls)
        tables.__dict__.update(fields)
        for name in ("words", "stems", "pairs"):
            rows = Rows.__new__(Rows)
            rows.__dict__.update(fields[name])
            setattr(tables, name, rows)
        return tables

    def counted(self) -> KneserNey:
        """The same tables, with the bigrams that the discount leaves."""
        counts = [c[:-1] for c in self.pairs.columns]
        left = np.logical_or(*[c > DISCOUNT for c in counts])
        return KneserNey.of(self.fields() | {"pairs": Rows(self.pairs.keys[left], [c[left] for c in counts]).__dict__})

    def fields(self) -> dict:
        return self.__dict__ | {name: getattr(self, name).__dict__ for name in ("words", "stems", "pairs")}

    def not_held(self, words: Words, ids, starts):
        """Places of the tokens whose bigram may be in the rest of the
        bigrams, and the bigrams' keys."""
        hashes, h = words.known()[0], _contexts(ids, starts)
        known = self.words.find(hashes) < len(self.words.keys)
        at = np.flatnonzero(known[h] & known[ids])
        keys = _pair(hashes[h[at]], hashes[ids[at]])
        new = self.pairs.find(keys) == len(self.pairs.keys)
        return at[new], keys[new]

    def log_ratio(self, words: Words, ids, starts, rest: Rows | None = None) -> np.ndarray:
        """log P(toxic model) - log P(ordinary model) of each token; ``rest``:
        counts of the texts' bigrams that are not held."""
        hashes, stems = words.known()
        word, stem = self.words.find(hashes), self.stems.find(stems)
        in_word, in_stem = self.words.columns, self.stems.columns
        given_stem = np.where(word < len(self.words.keys), in_word[0][word] / in_stem[0][stem], np.float32(1))
        h = _contexts(ids, starts)
        keys = _pair(hashes[h], hashes[ids])
        at, logs = self.pairs.find(keys), []
        in_rest = rest.find(keys) if rest else None
        for c in (0, 1):
            inverse, backoff, first = (x[word] for x in in_word[1 + 3 * c:4 + 3 * c])
            one = first + self.rest[c] * in_stem[1 + c][stem] * given_stem
            n = self.pairs.columns[c][at].astype(np.float32)
            if rest:
                n += rest.columns[c][in_rest]
            p = np.maximum(n - DISCOUNT, 0) * inverse[h] + backoff[h] * one[ids]
            logs.append(np.log(np.maximum(p, 1e-30)))
        return logs[1] - logs[0]


def _features(model: KneserNey, words: Words, texts: list, rest: Rows | None = None) -> np.ndarray:
    """Per text: mean log ratio, the largest mean over STRETCH words, the
    largest of a word, the log of the length, and the second largest of a word."""
    out = np.zeros((len(texts), FEATURES))
    for first, part in _chunks(texts):
        ids, starts = words.read(part)
        if not len(ids):
            continue
        ratio = model.log_ratio(words, ids, starts, rest).astype(float)
        if words.full():
            words._start()
        ends = np.append(starts[1:], len(ids))
        n = ends - starts
        run = np.append(0.0, np.cumsum(ratio))
        mean = (run[ends] - run[starts]) / np.maximum(n, 1)
        best = mean.copy()
        if len(ids) >= STRETCH:
            at = np.arange(len(ids) - STRETCH + 1)
            window = (run[STRETCH:] - run[:-STRETCH]) / STRETCH
            doc = np.repeat(np.arange(len(part)), n)[at]
            window[at + STRETCH > ends[doc]] = -np.inf
            long = np.flatnonzero(n >= STRETCH)
            if len(long):
                best[long] = np.maximum.reduceat(window, starts[long])
        some = np.flatnonzero(n)
        top = np.zeros(len(part))
        top[some] = np.maximum.reduceat(ratio, starts[some])
        # once more without the most toxic word; a text of one word has only that
        at = np.where(ratio == np.repeat(top, n), np.arange(len(ratio)), -1)
        ratio[np.maximum.reduceat(at, starts[some])] = -np.inf
        second = np.zeros(len(part))
        second[some] = np.maximum.reduceat(ratio, starts[some])
        second[n == 1] = top[n == 1]
        out[first:first + len(part)] = np.c_[mean, best, top, np.log1p(n), second]
    return out


class ToxicityModel:
    def __init__(self, tables: KneserNey | None, calibration: Calibration | None, base: float, held=None, rest=None):
        """``held``: the broadcast fields of ``tables``, one for all uses;
        ``rest``: a table of the bigrams that are not in it, if any."""
        self.tables, self.calibration, self.base, self.held, self.rest = tables, calibration, base, held, rest

    def scores(self, texts: list, words: Words, rest: Rows | None = None) -> np.ndarray:
        if self.calibration is None or self.calibration.w is None:
            return np.full(len(texts), self.base)
        x = _features(self.tables, words, texts, rest)
        s = self.calibration(x)
        s[x[:, 3] == 0] = self.base
        return s


def _arrays(df: DataFrame) -> dict:
    t = df.toArrow()
    return {c: t[c].to_numpy() for c in t.column_names}


def _word_table(pairs: DataFrame, words: DataFrame) -> dict:
    """What KneserNey needs of each word of the labelled sample."""
    seen = [(F.col(n) > 0).cast("long") for n in ("n0", "n1")]
    taken = [F.least(F.col(n), F.lit(DISCOUNT)) for n in ("n0", "n1")]
    no = F.lit(0).cast("long")
    names = ["key", "n", "t0", "t1", "k0", "k1", "c0", "c1"]
    rows = pairs.select("h", no, "n0", "n1", *taken, no, no).toDF(*names)
    rows = rows.unionAll(pairs.select("w", no, no, no, no, no, *seen).toDF(*names))
    rows = rows.unionAll(words.filter("n0 + n1 > 0").select("w", "n", no, no, no, no, no, no).toDF(*names))
    # counts in the bounded sample are small
    return _arrays(rows.groupBy("key").agg(F.sum("n").alias("n"), *(F.sum(c).cast("int").alias(c) for c in names[2:])))


def _stem_table(pairs: DataFrame, words: DataFrame) -> tuple[dict, dict]:
    """What KneserNey needs of each stem of the labelled sample, and its totals."""
    stems = words.groupBy(F.col("h").alias("key")).agg(
        F.sum("n").alias("n"), F.sum("n0").alias("s0"), F.sum("n1").alias("s1"))
    t = stems.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("k")).first().asDict()
    r = pairs.agg(*(F.count_if(F.col(f"n{c}") > 0).alias(f"seen{c}") for c in (0, 1))).first()
    t["seen"] = [r["seen0"], r["seen1"]]
    return _arrays(stems.filter("s0 + s1 > 0")), t


def _bigrams(pairs: DataFrame) -> tuple[Rows, DataFrame | None]:
    """The bigrams with the least power of two as count so that at most HELD
    have it, and the table of all others (None: there are none)."""
    top = F.greatest("n0", "n1")
    levels = {r["e"]: r["count"] for r in pairs.groupBy(F.floor(F.log2(top)).alias("e")).count().collect()}
    least = 0
    while sum(k for e, k in levels.items() if e >= least) > HELD:
        least += 1
    keyed = pairs.select(_pair_column().alias("key"), F.col("n0").cast("int"), F.col("n1").cast("int"))
    # read in slices of the keys' order, so that the driver holds one slice besides the narrow columns
    bits = max(0, (sum(k for e, k in levels.items() if e >= least) // SLICE).bit_length())
    slices = []
    for k in range(-(1 << bits >> 1), 1 << bits >> 1) if bits else [None]:
        t = keyed.filter(top >= 1 << least)
        t = _arrays(t if k is None else t.filter(F.shiftright("key", 64 - bits) == k))
        slices.append(Rows(t["key"], [t["n0"], t["n1"]]))
        del t
        pa.default_memory_pool().release_unused()
    return Rows.joined(slices), keyed.filter(top < 1 << least) if least else None


def _with_rest(texts: DataFrame, text_col: str, held, rest: DataFrame | None) -> DataFrame:
    """``texts`` with a column ``_rest`` of the counts of its bigrams that are
    not held, if there are any: the different bigrams of each text are joined
    to their table, and the texts to what was found by their md5."""
    if rest is None:
        return texts

    def wanted(batches):
        words, model = Words(), KneserNey.of(held.value)
        for b in batches:
            of = b.column(0).to_numpy(zero_copy_only=False)
            for first, part in _chunks(_read(b.column(1))):
                ids, starts = words.read(part)
                at, keys = model.not_held(words, ids, starts)
                doc = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(ids))))[at]
                if words.full():
                    words._start()
                yield pa.RecordBatch.from_pydict({"_of": pa.array(of[first + doc], pa.string()), "key": keys})

    md5 = F.md5(F.col(text_col).cast("binary"))
    pairs = texts.select(md5.alias("_of"), text_col).mapInArrow(wanted, "_of string, key long").distinct()
    found = pairs.join(rest, "key").groupBy("_of").agg(F.collect_list(F.struct("key", "n0", "n1")).alias("_rest"))
    return texts.join(found, md5 == F.col("_of"), "left").select(*texts.columns, "_rest")


def _rest_of(batch, place: int) -> Rows | None:
    """The counts in the column ``_rest`` at ``place``, if it is there."""
    if batch.num_columns <= place:
        return None
    found = batch.column(place).flatten()
    keys, at = np.unique(found.field("key").to_numpy(), return_index=True)
    return Rows(keys, [found.field(n).to_numpy()[at] for n in ("n0", "n1")])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str, learn, id_col="doc_id", text_col="text",
                 sample: int = SAMPLE) -> ToxicityModel:
    sizes = class_sizes(labels, label, learn)
    base = (sizes[1] + 1.0) / (sizes[0] + sizes[1] + 2.0)
    if not (sizes[0] and sizes[1]):
        return ToxicityModel(None, None, base)
    chosen = cut_lineage(labelled_sample(docs, labels, label, learn, sample, "toxic", id_col), "toxic-sample")
    share = min(max(300.0 / min(sizes.values()), 0.1), 0.4)
    # at most 2 * sample ids: a bounded side
    known = F.broadcast(chosen)
    texts = docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
    marked = texts.join(known, F.col("_i") == F.col("_id"), "left").select(
        "_t", F.when(F.col("_u") >= share, F.col("_y")).alias("_c"))
    counts = marked.mapInArrow(_count_rows, COUNTS).groupBy("pair", "h", "w").agg(
        *(F.sum(n).alias(n) for n in ("n", "n0", "n1")))
    counts = cut_lineage(counts, "toxic-counts")
    pairs, words = counts.filter("pair"), counts.filter("not pair")
    tables = KneserNey(_word_table(pairs, words), *_stem_table(pairs, words), None)
    tables.pairs, rest = _bigrams(pairs)
    held = docs.sparkSession.sparkContext.broadcast(tables.counted().fields())

    def measure(batches):
        words, model = Words(), KneserNey.of(held.value)
        for b in batches:
            x = _features(model, words, _read(b.column(0)), _rest_of(b, 2))
            yield pa.RecordBatch.from_pydict({"y": b.column(1), **{f"x{k}": x[:, k] for k in range(FEATURES)}})

    rows = texts.join(known.filter(F.col("_u") < share), F.col("_i") == F.col("_id")).select("_t", "_y")
    rows = _with_rest(rows, "_t", held, rest).mapInArrow(
        measure, "y int, " + ", ".join(f"x{k} double" for k in range(FEATURES))).toArrow()
    y = rows["y"].to_numpy().astype(float)
    x = np.column_stack([rows[f"x{k}"].to_numpy() for k in range(FEATURES)])
    calibration = Calibration(x, y, base).for_odds(sizes, y)
    return ToxicityModel(tables, calibration, base, held, rest)


def _with_scores(docs: DataFrame, model: ToxicityModel, text_col: str, schema, build) -> DataFrame:
    known = model.calibration is not None and model.calibration.w is not None
    place, width, held = docs.columns.index(text_col), len(docs.columns), model.held
    calibration, base = model.calibration, model.base

    def run(batches):
        words = Words()
        own = ToxicityModel(KneserNey.of(held.value) if known else None, calibration, base)
        for b in batches:
            scores = own.scores(_read(b.column(place)), words, _rest_of(b, width))
            yield build(b.select(list(range(width))), scores)

    return _with_rest(docs, text_col, held, model.rest if known else None).mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, score`` for every row, in one narrow pass."""
    kind = docs.schema[id_col].dataType.simpleString()
    return _with_scores(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, "text",
                        f"doc_id {kind}, score double",
                        lambda b, s: pa.RecordBatch.from_pydict({"doc_id": b.column(0), "score": s}))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col="doc_id",
               text_col="text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; all labels are
    learned from."""
    model = fit_toxicity(docs, labels, "toxic", F.lit(True), id_col, text_col)
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])     # columns may share a name
    kept = _with_scores(plain, model, f"c{names.index(text_col)}", plain.schema,
                        lambda b, s: b.filter(pa.array(s < threshold)))
    return kept.toDF(*names)


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted``, learned on rows whose
    crc32(doc_id) mod 3 is not 1 (a null id is neither held out nor learned)."""
    model = fit_toxicity(docs, labels, "toxic", fold(F.col("_id"), 3) != 1)
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
