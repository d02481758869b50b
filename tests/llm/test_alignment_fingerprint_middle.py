"""Token alignment, phrase fingerprints and fill-in-middle against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers
from tablelearn.llm import fill_in_middle, lz_fingerprint, queries, token_alignment
from tablelearn.llm.tokens import ByteBpe

SMALL = "/root/testdata/sf0.001"
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def same_rows(got, want):
    key = lambda r: repr(sorted(r.items(), key=str))
    assert sorted(map(key, got)) == sorted(map(key, want))


def dicts(df):
    return [r.asDict() for r in df.collect()]


# ---------------------------------------------------------------- 11 alignment


@pytest.fixture(scope="module")
def tokenizers_():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # the byte alphabet of byte-level BPE: printable bytes stand for themselves, the others follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(sorted(set(range(256)) - set(plain)))}
    bytes_a = {i: bytes(letter[c] for c in t) for t, i in a.get_vocab().items() if set(t) <= set(letter)}
    piece = lambda i: b.id_to_piece(i)
    bytes_b = {i: bytes([int(piece(i)[3:5], 16)]) if b.is_byte(i) else piece(i).replace("▁", " ").encode()
               for i in range(b.get_piece_size())}
    return a, b, bytes_a, bytes_b


def plain_groups(text, tools):
    """Groups of a text as pairs of id lists, by walking both token lists."""
    a, b, bytes_a, bytes_b = tools
    if not text:
        return []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    if b"".join(bytes_a[i] for i in ids_a) != whole or b"".join(bytes_b[i] for i in ids_b) != whole:
        return []
    groups, end_a, end_b, j, now = [], 0, 0, 0, ([], [])
    for i in ids_a:
        now[0].append(i)
        end_a += len(bytes_a[i])
        while end_b < end_a:
            now[1].append(ids_b[j])
            end_b += len(bytes_b[ids_b[j]])
            j += 1
        if end_a == end_b:
            groups.append(now)
            now = ([], [])
    assert not now[0] and j == len(ids_b)
    return groups


def plain_report(rows, tools):
    groups = [plain_groups(t, tools) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for link in links for p in link)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _), g, link in zip(rows, groups, links):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append({"doc_id": i, "n_a": sum(len(a) for a, _ in g), "n_b": sum(len(b) for _, b in g),
                    "n_groups": len(g), "n_links": sum(link.values()),
                    "n_best": sum(n for p, n in link.items() if count[p] == best[p[0]]),
                    "count_sum": sum(n * count[p] for p, n in link.items()),
                    "groups_sha256": sha(spelled) if spelled else ""})
    return out


def test_alignment_against_brute_force(spark, tokenizers_):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same_rows(dicts(queries.op11_token_alignment(spark, SMALL)), plain_report(rows, tokenizers_))


@pytest.mark.parametrize("chunk, listed", [(token_alignment.CHUNK, token_alignment.LISTED), (200, 2)])
def test_alignment_of_odd_rows(spark, odd, tokenizers_, chunk, listed, monkeypatch):
    monkeypatch.setattr(token_alignment, "LISTED", listed)
    extra = ["<|endoftext|> and <s> </s> <unk>", "U+2581 ▁ here", "ﬁ ① é 中文 \U0001f600", "a  b\n\n c \t", "</s>",
             "a\x00b", "中" * 70, "́́x"]
    more = spark.createDataFrame([(100 + k, t) for k, t in enumerate(extra * 2)], "doc_id long, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same_rows(dicts(token_alignment.alignment_report(docs, chunk=chunk)), plain_report(rows, tokenizers_))


def test_pair_counts_and_groups(spark, tokenizers_):
    rows = [(1, "the cat sat"), (2, "the cat sat"), (3, "the dog"), (4, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["a"], r["b"]): (r["count"], r["best"]) for r in token_alignment.pair_counts(docs).collect()}
    groups = {i: plain_groups(t, tokenizers_) for i, t in rows}
    count = Counter(p for g in groups.values() for p in {(x, y) for a, b in g for x in a for y in b})
    top = {a: max(n for (x, _), n in count.items() if x == a) for a, _ in count}
    assert got == {p: (n, n == top[p[0]]) for p, n in count.items()}
    spelled = {r["doc_id"]: r["groups"] for r in token_alignment.token_groups(docs).collect()}
    assert spelled == {i: ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
                       for i, g in groups.items()}
    assert token_alignment.alignment_report(docs.limit(0)).count() == 0


def test_very_long_runs_have_tokens(tokenizers_):
    bpe = ByteBpe(*token_alignment.public_files()[:3])
    for text in (" " * 2_000_000, "\n" * 2_000_000, "a" * 200_000 + "\n" * 2_000_000 + "b"):
        ids = bpe.ids(text)
        assert b"".join(map(bpe.bytes.__getitem__, ids.tolist())) == text.encode()
        assert ids.tolist() == tokenizers_[0].encode(text, add_special_tokens=False).ids


# -------------------------------------------------------------- 12 fingerprints


def plain_phrases(text):
    seen, at = set(), 0
    for end in range(1, len(text) + 1):
        if text[at:end] not in seen:
            seen.add(text[at:end])
            at = end
    return seen


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text("ab", max_size=300), st.text(max_size=80)), st.integers(0, 300), st.text("ab", max_size=100))
def test_phrases_and_shared_parse(text, cut, other):
    seen = set()
    bounds = lz_fingerprint.parse(text, 0, seen)
    assert seen == plain_phrases(text) == {text[s:e] for s, e in zip(bounds, bounds[1:])} and len(seen) == len(bounds) - 1
    make = lz_fingerprint.Signatures()
    cut = min(cut, len(text))
    parsed = lz_fingerprint.Parsed(make, text, cut)
    for tail in (text[cut:], other, text[cut:]):
        assert (parsed.ending(tail) == make.of(text[:cut] + tail)).all()


def test_long_repeats_are_linear_and_blocks_do_not_matter(monkeypatch):
    make, text = lz_fingerprint.Signatures(), "ab" * 1_000_000
    whole = make.of(text)
    monkeypatch.setattr(lz_fingerprint, "BLOCK", 1000)
    assert (lz_fingerprint.Signatures().of(text) == whole).all()


def test_likeness_estimates_jaccard():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    make, errors = lz_fingerprint.Signatures(), []
    for k in range(60):
        a = " ".join(rng.choice(words) for _ in range(60 + 20 * k))
        b = a[:len(a) * (k % 7) // 6] + " ".join(rng.choice(words) for _ in range(80))
        x, y = plain_phrases(a), plain_phrases(b)
        errors.append(lz_fingerprint.likeness(make.of(a), make.of(b)) - len(x & y) / len(x | y))
    assert np.abs(errors).max() < 0.2 and np.abs(np.mean(errors)) < 0.03


def plain_compare(rows):
    """``rows`` in their order, each with its successor."""
    make, out = lz_fingerprint.Signatures(), []
    for (i, t), (_, f) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 3
        edited = t[:len(t) - k] + f[:k]
        own, other, following = make.of(t), make.of(edited), make.of(f)
        out.append({"doc_id": i, "n_chars": len(t), "edited_sha256": sha(edited),
                    "fingerprint": lz_fingerprint.packed(own).hex(),
                    "edited_fingerprint": lz_fingerprint.packed(other).hex(),
                    "near_edited": lz_fingerprint.likeness(own, other),
                    "near_next": lz_fingerprint.likeness(own, following)})
    return out


def test_neighbours_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    same_rows(dicts(queries.op12_lz_fingerprint(spark, SMALL)), plain_compare(rows))
    shuffled = docs.repartition(7).withColumn("part", docs.doc_id).withColumn("first", docs.text)
    same_rows(dicts(lz_fingerprint.compare_with_next(shuffled)), plain_compare(rows))


def test_neighbours_of_odd_rows(spark, odd):
    hashed = odd.selectExpr("doc_id", "coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as h").collect()
    rows = sorted(hashed, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))
    same_rows(dicts(lz_fingerprint.compare_with_next(odd)), plain_compare([(r["doc_id"], r["text"]) for r in rows]))
    kept = lz_fingerprint.compare_with_next(odd, keep_texts=True)
    assert {sha(r["edited"]) for r in kept.collect()} == {
        r["edited_sha256"] for r in lz_fingerprint.compare_with_next(odd).collect()}
    one = odd.filter("doc_id = 5")
    assert [r["near_next"] for r in lz_fingerprint.compare_with_next(one).collect()] == [1.0]
    assert lz_fingerprint.compare_with_next(odd.limit(0)).count() == 0
    assert lz_fingerprint.fingerprints(odd.limit(0)).count() == 0


def test_equal_and_empty_texts(spark):
    rows = [(1, "same text, same print"), (2, "same text, same print"), (3, ""), (4, None), (5, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in lz_fingerprint.fingerprints(docs).collect()}
    assert got[1] == got[2] and got[3] == got[4] and len(set(got.values())) == 3
    like = lambda a, b: lz_fingerprint.likeness(lz_fingerprint.read(got[a]), lz_fingerprint.read(got[b]))
    assert like(1, 2) == like(3, 4) == 1.0 and like(1, 3) == 0.0
    report = {r["doc_id"]: r for r in lz_fingerprint.compare_with_next(docs).collect()}
    assert all(r["fingerprint"] == got[i] for i, r in report.items()) and report[4]["near_next"] == 1.0


def test_an_edit_is_nearer_than_another_document(spark):
    rows = queries.op12_lz_fingerprint(spark, SMALL).filter("n_chars > 200").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.95 * len(rows)


# ------------------------------------------------------------ 13 fill in middle


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_transform(i, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    x = sha(f"42:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(x[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "plain" if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50 else "spm" if h4 % 100 < 80 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return {"doc_id": i, "n": n, "form": form, "prefix_chars": None if form == "plain" else len(p),
            "middle_chars": None if form == "plain" else len(m), "output_sha256": sha(out), "restored_sha256": sha(text)}


def middle_report(docs):
    from pyspark.sql import functions as F
    return fill_in_middle.fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def test_fill_in_middle_against_brute_force(spark, odd):
    texts = ["a<P>b", "<S", "<M>", "<", "<<P", " lead and trail \n", "\x1c\x85 other blanks here", "x\n\ny", "P> <S <M"]
    more = spark.createDataFrame([(k, texts[k % len(texts)]) for k in range(1000, 1400)], "doc_id long, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    want = [plain_transform(r["doc_id"], r["text"]) for r in docs.collect()]
    same_rows(dicts(middle_report(docs)), want)
    assert {r["form"] for r in want} == {"plain", "psm", "spm"}
    assert middle_report(docs.limit(0)).count() == 0


def test_fill_in_middle_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    same_rows(dicts(queries.op13_fill_in_middle(spark, SMALL)),
              [plain_transform(r["doc_id"], r["text"]) for r in docs.collect()])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=1500), st.integers(0, 7), st.integers(0, 1500))
def test_wavelet_rank(codes, code, place):
    place = min(place, len(codes))
    matrix = fill_in_middle.WaveletMatrix(np.array(codes, np.uint8), 3)
    assert matrix.rank(code, place) == codes[:place].count(code)
