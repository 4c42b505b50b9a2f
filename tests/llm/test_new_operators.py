"""Whitening, source divergence and SentencePiece against brute force, and the cases that docstrings define."""

import hashlib
import math
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import divergence, queries, sentencepiece_bpe, whitening

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- whitening

def brute_whitening(rows, k=4):
    """{position: (n, deviation, whitened, explained)} with whole numbers of any size and float64 eigenvectors."""
    x = {i: tuple(math.floor(256 * float(c)) for c in v) for i, v in enumerate(rows)
         if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted(set(x.values()))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[n * a - b for a, b in zip(v, s)] for v in fit], float) / n
    lam, vec = np.linalg.eigh(y.T @ y / n)
    lam, vec = lam[::-1][:k], vec[:, ::-1][:, :k]
    out = {}
    for i, v in x.items():
        d = [n * a - b for a, b in zip(v, s)]
        out[i] = (n, sum(a * a for a in d), (np.array(d, float) / n) @ vec / np.sqrt(lam), lam / np.trace(y.T @ y / n))
    return out


def check_whitening(got, rows):
    want = brute_whitening(rows)
    by = {}
    for r in got:
        by.setdefault(r["component"], {}).setdefault(r["vec_id"], r)
    assert set(by) == {1, 2, 3, 4} and all(set(v) == set(want) for v in by.values())
    for c, found in by.items():
        sign = np.sign(sum(found[i]["whitened"] * w[2][c - 1] for i, w in want.items()))
        for i, (n, dev, white, expl) in want.items():
            r = found[i]
            assert (r["n"], r["deviation"]) == (n, dev)
            assert r["whitened"] == pytest.approx(sign * white[c - 1], abs=1e-9) and r["explained"] == pytest.approx(expl[c - 1], rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-12


def test_whitening_whole_table(spark):
    ids, rows = zip(*duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall())
    assert list(ids) == list(range(len(ids)))
    got = queries.QUERIES["op11_whitening"](spark, SF).collect()
    assert len(got) == 4 * len(rows)
    check_whitening(got, rows)


def test_whitening_cases(spark):
    rng = np.random.default_rng(3)
    rows = [[float(c) for c in rng.normal(0, s, 6)] for s in rng.uniform(0.1, 50, 60)]
    rows += [None, [], [1.0, None, 2.0, 3.0, 4.0, 5.0], [math.nan] * 6, [math.inf] + [0.0] * 5, rows[0], rows[0], [-0.0] * 6]
    df = spark.createDataFrame([(i, v, "e", 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, x string, n int")
    check_whitening(whitening.whiten(df).collect(), rows)
    # an odd length, a null id and a repeated id
    more = df.unionByName(spark.createDataFrame([(None, rows[1], "", 0), (5, rows[5], "", 0), (99, [1.0], "", 0)], df.schema))
    got = whitening.whiten(more).collect()
    assert {r["vec_id"] for r in got} == {r["vec_id"] for r in whitening.whiten(df).collect()} | {None}
    assert sum(r["vec_id"] == 5 for r in got) == 8
    assert whitening.whiten(df.where("false")).collect() == [] == whitening.whiten(df.where("size(embedding) = 0")).collect()
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.5, 2.0]), (3, [1.0, 2.0])], "vec_id long, embedding array<float>"))
    assert sorted((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"], r["identity_error"]) for r in flat.collect()) == [
        (i, c, 2, 128 * 128, 1.0 if c == 1 else 0.0, 1.0 if c == 1 else 0.0, 0.0) for i in (1, 2, 3) for c in (1, 2)]


def test_whole_numbers_beyond_small_ranges():
    rows = [[1e300, -1e300, 3.0], [2.0**55, -2.0**55, -0.001], [127 / 256, -0.5, 0.0], [128 / 256, -0.501, 1.0]]
    import pyarrow as pa
    (at, x), = whitening.vectors(pa.array(rows, pa.list_(pa.float64())))
    assert at.tolist() == [0, 1, 2, 3]
    assert x.tolist() == [[2**63 - 1, -2**63, 768], [2**63 - 1, -2**63, -1], [127, -128, 0], [128, -129, 256]]
    packed = whitening.packed(x)
    assert [p[0] for p in packed] == [8, 8, 1, 2] and np.array_equal(whitening.unpacked(packed), x)


@pytest.mark.parametrize("lam", [[5, 4, 3, 2, 1.0], [3, 3, 3, 1, 1.0], [1, 1 + 1e-9, 1 + 2e-9, 1e-6, 0], [1 + 1e-13, 1, 1 - 1e-13, .5, .5],
                                 [0, 0, 0, 0, 0.0], [1e12, 1, 1e-3, 1e-3, 0]])
def test_refined_eigenvectors(lam):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(5, 5)))[0]
    a = (q * np.array(lam)) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.refined(a)
    assert got == pytest.approx(sorted(lam, reverse=True), abs=4e-15 * max(lam))
    assert np.abs(x.T @ x - np.eye(5)).max() < 2e-15
    assert np.abs(a @ x - x * got).max() <= 4e-15 * max(lam)


def test_refinement_is_needed():
    """float32 vectors alone are off by a million times more."""
    m = np.random.default_rng(2).normal(size=(200, 40))
    a = m.T @ m / 200
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    lam, x = whitening.refined(a)
    off = lambda v: np.abs(v.T @ a @ v - np.diag(np.diag(v.T @ a @ v))).max()
    assert off(x) < 1e-14 < 1e-8 < off(rough)


# ---------------------------------------------------------------- divergence

def divergence_by_sql(docs):
    con = duckdb.connect()
    con.register("frame", docs.toPandas())
    con.sql("CREATE VIEW documents AS SELECT * FROM frame")
    return sorted(con.sql(f"SELECT lang, source, part, item, value, rank FROM ({queries.ORACLE['op12_divergence']})").fetchall())


def test_divergence_whole_table(spark):
    got = queries.QUERIES["op12_divergence"](spark, SF).select("lang", "source", "part", "item", "value", "rank").collect()
    assert got and sorted(map(tuple, got)) == divergence_by_sql(spark.read.parquet(f"{SF}/documents.parquet"))


def test_divergence_by_hand(spark):
    rows = [(i, "Tide tide sea" if i % 2 else "tide", "en", "a" if i < 12 else "b") for i in range(24)] + [(0, None, "en", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    a = b = 1 + 10**9 * (18 + 2) // (24 + 4), 1 + 10**9 * (6 + 2) // (24 + 4)
    c = (1 + 10**9 * 2 // 4,) * 2
    f = lambda p, q: (p - q) ** 2 // (p + q)
    lang = 1 + 10**9 * (36 + 2) // (48 + 4), 1 + 10**9 * (12 + 2) // (48 + 4)
    far = sum(map(f, a, c))
    terms = [("en", g, "term", "sea", f(a[1], lang[1]), 1) for g in "ab"]
    want = [("en", "a", "pair", "b", sum(map(f, a, b)), 2), ("en", "a", "pair", "c", far, 1), ("en", "b", "pair", "a", 0, 2), ("en", "b", "pair", "c", far, 1),
            ("en", "c", "pair", "a", far, 1), ("en", "c", "pair", "b", far, 2)] + [t for t in terms if a[1] > lang[1]]
    assert sorted(map(tuple, divergence.audit(df).collect())) == sorted(want)


def test_divergence_cases(spark):
    """Nulls, empty texts, a group without terms, other scripts, repeated ids, clashing names; any block size gives the same."""
    rng = random.Random(4)
    word = ["Ümläut", "ümläut", "tide", "TIDE", "maré", "海", " x", "a1b", "x-y", "\x85z", "sea"]
    rows = [(rng.choice([None, 1, i]), rng.choice(["", None, " 12 "]) if rng.random() < .1 else " ".join(rng.choices(word, k=rng.randint(1, 30))) + "\n",
             rng.choice(["en", "pt", None, ""]), rng.choice(["s", "t", None, "ü", "u"]), 1, "x", b"t") for i in range(400)]
    rows += [(1, "lonely", "fi", "s", 1, "x", b"t"), (1, None, "fi", None, 1, "x", b"t"), (1, "alone", "sv", "s", 1, "x", b"t"), (9, "word " * 200_000, "en", "s", 1, "x", b"t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, c int, block string, term binary")
    want = divergence_by_sql(df.drop("term"))
    assert sorted(map(tuple, divergence.audit(df).collect())) == want
    assert sorted(map(tuple, divergence.audit(df, block=1).collect())) == want
    assert [r for r in want if r[0] == "fi"] == [("fi", "", "pair", "s", 0, 1), ("fi", "s", "pair", "", 0, 1)] and not [r for r in want if r[0] == "sv"]
    assert divergence.audit(df.where("false")).collect() == []


def test_small_tables_and_matrices_give_the_same(spark, monkeypatch):
    c, total, v = np.array([0, 1, 7, 10**12, 10**15]), 4 * 10**15, 10**6
    assert divergence.smoothed(c, total, v).tolist() == [1 + 10**9 * (int(x) + 2) // (total + 2 * v) for x in c]
    import pyarrow as pa
    left = pa.table({"source": ["a", "b", "a", "c"], "term": pa.array([b"x", b"x", b"y", b"z"]), "c": [3, 4, 5, 6]})
    right = pa.table({"lang": ["en"] * 3, "source": ["a", "b", "c"], "n": [8, 4, 6], "v": [3, 3, 3]})
    whole = divergence._block_pairs(left, right)
    monkeypatch.setattr(divergence, "CELLS", 1)
    assert divergence._block_pairs(left, right).equals(whole) and whole.num_rows == 3


# ---------------------------------------------------------------- SentencePiece

@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def bpe():
    with open(MODEL, "rb") as f:
        return sentencepiece_bpe.Bpe(f.read())


def test_sentencepiece_whole_table(spark, lib):
    text = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = queries.QUERIES["op13_sentencepiece"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(text) and len(rows) == len(text)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = lib.encode(text[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))


def test_sentencepiece_against_library(bpe, lib):
    rng = random.Random(6)
    odd = "ab▁ \n\té中ア\U0001f600theing  \x00ß0123aaa   "
    pieces = [lib.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    texts = ["", " ", "  ", "▁", "\x00", "﻿x", "aaaaaaa", "hello" * 9, "́é", " " * 100, "\n" * 33]
    texts += ["".join(rng.choices(odd, k=rng.randint(0, 40))) for _ in range(4000)] + ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(4000)]
    texts += [t.replace(" ", "") for t in texts[-2000:]]
    for t in texts:
        ids = lib.encode(t)
        assert bpe.encode(t) == ids, t
        assert bpe.decode(ids) == lib.decode(ids), t


def test_sentencepiece_long_cuts(bpe, lib):
    """Texts without a place to cut: one run of letters is backtracked as a whole."""
    rng = random.Random(7)
    for t in ("a" * 100_000, "".join(rng.choices("abcdeghinorst", k=100_000)), "漢" * 50_000, " " * 50_000):
        assert bpe.encode(t) == lib.encode(t)


def test_sentencepiece_decodes_any_ids(bpe, lib):
    rng = random.Random(8)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(262), rng.randrange(190, 262), 259, 28705, 1]) for _ in range(rng.randint(0, 10))]
        assert bpe.decode(ids) == lib.decode(ids), ids


def test_sentencepiece_backtracks(bpe):
    """Longest matches alone are wrong; the bitfield's failures are met."""
    greedy = bpe.machine
    wrong = 0
    for w in ("▁thanthwh", "▁esonan", "▁reinshth", "▁anenedti"):
        at, out = 0, []
        while at < len(w):
            n = greedy.longest_prefix(w[at:])
            while w[at:at + n] not in bpe.id:
                n -= 1
            out.append(w[at:at + n])
            at += n
        assert bpe.split(w) == bpe.merge(w)
        wrong += out != bpe.merge(w)
    assert wrong


def test_sentencepiece_cases(spark, lib):
    rows = [(1, None, 1, "i"), (1, None, 1, "i"), (2, "", 2, "j"), (None, "a b", 3, "k"), (3, "x" * 200_000, 4, "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    got = sentencepiece_bpe.encode(df, MODEL).collect()
    assert sorted(((r["row"]["doc_id"] or 0), r["row"]["decoded"], r["ids"], r["decoded"]) for r in got) == sorted(
        ((i or 0), s, lib.encode(t or ""), lib.decode(lib.encode(t or ""))) for i, t, _, s in rows)
    assert sentencepiece_bpe.encode(df.where("false"), MODEL).collect() == []
    tokens = spark.createDataFrame([(lib.encode("Tide é"),), (None,), ([],)], "ids array<long>")
    assert [r["decoded"] for r in sentencepiece_bpe.decode(tokens, MODEL).collect()] == ["Tide é", "", ""]
