"""Byte-level BPE by queries, alignment of tokenizers and whitening against the libraries and brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bitextra.llm import alignment, byte_queries, queries, whitening

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SYLLABLES = ["a", "b", "the ", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ქ", "中文", "　", "▁", "\r", "\x1c", " ", "\U0001f600", "12"]
SYLLABLES += ["--", "<|endoftext|>", "<s>", "<0x0A>", "ﬁ", "ation", "²", "́", "​", "\x85"]
ODD = [None, "", " ", "\n", "  two  blanks \n\nend ", "same same", "same same", "a" * 100_000, "ab" * 4000, "<|endoftext|> plain"]
ODD += ["".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=3000)), "ქართულიენა" * 300, "=" * 777]


def texts(seed, n):
    rnd = random.Random(seed)
    mixed = ["".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 30))) for _ in range(n)]
    signs = ["".join(map(chr, rnd.choices([*range(1, 0xD800), *range(0xE000, 0x20000)], k=8))) for _ in range(n)]
    return ODD + mixed + signs


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_queries.read_ranks(RANKS), special_tokens={})


def test_byte_queries_equal_the_library(spark, library):
    rows = [(i, t, "mine", "mine") for i, t in enumerate(texts(1, 1500))]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    for some in (df, spark.read.parquet(f"{SF}/documents.parquet").limit(100), df.limit(0)):
        coded = byte_queries.decode_ids(byte_queries.encode_documents(some, RANKS, PATTERN, memo=500), RANKS, PATTERN)
        assert set(coded.columns) == {*some.columns, "ids", "decoded"}
        got = coded.select("text", "ids", "decoded").collect()
        assert len(got) == some.count()
        for r in got:
            assert r["ids"] == library.encode_ordinary(r["text"] or "")
            assert bytes(r["decoded"]) == (r["text"] or "").encode()
    part = spark.createDataFrame([([255],), ([],), (None,)], "ids array<int>")
    assert [bytes(r["decoded"]) for r in byte_queries.decode_ids(part, RANKS, PATTERN).collect()] == [library.decode_bytes([255]), b"", b""]


def test_byte_query(spark, library):
    for r in queries.op11_byte_queries(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect():
        ids = library.encode_ordinary(r["text"] or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_long_words_are_cut_where_no_token_reaches():
    codec = byte_queries.Codec(RANKS, PATTERN, 100)
    word = random.Random(2).randbytes(4000)
    parts = codec._cut(word)
    assert b"".join(parts) == word and len(parts) > 100
    ends = np.cumsum([len(p) for p in parts])[:-1].tolist()
    longest = max(map(len, codec.ranks))
    for end in ends:
        for a in range(max(0, end - longest), end):
            assert not any(word[a:b] in codec.ranks for b in range(end + 1, end + longest))


def plain_alignment(t):
    """Tokens of both with byte offsets, by definition; None without tokens."""
    a_tool, b_tool = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tool.encode_special_tokens = True
    known = alignment.Tokenizers(A, B, 10)

    def tokens(text):
        if not text:
            return None
        out = []
        for ids, strings in ((a_tool.encode(" " + text, add_special_tokens=False).ids, known.strings_a), (b_tool.encode(text), known.strings_b)):
            ends = np.cumsum([len(strings[i]) for i in ids]).tolist()
            if b"".join(strings[i] for i in ids) != (" " + text).encode():
                return None
            out.append(list(zip(ids, [0, *ends[:-1]], ends)))
        return out

    rows, counts = [], Counter()
    for text in t:
        found = tokens(text)
        if found is None:
            rows.append(((0, 0, 0, 0, ""), Counter()))
            continue
        a, b = found
        both = sorted({e for *_, e in a} & {e for *_, e in b})
        cut = [([i for i, s, e in a if lo <= s and e <= hi], [i for i, s, e in b if lo <= s and e <= hi]) for lo, hi in zip([0, *both], both)]
        listed = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in cut)
        links, first = Counter(), 0
        for i, s, e in a:
            while b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links[i, b[k][0]] += 1
                k += 1
        rows.append(((len(a), len(b), len(cut), links.total(), hashlib.sha256(listed.encode()).hexdigest()), links))
        counts.update(links.keys())
    most = Counter()
    for (i, _), c in counts.items():
        most[i] = max(most[i], c)
    out = Counter()
    for t_id, (facts, links) in enumerate(rows):
        best = sum(n for (i, j), n in links.items() if counts[i, j] == most[i])
        out[(t_id, *facts[:4], best, sum(n * counts[p] for p, n in links.items()), facts[4])] += 1
    return out, counts


def test_alignment_equals_its_definition(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 500)
    some = texts(3, 400)
    df = spark.createDataFrame([(i, t, "mine", "mine") for i, t in enumerate(some)], "doc_id long, text string, n_a string, pair string")
    got, table = alignment.align_documents(df.repartition(3), A, B, memo=200)
    want, counts = plain_alignment(some)
    assert Counter(tuple(r) for r in got.collect()) == want
    found = {(r["a"], r["b"]): r["n_docs"] for r in table.collect()}
    assert found == dict(counts)


def test_alignment_of_odd_tables(spark):
    schema = "doc_id long, text string"
    got, table = alignment.align_documents(spark.createDataFrame([], schema), A, B)
    assert got.count() == 0 and table.count() == 0
    got, _ = alignment.align_documents(spark.createDataFrame([(None, "one"), (7, None), (7, ""), (7, "one"), (7, "one")], schema), A, B)
    assert Counter((r["doc_id"], r["n_a"], r["count_sum"]) for r in got.collect()) == {(None, 1, 3): 1, (7, 0, 0): 2, (7, 1, 3): 2}


def test_align_skips_stretches():
    rnd = random.Random(4)
    for _ in range(300):
        n = rnd.randint(1, 200)
        p = rnd.choice([0.05, 0.5, 0.95])
        a = sorted({*(i for i in range(1, n) if rnd.random() < p), n})
        b = sorted({*(i for i in range(1, n) if rnd.random() < p or rnd.random() < p and i in a), n})
        stretches, links_a, links_b = alignment.align(a, b)
        groups = [(i + k, j + k) for i, j, m in stretches for k in range(m)]
        both = sorted({*a} & {*b})
        assert groups == [(0, 0), *[(a.index(e) + 1, b.index(e) + 1) for e in both[:-1]]]
        starts = lambda x: [0, *x[:-1]]
        assert list(zip(links_a, links_b)) == [
            (i, j) for i, (s, e) in enumerate(zip(starts(a), a)) for j, (u, v) in enumerate(zip(starts(b), b)) if max(s, u) < min(e, v)
        ]


def exact_covariance(vectors):
    x = [[math.floor(64 * Fraction(c)) + 1_000_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(dims)]
    cov = [[Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x), n**3) for j in range(dims)] for i in range(dims)]
    return x, n, sums, cov


@pytest.mark.parametrize("scale", [1.0, 1e-3, 3e7, 1e25])
def test_whitening_is_exact(spark, scale):
    rng = np.random.default_rng(7)
    vectors = (rng.normal(size=(150, 6)) @ rng.normal(size=(6, 6)) * scale).astype(np.float32)
    if scale == 1.0:
        vectors[3, 2] = 5e6
    rows = [(i, v.tolist(), "mine", "mine") for i, v in enumerate(vectors)]
    rows += [(900, None, "", ""), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], "", ""), (902, [float("nan")] * 6, "", ""), (903, [float("inf")] * 6, "", "")]
    rows += [(904, [1.0], "", ""), (905, [], "", "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, whitened string").repartition(4)
    got, model = whitening.whiten(df, most=4)
    found = {r["vec_id"]: r for r in got.collect()}
    assert set(found) == set(range(150))
    x, n, sums, cov = exact_covariance(vectors.tolist())
    assert [s + n * 1_000_000 for s in model.sums] == sums
    trace = sum(cov[i][i] for i in range(6))
    for i, row in enumerate(x):
        want = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        r = found[i]
        assert (r["n"], r["deviation_exact"], r["deviation"]) == (n, str(want), want if want < 1 << 63 else None)
    white = np.array([found[i]["whitened"] if None not in found[i]["whitened"] else [0.0] * 4 for i in range(n)])
    if trace and all(model.real):
        assert abs(white.T @ white / n - np.eye(4)).max() < 1e-4 and model.identity_error < 1e-4
        centred = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(row, sums)] for row in x])
        for k in range(4):
            v = model.vectors[:, k]
            e = sum(Fraction(float(a)) * Fraction(float(b)) * cov[i][j] for i, a in enumerate(v) for j, b in enumerate(v))
            assert float(e / trace) == pytest.approx(model.explained[k], rel=1e-4)
            np.testing.assert_allclose(white[:, k], centred @ v / math.sqrt(e), rtol=1e-6, atol=1e-6)


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    got, model = whitening.whiten(spark.createDataFrame([], schema))
    assert got.count() == 0 and model is None
    got, model = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], schema))
    assert [(r["n"], r["deviation"], r["whitened"]) for r in got.collect()] == [(3, 0, [None, None])] * 3
    assert model.explained == [None, None]
    # a dimension that is a copy of another has no component of its own
    rows = [(i, [float(i % 7), float(i % 7), float(i % 5)]) for i in range(70)]
    got, model = whitening.whiten(spark.createDataFrame(rows, schema))
    assert model.real == [True, True, False] and model.identity_error < 1e-9
    assert all(r["whitened"][2] is None for r in got.collect())


def test_whitening_query(spark):
    rows = queries.op12_bit_sliced_whitening(spark, SF)
    n = spark.read.parquet(f"{SF}/embeddings.parquet").where(F.col("embedding").isNotNull()).count()
    assert rows.count() == n * 32
    one = rows.agg(F.countDistinct("vec_id", "component").alias("k"), F.max("identity_error").alias("e"), F.min("component").alias("a"), F.max("component").alias("z")).first()
    assert one["k"] == n * 32 and one["e"] < 1e-4 and (one["a"], one["z"]) == (1, 32)


def test_bit_planes():
    rng = np.random.default_rng(3)
    for high, kind in ((40, np.int64), (1 << 40, np.int64), (10**30, object)):
        x = np.array([[int(v) * (high // 40) - high // 3 for v in row] for row in rng.integers(0, 40, (131, 5))], dtype=kind)
        sums, products = whitening.scatter(x)
        plain = [[int(v) for v in row] for row in x]
        assert sums == [sum(r[i] for r in plain) for i in range(5)]
        assert all(p == sum(r[i] * r[j] for r in plain) for (i, j), p in products.items())


def test_links_are_arrays_made_from_groups():
    stretches, links_a, links_b = alignment.align([2, 3, 7, 9], [1, 3, 4, 5, 9])
    assert stretches == [(0, 0, 1), (2, 2, 1)]
    assert isinstance(links_a, np.ndarray) and isinstance(links_b, np.ndarray)
    assert list(zip(links_a.tolist(), links_b.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3), (2, 4), (3, 4)]
    assert [len(x) for x in alignment.align([], [])] == [0, 0, 0]
