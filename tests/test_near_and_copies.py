"""Near duplicates by fingerprints, vectors and verified sets; rows that are equal throughout."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitextra.operators import contamination as C, dedup, lookup as L, near as N, sampling as S

WORDS = [f"w{i}" for i in range(4000)]


def fingerprint(text):
    sums = [0] * 64
    for w in text.split():
        h = int(hashlib.md5(w.encode()).hexdigest()[:16], 16)
        for j in range(64):
            sums[j] += 1 if h >> j & 1 else -1
    return sum(1 << j for j in range(64) if sums[j] > 0)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.fixture(scope="module")
def corpus(spark):
    """Source texts, and a target with copies, near copies and unrelated texts."""
    rnd = random.Random(5)
    make = lambda n: [rnd.choice(WORDS) for _ in range(n)]
    source = [make(rnd.randint(150, 400)) for _ in range(60)]
    target = {}
    for i, words in enumerate(source[:40]):
        target[f"near{i}"] = [*words[:-1], "changed"]
    target |= {f"new{i}": make(rnd.randint(150, 400)) for i in range(60)}
    target |= {"copy": source[50], "copy2": source[50], "empty": [], "short": ["one"]}
    both = lambda rows: spark.createDataFrame([(k, " ".join(t) if t else None) for k, t in rows], "id string, text string")
    src = both([(f"s{i}", t) for i, t in enumerate(source)] + [("none", []), ("short", ["one"])])
    return src, both(target.items()), source, target


def flags(source, target, near, key="id"):
    rows = C.flag_contamination(source, target, {"exact_match": {"enabled": False}, "near_duplicate": {"columns": ["text"], **near}}, key=key)
    return {r[key]: r["is_near"] for r in rows.collect()}


def test_simhash_is_the_sum_of_signed_bits(spark):
    texts = ["a b c", "a a a b", "one", " ".join(WORDS[:3000]) + " " + " ".join(WORDS[:1000])]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(N.simhash(F.split("t", " ")).alias("p"))
    assert [r["p"] for r in df.collect()] == [signed(fingerprint(t)) for t in texts]


@pytest.mark.parametrize(("distance", "blocks"), [(0, 1), (3, 6), (3, 4), (5, 8)])
def test_block_masks_meet_all_within_the_distance(distance, blocks):
    masks = N.block_masks(distance, blocks)
    rnd = random.Random(1)
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for j in rnd.sample(range(64), rnd.randint(0, distance)):
            b ^= 1 << j
        assert any(signed(a) & m == signed(b) & m for m in masks)
    with pytest.raises(ValueError):
        N.block_masks(blocks, blocks)


@pytest.mark.parametrize("distance", [3, 8])
def test_simhash_finds_near_copies_only(corpus, distance):
    source, target, src, tgt = corpus
    got = flags(source, target, {"algorithm": "simhash", "simhash_params": {"distance": distance, "blocks": distance + 3}})
    prints = [fingerprint(" ".join(t)) for t in src] + [fingerprint("one")]
    want = {k: bool(t) and any((fingerprint(" ".join(t)) ^ p).bit_count() <= distance for p in prints) for k, t in tgt.items()}
    assert got == want
    assert got["copy"] and got["copy2"] and got["short"] and not got["empty"]
    assert not any(v for k, v in got.items() if k.startswith("new"))
    if distance == 8:
        assert sum(got[f"near{i}"] for i in range(40)) >= 36


def test_verified_matching_is_exact_jaccard(corpus):
    source, target, src, tgt = corpus
    params = {"num_perm": 128, "threshold": 0.9}
    loose = flags(source, target, {"minhash_params": params})
    got = flags(source, target, {"minhash_params": {**params, "verify": True}})
    sets = [set(t) for t in src] + [{"one"}]
    best = {k: max(len(set(t) & s) / len(set(t) | s) for s in sets) for k, t in tgt.items() if t}
    for k, hit in got.items():
        assert hit == (loose[k] and best.get(k, 0) >= 0.9)
    assert all(got[f"near{i}"] for i in range(40)) and got["copy"] and got["short"] and not got["empty"]


def test_verification_drops_chance_hits(spark, monkeypatch):
    """Bands of one row hit texts of little similarity; verification keeps them out."""
    monkeypatch.setitem(C.KNOWN_SHAPES, (0.9, 64), (64, 1))
    source = spark.createDataFrame([("s", "a b c d e f g h")], "id string, text string")
    target = spark.createDataFrame([("half", "a b c d x y z u"), ("same", "h g f e d c b a a")], "id string, text string")
    params = {"num_perm": 64, "threshold": 0.9}
    assert flags(source, target, {"minhash_params": params}) == {"half": True, "same": True}
    assert flags(source, target, {"minhash_params": {**params, "verify": True}}) == {"half": False, "same": True}


def test_embeddings_follow_the_cosine(spark):
    rng = np.random.default_rng(3)
    source = rng.normal(size=(300, 32))
    target = np.concatenate([source[:200] + rng.normal(size=(200, 32)) * rng.uniform(0.1, 0.6, (200, 1)), rng.normal(size=(200, 32))])
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    close = (unit(target) @ unit(source).T).max(axis=1)
    rows = [(str(i), v.tolist()) for i, v in enumerate(target)]
    rows += [("scaled", (source[0] * 1e200).tolist()), ("null", None), ("hole", [None] * 32), ("nan", [float("nan")] * 32), ("zero", [0.0] * 32), ("short", [1.0])]
    rows += [("copy", source[1].tolist())] * 3
    schema = "id string, embedding array<double>"
    df = spark.createDataFrame(rows, schema)
    src = spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(source)] + [("z", [0.0] * 32), ("n", None)], schema)
    near = {"algorithm": "embeddings", "embedding_params": {"threshold": 0.9, "bits": 8, "recall": 0.95}}
    got = flags(src, df, near)
    wanted = {str(i) for i in np.flatnonzero(close >= 0.9)} | {"scaled", "copy"}
    found = {k for k, hit in got.items() if hit}
    assert found <= wanted and len(found) >= 0.9 * len(wanted) and {"scaled", "copy"} <= found
    assert len(wanted) > 60
    assert C.flag_contamination(src, df.limit(0), {"exact_match": {"enabled": False}, "near_duplicate": near}).count() == 0
    with pytest.raises(ValueError):
        N.hyperplane_tables(1.0, 8, 0.9)


def test_repeat_rows(spark):
    counts = {"a": 1, "b": 9, "c": 10, "d": 11, "e": 1234, "f": 0, "g": None}
    df = spark.createDataFrame(list(counts.items()), "k string, n long")
    got = {r["k"]: r["count"] for r in L.repeat_rows(df, "n", copies=10).groupBy("k").count().collect()}
    assert got == {k: n for k, n in counts.items() if n}


def test_millions_of_equal_rows(spark):
    df = spark.range(3_000_000).select(F.lit(1).alias("id"), F.when(F.lit(True), F.lit("same text")).alias("text"))
    marked = dedup.mark_duplicates(df, ["text"], "id", hot_rows=1000).groupBy("is_duplicate").count().collect()
    assert {r["is_duplicate"]: r["count"] for r in marked} == {False: 1, True: 2_999_999}
    assert dedup.drop_duplicates(df, ["text"], "id").count() == 1


def test_duplicates_keep_the_first_by_order_then_content(spark):
    rows = [(2, "x", "b"), (1, "x", "b"), (1, "x", "a"), (1, "x", "a"), (None, "y", None), (None, "y", None), (3, None, "n"), (4, None, None)]
    df = spark.createDataFrame(rows, "pos int, text string, more string")
    kept = dedup.drop_duplicates(df, ["text"], "pos").collect()
    assert sorted((r["pos"] or 0, r["text"] or "", r["more"] or "") for r in kept) == [(0, "y", ""), (1, "x", kept[[r["text"] for r in kept].index("x")]["more"]), (3, "", "n")]
    marked = Counter(r["is_duplicate"] for r in dedup.mark_duplicates(df, ["text"], "pos").collect())
    assert marked == {False: 3, True: 5}


@pytest.mark.parametrize("seed", range(6))
def test_samples_of_repeated_and_null_keys(spark, seed):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c"), (None, "d"), (None, "d")], "k int, t string")
    for n in range(8):
        got = S.sample_rows(df, n, ["k"], seed).collect()
        assert len(got) == min(n, 6)
        left = Counter(tuple(r) for r in df.collect())
        left.subtract(Counter(tuple(r) for r in got))
        assert min(left.values()) >= 0
    again = [sorted(map(str, S.sample_rows(df.repartition(p), 3, ["k"], seed).collect())) for p in (1, 3)]
    assert again[0] == again[1]


def test_stratified_samples_of_one_repeated_key(spark):
    df = spark.range(5000).select(F.lit("same").alias("k"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("domain"), (F.col("id") % 7).alias("x"))
    got = {r["domain"]: r["count"] for r in S.sample_stratified(df, 30, ["k"]).groupBy("domain").count().collect()}
    sizes = {r["domain"]: r["count"] for r in df.groupBy("domain").count().collect()}
    assert got == {d: int(n * 30 / 100) for d, n in sizes.items()}
