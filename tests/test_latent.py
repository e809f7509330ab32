"""Latent semantics and clusters against dense linear algebra and brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bitextra.operators import latent as L, mining as M

FEATURES = 40


@pytest.fixture(scope="module")
def dense():
    """300 sparse rows of six topics, some without entries; singular values fall by a third."""
    rng = np.random.default_rng(3)
    topics = rng.random((6, FEATURES)) * (rng.random((6, FEATURES)) < 0.4)
    rows = rng.random((300, 6)) * 3.0 ** -np.arange(6) @ topics
    rows[::37] = 0
    return rows


@pytest.fixture(scope="module")
def rows(spark, dense):
    data = [
        (f"d{i}", [(f"t{f}", f, float(w)) for f, w in enumerate(r) if w] if i != 5 else None) for i, r in enumerate(dense)
    ]
    df = spark.createDataFrame(data, "id string, entries array<struct<term:string,feature:int,weight:double>>")
    return df.repartition(7)


def test_loadings_are_the_singular_vectors(rows, dense, monkeypatch):
    monkeypatch.setattr(L, "STEP", 64)  # several blocks a batch
    dense = dense.copy()
    dense[5] = 0
    found = L.principal_loadings(rows, FEATURES, 5, passes=40, tolerance=1e-14)
    exact = np.linalg.svd(dense)[2][:5].T
    assert np.allclose(found.T @ found, np.eye(5), atol=1e-9)
    assert np.allclose(np.abs((found * exact).sum(axis=0)), 1, atol=1e-6)
    assert (found[np.abs(found).argmax(axis=0), np.arange(5)] > 0).all()


def test_vectors_and_explained_variance(rows, dense):
    dense = dense.copy()
    dense[5] = 0
    vectors, ratio = L.lsa(rows, "id", FEATURES, 4)
    got = {r["id"]: r["vector"] for r in vectors.collect()}
    assert len(got) == 300 and got["d0"] == [0.0] * 4 == got["d5"]
    whole = np.array([got[f"d{i}"] for i in range(300)])
    assert ratio == pytest.approx(whole.var(axis=0).sum() / dense.var(axis=0).sum(), rel=1e-9)
    exact = dense @ np.linalg.svd(dense)[2][:4].T
    assert ratio == pytest.approx(exact.var(axis=0).sum() / dense.var(axis=0).sum(), rel=1e-3)


def test_rows_without_a_known_word_keep_a_vector(spark):
    df = spark.createDataFrame([("a", "river bridge"), ("b", None), ("c", "bridge bridge toll"), ("c", "of")], "id string, text string")
    vectors, _ = L.lsa(M.tfidf_rows(df, "id", F.col("text"), 10), "id", 10, 2)
    assert Counter(r["id"] for r in vectors.collect()) == {"a": 1, "b": 1, "c": 2}


def test_an_empty_table_has_no_vectors(spark):
    df = spark.createDataFrame([], "id string, entries array<struct<term:string,feature:int,weight:double>>")
    vectors, ratio = L.lsa(df, "id", 10, 2)
    assert vectors.count() == 0 and ratio == 0.0
    with pytest.raises(ValueError):
        L.cluster(vectors, "id", 3, starts=1)


def test_packed_rows_stay_in_no_executors_memory(rows, dense):
    """Packed and listed entries give the same numbers; the rows are read from the checkpoint folder in every pass."""
    vectors, ratio = L.lsa(rows, "id", FEATURES, 4)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in plan and "bitextra-sparse-rows" in plan
    again, same = L.lsa(L.pack(rows, "id"), "id", FEATURES, 4)
    assert same == pytest.approx(ratio, rel=1e-9)
    other = {r["id"]: r["vector"] for r in again.collect()}
    assert all(np.allclose(other[r["id"]], r["vector"], atol=1e-8) for r in vectors.collect())
    entries = pa.array([[], None, [{"feature": 2, "weight": 1.5}, {"feature": 0, "weight": 2.0}, {"feature": 2, "weight": 0.5}]])
    blocks = [(lo, used.tolist(), x.tolist()) for lo, used, x in L._dense(entries, 4, 1)]
    assert blocks == [(0, [0, 2], [[0, 0], [0, 0], [2.0, 2.0]])]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 3)) * 20
    data = [(f"p{i}", (centres[i % 4] + rng.normal(size=3) * 0.3).tolist()) for i in range(400)]
    df = spark.createDataFrame([*data, ("none", None)], "id string, vector array<double>").repartition(6)
    return df, np.array([v for _, v in data])


def test_clusters_find_separate_groups(points):
    df, x = points
    clusters, costs, best = L.cluster(df, "id", 6, starts=3)
    groups = [x[i::4] for i in range(4)]
    within = sum(((g - g.mean(axis=0)) ** 2).sum() for g in groups)
    assert dict(costs)[4] == pytest.approx(within, rel=1e-6)
    assert [c for _, c in costs] == sorted((c for _, c in costs), reverse=True)
    got = {r["id"]: r["cluster"] for r in clusters.collect()}
    assert len(got) == 400 and best == L.elbow(costs)
    assert all(len({got[f"p{j}"] for j in range(i, 400, 4)}) == 1 for i in range(4)) or best < 4


def test_vectors_are_written_once_for_all_passes(points):
    df, x = points
    clusters, costs, _ = L.cluster(df, "id", 3, starts=2)
    plan = clusters._jdf.queryExecution().executedPlan().toString()
    assert "bitextra-vectors" in plan and "InMemoryTableScan" not in plan and clusters.count() == len(x)
    assert L._matrix(L._as_bytes.func(pa.array(x.tolist()))).tolist() == x.tolist()


def test_more_starts_never_cost_more(points):
    df, _ = points
    one = dict(L.cluster(df, "id", 5, starts=1)[1])
    many = dict(L.cluster(df, "id", 5, starts=4)[1])
    assert all(many[k] <= one[k] + 1e-9 for k in one)


def test_equal_vectors_need_no_second_centre(spark):
    df = spark.createDataFrame([(str(i), [1.0, 2.0]) for i in range(9)], "id string, vector array<double>")
    clusters, costs, _ = L.cluster(df, "id", 3, starts=2)
    assert [c for _, c in costs] == [0.0, 0.0] and clusters.count() == 9


def test_samples_hold_n_rows_where_ids_repeat(spark):
    df = spark.createDataFrame([("a", f"k{i}", f"e{i}", "d") for i in range(8)] + [("b", "k", "e", "d")], "id string, ka string, en string, domain string")
    clusters = spark.createDataFrame([("a", 0)] * 8 + [("b", 1)], "id string, cluster int")
    got = L.cluster_samples(df, clusters, "id", 3)
    assert Counter(r["cluster"] for r in got.collect()) == {0: 3, 1: 1}
