"""Texts enter no shuffle that does not need them, and matching does its costly part once."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitextra.operators import contamination as C, near as N
from bitextra.operators.sampling import sample_stratified
from bitextra.plans import preprocess


def joins(df) -> list[str]:
    """The output of every join of the optimized plan."""
    found, nodes = [], [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Join":
            found.append(node.output().mkString(" "))
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_fates_are_joined_without_texts(spark):
    rows = [("a", "x", "y", "d1"), ("b", "x", "y", "d2"), ("b", "x", "y", "d2"), ("c", " ", "y", "d1"), ("c", " ", "y", "d1"), ("e", None, "y", "d3")]
    df = spark.createDataFrame(rows * 3, "id string, en string, ka string, domain string").repartition(3)
    marked = preprocess.mark_cleanup(df)
    assert marked.columns == [*df.columns, "_fate"]
    narrow = marked.select("domain", "_fate")
    assert joins(narrow) and not any("en#" in o or "ka#" in o for o in joins(narrow))
    counts = {(r["domain"], r["_fate"]): r["count"] for r in narrow.groupBy("domain", "_fate").count().collect()}
    assert counts == {("d1", "kept"): 1, ("d1", "duplicate"): 2, ("d2", "duplicate"): 6, ("d1", "empty"): 6, ("d3", "empty"): 3}


def test_few_strata_are_broadcast(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).cast("string").alias("domain"), F.lit("t").alias("text"))
    df = df.withColumn("domain", F.nullif("domain", F.lit("3")))
    got = sample_stratified(df, 40, ["id"])
    # one join, with the cut-offs, and by broadcast
    assert len(joins(got)) == 1 and "broadcast" in got._jdf.queryExecution().optimizedPlan().toString()
    sizes = {r["domain"]: r["count"] for r in df.groupBy("domain").count().collect()}
    assert {r["domain"]: r["count"] for r in got.groupBy("domain").count().collect()} == {d: n * 40 // 100 for d, n in sizes.items()}


def test_verified_sets_are_signed_once(spark):
    words = [f"w{i}" for i in range(40)]
    same, turned, close, far = " ".join(words), " ".join(words[::-1]), " ".join([*words[:-1], "other"]), "nothing like it"
    source = spark.createDataFrame([(same,), (far + " at all",), (None,), (" ",)], "t string")
    target = spark.createDataFrame([(turned,), (close,), (far,), (None,), (" ",), (turned,)], "t string")
    calls = []

    def bands(sets, keep):
        calls.append(keep)
        return sets.select(*keep, F.when(F.size("_w") > 0, F.array(F.lit("all"), F.element_at("_w", 1))).alias("_bands"))

    found = N.verified_partners(source, target, ["t"], F.coalesce("t", F.lit("")), bands, 0.9)
    keyed = target.select("t", C.digest(F.col("t")).alias("_text")).distinct()
    assert {r["t"] for r in found.join(keyed, "_text").collect()} == {turned, close}
    assert found.count() == 2 and len(calls) == 1


@pytest.mark.parametrize("dims", [1, 3])
def test_large_buckets_are_cut_into_parts(spark, monkeypatch, dims):
    monkeypatch.setattr(N, "BUCKET", 3)
    monkeypatch.setattr(N, "ASKED", 2)
    rng = np.random.default_rng(dims)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(90, dims)))]
    odd = [(900, None), (901, [float("nan")] * dims), (902, [0.0] * dims), (903, []), (904, [1.0] * (dims + 1)), (905, [1e200] * dims), (906, [1e-200] * dims)]
    df = spark.createDataFrame(rows + odd, "i long, v array<double>").repartition(4)
    source, target = df.where("i % 2 = 0"), df.where("i % 2 = 1")
    found = N.vector_partners(source, target, "v", 0.95, bits=2, recall=1 - 1e-9)
    got = {r["i"] for r in found.join(target.withColumn("_text", N.vector_digest("v")), "_text").collect()}
    unit = {i: np.array(v) / max(map(abs, v)) for i, v in rows + odd if v and len(v) == dims and max(v) != 0 and v[0] == v[0]}
    cos = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    assert got == {i for i, v in unit.items() if i % 2 and any(j % 2 == 0 and cos(v, w) >= 0.95 for j, w in unit.items())}
