"""Extra columns of any name come through operators and stages; no learned word is dropped."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bitextra.llm import jaccard_forest, llr_rules, toxicity

SF = "/root/testdata/sf0.001"
NAMES = "_h _t _v _f _r _s _raw _d _k _key _first _again _length _carried score kept shard order taken copy size h".split()


@pytest.fixture(scope="module")
def docs(spark):
    some = spark.read.parquet(f"{SF}/documents.parquet").withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in NAMES})
    odd = some.limit(2).withColumns({"text": F.lit(None).cast("string"), "lang": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 10**6})
    odd = odd.unionByName(odd.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit("")}))
    return some.unionByName(odd).unionByName(some.limit(3))


def own(row, names=NAMES):
    """Every extra value is that of the row's document."""
    ids = {row[n].removeprefix(f"{n} of ") if row[n] is not None else None for n in names}
    return len(ids) == 1


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_operators_carry_columns_of_any_name(docs, labels):
    n = docs.count()
    for out, new in (
        (llr_rules.judge(docs, labels, buckets=256), {"kept"}),
        (toxicity.score(docs, labels, trees=3), {"score"}),
        (jaccard_forest.keep_first(docs), set()),
    ):
        rows = out.collect()
        assert all(own(r, [c for c in NAMES if c not in new]) for r in rows)
        assert len(rows) == n or not new and len(rows) < n


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_return_their_columns(spark, docs, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    out = run(spark, docs, SF)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(own(r) for r in rows)
    known = Counter((r["doc_id"], r["lang"], r["source"]) for r in docs.collect())
    assert all((r["doc_id"], r["lang"], r["source"]) in known for r in rows)
    assert run(spark, docs.limit(0), SF).count() == 0


def test_last_stage_codes_every_row(spark, docs):
    rows = corpus_pipeline.encoding(spark, docs, SF)
    assert rows.count() == docs.count() and rows.where("not round_trip").count() == 0


def test_all_learned_words_count(spark):
    words = [f"insult{i}" for i in range(300)]
    toxic = [(1.0, " ".join(words))] * 8
    clean = [(0.0, "plain words only")] * 80
    got = toxicity.learned_words(spark.createDataFrame(toxic + clean, "label double, text string"))
    assert sorted(got) == sorted(words)


def test_spelled_out_words_meet_learned_ones():
    plain = toxicity.features("z.o.r.k you", frozenset(), frozenset())
    known = toxicity.features("z.o.r.k you", frozenset(), frozenset({"zork"}))
    assert plain != known
