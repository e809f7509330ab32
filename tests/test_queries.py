"""Every registered query: equal to its SQL twin, and with a plan that scales."""

from __future__ import annotations

import os

import pytest
from oracle import connect, differences

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()
# these collect models or run whole jobs; they are covered by check.py and their own tests
HEAVY = {"preprocess_and_augment", "run_splitting"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    found = [d for d in differences(QUERIES[name](spark, SF), con, SQL[name]) if d != "warning: no rows"]
    assert found == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - HEAVY))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


ROW_LOCAL = [
    "filter_empty_content", "filter_purity", "filter_shared_latin", "filter_length_ratio", "filter_minimum_length",
    "cleaner_chain", "normalize_characters", "remove_extra_whitespaces", "convert_to_american", "lowercase_english",
    "sync_punctuation", "remove_brackets_content", "fix_encoding_issues", "preprocessor_chain", "natural_writing_variations",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_text_operators_stay_in_the_jvm(spark, name):
    assert "EvalPython" not in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - HEAVY - {"streaming_ingest"}))
def test_no_cross_joins_and_no_row_udfs(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "BatchEvalPython" not in text


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "retention" in df.columns


def test_pairs_hold_every_document(spark):
    from bitextra.queries.base import pairs

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pairs(spark, SF, positions=True)
    texts = rows.selectExpr("explode(array(en, ka)) AS text").distinct()
    assert docs.join(texts, "text", "left_anti").count() == 0
    assert rows.select("row_pos").distinct().count() == rows.select("id").distinct().count() == rows.count()
