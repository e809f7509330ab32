"""Spelling by a word list, in the row and by join, and the augmenters that draw words."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bitextra.functions import text as X
from bitextra.operators import augmenters as aug
from bitextra.operators.preprocessors import convert_to_american
from bitextra.operators.spelling import respell

#: An independently written list: British word, American word.
LIST = {
    "colour": "color", "centre": "center", "grey": "gray", "tyre": "tire", "whisky": "whiskey", "lorry": "truck",
    "can't": "cannot", "ქართული": "Georgian", "aeroplane": "airplane",
}
TEXTS = {
    "The colour of the CENTRE is Grey.": "The color of the CENTER is Gray.",
    "colourful colours stay": "colourful colours stay",
    "Lorry, lorry; LORRY!  a\tlorry\n": "Truck, truck; TRUCK!  a\ttruck\n",
    "we can't and Can't": "we cannot and Cannot",
    "ქართული ენა": "Georgian ენა",
    "x1tyre2 tyre's": "x1tire2 tyre's",
    "": "",
    None: None,
}


@pytest.mark.parametrize("most", [100, 2])
def test_word_lists_in_the_row_and_by_join(spark, most):
    rows = [(i, t, "mine") for i, t in enumerate([*TEXTS, *TEXTS])]
    df = spark.createDataFrame(rows, "id long, en string, word string")
    want = [TEXTS[t] for _, t, _ in rows]
    for words in (LIST, spark.createDataFrame([*LIST.items(), (None, "x"), ("Grey", "green")], "word string, to string")):
        out = respell(df, ["en", "absent"], words, most=most, hot_rows=1).orderBy("id").collect()
        assert [r["en"] for r in out] == want and {r["word"] for r in out} == {"mine"}
    assert respell(df.limit(0), ["en"], LIST, most=most).count() == 0


def test_lists_come_before_the_rules(spark):
    df = spark.createDataFrame([("The whisky has a Flavour",)], "en string")
    assert convert_to_american(df, {"dictionary": LIST}).first()["en"] == "The whiskey has a Flavor"
    assert convert_to_american(df, {}).first()["en"] == "The whisky has a Flavor"


def test_the_guard_lets_every_rule_through(spark):
    words = "colour ORGANISE organises analysed CENTRE metres catalogue defence travelled grey tyres programme aluminium jewellery mouse moustache"
    words += " anaesthetic paediatric moulds foetus haemoglobin judgement cheque Chequered manoeuvres Manoeuvring aeroplane Sceptic Ploughs pyjamas"
    words += " enrolment fulfil instalment wilful artefact practised tot colouring"
    df = spark.createDataFrame([(w,) for w in words.split()], "w string")
    chain = F.col("w")
    for pattern, to in X.AMERICAN_RULES:
        chain = F.regexp_replace(chain, pattern, to)
    rows = df.select("w", X.to_american(F.col("w")).alias("new"), chain.alias("plain")).collect()
    assert all(r["new"] == r["plain"] for r in rows)
    assert sum(r["new"] != r["w"] for r in rows) >= 33


def test_word_augmenters(spark):
    df = spark.createDataFrame(
        [(f"r{i}", f"one two  three\tfour {i}", None) for i in range(200)] + [("n", None, "x"), ("e", "", "x")], "id string, en string, ka string"
    ).withColumns({"title": F.lit("t"), "domain": F.lit("d")})
    turned = {r["id"]: r["en"] for r in aug.sentence_reversal(df, {"percentage": 1.0}).collect()}
    assert turned["r7_reversed"] == "7 four three two one" and turned["n_reversed"] is None and turned["e_reversed"] == ""
    params = {"percentage": 1.0, "word_percentage": 0.5, "lexicon": ["A", "B", "C"]}
    first = {r["id"]: r["en"] for r in aug.random_word_replacement(df, params).collect()}
    again = {r["id"]: r["en"] for r in aug.random_word_replacement(df.repartition(5), params).collect()}
    assert first == again and first["n_replaced"] is None
    changed = [w for k, t in first.items() if k[0] == "r" for w in t.split(" ") if w in "ABC"]
    assert 400 < len(changed) < 600 and len(set(changed)) == 3
    assert all(len(t.split(" ")) == 5 for k, t in first.items() if k[0] == "r")
    with pytest.raises(ValueError):
        aug.random_word_replacement(df, {"percentage": 1.0})


def test_numbers_come_from_the_rows(spark):
    df = spark.createDataFrame([("a", "pay 12.50 now or 3", "x"), ("b", "no number", "x"), ("c", None, "x")], "id string, en string, ka string")
    df = df.withColumns({"title": F.lit("t"), "domain": F.lit("d")})
    (row,) = aug.number_copying(df, {"from_rows": True}).collect()
    assert "12.50" in row["en"] and "12.50" in row["ka"] and row["id"] == "number_copy_a"


def test_pairs_are_spread_over_the_cores(spark):
    from bitextra.queries.base import pairs

    counts = pairs(spark, "/root/testdata/sf0.01").groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) >= spark.sparkContext.defaultParallelism
