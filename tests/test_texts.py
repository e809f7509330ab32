"""Golden rows and agreement with Python's own text functions."""

from __future__ import annotations

import html
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from bitextra.functions import constants as K, text as X
from bitextra.operators import augmenters as A, cleaners as C, preprocessors as P
from bitextra.registry import cleaners, preprocessors


def kept(df, name, **params):
    keep = cleaners.get(name)(params)
    return [r["keep"] for r in df.withColumn("keep", keep).orderBy("id").collect()]


def done(df, name, column="en", **params):
    return [r[column] for r in preprocessors.get(name)(df, params).orderBy("id").collect()]


@pytest.mark.parametrize("text,keep", [("", False), (" .,! ", False), ("—", True), ("…", True), ("a.", True), (None, False)])
def test_empty_content(parallel, text, keep):
    assert kept(parallel([("x", text)]), "filter_empty_content") == [keep]


def test_purity(parallel):
    rows = ["ქართული სიახლეები დღეს", "abc ქართ", "abcd ქარ", "Windows და Linux", "2024 წელი", "“ციტატა”", "", None]
    df = parallel([("x", t) for t in rows])
    assert kept(df, "filter_georgian_purity", threshold=0.5) == [True, True, False, False, True, True, False, False]
    assert kept(df, "filter_georgian_purity", threshold=0.1) == [True, False, False, False, True, False, False, False]


def test_shared_latin(parallel):
    df = parallel(
        [
            ("Henry IV ruled", "ჰენრი IV მართავდა"),
            ("He uses Linux", "ის Linux იყენებს"),
            ("He uses it", "ის Linux იყენებს"),
            ("He uses it", "იყენებს Linux."),
            ("mix it", "mix არის"),
        ]
    )
    assert kept(df, "filter_shared_latin_characters") == [True, True, False, True, True]
    reduced = X.without_trailing_latin(X.without_roman_numerals(F.lower("ka")))
    got = [r[0] for r in df.orderBy("id").select(reduced).collect()]
    assert got == ["ჰენრი  მართავდა", "ის linux იყენებს", "ის linux იყენებს", "იყენებს.", "არის"]


def test_lengths_and_ratio(parallel):
    df = parallel([("12345", "12345"), (" 1234 ", "12345"), ("1", "12345"), ("", "1"), ("123", "1"), ("1234", "1"), (None, "1")])
    assert kept(df, "filter_minimum_length") == [True, False, False, False, False, False, False]
    assert kept(df, "filter_length_ratio") == [True, True, False, False, True, False, False]


def test_sample_table(sample):
    names = {r[0] for r in sample.select(P.id_parts(F.col("id"))["dataset_name"]).distinct().collect()}
    assert names == {"met", "road", "kitchen", "manual", "rail"}
    assert sample.where(C.in_domain("traffic")).count() == 2 and sample.where(C.in_dataset("met")).count() == 2
    dropped = sample.where(~C.filter_empty_content({})).select("id").collect()
    assert [r[0] for r in dropped] == ["road_notes_b"]


def test_id_parts(spark):
    df = spark.createDataFrame([("met_daily_07_b",), ("plain",)], "id string")
    rows = [tuple(r[0]) for r in df.select(P.id_parts(F.col("id"))).collect()]
    assert rows == [("met", "daily_07_b", "met_daily_07_b"), ("plain", "", "plain")]


GOLDEN = {
    "remove_extra_whitespaces": [("  a   b ", "a b"), ("a\n\n\nb", "a\nb"), ("a\t\tb", "a b"), ("a \t b", "a   b"), ("\xa0a\xa0", "a")],
    "remove_brackets_content": [("a (note) b", "a b"), ("(a(b)c)", "c)"), ("keep [x] (y)", "keep [x]"), ("a () b", "a b")],
    "fix_encoding_issues": [
        ("donâ€™t", "don't"), ("cafÃ©", "café"), ("waitâ€¦", "wait¦"), ("a&nbsp;&amp;b", "a &b"), ("&amp;lt;", "<"),
        ("&amp;nbsp;", "&nbsp;"), ("A​B", "AB"), ("10Â°", "10°"),
    ],
    "remove_html_tags": [
        ('<p class="x">Hi&nbsp;there</p>', "Hi there"), ("2 < 3 and 4 > 1", "2 < 3 and 4 > 1"), ("<br/>a<BR>b", "a b"),
        ("&amp;lt;b&gt;", "&lt;b>"), ("<my-tag>x</my-tag>", "<my-tag>x</my-tag>"), ("<!-- c -->y", "<!-- c -->y"),
        ("&#8364;&#x41;&eacute", "€Aé"),
    ],
    "convert_to_american": [
        ("colour", "color"), ("realise", "realize"), ("centre", "center"), ("The  Colours, travelled.", "The Colors, traveled."),
        ("exercise precise wise", "exercise precise wise"), ("GREY", "GREY"), ("catalogue defence", "catalog defense"),
    ],
    "normalize_characters": [("a–b—c „q“ …", 'a-b-c "q“ ...')],
    "lowercase_english": [("ABC", "abc")],
}


@pytest.mark.parametrize("name", GOLDEN)
def test_preprocessor_golden_rows(parallel, name):
    rows = GOLDEN[name]
    df = parallel([(None, "k", a, "d", f"{i:03d}") for i, (a, _) in enumerate(rows)])
    assert done(df, name) == [b for _, b in rows]


def test_null_stays_null(parallel):
    df = parallel([(None, None, None, "d", "1")])
    for name in preprocessors.names():
        row = preprocessors.get(name)(df, {}).first()
        assert (row["en"], row["ka"]) == (None, None), name


PUNCTUATION = [
    ("Hello.", "გამარჯობა", ("Hello.", "გამარჯობა."), ("Hello.", "გამარჯობა.")),
    ("Hello", "გამარჯობა!", ("Hello!", "გამარჯობა!"), ("Hello!", "გამარჯობა!")),
    ("Really?", "მართლა.", ("Really?", "მართლა?"), ("Really.", "მართლა.")),
    ('He said "yes."', 'მან თქვა "კი"', ('He said "yes."', 'მან თქვა "კი."'), ('He said "yes."', 'მან თქვა "კი."')),
    ("none", "არა", ("none", "არა"), ("none", "არა")),
    ("'Wait... '", "მოიცა", ("'Wait... '", "მოიცა."), ("'Wait... '", "მოიცა.")),
]


@pytest.mark.parametrize("prefer,at", [("en", 2), ("ka", 3)])
def test_sync_punctuation(parallel, prefer, at):
    df = parallel([(None, r[1], r[0], "d", str(i)) for i, r in enumerate(PUNCTUATION)])
    out = preprocessors.get("sync_punctuation")(df, {"prefer": prefer}).orderBy("id").collect()
    assert [(r["en"], r["ka"]) for r in out] == [r[at] for r in PUNCTUATION]


def test_brackets_only_in_some_domains(parallel):
    df = parallel([(None, "k", "a (b)", "x", "1"), (None, "k", "a (b)", "y", "2")])
    assert done(df, "remove_brackets_content", domains=["x"]) == ["a", "a (b)"]


def test_informal_style(spark):
    df = spark.createDataFrame([("I am sure that it is late and you are tired",)], "t string")
    assert df.select(A.informal(F.col("t"))).first()[0] == "I'm sure that it's late & you're tired"


# --- properties ---------------------------------------------------------------------------

ALPHABET = "aB é.,!?'\"()[]<>&;#\t\n\r\x0b\x1c\x1f\x85\xa0 ​ა–…`x9_"
TEXTS = st.lists(st.text(ALPHABET, max_size=30), min_size=1, max_size=60)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


@SLOW
@given(TEXTS)
def test_like_python(spark, texts):
    assert column(spark, texts, X.strip) == [t.strip() for t in texts]
    assert column(spark, texts, X.words) == [t.split() for t in texts]
    assert column(spark, texts, X.space_tokens) == [t.strip().split(" ") for t in texts]
    assert column(spark, texts, X.collapse_ws) == [re.sub(r"\s+", " ", t).strip() for t in texts]
    tag = re.compile(r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*?)?/?>")
    plain = [re.sub(r"\s+", " ", html.unescape(tag.sub(" ", t))).strip() for t in texts]
    assert column(spark, texts, X.strip_html) == plain


@SLOW
@given(TEXTS)
def test_idempotent(spark, texts):
    for fn in (X.normalize, F.lower, lambda c: X.drop_brackets(c, list(K.BRACKETS)), X.to_american):
        once = column(spark, texts, fn)
        assert column(spark, once, fn) == once


@SLOW
@given(TEXTS)
def test_noise_changes_length_by_at_most_one(spark, parallel, texts):
    df = parallel([(None, "k", t, "d", f"r{i}") for i, t in enumerate(texts)])
    out = A.synthetic_noise(df, {"percentage": 1.0}).collect()
    assert len(out) == len(texts)
    for r in out:
        source = texts[int(r["id"].removesuffix("_synthetic_noise")[1:])]
        assert abs(len(r["en"]) - len(source)) <= 1


def test_more_american_spellings(spark):
    british = "Cheque manoeuvre aeroplane sceptical plough foetus haemoglobin pyjamas judgement enrolment artefact skilful practise fulfilled Tyre tyre"
    american = "Check maneuver airplane skeptical plow fetus hemoglobin pajamas judgment enrollment artifact skillful practice fulfilled Tyre tire"
    df = spark.createDataFrame([(british,)], "t string")
    assert df.select(X.to_american(F.col("t"))).first()[0] == american
