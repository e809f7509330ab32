"""Operators against brute force, with hot keys and small cells forced."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bitextra.functions import arrays as A
from bitextra.functions.arrays import ngrams
from bitextra.operators import augmenters as aug, contamination as C, dedup, encoding as E, lookup as L, metrics as M
from bitextra.operators import mining as M2, preprocessors as P2
from bitextra.operators import profile
from bitextra.operators import sampling as S, scoring, trainlog
from bitextra.operators.profile import most_frequent
from bitextra.plans import evaluate as evaluate_plan, preprocess as preprocess_plan
from bitextra.plans.spec import Step


def numbers(spark, n=500, seed=1):
    rnd = random.Random(seed)
    rows = [(i, "hot" if rnd.random() < 0.4 else f"g{rnd.randint(0, 9)}") for i in rnd.sample(range(10_000), n)]
    return rows, spark.createDataFrame(rows, "pos long, g string").repartition(7)


@pytest.mark.parametrize("width", [3, 100, 1 << 17])
def test_dense_index(spark, width):
    rows, df = numbers(spark)
    got = {r["pos"]: (r["i"], r["k"]) for r in L.dense_index(L.dense_index(df, ["pos"], None, "i", width), ["pos"], ["g"], "k", width).collect()}
    whole = {p: i for i, (p, _) in enumerate(sorted(rows))}
    seen, inside = Counter(), {}
    for p, g in sorted(rows):
        inside[p] = seen[g]
        seen[g] += 1
    assert got == {p: (whole[p], inside[p]) for p, _ in rows}


def test_row_index_by_text(spark):
    rows, df = numbers(spark)
    got = {r["key"]: r["idx"] for r in L.row_index(df.select(F.concat("g", F.lit("-"), "pos").alias("key")), ["key"]).collect()}
    assert got == {k: i for i, k in enumerate(sorted(f"{g}-{p}" for p, g in rows))}


def test_row_index_in_groups_by_several_keys(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), float(rnd.randrange(5)) if i % 9 else None, f"k{i:03d}", f"text {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x double, k string, text string").repartition(5)
    got = {r["k"]: (r["idx"], r["text"]) for r in L.row_index(df, ["x", "k"], group=["g"]).collect()}
    seen = Counter()
    for g, _, k, text in sorted(rows, key=lambda r: (r[1] is not None, r[1], r[2])):
        assert got[k] == (seen[g], text)
        seen[g] += 1


def test_row_index_numbers_ties_once(spark):
    df = spark.createDataFrame([("a", i, f"t{i}") for i in range(30)] + [(None, 0, "n"), ("b", 0, "n")], "k string, i int, text string")
    got = [(r["idx"], r["k"]) for r in L.row_index(df.repartition(3), ["k"]).collect()]
    assert sorted(i for i, _ in got) == list(range(32)) and dict(got)[0] is None and dict(got)[31] == "b"
    assert L.row_index(df.limit(0), ["k"]).count() == 0


def test_a_run_ordered_by_time_spreads_over_tasks(spark):
    df = spark.range(200_000).selectExpr("id % 1 AS run", "timestamp_seconds(id) AS ts", "id", "double(id) AS m")
    index = L.row_index(df, ["ts", "id"], "i", ["run"], ["m"])
    assert index.where("i <> id").count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = L.row_index(df, ["ts", "id"], "i", ["run"], ["m"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 150_000


@pytest.mark.parametrize("hot_rows", [1, 5, 50, 1000])
def test_attach_and_duplicates_with_hot_keys(spark, hot_rows):
    rows, df = numbers(spark)
    copies = df.groupBy("g").agg(F.count("*").alias("n"))
    out = L.attach(df, copies, "g", "n", F.col("pos"), hot_rows).collect()
    counts = Counter(g for _, g in rows)
    assert Counter((r["pos"], r["g"], r["n"]) for r in out) == Counter((p, g, counts[g]) for p, g in rows)
    first = {}
    for p, g in sorted(rows):
        first.setdefault(g, p)
    kept = dedup.drop_duplicates(df, ["g"], "pos").collect()
    assert {(r["g"], r["pos"]) for r in kept} == set(first.items()) and len(kept) == len(first)
    assert dedup.list_duplicates(df, ["g"], "pos").count() == len(rows) - len(first)


def test_attach_keeps_rows_without_match(spark):
    rows, df = numbers(spark)
    table = spark.createDataFrame([("hot", 300)], "g string, n long")
    out = L.attach(df, table, "g", "n", F.col("pos"), 10)
    assert out.count() == len(rows) and out.where("n is null").count() == sum(g != "hot" for _, g in rows)


def _order(seed, p):
    return hashlib.md5(f"{seed}|{p}".encode()).hexdigest(), p


@pytest.mark.parametrize("partitions", [1, 13])
def test_samples_are_exact_and_do_not_depend_on_partitions(spark, partitions):
    rows, df = numbers(spark)
    df = df.repartition(partitions)
    ranked = sorted((p for p, _ in rows), key=lambda p: _order(42, p))
    assert {r["pos"] for r in S.sample_rows(df, 37, ["pos"]).collect()} == set(ranked[:37])
    assert {r["pos"] for r in S.sample_percentage(df, 20, ["pos"]).collect()} == set(ranked[:100])
    got = {r["pos"]: r["_rank"] for r in S.sample_ranked(df, S.exactly(41), ["pos"], 42).collect()}
    assert got == {p: i for i, p in enumerate(ranked[:41])}
    assert S.sample_rows(df, 0, ["pos"]).count() == 0 and S.sample_rows(df, 10**6, ["pos"]).count() == len(rows)
    by_group = {}
    for p, g in rows:
        by_group.setdefault(g, []).append(p)
    want = set()
    for ps in by_group.values():
        n = min(len(ps), max(10, int(len(ps) * 30 / 100)))
        want |= set(sorted(ps, key=lambda p: _order(42, p))[:n])
    assert {r["pos"] for r in S.sample_stratified(df, 30, ["pos"], strata="g").collect()} == want


def corpus(spark, copies=60):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    base = [" ".join(word() for _ in range(60)) for _ in range(30)]
    rows = [(f"r{i}", t, f"ka {t}") for i, t in enumerate(base)]
    rows += [(f"c{i}", base[0], f"ka {base[0]}") for i in range(copies)]  # a hot text
    for i in range(copies):  # near copies share bands with base[1]
        w = base[1].split()
        w[i % len(w)] = word()
        rows.append((f"n{i}", " ".join(w), f"ka {base[1]}"))
    return spark.createDataFrame(rows, "id string, en string, ka string").repartition(5)


def _signature(text, n):
    out = []
    for a, b in C.coefficients(n):
        out.append(min((a * int(hashlib.md5(w.encode()).hexdigest()[:7], 16) + b) % 2_147_483_647 for w in set(text.split())))
    return out


@pytest.mark.parametrize("hot_rows", [2, 10_000])
def test_contamination_with_hot_texts_and_bands(spark, hot_rows):
    df = corpus(spark)
    source = df.where("id in ('r0', 'r1', 'r2')")
    target = df.where("id not in ('r0', 'r1', 'r2')")
    flagged = {r["id"]: (r["is_exact"], r["is_near"]) for r in C.flag_contamination(source, target, hot_rows=hot_rows).collect()}
    b, r = C._shape(0.9, 128)
    bands = lambda row: {(j, tuple(_signature(f"{row['en']} {row['ka']}", b * r)[j * r : j * r + r])) for j in range(b)}
    protected = set().union(*[bands(x) for x in source.collect()])
    texts = {(x["en"], x["ka"]) for x in source.collect()}
    want = {x["id"]: ((x["en"], x["ka"]) in texts, bool(bands(x) & protected)) for x in target.collect()}
    assert flagged == want
    assert any(n and not e for e, n in want.values()) and sum(e for e, _ in want.values()) == 60


def test_band_shapes_and_algorithms(spark):
    assert C.band_shape(0.9, 128) == (5, 25) and C.band_shape(0.85, 256) == (13, 19)
    df = corpus(spark, 2)
    with pytest.raises(ValueError):
        C.flag_contamination(df, df, {"near_duplicate": {"algorithm": "other"}})


@pytest.mark.parametrize("min_delta", [0.0, 0.4])
@pytest.mark.parametrize("greater", [True, False])
def test_early_stopping(spark, min_delta, greater):
    rnd = random.Random(5)
    rows = [(run, i, rnd.random()) for run in ("a", "b", "c") for i in range(40)] + [("d", i, float(i)) for i in range(30)]
    out = trainlog.early_stopping(
        spark.createDataFrame(rows, "run string, step long, m double").repartition(6),
        "run", ["step"], "m", patience=3, greater_is_better=greater, min_delta=min_delta, cell=7,
    )
    for r in out.collect():
        best, wait, stop = None, 0, None
        for _, i, m in sorted(x for x in rows if x[0] == r["run"]):
            v = m if greater else -m
            if best is None or v > best + min_delta:
                best, wait = v, 0
            else:
                wait += 1
            if wait >= 3 and stop is None:
                stop = i
        assert r["stop_index"] == stop, r


@pytest.mark.parametrize("min_delta", [0.0, 0.05])
def test_early_stopping_by_time(spark, min_delta):
    rnd = random.Random(6)
    rows = [(run, i // 3, f"e{i:03d}", rnd.random() if i % 11 else None) for run in ("a", None) for i in range(60)]
    out = trainlog.early_stopping(
        spark.createDataFrame(rows, "run string, at long, event string, m double").selectExpr("run", "timestamp_seconds(at) AS at", "event", "m"),
        "run", ["at", "event"], "m", patience=4, min_delta=min_delta, cell=5,
    )
    got = {r["run"]: (r["evaluations"], r["stop_index"], r["best"]) for r in out.collect()}
    for run in ("a", None):
        ms = [m for r, _, _, m in sorted((x for x in rows if x[0] == run), key=lambda x: x[2]) if m is not None]
        best, wait, stop = None, 0, None
        for i, m in enumerate(ms):
            best, wait = (m, 0) if best is None or -m > -best + min_delta else (best, wait + 1)
            stop = i if wait >= 4 and stop is None else stop
        assert got[run] == (len(ms), stop, min(ms))


def test_concatenation_and_restructure(spark, parallel):
    df = parallel([(None, f"k{i}", f"e{i}", "d", f"r{i:04d}") for i in range(300)])
    one = aug.sentence_concatenation(df, {"percentage": 0.5, "min_n": 2, "max_n": 4}).collect()
    two = aug.sentence_concatenation(df.repartition(9), {"percentage": 0.5, "min_n": 2, "max_n": 4}).collect()
    assert Counter(one) == Counter(two) and 90 < len(one) < 210
    for r in one:
        start, n = int(r["id"][1:5]), int(r["id"].split("concat")[1])
        assert r["en"] == " ".join(f"e{i}" for i in range(start, start + n)) and (n in (2, 3, 4) or start + n == 300)
    for strategy in ("consecutive", "random"):
        out = aug.restructure_to_longer_texts(df, {"concatenation_ratio": 0.4, "strategy": strategy}).collect()
        merged = [r for r in out if r["id"].startswith("restructured_")]
        sizes = [len(r["en"].split()) for r in merged]
        assert merged and all(2 <= n <= 4 for n in sizes) and sum(sizes) <= 120
        assert sorted(w for r in out for w in r["en"].split()) == sorted(f"e{i}" for i in range(300))
        if strategy == "consecutive":
            for r in merged:
                at = [int(w[1:]) for w in r["en"].split()]
                assert at == list(range(at[0], at[0] + len(at)))
    three = parallel([(None, "k", t, "d", str(i)) for i, t in enumerate(["Hello.", "How are you?", "Fine."])])
    whole = aug.restructure_to_longer_texts(three, {"concatenation_ratio": 1.0, "min_group_size": 3, "max_group_size": 3})
    assert [(r["id"], r["en"]) for r in whole.collect()] == [("restructured_0_1_2", "Hello. How are you? Fine.")]


def test_concatenation_reaches_beyond_a_block(spark):
    df = spark.range(6000).select(
        F.lit(None).cast("string").alias("title"), F.lit("k").alias("ka"), F.concat(F.lit("e"), "id").alias("en"), F.lit("d").alias("domain"),
        F.format_string("r%05d", "id").alias("id"),
    )
    out = aug.sentence_concatenation(df, {"percentage": 0.01, "min_n": 5000, "max_n": 5000}).select("id", F.size(F.split("en", " ")).alias("n")).collect()
    assert len(out) > 20 and any(int(r["id"][1:6]) < 1000 for r in out)
    assert all(r["n"] == min(5000, 6000 - int(r["id"][1:6])) for r in out)


@pytest.mark.parametrize("ratio", [0.2, 0.4, 0.9, 1.0])
@pytest.mark.parametrize("n", [3, 2001])
def test_restructure_spends_its_budget(spark, ratio, n):
    df = spark.range(n).select(F.lit("k").alias("ka"), F.concat(F.lit("e"), "id").alias("en"), F.format_string("r%05d", "id").alias("id"))
    out = aug.restructure_to_longer_texts(df, {"concatenation_ratio": ratio}).collect()
    sizes = [len(r["en"].split()) for r in out if r["id"].startswith("restructured_")]
    # a lone last row cannot be merged
    most = min(int(n * ratio), n - (n % 4 == 1))
    assert most - 2 < sum(sizes) <= most and all(2 <= s <= 4 for s in sizes)
    assert sorted(w for r in out for w in r["en"].split()) == sorted(f"e{i}" for i in range(n))


def test_restructure_leaves_small_tables_alone(parallel):
    df = parallel([("a", "b")])
    assert aug.restructure_to_longer_texts(df, {}).collect() == df.collect()


def test_generated_rows_have_the_input_columns(spark, parallel):
    df = parallel([("an example", "ტექსტი"), ("b", "კი")]).withColumn("extra", F.lit(1))
    for name in ("number_copying", "georgian_text_copying"):
        out = getattr(aug, name)(df, {"num_examples": 1})
        assert out.columns == df.columns and out.first()["extra"] is None
    assert [r["en"] for r in aug.georgian_text_copying(df, {"num_examples": 9}).collect()] == ["ტექსტი"]


def test_bleu_by_hand(spark):
    ref = "the cat sat on the mat"
    rows = [("1", "the cat sat on the mat today", ref), ("2", "the cat sat on the", ref), ("3", "", ref), ("4", ref, ref), ("5", "cat", "")]
    df = spark.createDataFrame(rows, "id string, prediction string, reference string")
    got = {r["id"]: round(r["bleu_score"], 6) for r in M.sentence_scores(df, families=("bleu",)).collect()}
    assert got == {"1": 80.910671, "2": 81.873075, "3": 0.0, "4": 100.0, "5": 0.0}
    perfect = M.corpus_scores(df.where("id = 4")).first()
    assert round(perfect["bleu"], 6) == 100.0 and round(perfect["chrf"], 6) == 100.0


def _overlap(h, r, n):
    grams = lambda x: Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1))
    a, b = grams(h), grams(r)
    return [sum((a & b).values()), a.total(), b.total()]


def test_ngram_overlap_against_counters():
    rnd = random.Random(9)
    for _ in range(50):
        h, r = (rnd.choices("abcდ", k=rnd.randint(0, 30)) for _ in range(2))
        want = [x for n in range(1, 7) for x in _overlap(h, r, n)]
        assert M.ngram_overlap(h, r, 6) == want == M.ngram_overlap("".join(h), "".join(r), 6)


def test_ngram_overlap_of_ends_blanks_and_rich_alphabets():
    rnd = random.Random(10)
    rich = [chr(i) for i in range(0x4E00, 0x4E00 + 1500)] + ["😀"]
    for letters, most in (("ab", 7), (rich, 3000)):  # the second needs more than 64 bits
        for _ in range(5):
            h, r = (rnd.choices(letters, k=rnd.randint(0, most)) for _ in range(2))
            want = [x for n in range(1, 7) for x in _overlap(h, r, n)]
            assert M.ngram_overlap(h, r, 6) == want == M.ngram_overlap("".join(h), "".join(r), 6)
    # blanks are those of the SQL, no-break and Georgian texts' wide ones included
    assert M.tokenize_13a("a\u00a0b. 3.5,x\u2003-\nc&amp;d 7-8") == ["a", "b", ".", "3.5", ",", "x", "c", "&", "d", "7", "-", "8"]
    assert M.chrf_words("(a) b\u3000!! x") == ["(a", ")", "b", "!", "!", "x"] and M.chrf_chars("a\x1cb\u2028 c") == "abc"


def test_scores_of_groups_and_total_count_ngrams_once(spark):
    rows = [("1", "x", "a b c d", "a b c d"), ("2", None, "a b c e", "a b q e"), ("3", "y", "k l m n o", "k l m n")]
    df = spark.createDataFrame(rows, "id string, domain string, reference string, prediction string")
    out = M.corpus_scores(df, by=["domain"], total=True)
    assert "ArrowEvalPython" not in out._jdf.queryExecution().executedPlan().toString()
    got = Counter((r["domain"], round(r["bleu"], 6), round(r["chrf"], 6)) for r in out.collect())
    want = M.corpus_scores(df, by=["domain"]).collect() + [{"domain": None, **M.corpus_scores(df).first().asDict()}]
    assert got == Counter((r["domain"], round(r["bleu"], 6), round(r["chrf"], 6)) for r in want)
    assert M.corpus_scores(df.limit(0), by=["domain"], total=True).count() == 1


def test_combined_evaluator(spark):
    df = spark.createDataFrame([("1", "s", "a b c d", "a b c d")], "id string, source string, reference string, prediction string")
    M.evaluators("always_fails", "for tests")(lambda df, params: 1 / 0)
    out = M.evaluate(df, [{"name": "sacrebleu"}, {"name": "chrf", "config": {"word_order": 2}}, {"name": "always_fails"}])
    assert round(out["sacrebleu"], 3) == round(out["chrf++"], 3) == 100.0 and "division" in out["always_fails_error"]


def test_encoding_round_trip(spark, parallel):
    df = parallel([("a b c", "x y"), ("a b", "x"), ("", None), ("a " * 200, "z")])
    vocabulary = E.fit_vocabulary(df, 100)
    out = E.words_tokenizer(df, {"vocabulary": vocabulary, "max_length": 8})
    assert all(len(r[c]) == 8 for r in out.collect() for c in ("input_ids", "attention_mask", "labels"))
    back = {r["id"]: r["text"] for r in E.decode(out, "input_ids", vocabulary).collect()}
    assert back == {"set_0": "a b c", "set_1": "a b", "set_2": "", "set_3": " ".join("a" * 8)}


def test_most_frequent(spark):
    rnd = random.Random(2)
    rows = [(f"w{i}", rnd.choice([1, 1, 1, 2, 3, 50])) for i in range(400)]
    df = spark.createDataFrame(rows, "word string, n long").repartition(5)
    ranked = sorted(rows, key=lambda r: (-r[1], r[0]))
    for size in (1, 60, 150, 399, 1000):
        assert [tuple(r) for r in most_frequent(df, size, "word", "n").select("word", "n").collect()] == ranked[:size]


def test_label_shifts(spark):
    rows = [([2, 7, 8, 3, -100], [1, 1, 1, 1, 0]), ([7, 8, 3, -100, -100], [1, 1, 1, 0, 0])]
    df = spark.createDataFrame(rows, "labels array<int>, decoder_attention_mask array<int>")
    out = E.shift_for_decoder(df).collect()
    assert out[0]["labels"] == [7, 8, 3, -100, -100] and out[0]["decoder_attention_mask"] == [1, 1, 1, 0, 0]
    assert out[1]["labels"] == rows[1][0] and out[0]["decoder_input_ids"] == [2, 7, 8, 3, 0]
    ids = spark.createDataFrame([([7, 4, 0, 0], [5, 6, 0, 0]), ([2, 7, 8, 9], [2, 5, 0, 0]), ([0, 0], [0, 0])], "input_ids array<int>, labels array<int>")
    framed = E.frame_sequences(ids).collect()
    assert framed[0]["input_ids"] == [2, 7, 3, 0] and framed[0]["labels"] == [2, 5, 6, 0]
    assert framed[1]["input_ids"] == [2, 7, 8, 3] and framed[1]["labels"] == [2, 5, 0, 0]
    assert framed[2]["input_ids"] == [2, 3]
    tag = ids.select(A.set_language_tag(F.col("labels"), 0, 99).alias("x")).collect()
    assert [r["x"] for r in tag] == [[99, 6, 0, 0], [99, 5, 0, 0], [0, 0]]


def test_scorer_failures(spark, parallel):
    df = parallel([("a", "b")] * 5)

    def broken():
        def score(columns):
            raise RuntimeError("no model")

        return score

    assert [r["score"] for r in scoring.score_rows(df, broken, ["en"], name="score").collect()] == [None] * 5
    with pytest.raises(Exception, match="no model"):
        scoring.score_rows(df, broken, ["en"], on_error="fail").collect()


def test_duplicates_with_equal_and_null_ids(spark):
    rows = [(None, "a", "x")] * 3 + [("1", "a", "x"), ("1", "a", "y"), ("1", "b", "x"), ("1", "b", "x"), ("2", "c", None)]
    df = spark.createDataFrame(rows, "id string, en string, ka string")
    groups = {(en, ka) for _, en, ka in rows}
    kept = dedup.drop_duplicates(df, ["en", "ka"], "id").collect()
    assert len(kept) == len(groups) and {(r["en"], r["ka"]) for r in kept} == groups
    marked = dedup.mark_duplicates(df, ["en", "ka"], "id", "later").collect()
    assert Counter((r["id"], r["en"], r["ka"]) for r in marked) == Counter(rows)
    assert Counter((r["en"], r["ka"]) for r in marked if not r["later"]) == Counter(groups)


@pytest.mark.parametrize("small", [200_000, 2])
def test_encoding_with_repeated_and_null_ids(spark, monkeypatch, small):
    """Rows with one id stay apart, by lookup within rows and by join alike."""
    monkeypatch.setattr(E, "BROADCAST_VOCABULARY", small)
    rows = [("a", "x y z"), ("a", "y"), ("a", "y"), (None, "z <s> q"), (None, None)]
    df = spark.createDataFrame(rows, "id string, en string")
    vocabulary = spark.createDataFrame([("x", 5), ("y", 6), ("z", 7)], "token string, token_id int")
    done = E.encode(df, vocabulary, {"s": F.col("en")}, max_length=3)
    want = [("a", (5, 6, 7)), ("a", (6, 0, 0)), ("a", (6, 0, 0)), (None, (7, 2, 1)), (None, (0, 0, 0))]
    assert Counter((r["id"], tuple(r["s_ids"])) for r in done.collect()) == Counter(want)
    back = E.decode(done, "s_ids", vocabulary).collect()
    assert Counter((r["id"], r["text"]) for r in back) == Counter([("a", "x y z"), ("a", "y"), ("a", "y"), (None, "z <unk>"), (None, "")])


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_language_model_equals_spark_ml_and_ignores_null_texts(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import HashingTF, StringIndexer
    from pyspark.ml.functions import vector_to_array

    rnd = random.Random(4)
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 40))) for letters in ("abcd é", "abxy 😀", "დეabc ") for _ in range(12)]
    rows = [(i, t, [None, "en", "ka"][i // 12]) for i, t in enumerate(texts)]
    grams = [[t[i : i + n] if n == 1 else " ".join(t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)] or [""] for t in map(str.lower, texts)]
    ml = spark.createDataFrame([(*r, g) for r, g in zip(rows, grams)], "id int, text string, lang string, grams array<string>")
    ml = StringIndexer(inputCol="lang", outputCol="label", handleInvalid="keep", stringOrderType="alphabetAsc").fit(ml).transform(ml)
    ml = HashingTF(numFeatures=1 << 14, inputCol="grams", outputCol="features").transform(ml)
    want = {
        r["id"]: (["en", "ka", None][int(r["prediction"])], round(r["p"], 9))
        for r in NaiveBayes().fit(ml).transform(ml).withColumn("p", F.array_max(vector_to_array("probability"))).collect()
        if texts[r["id"]].strip()
    }
    df = spark.createDataFrame([*rows, (99, None, "en"), (98, " ", "ka")], "id int, text string, lang string")
    found = {r["id"]: (r["detected_lang"], round(r["confidence"], 9)) for r in M2.detect_language(M2.language_model(df.where("id != 98")), df).collect()}
    blank = {i: ("unknown", 0.0) for i in found if i > 90 or not texts[i].strip()}
    assert found == {**want, **blank}


def test_terms_are_counted_once(spark):
    df = spark.createDataFrame([(1, "red red fox"), (2, "red hen"), (3, None)], "id int, t string")
    rows = M2.tfidf_rows(df, "id", F.col("t"), 3)
    assert "regexp_extract_all" not in _plan(rows)
    assert {r["id"]: [e["term"] for e in r["entries"]] for r in rows.collect()} == {1: ["red", "fox"], 2: ["red", "hen"], 3: []}


def test_terms_of_a_batch_are_counted_and_weighed_in_pieces(spark, monkeypatch):
    """A task holds the words of a piece, not of an Arrow batch; pieces change no count."""
    texts = ["red the fox x red", "", None, "of", "hen 12 a_b", "ფოქსი red ა é éé"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").coalesce(1)
    want = {}
    for i, t in enumerate(texts):
        kept = [w for w in (t or "").split() if len(w) > 1 and w not in ("the", "of")]
        want[i] = {w: kept.count(w) for w in kept}
    joined = pa.array([(t or "") for t in texts])
    for size in (1, 16, 1 << 20):
        monkeypatch.setattr(M2, "PIECE", size)
        counted = M2._counted.func(joined)
        got = [dict(zip(c["words"].split(), np.frombuffer(c["tf"], np.int32).tolist())) for c in counted.to_pylist()]
        assert got == list(want.values())
        sums = pa.Table.from_batches(M2._term_sums([pa.RecordBatch.from_arrays([counted.field("words"), counted.field("tf")], names=["w", "n"])]))
        red = [(n, d) for t, n, d in zip(*(sums.column(c).to_pylist() for c in ("term", "n", "df"))) if t == "red"]
        assert (sum(n for n, _ in red), sum(d for _, d in red)) == (9, 6)
    monkeypatch.undo()
    many = pa.array([" ".join(f"w{j % 97}" for j in range(600))] * 5000)
    tracemalloc.start()
    M2._counted.func(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20
    flat = {(r["id"], r["term"], r["feature"], round(r["weight"], 9)) for r in M2.tfidf(df, "id", F.col("t"), 4).collect()}
    rows = M2.tfidf_rows(df, "id", F.col("t"), 4).collect()
    assert flat == {(r["id"], e["term"], e["feature"], round(e["weight"], 9)) for r in rows for e in r["entries"]}
    assert len(rows) == len(texts) and {t for _, t, *_ in flat} == {"red", "12", "a_b", "fox"}
    packed = {r["id"]: (np.frombuffer(r["entries"]["feature"], np.int32).tolist(), np.frombuffer(r["entries"]["weight"])) for r in M2.tfidf_rows(df, "id", F.col("t"), 4, pack=True).collect()}
    for r in rows:
        assert packed[r["id"]][0] == [e["feature"] for e in r["entries"]]
        assert packed[r["id"]][1] == pytest.approx([e["weight"] for e in r["entries"]])


def test_changed_rows_run_the_step_once(spark, parallel):
    left = parallel([("the colour", "a", "b", "c", "x"), ("plain", "a", "b", "c", "y")]).select("title", "ka", "en", "domain", "id")
    df = left.join(spark.createDataFrame([("x",), ("y",)], "id string").hint("merge"), "id")
    df = df.withColumn("en", F.when(F.col("id") == "x", "the colour").otherwise("plain"))
    out = preprocess_plan.changed_rows(df, Step("convert_to_american"))
    assert _plan(out).count("RLIKE") == 1
    assert [(r["en_before"], r["en_after"], r["id"]) for r in out.collect()] == [("the colour", "the color", "x")]


def test_profile_counts_words_once(spark, parallel):
    df = parallel([("a b c d a b c d", "k l"), ("a b", None), ("", "m")]).withColumn("dataset", F.lit("d"))
    tables = evaluate_plan.profile(df, "text")
    for name in ("words", "word_lengths", "edges", "longest", "zipf"):
        assert "word-counts" in _plan(tables[name]) and "Generate explode" not in _plan(tables[name])
    assert tables["words"].where("lang = 'en' and word = 'a'").first()["count"] == 3
    grams = {r["ngram"]: r["count"] for r in tables["fourgrams"].where("lang = 'en'").collect()}
    assert grams == {"a b c d": 2, "b c d a": 1, "c d a b": 1, "d a b c": 1}
    one = spark.createDataFrame([([],), (["x"],), (["x", "y", "z"],)], "t array<string>").select(ngrams("t", 3).alias("g"))
    assert [r["g"] for r in one.collect()] == [[], [], ["x y z"]]


@pytest.mark.parametrize("places", [1, 3, 4096])
def test_top_ngrams_count_one_by_one_only_what_can_be_among_them(spark, parallel, monkeypatch, places):
    """Exact with ties, empty tokens and few n-grams, however few places are counted first; a frequent n-gram needs no count of the rare ones."""
    rnd = random.Random(2)
    texts = ["", "one", " a  b a  b ", "ü é ü é", None, *(" ".join(rnd.choices("abcdefgh", k=rnd.randint(0, 12))) for _ in range(80))]
    df = parallel([(t, rnd.choice(texts)) for t in texts]).repartition(3)
    monkeypatch.setattr(profile, "PLACES", places)
    monkeypatch.setattr(profile, "PIECE", 64)
    shared = profile.frequent_ngrams(df, [2, 3, 4], 7)
    for n in (2, 3, 4):
        for counts in (None, shared):
            got = {(r["lang"], r["rank"]): (r["ngram"], r["count"]) for r in profile.top_ngrams(df, n, 7, counts).collect()}
            every = {(r["lang"], r["ngram"]): r["count"] for r in profile.ngram_counts(df, n).collect()}
            for lang in ("ka", "en"):
                best = sorted((-c, g.encode()) for (x, g), c in every.items() if x == lang)[:7]
                assert [got.pop((lang, i + 1)) for i in range(len(best))] == [(g.decode(), -c) for c, g in best]
            assert not got
    long = parallel([("the same words " * 40 + " ".join(f"w{i}" for i in range(500)), "x")])
    counted = profile.frequent_ngrams(long, [2], 3)
    assert counted.count() < 600 and profile.top_ngrams(long, 2, 3, counted).count() == 3
    if places < 4096:
        assert counted.where("lang = 'en'").count() < 10


def test_characters_words_and_digits_are_counted(spark, parallel):
    rows = [("a b  é 😀 12345 6", "აბ 12 ٣٤"), ("", None), (None, "a\u0000 b"), (" 1234 123456789 b", "x")] * 3
    df = parallel(rows)
    texts = [(lang, t) for en, ka in rows for lang, t in (("en", en), ("ka", ka)) if t is not None]
    assert {(r["lang"], r["char"]): r["count"] for r in profile.char_counts(df).collect()} == Counter((x, c) for x, t in texts for c in t)
    want = Counter((x, w) for x, t in texts for w in t.strip(" ").split(" "))
    assert {(r["lang"], r["word"]): r["count"] for r in profile.word_counts(df).collect()} == want
    mixed = df.withColumn("domain", F.when(F.col("en") != "", F.col("domain"))).withColumn("part", F.length("ka"))
    by = {(r["domain"], r["part"], r["lang"], r["word"]): r["count"] for r in profile.word_counts(mixed, "domain", "part").collect()}
    assert by == Counter((("d" if en else None), (None if ka is None else len(ka)), x, w) for en, ka in rows for x, t in (("en", en), ("ka", ka)) if t is not None for w in t.strip(" ").split(" "))
    counts = {r["pattern"]: r["count"] for r in profile.number_patterns(df).collect()}
    every = [t for _, t in texts]
    assert counts == {k: sum(len(re.findall(p.replace(r"\p{Nd}", r"\d"), t)) for t in every) for k, p in profile.NUMBER_PATTERNS.items()}
    assert [r["count"] for r in profile.number_patterns(df.limit(0)).collect()] == [None] * 5
    assert "Generate explode" not in _plan(profile.char_counts(df))


def test_row_functions_take_arrow_batches_in_pieces():
    over = P2.row_function(str.upper).func
    for n in (0, 1, 600):
        assert over(pa.array(["a", None, "b"] * n, pa.string())).to_pylist() == ["A", None, "B"] * n
