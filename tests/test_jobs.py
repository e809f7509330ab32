"""Specs, registries, sources and whole jobs."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bitextra import registry as R
from bitextra.plans import clean, evaluate, load, preprocess as prep, spec as specs, split
from bitextra.schema import ContractError, require_parallel, require_same_columns
from bitextra.sources import paths, readers, writers

EXAMPLES = "examples"


def test_registry():
    r = R.Registry("thing")
    r("one", "the first")(lambda: 1)
    with pytest.raises(R.DuplicateComponent):
        r("one")(lambda: 2)
    with pytest.raises(R.UnknownComponent, match="available: one"):
        r.get("two")
    assert r.describe() == {"one": "the first"}
    assert len(R.cleaners.names()) == 6 and len(R.preprocessors.names()) == 8 and len(R.augmenters.names()) >= 6


def test_contracts(sample):
    require_parallel(sample)
    with pytest.raises(ContractError):
        require_parallel(sample.drop("title"))
    with pytest.raises(ContractError):
        require_same_columns(sample, sample.withColumn("x", F.lit(1)), "step")


def test_example_specs_are_valid(request):
    root = request.config.rootpath / EXAMPLES
    assert specs.validate_spec(str(root / "cleaning.yaml"), ["cleaners"]) == []
    assert specs.validate_spec(str(root / "preprocessing.yaml"), ["preprocessors", "augmenters"]) == []
    names = [x["name"] for x in specs.load_spec(str(root / "cleaning.yaml")).listing() if x["enabled"]]
    assert names == ["filter_empty_content", "filter_georgian_purity", "filter_shared_latin_characters", "filter_length_ratio"]
    bad = {"cleaners": [{"name": "nope"}]}
    assert specs.validate_spec(bad, ["cleaners", "other"]) == ["missing section 'other'", "unknown cleaner 'nope'"]
    with pytest.raises(ValueError):
        specs.require_valid(bad, ["cleaners"])


def test_cleaning_conserves_rows_and_reports_each_step(sample, request):
    kept, dropped, stats = clean.clean(sample, str(request.config.rootpath / EXAMPLES / "cleaning.yaml"))
    assert kept.columns == sample.columns and kept.count() + dropped.count() == sample.count()
    assert {(r["id"], r["_reason"]) for r in dropped.select("id", "_reason").collect()} == {
        ("road_notes_b", "filter_empty_content"),
        ("manual_setup", "filter_georgian_purity"),
    }
    rows = {r["cleaner"]: (r["original"], r["cleaned"], r["dropped"]) for r in stats.where("is_total").collect()}
    assert rows["filter_empty_content"] == (6, 5, 1) and rows["filter_georgian_purity"] == (5, 4, 1)
    assert rows["filter_length_ratio"] == (4, 4, 0)


def test_run_cleaning_writes_once(spark, sample, request, tmp_path):
    path = str(request.config.rootpath / EXAMPLES / "cleaning.yaml")
    stats = clean.run_cleaning(sample.withColumn("dataset", F.lit("set")), path, str(tmp_path))
    assert stats.where("not is_total and step = 0").first()["dropped"] == 1
    kept = clean.read_kept(spark, str(tmp_path))
    assert kept.count() == 4 and set(sample.columns) <= set(kept.columns)
    previews = spark.read.parquet(f"{tmp_path}/samples").select("stage", "id").collect()
    assert {tuple(r) for r in previews} == {
        ("dropped:filter_empty_content", "road_notes_b"),
        ("dropped:filter_georgian_purity", "manual_setup"),
    }


def test_jobs_fail_when_a_step_loses_rows(sample, tmp_path, monkeypatch):
    lossy = lambda df, steps, scorer=None: df.where("domain <> 'cooking'").withColumn("_step", F.lit(len(steps)))
    spec = {"cleaners": [{"name": "filter_empty_content"}]}
    with monkeypatch.context() as m:
        m.setattr(clean, "mark_failing_step", lossy)
        with pytest.raises(ContractError, match="6 rows went in and 5 came out"):
            clean.run_cleaning(sample, spec, str(tmp_path / "a"))
    assert clean.run_cleaning(sample.limit(0), spec, str(tmp_path / "b")).where("dropped > 0").count() == 0
    R.preprocessors("lossy_for_test")(lambda df, params: df.where("domain <> 'cooking'"))
    with pytest.raises(ContractError, match="preprocessing"):
        prep.run_preprocessing(sample, {"preprocessors": [{"name": "lossy_for_test"}]})


def test_preprocessing_writes_previews(spark, sample, request, tmp_path):
    out = str(tmp_path / "out")
    rows = sample.withColumn("dataset", F.lit("set"))
    prep.run_preprocessing(rows, {"preprocessors": [{"name": "lowercase_english"}], "settings": {"preview_rows": 3}}, out=out)
    counts = {r["stage"]: r["count"] for r in spark.read.parquet(f"{out}/_samples").groupBy("stage").count().collect()}
    assert counts == {"input": 3, "preprocessed": 3, "final": 3}
    assert spark.read.parquet(out).count() == 5


def test_scorer_sees_only_rows_that_pass_cheap_rules(sample):
    spec = {"cleaners": [{"name": "filter_empty_content"}, {"name": "filter_similarity_threshold", "params": {"threshold": 0.9}}]}
    seen = []

    def scorer(df):
        seen.append(df.count())
        return df.withColumn("similarity_score", F.when(F.col("domain") == "traffic", 0.1).otherwise(F.lit(None).cast("double")))

    kept, dropped, _ = clean.clean(sample, spec, scorer)
    assert seen == [5] and kept.count() == 4  # NULL scores stay
    row = dropped.where("_reason = 'filter_similarity_threshold'").first()
    assert row["similarity_score"] == 0.1
    with pytest.raises(ValueError, match="scorer"):
        clean.clean(sample, spec)


def test_preprocessing_job(spark, sample, request):
    out = prep.run_preprocessing(sample, str(request.config.rootpath / EXAMPLES / "preprocessing.yaml"))
    rows = out.collect()
    assert out.columns == sample.columns
    assert len({(r["en"], r["ka"]) for r in rows}) == len(rows) and all(r["ka"].strip() for r in rows)
    assert {"number_copy_0", "kitchen_cards_3"} <= {r["id"] for r in rows}


def test_cleanup_prefers_the_input_row(parallel):
    df = parallel([("a", "b")])
    R.augmenters("copy_for_test")(lambda df, params: df.withColumn("id", F.lit("0_copy")))
    out = prep.run_preprocessing(df, {"preprocessors": [], "augmenters": [{"name": "copy_for_test"}]})
    assert [r["id"] for r in out.collect()] == ["set_0"]


def test_split_job(spark, tmp_path, request):
    rows = [(None, f"ka {i}", f"en {i}", f"d{i % 3}", f"p_{i}") for i in range(200)]
    root = str(tmp_path / "collections")
    base = spark.createDataFrame(rows, "title string, ka string, en string, domain string, id string")
    base.write.parquet(f"{root}/preprocessed/v1/corpus.parquet")
    base.where("id in ('p_1', 'p_2')").write.parquet(f"{root}/preprocessed/v2/flores.parquet")
    collections = paths.Collections(spark, root)
    spec = specs.read_yaml(request.config.rootpath / EXAMPLES / "splitting.yaml")
    splits, report = split.run_splitting(spec, lambda ref: readers.read_collection(collections, ref), str(tmp_path / "out"))
    back = readers.read_splits(spark, str(tmp_path / "out"))
    sets = {s: {r["en"] for r in back.where(F.col("split") == s).collect()} for s in readers.SPLITS}
    assert len(sets["test"]) == 2 and not sets["train"] & (sets["test"] | sets["valid"])
    assert [r["source_split"] for r in report.collect()] == ["test", "valid"]
    with pytest.raises(FileNotFoundError):
        readers.read_splits(spark, root)


def test_versions(spark, tmp_path):
    assert paths.new_version("/r/", datetime(2024, 1, 2, 3, 4, 5)) == "/r/2024-01-02_03-04-05"
    for v in ("v9", "v10"):
        spark.range(3).write.parquet(f"{tmp_path}/raw/{v}/a.parquet")
    c = paths.Collections(spark, str(tmp_path))
    assert c.resolve("raw:latest").endswith("/raw/v10") and c.resolve("raw:v9").endswith("/raw/v9")
    assert {r["source_file"] for r in readers.read_collection(c, "raw:v9").collect()} == {"a"}
    for ref in ("raw:v3", "none"):
        with pytest.raises(ValueError):
            c.resolve(ref)
    with pytest.raises(ValueError, match="no parquet"):
        (tmp_path / "empty").mkdir()
        readers.read_datasets(spark, str(tmp_path / "empty"))


def test_csv_and_json(spark, tmp_path):
    csv = tmp_path / "in.csv"
    csv.write_text('georgian_text;english_text\n"ა ""ბ""\nგ";one\nდ;two\n', encoding="utf-8")
    rows = readers.load_csv(spark, str(csv), sep=";").orderBy("id").collect()
    assert [(r["ka"], r["en"], r["domain"], r["id"], r["title"]) for r in rows] == [
        ('ა "ბ"\nგ', "one", "general", "custom_0", None),
        ("დ", "two", "general", "custom_1", None),
    ]
    js = tmp_path / "in.json"
    js.write_text(json.dumps([{"ka_text": "ა", "en_text": "a", "domain": "x"}, {"ka_text": "ბ", "en_text": "b", "domain": "y"}]))
    rows = readers.load_json(spark, str(js), name="set").orderBy("id").collect()
    assert [(r["ka"], r["domain"], r["id"]) for r in rows] == [("ა", "x", "set_0"), ("ბ", "y", "set_1")]
    with pytest.raises(ValueError, match="not found"):
        readers.load_csv(spark, str(csv))


def test_file_order_is_row_order(spark, tmp_path):
    for i in range(4):
        spark.createDataFrame([(i * 10 + j,) for j in range(10)], "n long").coalesce(1).write.parquet(f"{tmp_path}/d{i}.parquet")
    df = readers.read_datasets(spark, str(tmp_path), positions=True)
    got = {r["n"]: r["idx"] for r in readers.indexed(df).collect()}
    assert got == {n: n for n in range(40)}


def test_load_job_and_datasets(spark, sample, tmp_path):
    writers.write_datasets(sample.withColumn("dataset", F.col("domain")), str(tmp_path / "sets"), "_cleaned")
    names = {r["dataset"] for r in readers.read_datasets(spark, str(tmp_path / "sets")).collect()}
    assert names == {f"{d}_cleaned" for d in ("weather", "traffic", "cooking", "software")}
    sample.write.parquet(f"{tmp_path}/corpus/train.parquet")
    spec = {"datasets": [{"name": "c", "source": f"{tmp_path}/corpus", "loader_function": "load_en_ka_corpora"}]}
    assert load.run_load(spark, spec, f"{tmp_path}/raw") == {"c": {"rows": 6, "null_ka": 0, "null_en": 0, "null_id": 0}}
    with pytest.raises(R.UnknownComponent):
        load.run_load(spark, {"datasets": [{"name": "c", "loader_function": "nope"}]}, str(tmp_path))


def test_profile_bundles(sample):
    df = sample.withColumn("dataset", F.lit("s"))
    assert set(evaluate.profile(df, "basic")) == {"basic", "lengths", "domains", "datasets", "quality"}
    issues = {r["issue"]: r["count"] for r in evaluate.profile(df, "quality")["quality"].collect()}
    assert issues["Empty Georgian texts"] == 1 and issues["Very short Georgian (<10 chars)"] == 1
    tables = evaluate.profile(df, "clustering", features=50, components=2, max_clusters=3)
    assert tables["cluster_fits"].count() == 2
    assert sum(r["count"] for r in tables["cluster_sizes"].collect()) == 6
    with pytest.raises(ValueError):
        evaluate.profile(df, "nope")


def test_split_sizes_and_steps(sample):
    steps = specs.load_spec({"preprocessors": [{"name": "lowercase_english"}]}).enabled("preprocessors")
    speed = prep.step_speeds(sample, steps)[0]
    assert speed["rows"] == 6 and speed["rows_per_second"] > 0
    stats = prep.preprocess_stats(sample, steps).first()
    assert (stats["rows"], stats["rows_changed"], stats["change_percentage"]) == (6, 6, 100.0)


@pytest.mark.parametrize("methods", [
    None,
    {"exact_match": {"columns": ["en"]}},
    {"near_duplicate": {"enabled": False}},
])
def test_checks_on_contents_equal_checks_on_rows(spark, methods):
    """Three checks in a row, one of them from a split that was itself cleaned: rows and report are the same."""
    words = [f"w{i}" for i in range(60)]
    text = lambda i: " ".join(words[(i * 7 + j) % (59 if i % 3 else 60)] for j in range(45))
    rows = [(None, f"k{i % 4}" if i % 5 else None, text(i % 13) + (" more" if i % 11 == 0 else ""), "d", f"r{i:03d}") for i in range(120)]
    rows += [(None, "", "", "d", "empty"), (None, None, None, "d", "none"), rows[3]]
    df = spark.createDataFrame(rows, "title string, ka string, en string, domain string, id string").repartition(3)
    at = F.coalesce(F.substring("id", -2, 2).try_cast("int"), F.lit(3))
    splits = {"train": df.where(at % 3 != 0), "valid": df.where(at % 5 == 0), "test": df.where(at % 17 == 1)}
    pairs = [("test", "valid", True), ("valid", "train", True), ("test", "train", True), ("train", "test", False)]
    one, first = split._by_contents(splits, pairs, methods)
    two, second = split._by_rows(splits, pairs, methods)
    for name in splits:
        assert sorted(one[name].collect(), key=str) == sorted(two[name].collect(), key=str), name
    assert [s.collect() for s in first] == [s.collect() for s in second]
