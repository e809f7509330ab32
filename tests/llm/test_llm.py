"""Operators for training data against brute force, round trips and defined edge cases."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bitextra.llm.common import Store, shared_uri
from bitextra.llm import bpe, cotraining, credentials, jaccard_forest, llr_rules, mixing, mtree, token_codes, toxicity, warc

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# NULLs, empty and long texts, repeated rows, ties; `shard`, `score` and `ids` clash with new columns
ODD = [
    (1, "one two three four five six seven eight nine ten", "en", "a", 48, "x"),
    (1, "one two three four five six seven eight nine ten", "en", "a", 48, "x"),
    (2, None, None, None, None, None),
    (None, "", "en", "b", 0, "x"),
    (3, "  lead\t\ttwo  blanks\n\nend ", "en", None, 24, "x"),
    (4, "password=abcdef12 <|endoftext|> café \U0001f600 they're", "fr", "b", 40, "x"),
    (None, "word " * 3000, "en", "a", 15000, "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long, ids string")
    return rows.withColumns({"shard": F.lit("mine"), "score": F.lit("mine"), "size": F.lit("mine"), "spans": F.lit("mine")})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_bpe_equals_the_library(spark, docs, odd):
    t = Tokenizer.from_file(VOCABULARY)
    for df in (docs, odd, docs.limit(0)):
        for r in bpe.encode_and_decode(df, VOCABULARY, memo=50).select("text", "ids", "decoded").collect():
            assert r["ids"] == t.encode(r["text"] or "", add_special_tokens=False).ids
            assert r["decoded"] == (r["text"] or "")
    broken = spark.createDataFrame([([256 - 256 + 94],), ([],), (None,), ([162, 50256],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode_ids(broken, VOCABULARY).collect()] == [
        t.decode(x or [], skip_special_tokens=False) for x in ([94], [], None, [162, 50256])
    ]


def test_token_files(spark, docs, odd):
    t = Tokenizer.from_file(VOCABULARY)
    for df in (docs, odd, docs.limit(0)):
        folder = token_codes.new_token_folder(spark)
        manifest = token_codes.write_tokens(df, VOCABULARY, folder, 2, memo=50)
        got = token_codes.read_tokens(manifest, folder).orderBy("start").collect()
        assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in df.collect()), key=lambda d: (d is not None, d))
        want = Counter((r["doc_id"], *t.encode(r["text"] or "", add_special_tokens=False).ids, 2) for r in df.collect())
        assert Counter((r["doc_id"], *r["ids"]) for r in got) == want
        at = 0
        for r in got:
            assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            at += r["n_tokens"]


def test_any_token_is_addressable():
    ids = np.random.default_rng(1).integers(0, 60_000, 5000).astype(np.uint32)
    for bits in (3, 8, 16):
        f = token_codes.TokenFile(token_codes.to_bytes([7], np.array([0, len(ids)]), ids, bits))
        assert all(f.token(i) == ids[i] for i in range(0, 5000, 61))
        assert (f.tokens(511, 1600) == ids[511:1600]).all()


def test_warc_round_trip(spark):
    rows = [(3, "u", "<p>same</p>"), (1, "v", "<p>same</p>"), (None, "w", "<p>same</p>"), (4, None, None), (5, "x", ""), (6, "y", "long " * 99999), (6, "y", "long " * 99999)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("revisit", F.lit("mine"))
    for df in (pages, pages.limit(0), spark.read.parquet(f"{SF}/pages.parquet")):
        folder = warc.new_archive_folder(spark)
        got = warc.read_archives(warc.write_archives(df, folder), folder).collect()
        want = [(r["page_id"], (r["html"] or "").encode()) for r in df.collect()]
        assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in got) == Counter((p, len(h), warc.digest(h)) for p, h in want)
        first = {}
        for p, h in want:
            first[h] = min(first.get(h, (True, 0)), (p is None, p or 0))
        responses = {r["payload"]: r["page_id"] for r in got if r["record_type"] == "response"}
        assert {h: p for h, (null, p) in first.items()} == {h: p for h, p in responses.items()}
        assert sum(r["record_type"] == "response" for r in got) == len(first)
        for r in got:
            if r["record_type"] == "revisit":
                assert r["payload"] is None and r["refers_to"] in responses.values()


def test_warc_reader_rejects_damage():
    good = warc.record(1, "u", b"payload", warc.digest(b"payload"), None, False)
    many = warc.archive([good] * 300)
    assert list(warc.frames(many)) == [good] * 300
    for bad in (good[:-1], good.replace(b"payload", b"payloaD"), good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"Content-Length: ", b"Content-Length: x")):
        with pytest.raises(warc.BadArchive):
            warc.read_record(bad)
    date = b"WARC-Date: " + warc.parse(good)[0]["warc-date"].encode()
    for bad in (good.replace(date + b"\r\n", b""), good.replace(date, b"WARC-Date: yesterday")):
        with pytest.raises(warc.BadArchive):
            warc.read_record(bad)
    again = warc.record(2, "v", b"payload", warc.digest(b"payload"), 1, True)
    assert warc.parse(again)[0]["warc-refers-to"] == warc.parse(good)[0]["warc-record-id"]
    with pytest.raises(warc.BadArchive):
        list(warc.frames(many[:-3]))


def test_secrets(spark, odd):
    text = "api_key: 'abc' token=secre password = \"hunter22\" AKIA" + "A1" * 8 + " " + "0a" * 12 + " 0a0a"
    assert [(k, text[a:b]) for k, a, b in credentials.base_spans(text)] == [
        ("assign", 'password = "hunter22'), ("access", "AKIA" + "A1" * 8), ("hex", "0a" * 12),
    ]
    key, user = "Zx8kQ2mN7pL4vT9rB3wY", "username: alice"
    kinds = lambda t: [s["kind"] for s in credentials.find(t, 200)]
    assert kinds(f"{user} and {key}") == ["identifier", "secret"]
    assert kinds(f"see https://host.example/x with {key}") == ["endpoint", "secret"]
    assert kinds(key) == [] and kinds(user) == [] and kinds(f"{user}\n\n{key}") == [] and kinds(user + " " * 300 + key) == []
    got = credentials.find_secrets(odd).collect()
    assert len(got) == len(ODD) and sum(len(r["spans"]) for r in got) == 1
    assert [r["text"] for r in credentials.redact(odd).where("doc_id = 4").collect()][0].startswith("[REDACTED] <|endoftext|>")
    assert credentials.redact(odd.limit(0)).count() == 0


def test_secrets_link_within_whole_scopes(spark):
    key, user, host = "Zx8kQ2mN7pL4vT9rB3wY", "username: alice", "https://host.example/x"
    filler = "\n".join(f"option {i} on" for i in range(2000))
    texts = [f"{user}\n{filler}\n{key}", f"{key}\n{filler}\n{host}", f"{user}\n{filler}\n\n{key}", user + " " * 300 + key]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in credentials.find_secrets(df).collect()}
    assert found == {0: ["identifier", "secret"], 1: ["secret", "endpoint"], 2: [], 3: ["identifier", "secret"]}
    clean = {r["doc_id"]: r["text"] for r in credentials.redact(df).collect()}
    assert clean[0] == f"[REDACTED]\n{filler}\n[REDACTED]" and clean[2] == texts[2]


def test_secrets_behind_spans_with_parts_and_prefixed_names():
    keys = ["Zx8kQ2mN7pL4vT9rB3wY", "b7Tq1Xc5Vn9Jm3Ks6Hd2", "Lw4Rz8Fy2Gp6Uv1Ea5Ti", "q9Nd3Sb7Xk1Mc5Zj8Wf4"]
    url = "https://host.example/x?" + "&".join(f"{n}~{k}" for n, k in zip("abcd", keys))
    kinds = lambda t: [s["kind"] for s in credentials.find(t)]
    assert kinds(url) == []
    assert "endpoint" in kinds(f"{url} P0oK9iJ8uH7yG6tF5rD4") and "endpoint" in kinds(f"P0oK9iJ8uH7yG6tF5rD4 {url}")
    for name in ("aws_access_key_id", "db_user", "DB_USERNAME"):
        assert kinds(f"{name}=alice {keys[0]}") == ["identifier", "secret"]
    assert kinds(f"superuser=alice {keys[0]}") == []


def test_mixing(spark, docs, odd):
    for df in (docs, odd, docs.limit(0)):
        got = mixing.decide(df).collect()
        assert len(got) == df.count()
        words = lambda t: len([w for w in (t or "").encode().split()])
        sizes = Counter()
        for r in got:
            assert r["size"] == words(r["text"]) and 0 <= r["taken"] <= 3 * r["size"]
            sizes[r["source"]] += r["size"]
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: i % 3 + 1 for i, s in enumerate(order)}
        target, free, left = {}, set(order), float(sum(sizes.values()))
        while free:
            level = left / sum(weight[s] for s in free)
            over = {s for s in free if level * weight[s] > 3 * sizes[s]}
            target |= {s: 3.0 * sizes[s] for s in over} if over else {s: level * weight[s] for s in free}
            left, free = left - sum(3 * sizes[s] for s in over), free - over if over else set()
        taken = Counter()
        for r in got:
            assert abs(r["target"] - target[r["source"]]) < 1e-6
            taken[r["source"]] += r["taken"]
        half = Counter()
        for r in got:
            half[r["source"]] = max(half[r["source"]], r["size"] / 2)
        assert all(abs(taken[s] - target[s]) <= half[s] + 2 for s in order)
        mixed = mixing.mix(df).collect()
        once = Counter((r["doc_id"], r["text"]) for r in got)
        assert {(r["doc_id"], r["text"]) for r in mixed} <= set(once) or max(once.values()) > 1
        assert sum(words(r["text"]) for r in mixed) == sum(taken.values())
        assert sorted(r["taken"] for r in mixing.decide(df).collect()) == sorted(r["taken"] for r in got)


def test_llr_rules(spark, docs, odd, labels):
    buckets, smoothing = 512, 1.0
    got = llr_rules.judge(docs, labels, buckets=buckets, smoothing=smoothing).collect()
    h = lambda *x: xxhash.xxh64_intdigest(x[0], 42) if len(x) == 1 else None
    signed = lambda v: v - (1 << 64) if v >> 63 else v

    def chain(*values: int) -> int:
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little"), seed)
        return signed(seed) % buckets

    def grams(text):
        w = [h(x) for x in (text or "").encode().split()]
        return [chain(a) for a in w] + [chain(a, b) for a, b in zip(w, w[1:])]

    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    raw, target = np.full(buckets, smoothing), np.full(buckets, smoothing)
    for r in got:
        for g in grams(r["text"]):
            raw[g] += 1
            target[g] += r["doc_id"] in good
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    for r in got:
        text = r["text"] or ""
        words = text.encode().split()
        runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        repeats = {i + j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert (r["n_words"], r["n_repeat_words"], r["n_dup_lines"]) == (len(words), len(repeats), len(lines) - len(set(lines)))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text) and r["word_chars"] == len(text) - sum(c in " \t\n\r\x0b\x0c" for c in text)
        assert r["base_failed"] == (len(words) < 10 or 100 * len(repeats) > 20 * len(words))
        if words:
            mean = float(np.mean([ratio[g] for g in grams(text)]))
            assert abs(r["llr"] - mean) < 1e-4
            assert abs(mean + 0.15) < 1e-3 or r["kept"] == (not r["base_failed"] and mean >= -0.15)
    assert llr_rules.judge(odd, labels).count() == len(ODD)
    # an id that is NULL is as good as one without a label
    unknown = docs.withColumn("doc_id", F.when(F.col("doc_id").isin(*good), F.col("doc_id")))
    scores = {(r["text"], r["llr"]) for r in llr_rules.judge(unknown, labels, buckets=buckets, smoothing=smoothing).select("text", "llr").collect()}
    assert scores == {(r["text"], r["llr"]) for r in got}
    assert llr_rules.judge(docs.limit(0), labels.limit(0)).count() == 0


def test_top_k_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "x") for i in range(400)]
    rows += [(i, rows[0][1], "x") for i in range(400, 450)] + [(450, None, "x"), (451, [float("nan")], "x"), (452, [None, 1.0], "x"), (453, [], "x"), (454, [1.0], "x"), (None, [1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    good = {i: np.floor(256 * np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and v is not None and None not in v and not np.isnan(v).any()}
    dot = lambda a, b: int(sum(x * y for x, y in zip(a, b)))
    want = []
    for q in good:
        if q % 50 == 0:
            best = sorted((-dot(good[q], v), i) for i, v in good.items() if i != q)[:5]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, mtree.top_k(df, shard_rows=90).collect())) == sorted(want)
    assert mtree.top_k(df.limit(0)).count() == 0 and mtree.top_k(df.where("vec_id < 1")).count() == 0
    # queries in several blocks and pieces, more of them than a task keeps
    for name, small in (("BLOCK", 4), ("PIECE", 3), ("KEPT", 1)):
        monkeypatch.setattr(mtree, name, small)
    assert sorted(map(tuple, mtree.top_k(df, shard_rows=90).collect())) == sorted(want)


def test_top_k_keeps_large_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    # 2^18 and beyond, sums beyond 2^53 that differ in their last digits, scores beyond a long, norms beyond a double
    rows += [(i, [float(x) for x in rng.integers(-(2**19), 2**19, 8)]) for i in range(300, 360)]
    rows += [(i, [float(2**28 + i % 7), float(i % 3), *[0.0] * 6]) for i in range(360, 420)]
    rows += [(i, [float(x) * 10.0 ** (i % 4 * 60 + 10) for x in rng.normal(size=8)]) for i in range(420, 455)]
    df = spark.createDataFrame([*rows, (455, [float("inf")]), (456, [float("nan")])], "vec_id long, embedding array<double>")
    good = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    for some in (lambda i: True, lambda i: i < 305, lambda i: i >= 350):  # all, few outliers, outliers only
        want = []
        for q in filter(some, good):
            if q % 50 == 0:
                best = sorted((-sum(x * y for x, y in zip(good[q], v)), i) for i, v in good.items() if i != q and some(i))[:5]
                want += [(q, n, i, -s if -(2**63) <= -s < 2**63 else None) for n, (s, i) in enumerate(best, 1)]
        got = mtree.top_k(df.where(F.col("vec_id").isin([*filter(some, good), 455, 456])), shard_rows=90).collect()
        assert sorted(map(tuple, got), key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])
    numbers = sorted([0, -1, 2**63 - 1, -(2**63), *[s * (2**e + d) for e in (62, 63, 126, 300) for d in (-1, 0, 1) for s in (1, -1)]])
    assert [mtree.from_limbs(mtree.to_limbs(n)) for n in numbers] == numbers and sorted(map(mtree.to_limbs, numbers)) == [mtree.to_limbs(n) for n in numbers]


def test_jaccard_classes(spark, odd):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 500, 120)]
    rows = [(i, " ".join(base[:j] + ["changed"] + base[j + 1 :])) for i, j in enumerate(range(0, 120, 2))]
    rows += [(100 + i, " ".join(base)) for i in range(20)] + [(200, " ".join(f"x{i}" for i in range(99))), (201, "a b"), (202, "a b"), (203, " "), (204, None), (None, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [set(jaccard_forest.shingles(t or "").tolist()) for _, t in rows]
    links = [sum(i != j and bool(a) and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    got = Counter((r["doc_id"], r["n_links"]) for r in jaccard_forest.classes(df, chunk=16).collect())
    assert got == Counter((d, n) for (d, _), n in zip(rows, links))
    by = {r["doc_id"]: r["class_id"] for r in jaccard_forest.classes(df).collect()}
    assert {by[i] for i in [*range(60), *range(100, 120)]} == {0} and by[200] == 200 and by[202] == by[None] == 201 and by[203] == 203
    assert jaccard_forest.keep_first(df).count() == 5
    assert jaccard_forest.keep_first(odd).count() == len(ODD) - 1 and jaccard_forest.keep_first(odd.limit(0)).count() == 0


def test_quality_learns_from_every_unlabelled_document(spark, docs, labels):
    some = labels.orderBy(F.xxhash64("doc_id")).limit(60).cache()
    first = docs.join(some, "doc_id", "left_anti").select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(60)
    fixed = [r["doc_id"] for r in first.union(some.select("doc_id")).collect()]
    # the labelled documents and the 60 of smallest hash stay as they are
    other = docs.withColumn("text", F.when(F.col("doc_id").isin(fixed), F.col("text")).otherwise(F.upper("text")))
    scores = lambda d: {r["doc_id"]: r["score"] for r in cotraining.classify(d, some, sample=60).where(F.col("doc_id").isin(fixed)).collect()}
    one, two = scores(docs), scores(other)
    assert max(abs(one[d] - two[d]) for d in one) > 1e-6
    again = scores(docs.repartition(7))
    assert max(abs(one[d] - again[d]) for d in one) < 0.01


def test_quality_fit_over_the_pool_equals_a_local_one(spark):
    rng = np.random.default_rng(4)
    flat = rng.normal(size=(3000, 25))
    flat[:, 15], flat[:, 16] = rng.integers(0, 64, 3000), rng.integers(0, 16, 3000)
    rows = spark.createDataFrame([(r, i * 2654435761) for i, r in enumerate(flat.tolist())], "f array<double>, draw long").repartition(5)
    views = cotraining.make_views(rows)
    x, y = [flat[:500, :15], flat[:500, 15:]], (flat[:500, 0] + flat[:500, 20] + rng.normal(size=500) > 0).astype(float)
    for view, part in zip(views, x):
        view.fit(part, y)
    pool = cotraining.Pool(rows, views)
    pool.exchange(0.5, 0.7, 0.1)
    blocks = [b for batch in pool.blocks.toArrow().to_batches() for b in cotraining.Pool._blocks(batch)]
    given = [[g[v][g[v] >= 0] for _, _, g in blocks] for v in (0, 1)]
    assert pool.size == 3000 and all(100 < sum(map(len, g)) < 330 for g in given)
    pool.fit(x, y, steps=30)
    for v, view in enumerate(views):
        at = np.concatenate([view.places(x[v]), *[view.starts[:-1] + bins[v][g[v] >= 0] for bins, _, g in blocks]])
        alone = cotraining.newton(view.design(at), np.concatenate([y, *given[v]]), 2.0, 30)
        assert np.abs(view.weights - alone).max() < 1e-2


def test_sums_of_the_pool_come_in_few_rows_whatever_the_partitions(spark, monkeypatch):
    rows = spark.createDataFrame([([float(i % 7)] * 25, i) for i in range(300)], "f array<double>, draw long").repartition(40)
    pool = cotraining.Pool(rows, cotraining.make_views(rows))
    pool.blocks = pool.blocks.repartition(40)  # as many tasks' sums, and more partitions than keys
    plain, frame, came = type(rows).repartition, type(rows).collect, []
    monkeypatch.setattr(type(rows), "repartition", lambda self, n, *by: plain(self, 211 if by else n, *by))
    monkeypatch.setattr(type(rows), "collect", lambda self: came.append(frame(self)) or came[-1])
    got = pool._sums([(2,)], lambda sums, block: np.add(sums[0], [1, len(block[1])], out=sums[0]))[0]
    assert got[1] == 300 and 0 < len(came[0]) <= cotraining.MERGED


def test_toxicity_and_quality(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    tox = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in tox]) > 0.93 and all(0 <= r["score"] <= 1 for r in tox)
    good = cotraining.classify(docs, labels).join(labels, "doc_id").collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in good]) > 0.97
    assert np.mean([r["kept"] for r in good if r["quality"] == 1]) > 0.99
    for f in (toxicity.score, cotraining.classify):
        assert f(odd, labels).count() == len(ODD)
        assert f(odd, labels.limit(0)).count() == len(ODD) and f(odd.limit(0), labels).count() == 0


def test_folders_are_the_same_for_spark_and_arrow(spark, tmp_path):
    assert shared_uri(spark, "s3a://corpus/x") == "s3://corpus/x" and shared_uri(spark, "abfss://c@a.net/x") == "abfss://c@a.net/x"
    # a path without a scheme is one of Spark's default file system
    assert shared_uri(spark, "/a/b") == shared_uri(spark, "file:/a/b") == shared_uri(spark, "file:///a/b") == "file:///a/b"
    with pytest.raises(ValueError, match="dbfs"):
        shared_uri(spark, "dbfs:/x")
    folder = str(tmp_path / "odd name 100%")
    store = Store(shared_uri(spark, folder))
    store.write("a.zst", b"as it is")
    assert store.read("a.zst") == b"as it is" and (tmp_path / "odd name 100%" / "a.zst").read_bytes() == b"as it is"
    assert spark.read.format("binaryFile").load(folder).first()["content"] == b"as it is"
