from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import sampling as S, trainlog
from .base import from_pairs, pairs, query, table

_BY_HASH = "SELECT *, row_number() OVER (ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) AS r, count(*) OVER () AS n FROM documents"


def _docs(spark, sf):
    return table(spark, sf, "documents")


@query("sample_percentage", f"SELECT doc_id, text FROM ({_BY_HASH}) WHERE r <= floor(n * CAST(30 AS DOUBLE) / 100)")
def _(spark, sf):
    return S.sample_percentage(_docs(spark, sf), 30, ["doc_id"], 42).select("doc_id", "text")


@query("sample_exact_rows", f"SELECT doc_id FROM ({_BY_HASH}) WHERE r <= 137")
def _(spark, sf):
    return S.sample_rows(_docs(spark, sf), 137, ["doc_id"], 42).select("doc_id")


@query(
    "sample_per_language",
    """SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) AS r,
    count(*) OVER (PARTITION BY lang) AS n FROM documents) WHERE r <= least(n, greatest(10, floor(n * CAST(5 AS DOUBLE) / 100)))""",
)
def _(spark, sf):
    return S.sample_stratified(_docs(spark, sf), 5, ["doc_id"], 42, strata="lang").select("doc_id", "lang")


@query("sample_ranked", f"SELECT doc_id, r - 1 AS rank FROM ({_BY_HASH}) WHERE r <= floor(n / 4)")
def _(spark, sf):
    quarter = lambda n: F.floor(n / 4)
    return S.sample_ranked(_docs(spark, sf), quarter, ["doc_id"], 42).select("doc_id", F.col("_rank").alias("rank"))


@query("shuffled_rows", "SELECT doc_id, text FROM documents")
def _(spark, sf):
    return S.shuffle_rows(_docs(spark, sf), ["doc_id"]).select("doc_id", "text")


_PREVIEWS = [("cleaning", 10), ("preprocessing", 20), ("final", 50)]


@query(
    "preview_samples",
    " UNION ALL ".join(f"SELECT doc_id, '{stage}' AS stage FROM ({_BY_HASH}) WHERE r <= {n}" for stage, n in _PREVIEWS),
)
def _(spark, sf):
    docs = _docs(spark, sf).select("doc_id")
    return reduce(DataFrame.unionByName, [S.preview_rows(docs, n, ["doc_id"], stage) for stage, n in _PREVIEWS])


@query("first_rows", from_pairs("SELECT id, en FROM pairs ORDER BY id LIMIT 100"))
def _(spark, sf):
    return S.first_rows(pairs(spark, sf), 100).select("id", "en")


@query(
    "mini_batches",
    from_pairs(
        """SELECT batch, len(ids) AS batch_size, array_to_string(ids, ',') AS ids, array_to_string(domains, ',') AS domains FROM (
        SELECT idx // 32 AS batch, list(id ORDER BY idx) AS ids, list(domain ORDER BY idx) AS domains
        FROM (SELECT *, row_number() OVER (ORDER BY row_pos) - 1 AS idx FROM pairs) GROUP BY batch)"""
    ),
)
def _(spark, sf):
    rows = S.indexed(pairs(spark, sf, positions=True))
    done = S.batches(rows, ["id", "domain"], 32)
    return done.select(
        "batch", "batch_size", F.array_join("id", ",").alias("ids"), F.array_join("domain", ",").alias("domains")
    )


@query(
    "early_stopping",
    """WITH e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events WHERE value IS NOT NULL),
    b AS (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM e),
    s AS (SELECT *, max(CASE WHEN best IS NULL OR value > best THEN i END) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last FROM b)
    SELECT user_id, count(*) AS evaluations, min(CASE WHEN i - last >= 3 THEN i END) AS stop_index, max(value) AS best FROM s GROUP BY user_id""",
)
def _(spark, sf):
    return trainlog.early_stopping(
        table(spark, sf, "events").select("user_id", "ts", "event_id", "value"),
        "user_id",
        ["ts", "event_id"],
        "value",
        patience=3,
        greater_is_better=True,
    )


@query(
    "early_stopping_min_delta",
    """WITH RECURSIVE e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events WHERE value IS NOT NULL),
    up AS (SELECT user_id, i, value FROM e WHERE i = 0 UNION ALL SELECT user_id, i, value FROM (
      SELECT e.user_id, e.i, e.value, row_number() OVER (PARTITION BY e.user_id ORDER BY e.i) AS r FROM up JOIN e
      ON e.user_id = up.user_id AND e.i > up.i AND e.value > up.value + 5) WHERE r = 1),
    s AS (SELECT e.*, max(up.i) OVER (PARTITION BY e.user_id ORDER BY e.i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last
      FROM e LEFT JOIN up ON up.user_id = e.user_id AND up.i = e.i)
    SELECT user_id, count(*) AS evaluations, min(CASE WHEN i - last >= 3 THEN i END) AS stop_index, max(value) AS best FROM s GROUP BY user_id""",
)
def _(spark, sf):
    log = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return trainlog.early_stopping(log, "user_id", ["ts", "event_id"], "value", greater_is_better=True, min_delta=5.0)
