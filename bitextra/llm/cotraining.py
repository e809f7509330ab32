"""Quality classifier by co-training: one view reads the text, the other what is known of the page.

Each view is an additive model: every feature is cut into quantile bins and logistic weights
of the bins are fitted by Newton steps. In each round both views label the unlabelled pool and
hand their confident labels to the other one. The pool is every unlabelled row: its bins stay in
blocks in the shared folder, and tasks sum gradients and curvature. Their log odds, calibrated on labelled rows that
neither has seen, are combined by a second logistic fit, which scores every document.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StructField

from .common import add_columns, settle

_TERMINAL = frozenset(".!?…:;\"'”»")
_SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]\\^~_=+@/]")
_SIGNS = re.compile(r"[^\w\s]")
TEXT_FEATURES = 15
PAGE_FEATURES = 10
BINS, SOURCES = 10, 64
#: Ranks of log odds, 1/256 wide; tasks that sum over the pool.
RANKS, TASKS, MERGED = 1 << 13, 1024, 16


def text_features(text: str) -> list[float]:
    """Rates over the whole text; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * TEXT_FEATURES
    chars = len(text)
    counts = Counter(words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    data = text.encode()
    signs = len(_SIGNS.findall(text))
    letters = sum(map(str.isalpha, text)) if signs * 8 > chars else chars - signs
    return [
        math.log1p(n),
        chars / n,
        sum(map(str.isupper, words)) / n,
        sum(w[0].isupper() for w in words) / n,
        len(_SYMBOLS.findall(text)) / n,
        signs / chars,
        letters / chars,
        text.count("!") / n,
        text.count("|") / n,
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        same / n,
        pairs / max(1, n - 1),
        len(zlib.compress(data, 1)) / len(data),
        len(zlib.compress(data, 1)) / math.sqrt(len(data)),
    ]


def page_features(text: str, n_chars: int | None, lang: str | None, source: str | None) -> list[float]:
    """Where a page is from, its size, and its layout: lines, not words."""
    lines = text.split("\n")
    full = [x for x in lines if x.strip()]
    bucket = lambda x, n: float(zlib.crc32((x or "").encode()) % n)
    n = max(1, len(full))
    return [
        bucket(source, SOURCES),
        bucket(lang, 16),
        math.log1p(max(0, n_chars if n_chars is not None else len(text))),
        math.log1p(len(full)),
        len(text) / n,
        max(map(len, full), default=0) / max(1, len(text)),
        sum(x.rstrip()[-1] in _TERMINAL for x in full) / n,
        sum(len(x) < 30 for x in full) / n,
        len(set(full)) / n,
        (len(lines) - len(full)) / len(lines),
    ]


class View:
    """Bins and weights of one view."""

    def __init__(self, cuts: list[list[float] | None], categories: dict[int, int]) -> None:
        self.edges = [np.arange(0.5, categories[j] - 1) if j in categories else np.unique(np.array(c or [])) for j, c in enumerate(cuts)]
        sizes = [len(e) + 1 for e in self.edges]
        self.starts = np.cumsum([1, *sizes])
        self.weights = np.zeros(self.starts[-1])

    def bins(self, x: np.ndarray) -> np.ndarray:
        """At most SOURCES bins a feature, so a byte each."""
        return np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]).astype(np.uint8)

    def places(self, x: np.ndarray) -> np.ndarray:
        return self.starts[:-1] + self.bins(x)

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 2.0, steps: int = 12) -> None:
        self.weights = newton(self.design(self.places(x)), y, ridge, steps)

    def design(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), len(self.weights)), np.float32)
        out[:, 0] = 1
        np.put_along_axis(out, at, 1, axis=1)
        return out

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.weights[0] + self.weights[self.places(x)].sum(axis=1) if len(x) else np.zeros(0)


def slopes(design: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log likelihood, which add up over rows."""
    p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
    return design.T @ (y - p), (design * (p * (1 - p))[:, None].astype(design.dtype)).T @ design


def newton_step(w: np.ndarray, gradient: np.ndarray, curve: np.ndarray, ridge: float) -> tuple[np.ndarray, bool]:
    """New weights, and whether they have settled; the first column is the intercept and is not held back."""
    hold = np.full(len(w), ridge)
    hold[0] = 1e-3
    step = np.linalg.solve(curve + np.diag(hold), gradient - hold * w)
    return w + step * min(1.0, 5 / max(1e-9, np.abs(step).max())), np.abs(step).max() < 1e-4


def newton(design: np.ndarray, y: np.ndarray, ridge: float, steps: int) -> np.ndarray:
    """Logistic weights."""
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        w, settled = newton_step(w, *slopes(design, y, w), ridge)
        if settled:
            break
    return w


class Pool:
    """All unlabelled rows in blocks: a byte for each feature, a draw, and the label that each view was given (-1: none)."""

    SCHEMA = "n int, bins0 binary, bins1 binary, draw binary, given0 binary, given1 binary"

    def __init__(self, rows: DataFrame, views: list[View]) -> None:
        """`rows` has f (the numbers of both views) and draw (a long)."""

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    bins = [v.bins(x) for v, x in zip(views, split(b.column("f")))]
                    draw = (b.column("draw").to_numpy() & 0xFFFFFFFF).astype(np.uint32)
                    yield Pool._block([*bins, draw, *[np.full(b.num_rows, -1, np.int8)] * 2])

        self.views = views
        self.blocks = settle(rows.mapInArrow(pack, self.SCHEMA), "blocks")
        self.size = self.blocks.agg(F.sum("n")).first()[0] or 0

    @classmethod
    def _block(cls, parts: list[np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array([len(parts[0])], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in parts]]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in cls.SCHEMA.split(", ")])

    @staticmethod
    def _blocks(batch: pa.RecordBatch) -> Iterator[tuple]:
        for r in batch.to_pylist():
            bins = [np.frombuffer(r[f"bins{v}"], np.uint8).reshape(r["n"], -1) for v in (0, 1)]
            yield bins, np.frombuffer(r["draw"], np.uint32), [np.frombuffer(r[f"given{v}"], np.int8) for v in (0, 1)]

    @staticmethod
    def _odds(view: View, bins: np.ndarray) -> np.ndarray:
        return view.weights[0] + view.weights[view.starts[:-1] + bins].sum(axis=1)

    def _sums(self, shapes: list[tuple], add) -> list[np.ndarray]:
        """Arrays that `add(sums, block)` fills, over all blocks.

        Each of at most TASKS tasks fills its own; MERGED tasks add those up, in the order of the tasks,
        and only theirs come to the driver.
        """
        names = [f"s{i}" for i in range(len(shapes))]

        def row(sums: list[np.ndarray]) -> pa.RecordBatch:
            arrays = [pa.array([TaskContext.get().partitionId()], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in sums]]
            return pa.RecordBatch.from_arrays(arrays, names=["task", *names])

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(x) for x in shapes]
            for b in batches:
                for block in Pool._blocks(b):
                    add(sums, block)
            yield row(sums)

        def total(parts: Iterator[tuple]) -> list[np.ndarray]:
            sums = [np.zeros(x) for x in shapes]
            for part in parts:
                for whole, one in zip(sums, part, strict=True):
                    whole += np.frombuffer(one).reshape(whole.shape)
            return sums

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = (tuple(b.column(n)[i].as_buffer() for n in names) for b in batches for i in range(b.num_rows))
            first = next(parts, None)
            if first is not None:  # a partition that no task's sums fell into sends nothing
                yield row(total(chain([first], parts)))

        schema = ", ".join(["task int", *[f"{n} binary" for n in names]])
        filled = self.blocks.coalesce(TASKS).mapInArrow(fill, schema)
        # MERGED different keys, so no more rows than these come to the driver however many partitions a session deals out
        merged = filled.repartition(MERGED, F.col("task") % MERGED).sortWithinPartitions("task").mapInArrow(merge, schema)
        return total(tuple(r)[1:] for r in sorted(merged.collect()))

    def exchange(self, good: float, sure: float, share: float) -> None:
        """Each view is given rows of which the other one is at least `sure`, best first.

        At most `share` of the pool, in the proportion of the labels. Log odds are ranked in steps
        of 1/256; of the rows in the last step the draws choose as many as are still due.
        """
        views, limit, most = self.views, math.log(sure / (1 - sure)), max(1, int(share * self.size))
        due = [math.ceil(most * (1 - good)), math.ceil(most * good)]

        def ranked(block: tuple, v: int) -> list[tuple[np.ndarray, np.ndarray]]:
            """Rows and ranks, by the label that they would be given."""
            bins, _, given = block
            odds = Pool._odds(views[1 - v], bins[1 - v])
            free = [np.flatnonzero((given[v] < 0) & (sign * odds >= limit)) for sign in (-1, 1)]
            return [(rows, np.minimum(np.abs(odds[rows]) * 256, RANKS - 1).astype(np.int64)) for rows in free]

        def add(sums: list[np.ndarray], block: tuple) -> None:
            for v in (0, 1):
                for label, (_, ranks) in enumerate(ranked(block, v)):
                    sums[0][v, label] += np.bincount(ranks, minlength=RANKS)

        counts = self._sums([(2, 2, RANKS)], add)[0]
        cuts = {}
        for v in (0, 1):
            for label in (0, 1):
                above = np.cumsum(counts[v, label][::-1])[::-1]  # rows of this rank and better ones
                last = int((above > due[label]).sum()) - 1  # the rank in which the rows due run out
                part = (due[label] - (above[last] - counts[v, label][last])) / counts[v, label][last] if last >= 0 else 0.0
                cuts[v, label] = last, part * 2.0**32

        def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for block in Pool._blocks(b):
                    bins, draw, given = block
                    fresh = [g.copy() for g in given]
                    for v in (0, 1):
                        for label, (rows, ranks) in enumerate(ranked(block, v)):
                            last, below = cuts[v, label]
                            fresh[v][rows[(ranks > last) | (ranks == last) & (draw[rows] < below)]] = label
                    yield Pool._block([*bins, draw, *fresh])

        self.blocks = settle(self.blocks.mapInArrow(give, self.SCHEMA), "blocks")

    def fit(self, labelled: list[np.ndarray], y: np.ndarray, ridge: float = 2.0, steps: int = 12) -> None:
        """Newton steps of both views, from their present weights, over labelled rows and all rows given so far."""
        views = self.views
        own = [view.design(view.places(x)) for view, x in zip(views, labelled)]
        open_ = [0, 1]

        def add(sums: list[np.ndarray], block: tuple) -> None:
            bins, _, given = block
            for i, v in enumerate(open_):
                rows = np.flatnonzero(given[v] >= 0)
                for at in range(0, len(rows), 8192):
                    some = rows[at : at + 8192]
                    gradient, curve = slopes(views[v].design(views[v].starts[:-1] + bins[v][some]), given[v][some].astype(np.float64), views[v].weights)
                    sums[2 * i] += gradient
                    sums[2 * i + 1] += curve

        for _ in range(steps):
            shapes = [x for v in open_ for x in ((len(views[v].weights),), (len(views[v].weights),) * 2)]
            sums, left = self._sums(shapes, add), []
            for i, v in enumerate(open_):
                gradient, curve = slopes(own[v], y, views[v].weights)
                views[v].weights, settled = newton_step(views[v].weights, gradient + sums[2 * i], curve + sums[2 * i + 1], ridge)
                left += [] if settled else [v]
            open_ = left
            if not open_:
                break


class Model:
    """Two views, their calibration, and how they are combined."""

    def __init__(self, views: list[View], calibration: list[np.ndarray], mix: np.ndarray) -> None:
        self.views, self.calibration, self.mix = views, calibration, mix

    def view_odds(self, parts: list[np.ndarray]) -> np.ndarray:
        """Calibrated log odds, a column for each view."""
        return np.column_stack([c[0] + c[1] * np.clip(v.log_odds(x), -12, 12) for v, x, c in zip(self.views, parts, self.calibration)])

    def probability(self, odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.mix[0] + odds @ self.mix[1:], -30, 30)))


def co_train(labelled: list[np.ndarray], y: np.ndarray, views: list[View], pool: DataFrame, rounds: int, sure: float, share: float) -> Model:
    """`labelled` holds a matrix for each view, `pool` the rows of `Pool`; every fifth labelled row only calibrates."""
    hold = np.arange(len(y)) % 5 == 4
    learned = [x[~hold] for x in labelled]
    for view, x in zip(views, learned):
        view.fit(x, y[~hold])
    rest = Pool(pool, views)
    for _ in range(rounds if rest.size else 0):
        rest.exchange(float(y.mean()), sure, share)
        rest.fit(learned, y[~hold])
    ones = lambda *c: np.column_stack([np.ones(len(c[0])), *c])
    both = [np.clip(view.log_odds(x[hold]), -12, 12) for view, x in zip(views, labelled)]
    known = y[hold]
    if len(known) < 20 or known.min() == known.max():
        calibration, mix = [np.array([0.0, 1.0])] * 2, np.array([-math.log(y.mean() / (1 - y.mean())), 1.0, 1.0])
    else:
        calibration = [newton(ones(o), known, 1e-2, 30) for o in both]
        odds = [c[0] + c[1] * o for c, o in zip(calibration, both)]
        mix = newton(ones(*odds), known, 1e-2, 30)
    return Model(views, calibration, mix)


def split(column: pa.Array) -> list[np.ndarray]:
    """The numbers of each view."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, TEXT_FEATURES + PAGE_FEATURES)
    return [flat[:, :TEXT_FEATURES], flat[:, TEXT_FEATURES:]]


def make_views(features: DataFrame) -> list[View]:
    """Bins at the quantiles of all rows (ranks within a ten-thousandth), with bins of their own for the extreme hundredths, where junk is."""
    at = sorted([*np.linspace(0, 1, BINS + 1)[1:-1].tolist(), 0.01, 0.03, 0.97, 0.99])
    kinds = {TEXT_FEATURES: SOURCES, TEXT_FEATURES + 1: 16}
    columns = [j for j in range(TEXT_FEATURES + PAGE_FEATURES) if j not in kinds]
    found = features.agg(*[F.percentile_approx(F.col("f")[j], at, 10_000).alias(str(j)) for j in columns]).first()
    cuts = [None if j in kinds else found[str(j)] for j in range(TEXT_FEATURES + PAGE_FEATURES)]
    return [View(cuts[:TEXT_FEATURES], {}), View(cuts[TEXT_FEATURES:], {0: SOURCES, 1: 16})]


def classify(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n_chars: str = "n_chars",
    lang: str = "lang",
    source: str = "source",
    sample: int = 12_000,
    rounds: int = 4,
    sure: float = 0.97,
    share: float = 0.1,
    keep_at: float = 0.5,
) -> DataFrame:
    """Adds to every row: text_score, page_score, score (probability of good quality), kept.

    Learns from at most `sample` rows of `labels` (doc_id, quality), those with the smallest
    hashes, which come to the driver as 25 numbers each, and from every unlabelled row; bins are
    cut over all rows. Every whole text is scored in its partition. NULL texts count as empty, NULL
    metadata as a kind of its own; repeated rows score alike. Without labels of both kinds
    nothing is rejected and every score is the share of good labels (1 without labels).
    Columns named like new ones are replaced.
    """
    names = ["text_score", "page_score", "score", "kept"]
    fields = [StructField(n, DoubleType()) for n in names[:3]] + [StructField("kept", BooleanType())]
    base = df.drop(*[n for n in names if n not in (doc_id, text, n_chars, lang, source)])

    def read(batch: pa.RecordBatch, of: list[str] = [text, n_chars, lang, source]) -> list[list[float]]:  # noqa: B006
        columns = [batch.column(c).to_pylist() for c in of]
        return [text_features(t or "") + page_features(t or "", n, g, s) for t, n, g, s in zip(*columns, strict=True)]

    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_l")).agg(F.min("quality").alias("label"))
    known = known.withColumn("h", F.xxhash64("_l"))
    chosen = known.orderBy("h", "_l").limit(sample)  # bounded, so it may be broadcast
    rows = base.select(F.col(doc_id).alias("_i"), *[F.col(c).alias(f"_{i}") for i, c in enumerate((text, n_chars, lang, source))])
    start = lambda: lambda b: [pa.array(read(b, [f"_{i}" for i in range(4)]), pa.list_(pa.float64()))]
    features = settle(add_columns(rows, [StructField("f", ArrayType(DoubleType()))], start).select("_i", "f"), "features")
    seen = features.join(F.broadcast(chosen), F.col("_i") == F.col("_l")).groupBy("h", "_l", "label").agg(F.min("f").alias("f"))
    table = seen.orderBy("h", "_l").select("f", "label").toArrow().combine_chunks()
    y = np.array(table.column("label").to_pylist(), dtype=np.float64)
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 1.0
        return base.withColumns({n: F.lit(rate) for n in names[:3]}).withColumn("kept", F.lit(True))
    unknown = features.where("_i is not null").join(known.select("_l"), F.col("_i") == F.col("_l"), "left_anti")
    pool = unknown.unionByName(features.where("_i is null")).select("f", F.xxhash64("_i", "f").alias("draw"))
    model = co_train(split(table.column("f").chunk(0)), y, make_views(features), pool, rounds, sure, share)

    def judge(batch: pa.RecordBatch) -> list[pa.Array]:
        flat = np.array(read(batch), dtype=np.float64).reshape(-1, TEXT_FEATURES + PAGE_FEATURES)
        odds = model.view_odds([flat[:, :TEXT_FEATURES], flat[:, TEXT_FEATURES:]])
        p = model.probability(odds)
        views = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        return [pa.array(views[:, 0]), pa.array(views[:, 1]), pa.array(p), pa.array(p >= keep_at)]

    return add_columns(base, fields, lambda: judge)
