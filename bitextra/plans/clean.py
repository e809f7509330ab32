"""Cleaning jobs: an ordered list of cleaners as one pass over the data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.sampling import preview_by
from ..registry import cleaners
from ..schema import require_conserved, watch
from ..sources.writers import INTERNAL, write_samples
from .spec import JobSpec, Step, require_valid

Scorer = Callable[[DataFrame], DataFrame]


def mark_failing_step(df: DataFrame, steps: list[Step], scorer: Scorer | None = None) -> DataFrame:
    """Add `_step`: the position of the first cleaner a row fails, or the number of cleaners.

    All cleaners form one expression, so the data is read once. A cleaner that needs a score
    runs the scorer on the rows still alive only, cheap rules having gone first.
    """
    n = len(steps)
    alive, dead, first = df, [], 0
    pending: list[tuple[int, Column]] = []

    def verdict(rules: list[tuple[int, Column]]) -> Column:
        failed = [F.when(~keep, F.lit(i)) for i, keep in rules]
        return F.coalesce(*failed, F.lit(n))

    for i, step in enumerate(steps):
        cleaner = cleaners.get(step.name)
        if getattr(cleaner, "needs_score", False) and "similarity_score" not in alive.columns:
            if scorer is None:
                raise ValueError(f"{step.name} needs a scorer or a similarity_score column")
            marked = alive.withColumn("_step", verdict(pending))
            dead.append(marked.where(F.col("_step") < n))
            alive, pending = scorer(marked.where(F.col("_step") == n).drop("_step")), []
        pending.append((i, cleaner(step.params)))
    out = alive.withColumn("_step", verdict(pending))
    for part in dead:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def reason(steps: list[Step]) -> Column:
    names = F.array(*[F.lit(s.name) for s in steps])
    return F.get(names, F.col("_step"))


def clean(df: DataFrame, spec: JobSpec | dict | str, scorer: Scorer | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, dropped, per-step stats). Dropped rows carry `_reason`, the cleaner's name."""
    steps = require_valid(spec, ["cleaners"]).enabled("cleaners")
    marked = mark_failing_step(df, steps, scorer)
    kept = marked.where(F.col("_step") == len(steps)).select(*df.columns)
    extra = ["similarity_score"] if "similarity_score" in marked.columns and "similarity_score" not in df.columns else []
    dropped = marked.where(F.col("_step") < len(steps)).select(*df.columns, *extra, reason(steps).alias("_reason"))
    return kept, dropped, cleaning_stats(marked, steps)


def run_cleaning(df: DataFrame, spec: JobSpec | dict | str, out: str, scorer: Scorer | None = None) -> DataFrame:
    """Clean in one pass: rows go to {out}/rows by status and dataset; returns the stats.

    `settings.save_dropped_data: false` keeps the dropped rows' ids and reasons only. Rows are
    counted on their way in and out of that pass, and an error tells if they differ.
    `settings.preview_rows` (20) rows per cleaner that drops some go to {out}/samples.
    """
    spec = require_valid(spec, ["cleaners"])
    steps = spec.enabled("cleaners")
    base = df if "dataset" in df.columns else df.withColumn("dataset", F.lit("all"))
    base, came = watch(base.drop(*INTERNAL), "cleaning_in")
    marked, left = watch(mark_failing_step(base, steps, scorer), "cleaning_out")
    is_kept = F.col("_step") == len(steps)
    rows = marked.withColumns(
        {"_reason": reason(steps), "status": F.when(is_kept, "kept").otherwise("dropped")}
    )
    if not spec.settings.get("save_dropped_data", True):
        rows = rows.withColumns({c: F.when(is_kept, F.col(c)) for c in ("title", "en", "ka") if c in rows.columns})
    path = f"{out}/rows"
    rows.hint("rebalance", "status", "dataset").write.mode("overwrite").partitionBy("status", "dataset").parquet(path)
    require_conserved(came, left, "cleaning")
    written = df.sparkSession.read.schema(_stored(rows)).parquet(path)
    previews = int(spec.settings.get("preview_rows", 20))
    if previews > 0:
        dropped = written.where(F.col("status") == "dropped").drop("_step")
        write_samples([preview_by(dropped, previews, ["id"], "_reason", "dropped")], f"{out}/samples")
    return cleaning_stats(written.select("dataset", "_step"), steps)


def _stored(rows: DataFrame) -> StructType:
    """Types of the written rows, so that an empty result can be read again."""
    return StructType([StructField(f.name, f.dataType) for f in rows.schema])


def read_kept(spark: SparkSession, out: str) -> DataFrame:
    """The rows a cleaning run kept, with their dataset."""
    rows = spark.read.parquet(f"{out}/rows").where(F.col("status") == "kept")
    return rows.drop("status", "_step", "_reason")


def cleaning_stats(marked: DataFrame, steps: list[Step], by: str = "dataset") -> DataFrame:
    """(dataset, step, cleaner, original, cleaned, dropped, retention) plus totals (dataset NULL).

    One grouped aggregate gives all steps at once; `rollup` adds the totals.
    """
    if by not in marked.columns:
        marked = marked.withColumn(by, F.lit("all"))
    counts = marked.rollup(by).agg(
        F.grouping(by).alias("_total"),
        *[F.count_if(F.col("_step") >= i).alias(f"_in{i}") for i in range(len(steps))],
        *[F.count_if(F.col("_step") == i).alias(f"_out{i}") for i in range(len(steps))],
    )
    per_step = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(s.name).alias("cleaner"),
                F.col(f"_in{i}").alias("original"),
                (F.col(f"_in{i}") - F.col(f"_out{i}")).alias("cleaned"),
                F.col(f"_out{i}").alias("dropped"),
            )
            for i, s in enumerate(steps)
        ]
    )
    rows = counts.select(by, F.col("_total").cast("boolean").alias("is_total"), F.inline(per_step))
    return rows.withColumn("retention", F.coalesce(F.try_divide(F.col("cleaned"), F.col("original")), F.lit(0.0)))


def cleaning_summary(stats: DataFrame, n_steps: int) -> DataFrame:
    """Rows before and after the whole chain, from its per-step stats."""
    ends = stats.groupBy("dataset", "is_total").agg(
        F.max(F.when(F.col("step") == 0, F.col("original"))).alias("original"),
        F.max(F.when(F.col("step") == n_steps - 1, F.col("cleaned"))).alias("cleaned"),
    )
    share = F.coalesce(F.try_divide(F.col("cleaned"), F.col("original")), F.lit(0.0))
    return ends.withColumns({"dropped": F.col("original") - F.col("cleaned"), "retention": share})
