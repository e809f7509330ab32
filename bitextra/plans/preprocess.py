"""Preprocessing and augmentation jobs."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.cleaners import final_empty_filter
from ..operators.dedup import drop_duplicates, mark_duplicates
from ..operators.lookup import ensure_checkpoint_dir
from ..operators.sampling import preview_rows
from ..registry import augmenters, preprocessors
from ..schema import require_conserved, require_same_columns, watch
from ..sources.writers import write_datasets, write_samples
from .spec import JobSpec, Step, require_valid


def preprocess(df: DataFrame, steps: list[Step]) -> DataFrame:
    """All steps as one chain of projections; columns and rows stay as they are."""
    for step in steps:
        df = require_same_columns(df, preprocessors.get(step.name)(df, step.params), step.name)
    return df


def preprocess_stats(df: DataFrame, steps: list[Step], columns: tuple[str, ...] = ("en", "ka")) -> DataFrame:
    """(step, preprocessor, rows, rows_changed, change_percentage) in one pass over the data."""
    names, current = df.columns, df
    for i, step in enumerate(steps):
        before = current.withColumns({f"_b_{c}": F.col(c) for c in columns})
        after = preprocessors.get(step.name)(before, step.params)
        current = after.withColumn(f"_changed{i}", changed(columns)).drop(*[f"_b_{c}" for c in columns])
        require_same_columns(df, current.select(*names), step.name)
    totals = current.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(f"_changed{i}").alias(f"_c{i}") for i in range(len(steps))],
    )
    per_step = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(s.name).alias("preprocessor"), F.col(f"_c{i}").alias("rows_changed"))
            for i, s in enumerate(steps)
        ]
    )
    share = F.coalesce(F.try_divide(F.col("rows_changed") * F.lit(100.0), F.col("rows")), F.lit(0.0))
    return totals.select("rows", F.inline(per_step)).withColumn("change_percentage", share)


def changed(columns: tuple[str, ...], before: str = "_b_"):
    differs = [~F.col(f"{before}{c}").eqNullSafe(F.col(c)) for c in columns]
    return reduce(lambda a, b: a | b, differs)


def changed_rows(df: DataFrame, step: Step, columns: tuple[str, ...] = ("en", "ka")) -> DataFrame:
    """Rows a step changes, with the texts before and after it.

    The new texts pass through an array of one entry: a filter that names them would else be
    moved below joins and exchanges, and the step would run there and here.
    """
    before = df.withColumns({f"_b_{c}": F.col(c) for c in columns})
    after = preprocessors.get(step.name)(before, step.params)
    others = [c for c in after.columns if c not in columns]
    once = after.select(*others, F.inline(F.array(F.struct(*columns))))
    sides = [x for c in columns for x in (F.col(f"_b_{c}").alias(f"{c}_before"), F.col(c).alias(f"{c}_after"))]
    position = [F.col("row_pos").alias("index")] if "row_pos" in df.columns else []
    return once.where(changed(columns)).select(*position, *sides, "domain", "id")


def augment(df: DataFrame, steps: list[Step], settings: dict | None = None, part: str | None = None) -> DataFrame:
    """Input plus the rows of each augmenter.

    An augmenter that replaces the table acts at its place in the list: those after it see
    the new table, those before it saw the old one. `part` names a column that tells the
    input (0) from the rows of the first, second, ... augmenter.
    """
    seed = (settings or {}).get("random_seed")
    current, extra = df, []
    for step in steps:
        fn = augmenters.get(step.name)
        params = {**({"random_seed": seed} if seed is not None else {}), **step.params}
        made = require_same_columns(current, fn(current, params), step.name)
        if getattr(fn, "replaces", False):
            current = made
        else:
            extra.append(made)
    tables = [current, *extra]
    if part:
        tables = [t.withColumn(part, F.lit(i)) for i, t in enumerate(tables)]
    return reduce(DataFrame.unionByName, tables)


def augmentation_stats(df: DataFrame, augmented: DataFrame) -> DataFrame:
    """Rows before and after, and generated rows per original row."""
    sides = df.select(F.lit(0).alias("_new")).unionAll(augmented.select(F.lit(1).alias("_new")))
    counts = sides.agg(F.count_if(F.col("_new") == 0).alias("original"), F.count_if(F.col("_new") == 1).alias("final"))
    made = F.col("final") - F.col("original")
    ratio = F.coalesce(F.try_divide(made, F.col("original")), F.lit(0.0))
    return counts.withColumns({"generated": made, "augmentation_ratio": ratio})


def mark_cleanup(df: DataFrame, order: str = "id") -> DataFrame:
    """`_fate` of each row: 'empty', 'duplicate' of an earlier (en, ka) pair, or 'kept'."""
    # blankness depends on the pair alone, so a group of equal pairs is blank as a whole; it is
    # judged before the join with the duplicates, which texts then enter only if they are read behind it
    judged = df.withColumn("_blank", ~final_empty_filter())
    marked = mark_duplicates(judged, ["en", "ka"], order, "_later", of=df.columns)
    fate = F.when(F.col("_blank"), "empty").when(F.col("_later"), "duplicate").otherwise("kept")
    return marked.withColumn("_fate", fate).drop("_later", "_blank")


def final_cleanup(df: DataFrame, order: str = "id") -> DataFrame:
    """The rows that `mark_cleanup` calls kept, in one pass over the others."""
    return drop_duplicates(df.where(final_empty_filter()), ["en", "ka"], order)


def cleanup_stats(marked: DataFrame) -> DataFrame:
    is_ = lambda fate: F.count_if(F.col("_fate") == fate)
    counts = marked.agg(
        F.count(F.lit(1)).alias("original_rows"),
        is_("kept").alias("final_rows"),
        is_("empty").alias("empty_content_removed"),
        is_("duplicate").alias("duplicates_removed"),
    )
    original, removed = F.col("original_rows"), F.col("original_rows") - F.col("final_rows")
    pct = lambda part, whole: F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))
    return counts.withColumns(
        {
            "total_removed": removed,
            "empty_content_percentage": pct(F.col("empty_content_removed"), original),
            "duplicate_percentage": pct(F.col("duplicates_removed"), original - F.col("empty_content_removed")),
            "total_removal_percentage": pct(removed, original),
            "retention_rate": F.coalesce(F.try_divide(F.col("final_rows"), original), F.lit(1.0)),
        }
    )


def preprocessing_summary(original: DataFrame, marked: DataFrame, by: str = "dataset") -> DataFrame:
    """Rows before, after augmentation and after cleanup per dataset, and in total (rollup)."""
    stages = original.select(by, F.lit("in").alias("_stage")).unionAll(marked.select(by, F.col("_fate").alias("_stage")))
    counts = stages.rollup(by).agg(
        F.grouping(by).cast("boolean").alias("is_total"),
        F.count_if(F.col("_stage") == "in").alias("original_rows"),
        F.count_if(F.col("_stage") != "in").alias("augmented_rows"),
        F.count_if(F.col("_stage") == "kept").alias("final_rows"),
    )
    removed = F.col("augmented_rows") - F.col("final_rows")
    made = F.col("augmented_rows") - F.col("original_rows")
    return counts.withColumns(
        {
            "cleanup_percentage": F.coalesce(F.try_divide(removed * F.lit(100.0), F.col("augmented_rows")), F.lit(0.0)),
            "augmentation_ratio": F.coalesce(F.try_divide(made, F.col("original_rows")), F.lit(0.0)),
        }
    )


def step_speeds(df: DataFrame, steps: list[Step]) -> list[dict]:
    """Seconds and rows per second of each step on its own, measured from the driver."""
    rows, out = df.count(), []
    for step in steps:
        start = time.perf_counter()
        preprocessors.get(step.name)(df, step.params).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        out.append({"preprocessor": step.name, "rows": rows, "seconds": seconds, "rows_per_second": rows / seconds})
    return out


def run_preprocessing(
    df: DataFrame, spec: JobSpec | dict | str, order: str = "id", out: str | None = None, suffix: str = "_processed"
) -> DataFrame:
    """Preprocess, augment, then drop blank rows and repeated pairs.

    The preprocessed table is written to the checkpoint folder: each augmenter and the
    cleanup read it from there instead of running the text functions again. Rows are counted on
    their way into that table and out of it. With `out`, `settings.preview_rows` (20) rows of the
    input, the preprocessed and the final table go to {out}/_samples.
    """
    spec = require_valid(spec, ["preprocessors"])
    ensure_checkpoint_dir(df.sparkSession)
    watched, came = watch(df, "preprocessing_in")
    done, left = watch(preprocess(watched, spec.enabled("preprocessors")), "preprocessing_out")
    done = done.checkpoint()
    require_conserved(came, left, "preprocessing")
    grown = augment(done, spec.enabled("augmenters"), spec.settings, part="_part")
    # of equal pairs the input's own row comes first, then augmenters in their order
    place = F.concat_ws(":", F.lpad(F.col("_part").cast("string"), 3, "0"), F.col(order).cast("string"))
    final = final_cleanup(grown.withColumn("_place", place), "_place").drop("_part", "_place")
    if out:
        write_datasets(final, out, suffix)
        previews = int(spec.settings.get("preview_rows", 20))
        if previews > 0:
            stages = {"input": df, "preprocessed": done, "final": final}
            write_samples([preview_rows(rows, previews, ["id"], stage) for stage, rows in stages.items()], f"{out}/_samples")
    return final
