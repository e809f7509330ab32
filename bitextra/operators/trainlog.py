"""Early stopping found in a table of evaluation results."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from .lookup import dense_index, null_safe_join, row_index


def _running_max(df: DataFrame, run: str, value: Column, name: str, inclusive: bool, cell: int) -> DataFrame:
    """max(value) over all earlier rows of the run, computed cell by cell of `cell` rows."""
    rows = df.withColumn("_v", value).withColumn("_c", F.floor(F.col("_i") / cell))
    before = Window.partitionBy(run).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(run, "_c").agg(F.max("_v").alias("_cm")).withColumn("_prior", F.max("_cm").over(before))
    here = Window.partitionBy(run, "_c").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    rows = rows.withColumn("_local", F.max("_v").over(here))
    joined = null_safe_join(rows, cells, [run, "_c"], ["_prior"])
    return joined.withColumn(name, F.greatest("_local", "_prior")).drop("_v", "_c", "_local", "_prior")


def _improvements(records: DataFrame, run: str, min_delta: float) -> DataFrame:
    """(run, _i) of the records that beat the last accepted one by more than min_delta.

    Whether a record counts depends on the one accepted before it, so the records of a run
    are read in order, one task per run, in constant memory.
    """

    def accept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, best, begun = None, 0.0, False
        for batch in batches:
            kept = []
            for at, (r, m) in enumerate(zip(batch[run].astype(object).where(batch[run].notna(), None), batch["_m"])):
                if not begun or r != current or m > best + min_delta:
                    current, best, begun = r, m, True
                    kept.append(at)
            yield batch.iloc[kept][[run, "_i"]]

    ordered = records.select(run, "_i", "_m").repartition(run).sortWithinPartitions(run, "_i")
    return ordered.mapInPandas(accept, records.select(run, "_i").schema)


def early_stopping(
    log: DataFrame,
    run: str,
    order: list[str],
    metric: str,
    patience: int = 3,
    greater_is_better: bool = False,
    min_delta: float = 0.0,
    cell: int = 1 << 16,
) -> DataFrame:
    """(run, evaluations, stop_index, best): the first evaluation at which `patience` have
    passed without a metric better by more than min_delta, NULL when that never happens.
    `order` is of any types and unique within the run.

    A long run is worked through in cells of equal size that run side by side: its rows are
    numbered by consecutive integers, if one is the whole order, else by sampled ranges. Only new
    maxima can be improvements; a min_delta is applied to them alone.
    """
    sign = 1.0 if greater_is_better else -1.0
    measured = log.where(F.col(metric).isNotNull()).select(*dict.fromkeys([run, *order, metric]))
    if len(order) == 1 and isinstance(measured.schema[order[0]].dataType, IntegralType):
        numbered = dense_index(measured, order, [run], "_i")
    else:
        numbered = row_index(measured, order, "_i", [run], [metric])
    rows = numbered.withColumn("_m", F.col(metric) * F.lit(sign))
    rows = _running_max(rows, run, F.col("_m"), "_top", False, cell)
    record = F.col("_top").isNull() | (F.col("_m") > F.col("_top"))
    if min_delta > 0:
        accepted = _improvements(rows.where(record), run, min_delta).withColumn("_up", F.col("_i"))
        rows = null_safe_join(rows, accepted, [run, "_i"], ["_up"], "left")
    else:
        rows = rows.withColumn("_up", F.when(record, F.col("_i")))
    rows = _running_max(rows, run, F.col("_up"), "_last", True, cell)
    waited = F.col("_i") - F.col("_last")
    return rows.groupBy(run).agg(
        F.count(F.lit(1)).alias("evaluations"),
        F.min(F.when(waited >= patience, F.col("_i"))).alias("stop_index"),
        (F.max("_m") * F.lit(sign)).alias("best"),
    )
