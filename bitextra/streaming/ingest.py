"""The cleaners and preprocessors of a batch job, applied to rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import digest, joined_digest
from ..plans.clean import mark_failing_step, reason
from ..plans.preprocess import preprocess
from ..plans.spec import JobSpec, load_spec

_SALTS = 64


def clean_stream(
    stream: DataFrame,
    spec: JobSpec | dict | str,
    event_time: str,
    delay: str = "1 hour",
    protected: DataFrame | None = None,
    columns: tuple[str, ...] = ("en", "ka"),
) -> DataFrame:
    """Rows with `_reason`: the cleaner that dropped a row, 'protected', or NULL for kept rows.

    Kept rows are preprocessed and pass once per (en, ka) within the watermark delay; dropped
    rows all pass, whatever their ids, and need no state. Copies are first dropped per salt and then per pair, so a text that arrives in masses does not
    end up in one task. `protected` is a static table whose pairs must not get through.
    """
    spec = load_spec(spec)
    steps = spec.enabled("cleaners")
    marked = mark_failing_step(stream, steps).withColumn("_reason", reason(steps)).drop("_step")
    done = preprocess(marked, spec.enabled("preprocessors"))
    if protected is not None:
        keys = protected.select(joined_digest(*[F.col(c) for c in columns]).alias("_key"), F.lit(True).alias("_hit"))
        done = done.withColumn("_key", joined_digest(*[F.col(c) for c in columns])).join(keys.distinct(), "_key", "left")
        done = done.withColumn("_reason", F.coalesce("_reason", F.when(F.col("_hit"), "protected"))).drop("_key", "_hit")
    once = digest(*[F.col(c) for c in columns])
    kept = done.where(F.col("_reason").isNull())
    salted = kept.withColumns({"_once": once, "_salt": F.pmod(F.xxhash64("id", event_time), F.lit(_SALTS)).cast("int")})
    first = salted.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["_once", "_salt"])
    unique = first.dropDuplicatesWithinWatermark(["_once"]).drop("_once", "_salt")
    return unique.unionByName(done.where(F.col("_reason").isNotNull()))


def start_ingest(cleaned: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write kept and dropped rows of each micro-batch; a repeated batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = batch.withColumn("status", F.when(F.col("_reason").isNull(), "kept").otherwise("dropped"))
        parts.write.mode("overwrite").partitionBy("status").parquet(f"{out}/batch={batch_id}")

    writer = cleaned.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
