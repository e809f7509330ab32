"""Split jobs: sample the sources of each split, remove contamination, report."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..operators import contamination as C
from ..operators.sampling import preview_rows, sample_percentage, sample_stratified, shuffle_rows


def build_split(split: dict, load: Callable[[str], DataFrame], settings: dict | None = None, key: list[str] | None = None) -> DataFrame:
    """Rows of one split: each source sampled (stratified by domain unless told otherwise)."""
    settings, key = settings or {}, key or ["id"]
    parts = []
    for source in split.get("sources", []):
        df = load(source["artifact"])
        percentage, seed = source["percentage"], source.get("seed", settings.get("random_seed", 42))
        if settings.get("stratify_by_domain", True):
            least = settings.get("min_samples_per_domain", 10)
            part = sample_stratified(df, percentage, key, seed, min_rows=least)
        else:
            part = sample_percentage(df, percentage, key, seed)
        parts.append(part)
    if not parts:
        raise ValueError("a split needs at least one source")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def build_splits(spec: dict, load: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    return {name: build_split(s, load, spec.get("settings")) for name, s in spec["splits"].items()}


def decontaminate(splits: dict[str, DataFrame], check: dict) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """(cleaned splits, report). Pairs are checked in order, against the original source."""
    if not check.get("enabled", True):
        return dict(splits), None
    pairs = []
    for pair in check.get("check_pairs", []):
        if pair["source"] in splits and pair["target"] in splits:
            pairs.append((pair["source"], pair["target"], pair.get("action", "remove_from_target") == "remove_from_target"))
        else:
            print(f"skipping contamination check {pair['source']} -> {pair['target']}: split missing")
    if not pairs:
        return dict(splits), None
    decide = _by_contents if C.settles_by_bands(check.get("methods")) else _by_rows
    cleaned, stats = decide(splits, pairs, check.get("methods"))
    return cleaned, C.contamination_report(stats)


def _by_rows(splits: dict[str, DataFrame], pairs: list, methods: dict | None) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    cleaned, stats = dict(splits), []
    for source, target, remove in pairs:
        flagged = C.flag_contamination(splits[source], cleaned[target], methods)
        stats.append(C.contamination_stats(splits[source], flagged, source, target))
        if remove:
            cleaned[target], _ = C.divide_contaminated(flagged)
    return cleaned, stats


def _by_contents(splits: dict[str, DataFrame], pairs: list, methods: dict | None) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """All checks on one table of signed contents; the rows of a target are joined once, to all that leaves it."""
    names = list(dict.fromkeys(n for pair in pairs for n in pair[:2]))
    whole = {n: F.col(f"_n{i}") for i, n in enumerate(names)}
    left = {n: F.col(f"_left{i}") for i, n in enumerate(names)}
    contents = C.signed_contents([splits[n] for n in names], methods)
    contents = contents.select("*", *[whole[n].alias(f"_left{i}") for i, n in enumerate(names)], F.concat("_exact", "_near").alias("_content"))
    gone, stats = {}, []
    for source, target, remove in pairs:
        bad = C.contaminated_contents(contents, whole[source], left[target], methods, cut_lineage=remove)
        stats.append(C.content_stats(contents, whole[source], left[target], bad, source, target))
        if remove:
            gone[target] = gone[target].unionByName(bad) if target in gone else bad
            at = f"_left{names.index(target)}"
            out = bad.select("_content", F.lit(True).alias("_out"))
            contents = contents.join(out, "_content", "left").withColumn(at, F.when(F.col("_out"), 0).otherwise(F.col(at))).drop("_out")
    return splits | {n: C.without_contents(splits[n], bad, methods) for n, bad in gone.items()}, stats


def tagged(splits: dict[str, DataFrame]) -> DataFrame:
    """All splits as one table with a `split` column."""
    parts = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def split_stats(rows: DataFrame, source: str = "source_artifact") -> DataFrame:
    """(split, size, percentage, unique_sources, num_domains)."""
    has_source = source in rows.columns
    counts = rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("size"),
        (F.count_distinct(source) if has_source else F.lit(0).cast("long")).alias("unique_sources"),
        F.count_distinct("domain").alias("num_domains"),
    )
    return counts.withColumn("percentage", _percent_of_all("size"))


def _percent_of_all(c: str):


    return F.col(c) * F.lit(100.0) / F.sum(c).over(Window.partitionBy(F.lit(1)))  # one row per split


def domain_distribution(rows: DataFrame) -> DataFrame:
    """(split, domain, count, percentage of its split)."""
    counts = rows.groupBy("split", "domain").count()
    sizes = counts.groupBy("split").agg(F.sum("count").alias("_size"))
    # one row per split
    return counts.join(F.broadcast(sizes), "split").select(
        "split", "domain", "count", (F.col("count") * F.lit(100.0) / F.col("_size")).alias("percentage")
    )


def domain_pivot(rows: DataFrame, splits: list[str], k: int = 10) -> DataFrame:
    """Counts of the k largest domains, one column per split."""
    wide = rows.groupBy("domain").pivot("split", splits).count().fillna(0, subset=splits)
    total = reduce(lambda a, b: a + b, [F.col(s) for s in splits])
    return wide.withColumn("total", total).orderBy(F.desc("total"), F.asc("domain")).limit(k)


def source_pivot(rows: DataFrame, splits: list[str], source: str = "source_artifact") -> DataFrame:
    return rows.groupBy(source).pivot("split", splits).count().fillna(0, subset=splits)


def run_splitting(spec: dict, load: Callable[[str], DataFrame], out: str | None = None) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Build, decontaminate, optionally shuffle and write the splits; returns them and the report."""
    from ..sources.writers import write_samples, write_splits

    cleaned, report = decontaminate(build_splits(spec, load), spec.get("contamination_check", {}))
    if (spec.get("settings") or {}).get("shuffle_before_split", True) and out:
        cleaned = {n: shuffle_rows(df, ["id"]) for n, df in cleaned.items()}
    if out:
        write_splits(cleaned, out)
        previews = int((spec.get("settings") or {}).get("preview_rows", 20))
        if previews > 0:
            stored = {n: df.sparkSession.read.schema(df.schema).parquet(f"{out}/{n}.parquet") for n, df in cleaned.items()}
            write_samples([preview_rows(df, previews, ["id"], n) for n, df in stored.items()], f"{out}/_samples")
    return cleaned, report
