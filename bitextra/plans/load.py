"""Load jobs: every enabled dataset through its loader and the schema gate into parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..registry import loaders
from ..schema import null_counts, require_parallel
from ..sources import readers  # noqa: F401  (registers the loaders)
from .spec import read_yaml


def run_load(spark: SparkSession, spec: dict | str, out: str) -> dict[str, dict]:
    """Writes {out}/{name}.parquet per dataset; returns rows and null counts of each."""
    spec = spec if isinstance(spec, dict) else read_yaml(spec)
    report = {}
    for config in spec.get("datasets", []):
        if not config.get("enabled", True):
            continue
        name = config["name"]
        df = require_parallel(loaders.get(config["loader_function"])(spark, config), config["loader_function"])
        path = f"{out}/{name}.parquet"
        df.write.mode("overwrite").parquet(path)
        written = spark.read.parquet(path)
        nulls = null_counts(written).first().asDict()  # three numbers
        for c, n in nulls.items():
            if n:
                print(f"warning: {name} has {n} rows with {c.replace('null_', 'NULL ')}")
        report[name] = {"rows": written.count(), **nulls}
    return report


def load_dataset(spark: SparkSession, config: dict) -> DataFrame:
    return require_parallel(loaders.get(config["loader_function"])(spark, config), config["loader_function"])
