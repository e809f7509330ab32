"""Paths on whatever file system Spark is configured for, and versioned collections."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def listing(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; hidden and marker files left out."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def new_version(root: str, now: datetime | None = None) -> str:
    """A run folder named by time, YYYY-MM-DD_HH-MM-SS."""
    return f"{root.rstrip('/')}/{(now or datetime.now()).strftime('%Y-%m-%d_%H-%M-%S')}"


def _version_order(v: str) -> tuple:
    return (0, int(v[1:]), "") if v[:1] == "v" and v[1:].isdigit() else (1, 0, v)


class Collections:
    """Resolves `name:version` under a root; `latest` (or no version) is the newest one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self._known = spark, root.rstrip("/"), {}

    def resolve(self, ref: str) -> str:
        if ref not in self._known:
            name, _, version = ref.partition(":")
            base = f"{self.root}/{name}"
            if version in ("", "latest"):
                versions = listing(self.spark, base)
                if not versions:
                    raise ValueError(f"no version of '{name}' under {self.root}")
                version = max(versions, key=_version_order)
            if not exists(self.spark, f"{base}/{version}"):
                raise ValueError(f"collection '{ref}' not found under {self.root}")
            self._known[ref] = f"{base}/{version}"
        return self._known[ref]
