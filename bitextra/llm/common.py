"""What the operators of this subpackage share: folders, Arrow columns, word patterns, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.lookup import ensure_checkpoint_dir

#: Rows that a Python function gets at once.
ROWS = 1024
#: A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the folder that driver and executors share (spark.checkpoint.dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Schemes of Spark's paths that pyarrow knows, and its own names for them.
ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def shared_uri(spark: SparkSession, folder: str) -> str:
    """The folder as a URI that names for pyarrow, in driver and tasks, the place that Spark reads under `folder`.

    A path without a scheme is one of Spark's default file system. Stores that pyarrow does not know
    are refused here, before any work. Credentials of a store are those that pyarrow finds on the
    machines (environment, roles), not Spark's.
    """
    scheme, colon, _ = folder.partition(":")
    if not colon or "/" in scheme:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    scheme, _, rest = folder.partition(":")
    if scheme not in ARROW_SCHEMES:
        raise ValueError(f"files cannot be written to {scheme}: by tasks; known are {', '.join(ARROW_SCHEMES)}")
    if not rest.startswith("//"):  # Hadoop writes file:/path
        rest = "//" + rest
    return f"{ARROW_SCHEMES[scheme]}:{quote(rest, safe='/:@')}"


class Store:
    """A folder of files with names of their own, for tasks; picklable, opened where it is used."""

    def __init__(self, uri: str) -> None:
        self.uri = uri
        self._at: tuple[fs.FileSystem, str] | None = None

    def __getstate__(self) -> dict:
        return {"uri": self.uri, "_at": None}

    def _open(self) -> tuple[fs.FileSystem, str]:
        if self._at is None:
            self._at = fs.FileSystem.from_uri(self.uri)
        return self._at

    def write(self, name: str, data: bytes) -> None:
        system, path = self._open()
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{name}", compression=None) as f:
            f.write(data)

    def read(self, name: str) -> bytes:
        system, path = self._open()
        with system.open_input_stream(f"{path}/{name}", compression=None) as f:
            return f.read()


def settle(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The table written to the shared folder and read again: computed once, no lineage."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same_or_null(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def add_columns(
    df: DataFrame,
    fields: list[StructField],
    start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
) -> DataFrame:
    """All columns and the new ones, made batch by batch in Python.

    `start()` runs once per task and returns the function of a batch. A column that already
    has the name of a new one is replaced.
    """
    base = df.drop(*[f.name for f in fields])
    schema = StructType([*base.schema.fields, *fields])
    names = schema.fieldNames()
    # what the function reads may be among the replaced columns
    kept = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), ROWS):
                b = whole.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *make(b)], names=names)

    return df.mapInArrow(run, schema)


def carried(df: DataFrame, needed: list[str], run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """run(df) in which columns that are not `needed` travel in one struct, out of the way of names inside `run`.

    They come back under their own names, but for those that `run` adds itself.
    """
    extra = [c for c in df.columns if c not in needed]
    if not extra:
        return run(df)
    box = "_carried"
    while box in df.columns:
        box += "_"
    plain = [c for c in df.columns if c in needed]
    out = run(df.select(*plain, F.struct(*[F.col(f"`{c}`") for c in extra]).alias(box)))
    new = [c for c in out.columns if c not in plain and c != box]
    kept = [F.col(c) if c in plain else F.col(box)[c].alias(c) for c in df.columns if c not in new]
    return out.select(*kept, *new)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected edges: (node, root) for every node of an edge.

    Each round moves every node to the member of its closed neighbourhood with the smallest
    hash (another hash each round, so sorted chains shrink as fast as random ones) and keeps
    the edges between what is left; the tables of a round are written to the shared folder.
    Hubs are met by partial aggregates and by joins that adaptive execution can split.
    """
    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b")).distinct()
    left = settle(left, "edges")
    moves: DataFrame | None = None
    turn = 0
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        step = (
            both.groupBy("a")
            .agg(F.min(ranked("b")).alias("m"))
            .select("a", F.least(F.col("m"), ranked("a"))["v"].alias("to"))
        )
        step = settle(step, "moves")
        to_a, to_b = step.withColumnsRenamed({"to": "x"}), step.withColumnsRenamed({"a": "b", "to": "y"})
        moved = left.join(to_a, "a").join(to_b, "b").where(F.col("x") != F.col("y"))
        left = settle(
            moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges"
        )
        if moves is None:
            moves = step.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            on = step.select(F.col("a").alias("root"), "to")
            moves = moves.join(on, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            moves = settle(moves, "roots")
        turn += 1
    if moves is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return moves
