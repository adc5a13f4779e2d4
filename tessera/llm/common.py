"""What the corpus operators share: work tables, row slicing, packed columns."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Where work tables go if the session names no shared folder (local runs and tests).
LOCAL_CHECKPOINTS = "/tmp/checkpoints"
#: Spark's setting by which a query's shuffle files go with it.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of text that a Python worker holds at a time.
SLICE_BYTES = 8 << 20

_scopes = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; set here only for a local master without one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = LOCAL_CHECKPOINTS
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch():
    """Tables that `written` makes inside are deleted at the end, those it is told to keep by the scope around."""
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for spark, path in stack.pop():
            _delete(spark, path)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of what is run inside go when it ends, and not when the driver's garbage collector finds them."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def written(df: DataFrame, name: str, codec: str = "snappy", keep: bool = False) -> DataFrame:
    """df as a table in the shared folder: lineage ends there, and a lost executor costs nothing.

    Inside `scratch` the table goes with the scope; one to keep goes with the scope around it, or stays if there is none.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    stack = _scopes.__dict__.get("stack", [])
    owners = stack[:-1] if keep else stack
    if owners:
        owners[-1].append((spark, path))
    with shuffles_dropped(spark):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(wanted: str, taken) -> str:
    """A column name that none of `taken` equals, whatever its case."""
    taken = {x.lower() for x in taken}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def texts(batch: pa.RecordBatch, column: int | str) -> list[bytes]:
    """A string column as UTF-8 bytes; null counts as empty."""
    col = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else pa.binary()
    return [x or b"" for x in col.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.Table]:
    """Runs of rows whose texts come to about `most` bytes; one longer text is a run of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if batch.num_rows == 0:
            continue
        lengths = np.nan_to_num(pc.binary_length(col).to_numpy(zero_copy_only=False).astype(np.float64))
        start, ends = 0, np.cumsum(lengths)
        base = 0.0
        for i in range(batch.num_rows):
            if size + ends[i] - base > most and (i > start or held):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, size, start, base = [], 0, i, ends[i] - lengths[i]
        held.append(batch.slice(start))
        size += ends[-1] - base
    if held:
        yield pa.Table.from_batches(held)


def column_bytes(table: pa.Table, name: str) -> list[bytes]:
    col = table.column(name)
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [x or b"" for x in col.cast(kind).to_pylist()]


def column_text(table: pa.Table, name: str) -> list[str]:
    return [x or "" for x in table.column(name).to_pylist()]
