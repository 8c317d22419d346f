"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a task holds decoded at once (a longer text is one slice).
SLICE_BYTES = 4 << 20


def ship(module: str) -> None:
    """Pickle a module's functions by value, so that executors run them without
    having this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into consecutive pieces whose `column` holds at most `limit`
    bytes (or one row), so that memory does not grow with the batch."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The column as UTF-8 bytes, nulls as None."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def placed(df: DataFrame, parts: int, *columns: str) -> DataFrame:
    """df checkpointed in `parts` partitions by hash of columns, such that later
    joins on these columns leave it where it is. An adaptive plan would not tell
    its partitioning to the checkpoint, so it is off for this one job."""
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        return df.repartition(parts, *columns).checkpoint()
    finally:
        conf.set(key, before)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for added columns, with underscores until none clashes with
    a column of df (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
