"""Top-k per group, global top-n, and nesting of ranked lists.

Per-group top-k is `row_number() <= k` over a window: Spark inserts a
WindowGroupLimit before the shuffle, so each map task forwards at most k rows
per group, and a group with a third of all rows costs no more than any other
at the exchange. Scores are ranked on `rank_key` (rounded) with ties broken by
the id columns, so rankings are deterministic across plans and engines.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.functions import as_col, rank_key
from shelfrank.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _order(score: str | None, tie_breakers: list, descending: bool = True) -> list[Column]:
    cols: list[Column] = []
    if score is not None:
        k = rank_key(score)
        cols.append(k.desc() if descending else k.asc())
    for t in tie_breakers:
        cols.append(as_col(t) if not isinstance(t, Column) else t)
    return cols


def top_k_per_group(
    df: DataFrame,
    group: str | list[str],
    k: int,
    score: str | None = None,
    tie_breakers: list | None = None,
    order: list[Column] | None = None,
    rank_col: str = "rank",
) -> DataFrame:
    """Keep the k best rows per group, numbered 1..k in `rank_col`.

    Either give `score` (descending, rounded rank key) plus `tie_breakers`, or
    a full `order` list.
    """
    groups = [group] if isinstance(group, str) else list(group)
    ordering = order if order is not None else _order(score, tie_breakers or [])
    w = Window.partitionBy(*groups).orderBy(*ordering)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def rank_all(
    df: DataFrame,
    group: str,
    order: list[Column],
    rank_col: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Exact 1..n rank of every row within its group, for groups of any size.

    A window per group would sort a group holding a third of all rows in one
    task. Instead the rows are range-partitioned on (group, order), which
    splits a large group over many partitions, sorted there and numbered in
    passing (`_numbered`), and written: the one shuffle of the rows. Rows of a
    group in earlier partitions precede those in later ones, so rank = (rows of
    the group in earlier partitions) + number inside the (group, partition)
    segment. Only the first group of a partition can have rows in earlier ones,
    so at most one offset per partition is broadcast. Rows of a null group have
    no rank and are left out.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    # Range partitioning samples its input first: writing the input once keeps
    # the sampling from running it a second time. Parquet rather than a
    # checkpoint: a fraction of the bytes, and readers plan with the true size.
    df.where(F.col(group).isNotNull()).write.parquet(f"{path}/rows")
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows")
    # Without an explicit count AQE sizes the range partitions from the data;
    # it only merges adjacent ranges, so partition ids stay in range order.
    ranged = rows.repartitionByRange(partitions, F.col(group), *order) if partitions else rows.repartitionByRange(
        F.col(group), *order
    )
    schema = T.StructType([*df.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField("_r", T.LongType())])
    numbered = ranged.sortWithinPartitions(F.col(group), *order).mapInArrow(_numbered(df.columns.index(group)), schema)
    numbered.write.parquet(f"{path}/numbered")
    numbered = spark.read.schema(schema).parquet(f"{path}/numbered")
    counts = numbered.groupBy(group, "_pid").agg(F.max("_r").alias("_n"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_pid", F.sum("_n").over(before).alias("_off")).where(F.col("_off") > 0)
    rank = (F.coalesce("_off", F.lit(0)) + F.col("_r")).cast("int")
    return numbered.join(F.broadcast(offsets), [group, "_pid"], "left").select(*df.columns, rank.alias(rank_col))


def _numbered(at: int):
    """For `mapInArrow`: adds the partition's number, and rows' numbers, from 1,
    within runs of equal values of column `at`, which are held one batch at a time."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(at).to_numpy(zero_copy_only=False)
            new = np.append(last is None or key[0] != last, key[1:] != key[:-1])
            row = np.arange(len(key), dtype=np.int64)
            first = np.maximum.accumulate(np.where(new, row, -1))
            # Rows before the batch's first new value go on with the last one's.
            number = np.where(first < 0, row + done, row - first) + 1
            last, done = key[-1], int(number[-1])
            more = [pa.array(np.full(len(key), pid, np.int32)), pa.array(number)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "_pid", "_r"])

    return number


def top_n(df: DataFrame, n: int, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """Global top-n with a rank column: sort+limit (TakeOrderedAndProject),
    then number the <= n rows."""
    limited = df.orderBy(*order).limit(n)
    w = Window.orderBy(*order)
    return limited.withColumn(rank_col, F.row_number().over(w))


# Fixed value: the most entries one nested row holds. Longer lists (uncapped
# similarity lists) span several rows, so no single row or aggregation group
# grows with the data.
PAGE_SIZE = 1000


def nest(
    df: DataFrame,
    key: str,
    item: str,
    score: str,
    rank_col: str = "rank",
    out: str = "recs",
    page_size: int | None = None,
    runs: bool = False,
) -> DataFrame:
    """Long (key, item, score, rank) -> (key, recs ARRAY<STRUCT<productId, score>>),
    the list ordered by rank.

    With `page_size`, a key's list is cut into pages of at most page_size
    entries: rows (key, first_rank, recs). Use it for lists without a cap. With
    `runs`, for rows that lie in the order of their lists, a page is made of rows
    side by side, without a shuffle; where a list is torn, it has a page more.
    """
    if page_size is not None and runs:
        kind = lambda c: df.schema[c].dataType.simpleString()
        schema = f"{key} {kind(key)}, first_rank {kind(rank_col)}, {out} array<struct<productId:{kind(item)},score:{kind(score)}>>"
        return df.select(key, rank_col, item, score).mapInArrow(_pages(page_size, (key, "first_rank", out)), schema)
    entry = F.struct(F.col(rank_col).alias("_r"), F.col(item).alias("productId"), F.col(score).alias("score"))
    recs = F.transform(
        F.array_sort(F.collect_list(entry)),
        lambda e: F.struct(e["productId"].alias("productId"), e["score"].alias("score")),
    )
    if page_size is None:
        return df.groupBy(key).agg(recs.alias(out))
    page = F.floor((F.col(rank_col) - 1) / F.lit(page_size))
    return (
        df.withColumn("_page", page)
        .groupBy(key, "_page")
        .agg(F.min(rank_col).alias("first_rank"), recs.alias(out))
        .drop("_page")
    )


def _pages(size: int, names: tuple[str, ...]):
    """For `mapInArrow` over (key, rank, item, score): a row (key, first rank, entries)
    for each run of rows of a key and page whose ranks follow each other. Held are
    a batch and the page that it breaks off."""

    def nested(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        whole = rows.combine_chunks().to_batches()[0]
        entries = pa.StructArray.from_arrays([whole.column(2), whole.column(3)], names=["productId", "score"])
        recs = pa.ListArray.from_arrays(pa.array(np.append(starts, len(rows)), pa.int32()), entries)
        at = pa.array(starts)
        return pa.RecordBatch.from_arrays([whole.column(0).take(at), whole.column(1).take(at), recs], names=list(names))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            key, rank = (rows.column(i).to_numpy() for i in (0, 1))
            new = (key[1:] != key[:-1]) | (rank[1:] != rank[:-1] + 1) | ((rank[1:] - 1) % size == 0)
            starts = np.flatnonzero(np.append(True, new))
            if len(starts) > 1:
                yield nested(rows.slice(0, int(starts[-1])), starts[:-1])
            rest = rows.slice(int(starts[-1]))
        if rest is not None:
            yield nested(rest, np.zeros(1, np.int64))

    return pages


def unnest(df: DataFrame, key: str, recs: str = "recs", outer: bool = False) -> DataFrame:
    """(key, recs) or paged (key, first_rank, recs) -> (key, rank, productId, score);
    rank is the 1-based list position.

    With outer=True a key with an empty list keeps one row with nulls.
    """
    pe = F.posexplode_outer(recs) if outer else F.posexplode(recs)
    base = F.col("first_rank") if "first_rank" in df.columns else F.lit(1)
    exploded = df.select(key, base.alias("_base"), pe.alias("_pos", "_rec"))
    return exploded.select(
        key,
        F.when(F.col("_rec").isNotNull(), F.col("_base") + F.col("_pos")).cast("int").alias("rank"),
        F.col("_rec.productId").alias("productId"),
        F.col("_rec.score").alias("score"),
    )
