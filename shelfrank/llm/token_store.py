"""Token-id store: documents' ids in ascending doc_id order, as Re-Pair shards.

Boundaries of doc_id ranges come from percentiles of the ids alone. Each task
encodes its documents where they are read and sends the ids, two bytes each, to
the range's partition; there they are sorted and streamed, and every SHARD_IDS
ids are compressed into one block (`repair`). Blocks are rows of Parquet files,
so writing uses Spark's commit protocol on any file system: a lost task leaves
no half block. A reader finds a block by its range and decodes it alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import ship, slices, texts
from shelfrank.llm.ranges import bounds, default_parts, part_of
from shelfrank.llm.repair import Shard, encode_shard
from shelfrank.llm.tokens import Encoder

ship(__name__)

END_ID = 1
SHARD_IDS = 1 << 20

_IDS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("terminals", T.IntegerType()),
    ]
)

BLOCKS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("first_doc_id", T.LongType()),
        T.StructField("last_doc_id", T.LongType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("ahead", T.LongType()),
        T.StructField("block", T.BinaryType()),
    ]
)

_READ = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def _encoded(tokenizer: str, end_id: int, cuts: list[int]):
    edges = np.array(cuts, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        terminals = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        kind = "<u2" if terminals <= 1 << 16 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for part in slices(whole, "text"):
                doc_id = part.column("doc_id")
                ids = [np.frombuffer(encoder.ids(raw) + end, "<u4").astype(kind).tobytes() for raw in texts(part, "text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part_of(doc_id, edges)),
                        doc_id,
                        pa.array(ids, pa.binary()),
                        pa.array(np.full(len(ids), terminals, np.int32)),
                    ],
                    names=_IDS.fieldNames(),
                )

    return run


def _blocks(shard_ids: int):
    """Blocks of a sorted partition, where rows of one part follow each other.
    `ahead` counts the ids of the part's earlier blocks."""

    def block(part: int, shard: int, ahead: int, doc_ids: list, docs: list, terminals: int) -> pa.RecordBatch:
        known = [d for d in doc_ids if d is not None]
        payload = encode_shard(doc_ids, docs, terminals)
        ends = min(known, default=None), max(known, default=None)
        row = (part, shard, *ends, len(docs), sum(map(len, docs)), ahead, payload)
        types = (pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=BLOCKS.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, ahead, held, doc_ids, docs, terminals = None, 0, 0, 0, [], [], 0
        for batch in batches:
            for p, d, ids, vocabulary in zip(*(c.to_pylist() for c in batch.columns)):
                if docs and (p != part or held >= shard_ids):
                    yield block(part, shard, ahead, doc_ids, docs, terminals)
                    shard, ahead = (shard + 1, ahead + held) if p == part else (0, 0)
                    held, doc_ids, docs = 0, [], []
                part, terminals = p, vocabulary
                docs.append(np.frombuffer(ids, "<u2" if vocabulary <= 1 << 16 else "<u4"))
                doc_ids.append(d)
                held += len(docs[-1])
        if docs:
            yield block(part, shard, ahead, doc_ids, docs, terminals)

    return run


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS, parts: int | None = None
) -> None:
    """Write the ids of all rows of docs (doc_id, text), each with an end id, as
    BLOCKS below path, in ascending doc_id order over (part, shard).

    A null or empty text is its end id alone. Null ids come first; rows of equal
    id are ordered by their ids' bytes. An empty table writes no block. `parts`
    is the number of ranges (default: Spark's shuffle partitions)."""
    parts = parts or default_parts(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = rows.mapInArrow(_encoded(tokenizer, end_id, bounds(rows, parts)), _IDS)
    ranged = ids.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "ids")
    ranged.mapInArrow(_blocks(shard_ids), BLOCKS).write.parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, block in zip(batch.column("base").to_pylist(), batch.column("block").to_pylist()):
            found = Shard(block).documents()
            columns = [
                [d for d, _, _ in found],
                [base + a for _, a, _ in found],
                [len(ids) for _, _, ids in found],
                [zlib.crc32(ids.astype("<u4").tobytes()) for _, _, ids in found],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_READ.fieldNames())


def with_base(blocks: DataFrame) -> DataFrame:
    """blocks with `base`, the number of ids in all blocks before. Only totals by
    part are added up on the driver and broadcast: as many rows as there are
    ranges, whatever the number of documents."""
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, rows = 0, []
    for part, n in totals:
        rows.append((part, before))
        before += n
    starts = blocks.sparkSession.createDataFrame(rows, "part int, part_base long")
    return blocks.join(F.broadcast(starts), "part").withColumn("base", F.col("part_base") + F.col("ahead"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document below path, decoded
    from the blocks; start counts the ids of all documents before it."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    return with_base(blocks).select("base", "block").mapInArrow(_decoded, _READ)
