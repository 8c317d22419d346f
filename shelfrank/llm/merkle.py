"""Merkle manifest of a document table, with resumable SHA-256 states.

A row is a leaf: the SHA-256 of its fields with their lengths. Within a
language, eight consecutive nodes become one parent, level by level, until one
is left, the language's subroot; subroots become the root the same way. A parent
keeps, beside its digest, the state of its hash before each child slot. To fold
a changed leaf, the state before its slot is resumed and takes the replacement
and the siblings to its right; what stands to its left is not hashed again.

Spark jobs:

1. Leaves are hashed by `sha2` where the texts are read; from here on a row
   carries two digests of 32 bytes and its id.
2. `numbered` sorts leaves by range of (language, doc_id, leaf), so that a
   language of any size is spread, and adds up the sizes of ranges.
3. `_built` makes the lowest LEVELS levels in tasks of 8^LEVELS consecutive
   leaves, whose digests and states are written. Their tops are the nodes of the
   next round, until each language has one. Rounds are log(n) / log(8^LEVELS).
4. Paths come down the same way; each chunk of leaves gets the path of its top
   and folds its leaves side by side.

Nothing is collected to the driver but whether another round is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm import sha256
from shelfrank.llm.common import ship
from shelfrank.llm.ranges import default_parts
from shelfrank.session import scratch_path

ship(__name__)

FANOUT = 8
#: Levels that one task builds: 8^4 = 4096 nodes, 260 bytes each with their states.
LEVELS = 4
CHUNK = FANOUT**LEVELS
#: One document in so many is tampered with.
TAMPER = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_LEVEL = T.StructType(
    [
        T.StructField("slot", T.IntegerType()),
        T.StructField("children", T.BinaryType()),
        T.StructField("state", T.BinaryType()),
    ]
)


# -------------------------------------------------------------------- leaves


def leaf(**replaced: Column) -> Column:
    """Hex SHA-256 of a row's fields: `-` for null, else byte count, colon, value."""
    parts = []
    for name in FIELDS:
        text = replaced.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, changed): digests of each row and of the row after
    tampering, which is null where the row is not tampered with."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPER == 0
    path = scratch_path(docs.sparkSession, "leaves")
    docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "lang",
        F.unhex(leaf()).alias("leaf"),
        F.when(hit, F.unhex(leaf(text=lowered))).alias("changed"),
    ).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def numbered(rows: DataFrame, by: str, *order: str) -> DataFrame:
    """rows with `pos`, their place among the rows of one `by` in the order of
    columns (equal rows in any order), and `total`, the number of these rows.
    Sorted by ranges, so no `by` need fit in a task."""
    keys = [by, *order, "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(default_parts(rows), *keys).withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = dealt.groupBy("_part", by).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("_part").alias("_p"),
        F.col(by).alias("_by"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(by)).alias("total"),
    )
    place = F.row_number().over(Window.partitionBy("_part", by).orderBy(*order, "_tie"))
    out = dealt.withColumn("_place", place).join(
        sizes, (F.col("_part") == F.col("_p")) & F.col(by).eqNullSafe(F.col("_by"))
    )
    return out.withColumn("pos", F.col("_before") + F.col("_place") - 1).drop(
        "_tie", "_part", "_p", "_by", "_before", "_place"
    )


# ------------------------------------------------------------- building a chunk


def _heights(total: int) -> int:
    """Levels above `total` nodes until one is left."""
    levels = 0
    while total > 1:
        total = -(-total // FANOUT)
        levels += 1
    return levels


def _parents(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the parents of consecutive nodes, and the states (parents, 8
    slots, 8 words) before each child slot."""
    n = -(-len(nodes) // FANOUT)
    blocks = sha256.as_block(nodes)
    held = np.full(n, FANOUT)
    held[-1] = len(nodes) - FANOUT * (n - 1)
    state, before = sha256.start(n), np.zeros((n, FANOUT, 8), np.uint32)
    for slot in range(FANOUT):
        some = n if slot < held[-1] else n - 1  # the last run alone may be shorter
        before[:some, slot] = state[:some]
        if some:
            state[:some] = sha256.advance(state[:some], blocks[slot::FANOUT][:some])
    return sha256.finish(state, held), before


def _levels(digests: np.ndarray, total: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Digests of each level of a chunk, lowest first, and the states of the
    parents above each."""
    up, states = [digests], []
    for _ in range(min(LEVELS, _heights(total))):
        above, before = _parents(up[-1])
        up.append(above)
        states.append(before)
    return up, states


def _chunk_schema(by: T.StructField) -> T.StructType:
    binary = T.ArrayType(T.BinaryType())
    return T.StructType(
        [
            T.StructField("by", by.dataType),
            T.StructField("chunk", T.LongType()),
            T.StructField("total", T.LongType()),
            T.StructField("top", T.BinaryType()),
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("changed", T.BinaryType()),
            T.StructField("digests", binary),
            T.StructField("states", binary),
        ]
    )


def _build(schema: pa.Schema):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        total = rows.column("total")[0].as_py()
        raw = rows.column("digest").to_pylist()
        up, states = _levels(sha256.from_bytes(b"".join(raw)), total)
        changed = b"".join(c or d for c, d in zip(rows.column("changed").to_pylist(), raw))
        row = {
            "by": rows.column("by")[0].as_py(),
            "chunk": rows.column("pos")[0].as_py() // CHUNK,
            "total": total,
            "top": sha256.to_bytes(up[-1]),
            "ids": rows.column("id").to_pylist(),
            "changed": changed,
            "digests": [sha256.to_bytes(d) for d in up],
            "states": [sha256.to_bytes(s) for s in states],
        }
        return pa.Table.from_pylist([row], schema=schema)

    return run


def _built(nodes: DataFrame) -> DataFrame:
    """A row per CHUNK consecutive nodes (by, pos, total, id, digest, changed):
    their digests and states up to the chunk's top. Written, as it is read by
    the next round and again on the way down."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _chunk_schema(nodes.schema["by"])
    path = scratch_path(nodes.sparkSession, "chunks")
    chunk = F.floor(F.col("pos") / CHUNK).alias("_chunk")
    made = nodes.groupBy("by", chunk).applyInArrow(_build(to_arrow_schema(schema)), schema)
    made.write.parquet(path)
    return nodes.sparkSession.read.schema(schema).parquet(path)


# ------------------------------------------------------------------ way down


class _Chunk:
    """A stored chunk: digests of each level, states of the parents above."""

    def __init__(self, digests: list[bytes], states: list[bytes]):
        self.digests = [sha256.from_bytes(d) for d in digests]
        self.states = [sha256.from_bytes(s).reshape(-1, FANOUT, 8) for s in states]

    def path(self, place: int) -> list[dict]:
        """Slot, children of the parent and state before the slot, level by level."""
        out = []
        for level, states in zip(self.digests, self.states):
            parent, slot = divmod(place, FANOUT)
            children = level[FANOUT * parent : FANOUT * (parent + 1)]
            out.append(
                {"slot": slot, "children": sha256.to_bytes(children), "state": sha256.to_bytes(states[parent, slot])}
            )
            place = parent
        return out


def _path_schema(by: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("by", by.dataType),
            T.StructField("pos", T.LongType()),
            T.StructField("path", T.ArrayType(_LEVEL)),
            T.StructField("end", T.BinaryType()),
        ]
    )


def _descend(schema: pa.Schema):
    """A row per node of each chunk: its path to the end of its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row["digests"], row["states"])
                rows = [
                    {
                        "by": row["by"],
                        "pos": row["chunk"] * CHUNK + i,
                        "path": chunk.path(i) + (row["above"] or []),
                        "end": row["end"],
                    }
                    for i in range(len(chunk.digests[0]))
                ]
                yield from pa.Table.from_pylist(rows, schema=schema).to_batches()

    return run


def _with_above(chunks: DataFrame, above: DataFrame | None) -> DataFrame:
    """Chunks with the path of their top and the end of their tree."""
    if above is None:
        return chunks.withColumn("above", F.lit(None).cast(T.ArrayType(_LEVEL))).withColumn("end", F.col("top"))
    up = above.select(F.col("by").alias("_by"), F.col("pos").alias("_pos"), F.col("path").alias("above"), "end")
    same = F.col("by").eqNullSafe(F.col("_by")) & (F.col("chunk") == F.col("_pos"))
    return chunks.join(up, same).drop("_by", "_pos")


def _climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chunks of nodes, with the path above each and the end (top of all) of
    its `by`."""
    chunks = _built(nodes)
    if not chunks.where(F.col("total") > CHUNK).isEmpty():
        tops = chunks.select(
            "by",
            F.col("chunk").alias("pos"),
            F.ceil(F.col("total") / CHUNK).alias("total"),
            F.lit(None).cast("long").alias("id"),
            F.col("top").alias("digest"),
            F.lit(None).cast("binary").alias("changed"),
        )
        return _with_above(chunks, _paths(_climb(tops)))
    return _with_above(chunks, None)


def _paths(chunks: DataFrame) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _path_schema(chunks.schema["by"])
    return chunks.select("by", "chunk", "digests", "states", "above", "end").mapInArrow(
        _descend(to_arrow_schema(schema)), schema
    )


# ------------------------------------------------------------------- folding


def _fold_level(value, parent, slot, children, held, state):
    """Digests of the parents with `value` in place of the child at `slot`:
    `state` is resumed and takes the replacement and the right siblings only.
    children (parents, 8, 8 words) and held (parents) are picked by parent."""
    state = state.copy()
    for j in range(FANOUT):
        own = np.flatnonzero(slot == j)
        if len(own):
            state[own] = sha256.advance(state[own], sha256.as_block(value[own]))
        right = np.flatnonzero((slot < j) & (j < held[parent]))
        if len(right):
            state[right] = sha256.advance(state[right], sha256.as_block(children[parent[right], j]))
    return sha256.finish(state, held[parent])


def _prove_level(proof, blocks, parent, slot, children, held) -> None:
    """Adds the siblings, left to right, to the running hash of each proof."""
    for j in range(FANOUT):
        other = np.flatnonzero((slot != j) & (j < held[parent]))
        if len(other):
            proof[other] = sha256.advance(proof[other], sha256.as_block(children[parent[other], j]))
            blocks[other] += 1


def _family(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes as (parents, 8, 8 words), and the number of children of each."""
    n = -(-len(nodes) // FANOUT)
    held = np.full(n, FANOUT)
    held[-1] = len(nodes) - FANOUT * (n - 1)
    children = np.zeros((n * FANOUT, 8), np.uint32)
    children[: len(nodes)] = nodes
    return children.reshape(n, FANOUT, 8), held


def _fold(chunk: _Chunk, changed: np.ndarray, above: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(roots after the change, proofs) of each leaf of a chunk."""
    n = len(changed)
    value, place = changed, np.arange(n)
    proof, blocks = sha256.start(n), np.zeros(n, np.int64)
    for level, states in zip(chunk.digests, chunk.states):
        children, held = _family(level)
        place, slot = np.divmod(place, FANOUT)
        value = _fold_level(value, place, slot, children, held, states[place, slot])
        _prove_level(proof, blocks, place, slot, children, held)
    for step in above:
        children, held = _family(sha256.from_bytes(step["children"]))
        place, slot = np.zeros(n, np.int64), np.full(n, step["slot"])
        value = _fold_level(value, place, slot, children, held, np.repeat(sha256.from_bytes(step["state"]), n, 0))
        _prove_level(proof, blocks, place, slot, children, held)
    return value, sha256.finish(proof, blocks)


_ROWS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
        T.StructField("verified", T.BooleanType()),
    ]
)


def _fold_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            chunk = _Chunk(row["digests"], row["states"])
            folded, proof = _fold(chunk, sha256.from_bytes(row["changed"]), (row["above"] or []) + row["over"])
            root, n = row["root"].hex(), len(folded)
            folded = sha256.hexes(folded)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(sha256.hexes(chunk.digests[0])),
                    pa.array([row["end"].hex()] * n),
                    pa.array([root] * n),
                    pa.array(sha256.hexes(proof)),
                    pa.array(folded),
                    pa.array([f == root for f in folded]),
                ],
                names=_ROWS.fieldNames(),
            )


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each
    row of docs (doc_id, source, lang, n_chars, text).

    Leaves of a language ascend by doc_id (null first), rows of one id by leaf;
    rows equal in all fields are leaves of their own. A null language is one of
    its own, the first. Null and empty fields differ (`-` and `0:`). A null id
    is not tampered with. The only row of a table is its own subroot and root,
    and its proof is the hash of no bytes. An empty table gives no rows. Columns
    beyond the five fields are not read."""
    rows = leaves(docs).select(F.col("lang").alias("by"), F.col("doc_id").alias("id"), F.col("leaf").alias("digest"), "changed")
    chunks = _climb(numbered(rows, "by", "id", "digest"))
    # Subroots in order of language, under one group.
    subroots = chunks.select(F.col("by").alias("lang"), "end").dropDuplicates(["lang"]).select(
        F.lit(0).alias("by"), "lang", F.lit(None).cast("long").alias("id"), F.col("end").alias("digest"), F.lit(None).cast("binary").alias("changed")
    )
    placed = numbered(subroots, "by", "lang").checkpoint()
    over = _paths(_climb(placed.drop("lang"))).withColumnRenamed("path", "over").withColumnRenamed("end", "root")
    over = over.drop("by").join(placed.select(F.col("lang").alias("_lang"), "pos"), "pos").drop("pos")
    both = chunks.join(over, F.col("by").eqNullSafe(F.col("_lang")))
    # Chunks are few and each takes seconds to fold: dealt out again, evenly.
    both = both.repartition(default_parts(docs), "by", "chunk")
    return both.select("ids", "changed", "digests", "states", "above", "end", "over", "root").mapInArrow(_fold_chunks, _ROWS)
