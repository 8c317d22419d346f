"""Exact Jaccard join of documents on word 5-grams, with several global orders.

A document's set holds its distinct 5-word shingles. Two sets link when
intersection / union >= 0.75. Then they share at least ceil(0.75 n) shingles of
either, so under any global order of the shingles they share one among the first
n - ceil(0.75 n) + 1 of each (their prefixes). A candidate pair must pass this
filter under three orders at once (rarest first; by hash class; by hash) before
it is verified.

Steps, all of them Spark jobs:

1. `describe` hashes every whole text once: set size and a 128-bit key of the
   set. Documents with one key are copies; from here on a key is one node.
2. `shared` finds, for each node, the shingles that another node has too. Each
   task packs shingle fingerprints into one binary row per bucket, so the shuffle
   moves 5 bytes a shingle; a bucket holds about BUCKET_SHINGLES of them, and the
   number of buckets follows the data. Copies within a slice are sent once.
   Shingles that a large share of all documents hold (`frequent`) would overload
   one bucket: they rank last in every order and stay with their documents. At
   most FREQUENT_SHARE x mean set size shingles can be that frequent, whatever
   the number of documents, which bounds the list that is broadcast.
   A node that shares fewer than 0.75 of its shingles links with nothing.
3. `links` compares candidates without forming all pairs of a large group. For
   each prefix shingle, all its nodes are first compared with one leader; nodes
   that join one component need no comparison with each other. After STAR_ROUNDS
   such rounds the rest is compared exhaustively: every pair of nodes that share
   a prefix shingle, lie in different components and could still link by where
   the shingle stands in both. So no link between components is lost, and no
   group is cut.
4. `components` labels connected nodes by iterated minimum labels with pointer
   jumping; lineage is cut with checkpoint().

Fingerprints carry 39 bits besides the bucket number, so within one pair of
documents a chance match has a probability of about n^2 / (2^39 x buckets).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import fresh, placed, ship, slices, texts
from shelfrank.llm.ranges import default_parts
from shelfrank.session import scratch_path

ship(__name__)

SHINGLE = 5
PERCENT = 75
BUCKET_SHINGLES = 5_000_000
#: A shingle is frequent if at least one document in FREQUENT_SHARE has it, and
#: no fewer than FREQUENT_LEAST documents do.
FREQUENT_SHARE = 1000
FREQUENT_LEAST = 64
STAR_ROUNDS = 2
#: Hash classes of the second order.
CLASSES = 16
#: Words whose hashes a task keeps, some 5 MB; frequent ones come back at once.
VOCABULARY = 32_000

_ODD = [
    np.uint64(x)
    for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)
]
_FP_BITS = 39
_NODE_BITS = 24
_LANES = 4
_FREQUENT_BYTE = 255  # the high byte of a fingerprint is below 128
_FREQUENT_ID = 1 << 62
_FREQUENT_DF = (1 << 32) - 1


class _Words(dict):
    """Word -> 64-bit hash, kept for at most VOCABULARY words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= VOCABULARY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(raw: bytes | None, words: _Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a text, A-Z
    lower-cased; of fewer words, the one of the whole sequence."""
    found = raw.lower().split() if raw else []  # both act on ASCII alone
    if not found:
        return np.empty(0, np.uint64)
    code = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    k = max(1, len(code) - SHINGLE + 1)
    h = np.full(k, min(len(code), SHINGLE), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(SHINGLE, len(code))):
            h = (h ^ code[i : i + k]) * _ODD[i]
            h ^= h >> np.uint64(31)
        h *= _ODD[1]
        h ^= h >> np.uint64(29)
    return np.unique(h)


# ------------------------------------------------------------- sets and keys

_DESCRIBED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.BinaryType()),
        T.StructField("common", T.LongType()),
        T.StructField("times", T.LongType()),
    ]
)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and a row (common, times) per shingle that several
    different sets of a slice have. Columns behind doc_id and text are kept."""
    words = _Words()
    for whole in batches:
        for part in slices(whole, "text"):
            sets = [shingles(raw, words) for raw in texts(part, "text")]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            different = list(dict(zip(keys, sets)).values())
            value, times = np.unique(np.concatenate(different), return_counts=True)
            value, times = value[times > 1], times[times > 1]
            n, m = len(sets), len(value)
            size = pa.array([len(s) for s in sets] + [None] * m, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([part.column("doc_id").cast(pa.int64()), pa.nulls(m, pa.int64())]),
                    size,
                    pa.array(keys + [None] * m, pa.binary()),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(value.view(np.int64))]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(times.astype(np.int64))]),
                    *(pa.concat_arrays([c, pa.nulls(m, c.type)]) for c in part.columns[2:]),
                ],
                names=[*_DESCRIBED.fieldNames(), *part.schema.names[2:]],
            )


def describe(docs: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node, more columns of docs) of each row of docs, and
    (common, times) of shingles met more than once in a slice, added up."""
    path = scratch_path(docs.sparkSession, "sets")
    taken = docs.select("doc_id", "text", *more)
    schema = T.StructType([*_DESCRIBED.fields, *(T.StructField(f.name, f.dataType) for f in taken.schema.fields[2:])])
    taken.mapInArrow(_describe, schema).write.parquet(path)
    rows = docs.sparkSession.read.schema(schema).parquet(path)
    sets = rows.where(F.col("n_shingles").isNotNull()).select("doc_id", "n_shingles", "node", *more)
    common = rows.where(F.col("common").isNotNull()).groupBy("common").agg(F.sum("times").alias("times"))
    return sets, common


def frequent(common: DataFrame, n_docs: int) -> np.ndarray:
    """Sorted hashes of the frequent shingles. They are no more than
    FREQUENT_SHARE x the mean set size of a document."""
    least = max(FREQUENT_LEAST, math.ceil(n_docs / FREQUENT_SHARE))
    rows = common.where(F.col("times") >= least).select("common").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


# ------------------------------------------------------- shingles of two nodes

_PACKED = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("low", T.BinaryType()),
        T.StructField("high", T.BinaryType()),
        T.StructField("held", T.BinaryType()),
        T.StructField("size", T.BinaryType()),
        T.StructField("nodes", T.BinaryType()),
    ]
)

_MET = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("nodes", T.BinaryType()),
        T.StructField("size", T.BinaryType()),
        T.StructField("held", T.BinaryType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("dfs", T.BinaryType()),
    ]
)

_SHARED = T.StructType(
    [
        T.StructField("node", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("dfs", T.ArrayType(T.LongType())),
    ]
)


def _pack(n_buckets: int, often):
    """Fingerprints of each slice's different sets, a binary row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        top = often.value
        for whole in batches:
            for part in slices(whole, "text"):
                sets = {}
                for raw in texts(part, "text"):
                    s = shingles(raw, words)
                    if len(s):
                        sets[xxhash.xxh3_128_digest(s.tobytes())] = s
                if not sets:
                    continue
                keys = np.frombuffer(b"".join(sets), np.uint64).reshape(-1, 2)
                n = np.array([len(s) for s in sets.values()], np.int64)
                value = np.concatenate(list(sets.values()))
                owner = np.repeat(np.arange(len(n)), n)
                bucket = ((value >> np.uint64(_FP_BITS)) % np.uint64(n_buckets)).astype(np.int64)
                fp = value & np.uint64((1 << _FP_BITS) - 1)
                low, high = fp.astype(np.uint32), (fp >> np.uint64(32)).astype(np.uint8)
                if len(top):
                    at = np.minimum(np.searchsorted(top, value), len(top) - 1)
                    hit = top[at] == value
                    low[hit], high[hit] = at[hit], _FREQUENT_BYTE
                    bucket[hit] = (keys[owner[hit], 0] % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                low, high, owner = low[order], high[order], owner[order]
                edge = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                rows = []
                for b in range(n_buckets):
                    i, j = edge[b], edge[b + 1]
                    if i == j:
                        continue
                    new = np.flatnonzero(np.diff(owner[i:j], prepend=-1))
                    held = np.diff(np.append(new, j - i)).astype(np.uint32)
                    who = owner[i:j][new]
                    rows.append((b, low[i:j], high[i:j], held, n[who].astype(np.uint32), keys[who]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32())]
                    + [pa.array([r[c].tobytes() for r in rows], pa.binary()) for c in range(1, 6)],
                    names=_PACKED.fieldNames(),
                )

    return run


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first of each different key in key order, and the number
    that each key has in this order."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.append(True, (keys[order][1:] != keys[order][:-1]).any(1))
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _held_by_two(low: np.ndarray, high: np.ndarray, node: np.ndarray, lane: int) -> tuple[np.ndarray, ...]:
    """(fingerprint, node, number of its nodes) of the fingerprints of one lane
    that are frequent or that two nodes have. Lanes bound the memory of a sort."""
    at = np.flatnonzero((low & np.uint32(_LANES - 1)) == lane)
    # One number per place, fingerprint above node: sorting it in place needs no
    # positions, and a bucket has fewer than 2^24 nodes.
    place = high[at].astype(np.uint64)
    place <<= np.uint64(32)
    place |= low[at]
    place <<= np.uint64(_NODE_BITS)
    place |= node[at]
    place.sort()
    if len(place):
        place = place[np.append(True, place[1:] != place[:-1])]  # one of each (fingerprint, node)
    fp = (place >> np.uint64(_NODE_BITS)).astype(np.int64)
    starts = np.flatnonzero(np.diff(fp, prepend=-1))
    times = np.diff(np.append(starts, len(fp)))
    df = np.repeat(times, times)
    keep = (df > 1) | (fp >> 32 == _FREQUENT_BYTE)
    return fp[keep], (place[keep] & np.uint64((1 << _NODE_BITS) - 1)).astype(np.int64), df[keep]


def _meet(n_parts: int):
    """The fingerprints of one bucket that two nodes have, a binary row per part
    of the nodes."""

    def run(packed: pa.Table) -> pa.Table:
        bucket = packed.column("bucket")[0].as_py()
        keys = _joined(packed.column("nodes"), np.uint64).reshape(-1, 2)
        size = _joined(packed.column("size"), np.uint32)
        first, node = _numbered(keys)
        keys, size = keys[first], size[first]
        node = np.repeat(node.astype(np.uint32), _joined(packed.column("held"), np.uint32))
        low = _joined(packed.column("low"), np.uint32)
        high = _joined(packed.column("high"), np.uint8)
        found = [_held_by_two(low, high, node, lane) for lane in range(_LANES)]
        fp, node, df = (np.concatenate(x) for x in zip(*found))
        often = fp >> 32 == _FREQUENT_BYTE
        ids = np.where(often, _FREQUENT_ID | (fp & 0xFFFFFFFF), (np.int64(bucket) << _FP_BITS) | fp)
        df = np.where(often, _FREQUENT_DF, np.minimum(df, _FREQUENT_DF - 1)).astype(np.uint32)
        # By part, then by node.
        part = (keys[:, 1] % np.uint64(n_parts)).astype(np.int64)
        order = np.lexsort((node, part[node]))
        ids, df, node = ids[order], df[order], node[order]
        edge = np.searchsorted(part[node], np.arange(n_parts + 1))
        rows = []
        for p in range(n_parts):
            i, j = edge[p], edge[p + 1]
            if i < j:
                new = np.flatnonzero(np.diff(node[i:j], prepend=-1))
                held = np.diff(np.append(new, j - i)).astype(np.uint32)
                who = node[i:j][new]
                rows.append((p, keys[who], size[who], held, ids[i:j], df[i:j]))
        return pa.table(
            [pa.array([r[0] for r in rows], pa.int32())]
            + [pa.array([r[c].tobytes() for r in rows], pa.binary()) for c in range(1, 6)],
            names=_MET.fieldNames(),
        )

    return run


def _gather(met: pa.Table) -> pa.Table:
    """The shared shingles of a part's nodes, of those with enough to link."""
    keys = _joined(met.column("nodes"), np.uint64).reshape(-1, 2)
    size = _joined(met.column("size"), np.uint32)
    held = _joined(met.column("held"), np.uint32)
    first, node = _numbered(keys)
    keys, size = keys[first], size[first].astype(np.int64)
    total = np.bincount(node, held, minlength=len(keys)).astype(np.int64)
    enough = 100 * total >= PERCENT * size
    node = np.repeat(node, held)
    take = np.flatnonzero(enough[node])
    take = take[np.argsort(node[take], kind="stable")]
    some = np.flatnonzero(enough)
    offsets = pa.array(np.append(0, np.cumsum(total[some])).astype(np.int32))
    ids = _joined(met.column("ids"), np.int64)[take]
    dfs = _joined(met.column("dfs"), np.uint32)[take].astype(np.int64)
    return pa.table(
        [
            pa.array([keys[i].tobytes() for i in some], pa.binary()),
            pa.array(size[some]),
            pa.ListArray.from_arrays(offsets, pa.array(ids)),
            pa.ListArray.from_arrays(offsets, pa.array(dfs)),
        ],
        names=_SHARED.fieldNames(),
    )


def _prefix(order: int) -> Column:
    """The node's prefix under an order, less the shingles that it alone has:
    those come first in every order and meet nothing. Order 1: rarest first, few
    places a shingle. Order 2: by hash class, within a class rarest first. Order
    3: by hash alone, so it owes nothing to rarity."""
    mixed = lambda x: F.xxhash64(F.lit(order), x["ids"])
    keys = {
        1: lambda x: [x["dfs"]],
        2: lambda x: [F.pmod(mixed(x), F.lit(CLASSES)), x["dfs"]],
        3: lambda x: [],
    }[order]
    keyed = F.transform(
        F.arrays_zip("ids", "dfs"),
        lambda x: F.struct(*(c.alias(f"k{i}") for i, c in enumerate(keys(x))), mixed(x).alias("h"), x["ids"].alias("id")),
    )
    length = F.size("ids") - F.ceil(F.col("n") * PERCENT / 100).cast("int") + 1
    return F.transform(F.slice(F.array_sort(keyed), F.lit(1), length), lambda x: x["id"])


def shared(docs: DataFrame, n_shingles: int, often: np.ndarray) -> DataFrame:
    """Nodes that share at least 0.75 of their shingles with others: (node, n,
    ids of the shared shingles, s their number, prefixes p1 to p3)."""
    spark = docs.sparkSession
    n_buckets = max(1, math.ceil(n_shingles / BUCKET_SHINGLES))
    found = (
        docs.select("text")
        .mapInArrow(_pack(n_buckets, spark.sparkContext.broadcast(often)), _PACKED)
        .groupBy("bucket")
        .applyInArrow(_meet(n_buckets), _MET)
        .groupBy("part")
        .applyInArrow(_gather, _SHARED)
    )
    out = found.select(
        "node",
        "n",
        F.size("ids").cast("long").alias("s"),
        "ids",
        *(_prefix(order).alias(f"p{order}") for order in (1, 2, 3)),
    )
    # Placed by node once: the joins on nodes below shuffle only their other side.
    return placed(out, default_parts(docs), "node")


# ------------------------------------------------------------- pairs and links


def _can_link() -> Column:
    """Bound on the overlap from the numbers of shared shingles."""
    most = F.least("s", "other_s")
    return 100 * most >= PERCENT * (F.col("n") + F.col("other_n") - most)


def _places_allow() -> Column:
    """Bound on the overlap from where a shared shingle stands in both nodes. At
    the first one that they share, in order 1, all others stand behind it; a pair
    that links passes there at the latest."""
    most = F.least(F.col("s") - F.col("pos"), F.col("other_s") - F.col("other_pos"))
    return 100 * most >= PERCENT * (F.col("n") + F.col("other_n") - most)


def _ordered(pairs: DataFrame) -> DataFrame:
    return (
        pairs.where(_can_link())
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
    )


def _filtered(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate pairs (they met in prefixes of order 1) whose prefixes meet under
    the other orders as well."""
    side = lambda name: nodes.select(
        F.col("node").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("p2", "p3"))
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    meet = [F.arrays_overlap(f"a_{p}", f"b_{p}") for p in ("p2", "p3")]
    return both.select("a", "b", *(m.alias(p) for m, p in zip(meet, ("meet2", "meet3"))))


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links among candidate pairs: the other orders' prefixes must meet too, then
    whole sets travel, for the pairs that are left, and are compared."""
    left = _filtered(pairs, nodes).where("meet2 and meet3").select("a", "b")
    side = lambda name: nodes.select(
        F.col("node").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("n", "ids"))
    )
    both = left.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("a_ids", "b_ids"))
    return both.where(100 * common >= PERCENT * (F.col("a_n") + F.col("b_n") - common)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for each node of links (a, b): comp is the least node that
    links reach. Repeats until no label changes."""
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = edges.checkpoint()
    label = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    label = label.select("node", F.least("node", "low").alias("comp")).checkpoint()
    while True:
        heard = edges.join(label, edges["b"] == label["node"]).groupBy("a").agg(F.min("comp").alias("heard"))
        step = label.join(heard, label["node"] == heard["a"]).select(
            "node", F.col("comp").alias("was"), F.least("comp", "heard").alias("via")
        )
        jump = label.select(F.col("node").alias("via"), F.col("comp").alias("beyond"))
        step = step.join(jump, "via", "left").select(
            "node", "was", F.least("via", F.coalesce("beyond", "via")).alias("comp")
        )
        step = step.checkpoint()
        label = step.select("node", "comp")
        if step.where(F.col("was") != F.col("comp")).isEmpty():
            return label


def links(nodes: DataFrame) -> DataFrame:
    """(node, comp) of nodes that link with another node."""
    spark = nodes.sparkSession
    places = nodes.select(F.posexplode("p1").alias("pos", "shingle"), "node", "n", "s")
    found, tried, label = [], [], None

    def compare(pairs: DataFrame) -> None:
        nonlocal label
        pairs = _ordered(pairs)
        for old in tried:
            pairs = pairs.join(old, ["a", "b"], "left_anti")
        pairs = pairs.checkpoint()
        tried.append(pairs)
        new = _verified(pairs, nodes).checkpoint()
        if label is None or not new.isEmpty():  # else the components are as they were
            found.append(new)
            label = components(reduce(DataFrame.unionByName, found))

    def placed() -> DataFrame:
        if label is None:
            return places.withColumn("comp", F.col("node"))
        known = places.join(label, "node", "left")
        return known.withColumn("comp", F.coalesce("comp", "node"))

    def open_places() -> tuple[DataFrame, DataFrame]:
        """Places of shingles that lie in several components, with the component
        `main` that has most of the shingle's nodes."""
        at = placed()
        by_comp = at.groupBy("shingle", "comp").agg(F.count("*").alias("m"))
        main = by_comp.groupBy("shingle").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.count("*").alias("c"))
        return at, main.where(F.col("c") > 1).select("shingle", "main")

    for star in range(STAR_ROUNDS):
        at, main = open_places()
        rest = at if star == 0 else at.join(main, "shingle").where(F.col("comp") != F.col("main"))
        # The node with the smallest share of shingles of its own leads.
        leader = rest.groupBy("shingle").agg(
            F.max_by(
                F.struct("node", "n", "s", "comp"), F.struct(F.col("s") / F.col("n"), F.col("n"), F.col("node"))
            ).alias("l")
        )
        leader = leader.join(main, "shingle", "left_semi").select(
            "shingle",
            F.col("l.node").alias("other"),
            F.col("l.n").alias("other_n"),
            F.col("l.s").alias("other_s"),
            F.col("l.comp").alias("other_comp"),
        )
        compare(at.join(leader, "shingle").where(F.col("comp") != F.col("other_comp")))
    at, main = open_places()
    at = at.join(main, "shingle").checkpoint()
    minor = at.where(F.col("comp") != F.col("main")).select(
        "shingle", *(F.col(c).alias(o) for c, o in (("node", "other"), *((c, f"other_{c}") for c in ("n", "s", "comp", "pos"))))
    )
    rest = at.join(minor, "shingle").where((F.col("comp") != F.col("other_comp")) & _can_link() & _places_allow())
    compare(rest)
    return label


def _least(sets: DataFrame, common: DataFrame, docs: DataFrame, rank: Column) -> DataFrame:
    """(node, least): the least rank among the rows of the node's class. rank is
    made of columns of sets."""
    n_docs, n_shingles = sets.agg(F.count("*"), F.sum("n_shingles")).first()
    copies = sets.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(rank).alias("first"))
    label = links(shared(docs, n_shingles or 0, frequent(common, n_docs)))
    # The smallest among a component's nodes, then of each node.
    named = copies.join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = label.join(copies, "node").groupBy("comp").agg(F.min("first").alias("least"))
    return named.join(least, "comp", "left").select("node", F.coalesce("least", "first").alias("least"))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs (doc_id, text).

    component_id is the smallest doc_id reachable by links, the row's own
    included. Null and empty texts, and texts without words, have 0 shingles and
    are their own class. Repeated rows repeat in the result. A row of null id
    gets the smallest id of its class, null if there is none."""
    sets, common = describe(docs)
    named = _least(sets, common, docs, F.col("doc_id"))
    return sets.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs (doc_id, text, ...) of each class: that of the smallest
    id, null ids last, then of the smallest text key (MD5). Texts of 0 shingles
    are classes of their own by id and text. Of rows equal in id and text the
    one whose further columns come first as JSON stays."""
    key = fresh(docs, "text_key")[0]
    keyed = docs.withColumn(key, F.md5("text"))
    sets, common = describe(keyed, key)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(key).alias("key"))
    rows = sets.withColumn("rank", rank).join(_least(sets, common, docs, rank), "node", "left")
    rows = rows.select("doc_id", key, (F.col("node").isNull() | (F.col("rank") == F.col("least"))).alias("stays"))
    rows = rows.groupBy("doc_id", key).agg(F.every("stays").alias("stays"), F.count("*").alias("n")).checkpoint()
    gone = rows.where(~F.col("stays") | (F.col("n") > 1))
    again = rows.where(F.col("stays") & (F.col("n") > 1))
    same = lambda other: keyed["doc_id"].eqNullSafe(other["doc_id"]) & keyed[key].eqNullSafe(other[key])
    out = keyed.join(gone, same(gone), "left_anti")
    if not again.isEmpty():
        order = Window.partitionBy("doc_id", key).orderBy(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns))))
        number = fresh(keyed, "number")[0]
        copies = keyed.join(again, same(again), "left_semi").withColumn(number, F.row_number().over(order))
        out = out.unionByName(copies.where(F.col(number) == 1).drop(number))
    return out.drop(key)
