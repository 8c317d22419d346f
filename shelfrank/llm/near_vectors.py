"""Near-duplicate vectors: Euclidean p-stable hashing, then exact cosines.

Two vectors of one label link when their cosine is at least LINK. Unit vectors
at that cosine are at most DISTANCE apart; floor((a.x + b) / WIDTH) with a
Gaussian a and a uniform b is equal for both with a probability that falls with
their distance only. A table takes `k` such numbers as its bucket. k follows the
largest label, so that a vector meets about one unlike vector a table; the
number of tables follows from k, so that a pair at exactly LINK is met with a
probability of at least RECALL (closer pairs with more).

A large group of near copies shares its buckets, so pairs are not formed inside
one. Copies in a group that lie within half the linking angle of one of them
link with each other by the triangle inequality. So:

1. `_nodes`: equal vectors of a label become one node with a number.
2. `_buckets`: (table and bucket, node) of every node; 16 bytes, no vectors.
3. `_balls`: each node takes its largest bucket; the bucket's leader gathers the
   nodes within half the angle. BALL_ROUNDS rounds; other nodes are balls alone.
   The members of a ball are linked and counted as a number.
4. Two balls that meet in any bucket are judged whole by the angle between their
   leaders and their radii: all their members link, or none do. Only what this
   leaves open is opened, first to (member, ball), then to (member, member), with
   exact cosines. So what buckets find is verified, and the rest of both groups
   comes with it.
5. Components over balls.

A dense group wider than the linking angle, without copies close to each other,
stays open pair by pair: its links are counted, never written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import ship
from shelfrank.llm.jaccard import components
from shelfrank.session import scratch_path

ship(__name__)

LINK = 0.93
RECALL = 0.99
WIDTH = 2.0
SEED = 11
BALL_ROUNDS = 2
#: Angles within this of a bound are settled by the cosine itself.
MARGIN = 1e-6


def _met(distance: float) -> float:
    """Probability that one number of two vectors so far apart is equal."""
    r = WIDTH / distance
    tail = math.erfc(r / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables(largest: int, link: float = LINK) -> tuple[int, int]:
    """(numbers a bucket, tables) for labels of at most so many vectors."""
    k = max(1, math.ceil(math.log(max(largest, 2)) / -math.log(_met(math.sqrt(2)))))
    near = _met(math.sqrt(2 - 2 * link)) ** k
    return k, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - near)))


# ---------------------------------------------------------------------- nodes


def _usable(column: str) -> Column:
    """Vectors that have a direction."""
    broken = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~broken & F.exists(column, lambda x: x != 0)


def _nodes(rows: DataFrame) -> DataFrame:
    """(node, label, dim, vector, m, first): one of each usable vector of a label,
    how many rows have it, and their smallest id."""
    grouped = rows.where(F.col("label").isNotNull() & _usable("vector")).groupBy("label", "vector")
    grouped = grouped.agg(F.count("*").alias("m"), F.min("vec_id").alias("first"))
    path = scratch_path(rows.sparkSession, "nodes")
    grouped.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


_BUCKETS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("node", T.LongType())])


def _hash(k: int, n_tables: int):
    """Buckets of each node. A bucket's number takes in label and table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = {}
        mix = np.random.default_rng(SEED).integers(1, 1 << 63, k, np.uint64) | np.uint64(1)
        for whole in batches:
            dims = whole.column("dim").to_numpy()
            for dim in np.unique(dims):
                if dim not in planes:
                    dice = np.random.default_rng([SEED, int(dim)])
                    planes[dim] = dice.normal(size=(int(dim), k * n_tables)), dice.uniform(0, WIDTH, k * n_tables)
                a, b = planes[dim]
                part = whole.filter(pa.array(dims == dim))
                cells = np.floor((_unit(_matrix(part.column("vector"))) @ a + b) / WIDTH).astype(np.int64).view(np.uint64)
                cells = cells.reshape(len(part), n_tables, k)
                with np.errstate(over="ignore"):
                    h = part.column("label_hash").to_numpy().view(np.uint64)[:, None] ^ (
                        np.arange(n_tables, dtype=np.uint64) * mix[0] + np.uint64(dim)
                    )
                    for i in range(k):
                        h = (h ^ cells[:, :, i]) * mix[i]
                        h ^= h >> np.uint64(29)
                node = np.repeat(part.column("node").to_numpy(), n_tables)
                yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(node)], names=_BUCKETS.fieldNames())

    return run


def _buckets(nodes: DataFrame, link: float) -> DataFrame:
    """(bucket, node, size) of the buckets that two nodes or more are in."""
    spark = nodes.sparkSession
    largest = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    keyed = nodes.select("node", "dim", "vector", F.xxhash64("label").alias("label_hash"))
    path = scratch_path(spark, "buckets")
    keyed.mapInArrow(_hash(*tables(largest, link)), _BUCKETS).write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes, "bucket").checkpoint()


# ---------------------------------------------------------------------- angles


def _cosine(u: str, v: str) -> Column:
    """Cosine of two vector columns in double precision; -1 for unlike lengths."""

    @F.arrow_udf(T.DoubleType())
    def run(u: pa.Array, v: pa.Array) -> pa.Array:
        nu, nv = (np.diff(x.offsets.to_numpy()) for x in (u, v))
        out = np.full(len(u), -1.0)
        for n in np.unique(nu):
            at = np.flatnonzero((nu == n) & (nv == n))
            if len(at):
                a, b = (_unit(_matrix(x.take(pa.array(at)))) for x in (u, v))
                out[at] = np.einsum("ij,ij->i", a, b)
        return pa.array(out)

    return run(F.col(u), F.col(v))


def _angle(cosine: str) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col(cosine))))


# ----------------------------------------------------------------------- balls


def _balls(nodes: DataFrame, buckets: DataFrame, link: float) -> DataFrame:
    """(node, ball, angle): the leader of each node's ball and the angle to it."""
    half = math.acos(link) / 2 - MARGIN
    spark, vectors = nodes.sparkSession, nodes.select("node", "vector")
    rest, found = vectors.select("node"), None
    for _ in range(BALL_ROUNDS):
        open_ = buckets.join(rest, "node")
        # The largest of a node's buckets by the open nodes in it.
        sizes = open_.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("lead"))
        chosen = open_.drop("size").join(sizes.where("n > 1"), "bucket").groupBy("node").agg(
            F.max_by("lead.node", F.struct("n", "bucket")).alias("ball")
        )
        # A leader follows no other; who led nobody is open again.
        pairs = chosen.join(vectors, "node").join(vectors.select(F.col("node").alias("ball"), F.col("vector").alias("lead")), "ball")
        near = pairs.withColumn("cosine", _cosine("vector", "lead")).select("node", "ball", _angle("cosine").alias("angle"))
        near = near.where((F.col("angle") <= half) & (F.col("node") != F.col("ball"))).checkpoint()
        leaders = near.select("ball").distinct()
        members = near.join(leaders.withColumnRenamed("ball", "node"), "node", "left_anti")
        led = members.select(F.col("ball").alias("node")).distinct().select("node", F.col("node").alias("ball"), F.lit(0.0).alias("angle"))
        members = members.unionByName(led).checkpoint()
        found = members if found is None else found.unionByName(members)
        rest = rest.join(members.select("node"), "node", "left_anti").checkpoint()
    path = scratch_path(spark, "balls")
    found.unionByName(rest.select("node", F.col("node").alias("ball"), F.lit(0.0).alias("angle"))).write.parquet(path)
    return spark.read.parquet(path)


def _links(nodes: DataFrame, buckets: DataFrame, balls: DataFrame, link: float) -> tuple[DataFrame, DataFrame]:
    """((node, links) of nodes with vectors linked in other balls, linked balls
    (a, b)). Both directions of a pair are judged, each for its own members."""
    full = math.acos(link)
    sides = balls.join(nodes.select("node", "vector", "m"), "node").checkpoint()
    whole = sides.groupBy("ball").agg(F.max("angle").alias("radius"), F.sum("m").alias("m"), F.count("*").alias("n"))
    lead = sides.where(F.col("node") == F.col("ball")).select("ball", F.col("vector").alias("lead")).join(whole, "ball").checkpoint()
    meets = buckets.join(balls.select("node", "ball"), "node").select("bucket", "ball").distinct()
    # A bucket of one ball makes no pair.
    several = meets.groupBy("bucket").agg(F.count("*").alias("balls")).where("balls > 1").select("bucket")
    meets = meets.join(several, "bucket")
    pairs = meets.join(meets.select("bucket", F.col("ball").alias("other")), "bucket").where("ball < other")
    pairs = pairs.select(F.col("ball").alias("a"), F.col("other").alias("b")).distinct()
    side = lambda x: lead.select(*(F.col(c).alias(n) for c, n in (("ball", x), ("lead", f"{x}_lead"), ("radius", f"{x}_radius"), ("n", f"{x}_n"))))
    judged = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("cosine", _cosine("a_lead", "b_lead"))
    between = _angle("cosine")
    judged = judged.select(
        "a",
        "b",
        "cosine",
        (between - F.col("a_radius") - F.col("b_radius") > full + MARGIN).alias("apart"),
        # Two single vectors are settled by their cosine alone.
        F.when((F.col("a_n") == 1) & (F.col("b_n") == 1), F.col("cosine") >= link)
        .otherwise(between + F.col("a_radius") + F.col("b_radius") <= full - MARGIN)
        .alias("all"),
        ((F.col("a_n") == 1) & (F.col("b_n") == 1)).alias("single"),
    ).where("not apart").checkpoint()
    both = lambda rows: rows.select("a", "b").unionByName(rows.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = whole.select(F.col("ball").alias("b"), "m", "radius", "n")
    # All of b for each member of a.
    certain = both(judged.where("all")).join(sizes.select("b", "m"), "b").groupBy("a").agg(F.sum("m").alias("links"))
    certain = certain.join(balls.select(F.col("ball").alias("a"), "node"), "a").select("node", "links")
    # Open: each member of a against the leader and radius of b, then against b's members.
    opened = both(judged.where("not all and not single"))
    members = opened.join(sides.select(F.col("ball").alias("a"), "node", "vector"), "a")
    members = members.join(sizes, "b").join(lead.select(F.col("ball").alias("b"), "lead"), "b").withColumn("cosine", _cosine("vector", "lead"))
    between = _angle("cosine")
    members = members.select(
        "a",
        "b",
        "node",
        "m",
        (F.when(F.col("n") == 1, F.col("cosine") < link).otherwise(between - F.col("radius") > full + MARGIN)).alias("apart"),
        (F.when(F.col("n") == 1, F.col("cosine") >= link).otherwise(between + F.col("radius") <= full - MARGIN)).alias("all"),
    ).where("not apart").checkpoint()
    wholly = members.where("all").select("a", "b", "node", F.col("m").alias("links"))
    single = members.where("not all").join(sides.select("node", "vector"), "node").select("a", "b", "node", "vector")
    single = single.join(sides.select(F.col("ball").alias("b"), F.col("vector").alias("lead"), "m"), "b")
    single = single.withColumn("cosine", _cosine("vector", "lead")).where(F.col("cosine") >= link)
    single = single.groupBy("a", "b", "node").agg(F.sum("m").alias("links"))
    found = wholly.unionByName(single).checkpoint()
    linked = judged.where("all").select("a", "b").unionByName(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = certain.unionByName(found.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links"))
    return links, linked.distinct()


def near_duplicates(rows: DataFrame, link: float = LINK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of rows (vec_id,
    embedding, label).

    Vectors link when their labels are equal and not null, their lengths are
    equal and their cosine is at least `link`. Null, empty and zero vectors and
    those with null or non-finite components link with nothing and are their own
    components. Repeated rows link with each other. A row of null vec_id gets the
    smallest id of its component, null if there is none; it is kept only then.
    Further columns are not read. An empty table gives no rows."""
    rows = rows.select("vec_id", F.col("embedding").alias("vector"), "label")
    nodes = _nodes(rows)
    buckets = _buckets(nodes, link)
    balls = _balls(nodes, buckets, link)
    links, linked = _links(nodes, buckets, balls, link)
    joined = components(linked)
    of = balls.select("node", "ball").join(joined.select(F.col("node").alias("ball"), "comp"), "ball", "left")
    of = of.select("node", "ball", F.coalesce("comp", "ball").alias("comp")).join(nodes.select("node", "m", "first"), "node").checkpoint()
    least = of.groupBy("comp").agg(F.min("first").alias("component_id"))
    held = of.groupBy("ball").agg(F.sum("m").alias("held"))
    named = of.join(least, "comp").join(held, "ball").join(links, "node", "left").select(
        "node", (F.col("held") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    keyed = nodes.select("node", F.col("label").alias("_label"), F.col("vector").alias("_vector")).join(named, "node")
    out = rows.join(keyed, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
