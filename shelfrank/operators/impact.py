"""Exact top-k by cosine of sparse vectors, from an inverted index in order of
weight (a threshold algorithm).

A term's list holds the vectors that have the term, heaviest weight first, ids
rising among equal weights. A vector reads the lists of its own terms page by
page, each page twice as long as the one before, and scores what it meets in
full. What it has not met scores at most sum(own weight x weight at which the
list stands); once its k-th best beats that bound it stops. So a term that a
third of all vectors have costs each of them a page or two, not the list.

Ties at the bound are settled by ids: where a list stands at a weight, vectors
of that weight still to come have larger ids than those met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions import rank_key
from shelfrank.operators.topk import rank_all, top_k_per_group
from shelfrank.session import ensure_checkpoint_dir

#: Entries of a list's first page.
PAGE = 256
#: Scores further apart than APART have rank keys in their order; scores within
#: NOISE are equal but for the order of a sum.
APART = 2e-9
NOISE = 1e-12


def _page(rank: str):
    """0 for ranks up to PAGE, 1 for the next 2 PAGE, 2 for the next 4 PAGE, ..."""
    return F.floor(F.log2((F.col(rank) - 1) / F.lit(PAGE) + 1)).cast("int")


def inverted_index(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, pages) of vectors (id, terms, weights), the weights of unit
    norm. postings: (term, page, id, w). pages: (term, page, stands, last_id, gap,
    ended): weight and id at which a list stands after the page, the distance to
    the next smaller weight, whether the list ends."""
    flat = vectors.select("id", F.explode(F.arrays_zip("terms", "weights")).alias("e"))
    flat = flat.select("id", F.col("e.terms").alias("term"), F.col("e.weights").alias("w"))
    order = [F.col("w").desc(), F.col("id").asc()]
    ranked = rank_all(flat, "term", order).withColumn("page", _page("rank")).checkpoint()
    length = ranked.groupBy("term").agg(F.max("rank").alias("length"))
    ends = ranked.groupBy("term", "page").agg(F.max(F.struct("rank", "w", "id")).alias("e"))
    ends = ends.select("term", "page", F.col("e.rank").alias("rank"), F.col("e.w").alias("stands"), F.col("e.id").alias("last_id"))
    # The next smaller weight: distinct weights of a term, numbered.
    weights = rank_all(flat.select("term", "w").distinct(), "term", [F.col("w").desc()]).checkpoint()
    below = weights.select("term", F.col("w").alias("next"), (F.col("rank") - 1).alias("rank"))
    below = weights.join(below, ["term", "rank"], "left").select("term", F.col("w").alias("stands"), "next")
    pages = ends.join(length, "term").join(below, ["term", "stands"]).select(
        "term",
        "page",
        "stands",
        "last_id",
        (F.col("stands") - F.coalesce("next", F.lit(0.0))).alias("gap"),
        (F.col("rank") == F.col("length")).alias("ended"),
    )
    return ranked.select("term", "page", "id", "w"), pages.checkpoint()


def _dot():
    """Dot product of (terms, weights) and (other_terms, other_weights), in the
    order of the terms, so that it is the same from both sides."""
    there = F.map_from_arrays("other_terms", "other_weights")
    both = F.filter(F.arrays_zip("terms", "weights"), lambda e: F.array_contains("other_terms", e["terms"]))
    return F.aggregate(both, F.lit(0.0), lambda s, e: s + e["weights"] * F.element_at(there, e["terms"]))


def top_k_sparse(vectors: DataFrame, k: int) -> DataFrame:
    """(a, b, sim), b != a: for each vector the k others of highest positive
    cosine, ties by id. vectors: (id, terms, weights), ids unique, terms sorted
    and unique in a vector, norms above 0."""
    ensure_checkpoint_dir(vectors.sparkSession)
    norm = F.sqrt(F.aggregate("weights", F.lit(0.0), lambda s, w: s + w * w))
    vectors = vectors.select("id", "terms", F.transform("weights", lambda w: w / norm).alias("weights")).checkpoint()
    postings, pages = inverted_index(vectors)
    others = vectors.select(F.col("id").alias("b"), F.col("terms").alias("other_terms"), F.col("weights").alias("other_weights"))
    open_, best, done, page = vectors, None, [], 0
    while True:
        reads = open_.select("id", F.explode(F.arrays_zip("terms", "weights")).alias("e"))
        reads = reads.select(F.col("id").alias("a"), F.col("e.terms").alias("term"), F.col("e.weights").alias("own"))
        met = reads.join(postings.where(F.col("page") == page), "term").where(F.col("id") != F.col("a"))
        met = met.select("a", F.col("id").alias("b")).distinct()
        if best is not None:
            met = met.join(best, ["a", "b"], "left_anti")
        met = met.join(open_.withColumnRenamed("id", "a"), "a").join(others, "b")
        found = met.select("a", "b", _dot().alias("sim")).where(F.col("sim") > 0)
        if best is not None:
            found = found.unionByName(best.select("a", "b", "sim"))
        order = [rank_key("sim").desc(), F.col("b").asc()]
        best = top_k_per_group(found, "a", k, order=order).checkpoint()
        # Where each list of an open vector stands: its last page read, if the list goes on.
        stands = reads.join(pages.where((F.col("page") == page) & ~F.col("ended")), "term")
        kth = best.where(F.col("rank") == k).select("a", F.col("sim").alias("kth"), F.col("b").alias("kth_id"))
        bound = stands.groupBy("a").agg(
            F.sum(F.col("own") * F.col("stands")).alias("bound"),
            F.max(F.when(F.col("own") * F.col("gap") > APART, F.col("last_id"))).alias("met_to"),
        )
        beats = F.col("kth") > F.col("bound") + APART
        ties = (F.col("kth") >= F.col("bound") - NOISE) & (F.col("kth_id") <= F.col("met_to"))
        goes_on = bound.join(kth, "a", "left").where(~F.coalesce(beats | ties, F.lit(False))).select("a")
        open_ = open_.join(goes_on, open_["id"] == goes_on["a"], "left_semi").checkpoint()
        rest = open_.select(F.col("id").alias("a"))
        if open_.isEmpty():
            done.append(best)
            break
        done.append(best.join(rest, "a", "left_anti"))
        best = best.join(rest, "a", "left_semi").checkpoint()
        page += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("a", "b", "sim")
