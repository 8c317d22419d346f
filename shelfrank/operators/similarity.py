"""Item-item similarity tables and per-user top-k from latent factors.

* `cosine_similarity`: cosine between item factor vectors above a threshold
  (the offline job's product similarity table).
* `factor_top_k`: top-k items per user by predicted score (dot product).
* `cooccurrence_similarity`: item-CF, n_ab / sqrt(n_a n_b) over users.
* `content_similarity`: TF-IDF over product tags, cosine, top-k per product.

All-pairs work goes through bounded block-pair tasks (`blocked`), pruned by
`pivots`, never a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.functions import l2norm, rank_key
from shelfrank.operators import blocked, cooccur, impact, pivots, waves
from shelfrank.operators.topk import rank_all, top_k_per_group
from shelfrank.session import ensure_checkpoint_dir, scratch_path

# Similarity threshold of the offline job, list lengths.
SIM_THRESHOLD = 0.6
MAX_RECS = 20


def cosine_similarity(
    factors: DataFrame,
    threshold: float = SIM_THRESHOLD,
    id_col: str = "id",
    vector_col: str = "features",
    block_rows: int = blocked.DEFAULT_BLOCK_ROWS,
    touching: DataFrame | None = None,
) -> DataFrame:
    """(productId, simId, sim) for all ordered pairs with cosine > threshold; of
    these the pairs with a product of `touching` (productId), where that is given:
    the lists of those products are whole, those of others are not.

    Zero vectors are dropped first: their cosine is 0/0, which the JVM compares
    as false but Spark SQL orders above every number.
    """
    v = factors.select(F.col(id_col).cast("int").alias("id"), F.col(vector_col).alias("v")).where(
        l2norm("v") > 0
    )
    pairs = pivots.cosine_join(v, "id", "v", threshold, block_rows=block_rows, touching=touching)
    return pairs.select(F.col("a").alias("productId"), F.col("b").alias("simId"), "sim")


def ranked_cosines(factors: DataFrame, threshold: float = SIM_THRESHOLD, id_col: str = "id", vector_col: str = "features") -> DataFrame:
    """`rank_similar` of `cosine_similarity`: (productId, simId, sim, rank), each list
    whole. Lists are ranked where their pairs are made; where a task cannot hold the
    vectors, or several have one id and so one list, pairs are dealt out to be
    ranked. Either way rows of a list that lie side by side are in the order of
    their ranks."""
    v = factors.select(F.col(id_col).cast("int").alias("id"), F.col(vector_col).alias("v")).where(l2norm("v") > 0)
    size = v.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.countDistinct("id").alias("ids")).first()
    if size["ids"] < size["n"] or not pivots.fits_lists(size["n"], size["dim"] or 1):
        return rank_similar(cosine_similarity(factors, threshold, id_col, vector_col))
    lists = pivots.ranked_lists(v, "id", "v", threshold)
    return lists.select(F.col("a").alias("productId"), F.col("b").alias("simId"), "sim", "rank")


#: Groups of pairs that `unmirrored` sums up.
MIRROR_GROUPS = 1 << 16


def mirror_sums(sim_col: str = "sim") -> list:
    """(group, up, down) of a pair's row (productId, simId, sim): the group is that
    of the pair in either direction, and up and down, the halves of a hash of pair
    and value with the direction's sign, add up to 0 over a row and its mirror image."""
    lo, hi = F.least("productId", "simId"), F.greatest("productId", "simId")
    sign = F.when(F.col("productId") < F.col("simId"), 1).otherwise(-1).cast("long")
    code = F.xxhash64(lo, hi, sim_col)
    return [
        F.pmod(F.hash(lo, hi), F.lit(MIRROR_GROUPS)).alias("group"),
        (sign * F.shiftright(code, 32)).alias("up"),
        (sign * code.bitwiseAND(F.lit((1 << 32) - 1))).alias("down"),
    ]


def unmirrored(sims: DataFrame, groups: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(asymmetric): rows of sims (productId, simId, sim) without a mirror image of
    the same sim. groups (group, up, down) holds the sums of `mirror_sums`; only
    rows of groups whose sums are not 0 are dealt to their mirror images, so that
    of symmetric pairs none moves. sims is computed again, where any such group is."""
    odd = groups.where((F.col("up") != 0) | (F.col("down") != 0)).select("group")
    if odd.isEmpty():
        return sims.sparkSession.range(1).select(F.lit(0).cast("long").alias("asymmetric"))
    rows = sims.select("productId", "simId", "sim", mirror_sums()[0]).join(odd, "group", "left_semi")
    back = rows.select(F.col("simId").alias("productId"), F.col("productId").alias("simId"), F.col("sim").alias("back"))
    both = rows.join(back, ["productId", "simId"], "left")
    return both.agg(F.count_if(F.coalesce(F.abs(F.col("back") - F.col("sim")) > tolerance, F.lit(True))).alias("asymmetric"))


def rank_similar(sims: DataFrame, k: int | None = None) -> DataFrame:
    """Rank each product's neighbours by sim desc, simId asc: adds `rank`;
    keeps the first k when k is given."""
    order = [rank_key("sim").desc(), F.col("simId").asc()]
    if k is None:
        # Uncapped lists: a product may neighbour a third of the catalogue.
        return rank_all(sims, "productId", order)
    return top_k_per_group(sims, "productId", k, order=order)


def factor_top_k(
    user_factors: DataFrame,
    item_factors: DataFrame,
    k: int = MAX_RECS,
    positive_only: bool = True,
    block_rows: int = blocked.DEFAULT_BLOCK_ROWS,
    user_block_rows: int | None = None,
) -> DataFrame:
    """(userId, rank, productId, score): each user's k best items by u . i,
    only scores > 0 when positive_only; ties by productId.

    Items are met in waves of falling norm, and a user stops when no item to come
    can enter their list (`waves.top_k_by_norm`). With far more users than items,
    give users larger blocks (`user_block_rows`): within a wave each user row is
    copied once per item block and each item row once per user block.
    """
    return waves.top_k_by_norm(user_factors, item_factors, k, positive_only, block_rows, user_block_rows)[0]


def cooccurrence_similarity(
    ratings: DataFrame,
    min_support: int = 1,
    k: int | None = MAX_RECS,
    heavy_items: int = cooccur.HEAVY_ITEMS,
) -> DataFrame:
    """Item-CF: sim(a, b) = n_ab / sqrt(n_a * n_b), n = distinct users; pairs
    need n_ab >= min_support. Output (productId, simId, sim, rank), rank <= k.
    Counted by `cooccur.top_pairs`, lists without a cap by `cooccur.pair_counts`."""
    up = ratings.select("userId", "productId").distinct()
    if k is not None:
        # Read more than once: written, the ratings are joined and dealt out once.
        spark, path = ratings.sparkSession, scratch_path(ratings.sparkSession, "user-items")
        up.write.parquet(path)
        up = spark.read.schema(up.schema).parquet(path)
    n_item = up.groupBy("productId").agg(F.count("*").alias("n"))
    if k is not None:
        return rank_similar(cooccur.top_pairs(up, n_item, k, min_support, heavy_items), k)
    return rank_similar(cooccur.scored(cooccur.pair_counts(up, heavy_items, n_item), n_item, min_support), k)


def tag_weights(products: DataFrame, tags_col: str = "tags") -> DataFrame:
    """TF-IDF weights per (productId, tag): tf = count of the tag in the
    product's list, idf = ln((N + 1) / (df + 1)) over N products with tags."""
    tokens = products.select(
        "productId", F.explode(F.split(F.col(tags_col), r"\|")).alias("tag")
    ).where(F.col("tag") != "")
    tf = tokens.groupBy("productId", "tag").agg(F.count("*").alias("tf"))
    # N is one number: a distributed count, as Spark ML's IDF computes it.
    n_docs = tf.select("productId").distinct().count()
    idf = tf.groupBy("tag").agg(
        F.log(F.lit(n_docs + 1.0) / (F.count("*") + F.lit(1.0))).alias("idf")
    )
    return tf.join(idf, "tag").select("productId", "tag", (F.col("tf") * F.col("idf")).alias("w"))


def content_similarity(products: DataFrame, k: int = MAX_RECS) -> DataFrame:
    """Content neighbours: cosine of TF-IDF tag vectors, top k per product.

    Products with the same tag multiset have the same vector, so similarity is
    computed between distinct tag profiles, from an inverted index by tag
    (`impact.top_k_sparse`, exact), then expanded to products. Expansion is exact
    and bounded: for a product in profile p only the first k+1 profiles q by (sim
    desc, smallest product id of q) and, in each q, its k+1 smallest product ids
    can reach the top k (k other products already precede anything later); of
    those, p keeps its best k+1, and each product of p drops itself and keeps k.
    The k+1 reach the profile's products as one list, so a product is one row until
    its k are taken, however many products share its profile. Output (productId, rank, simId, sim).
    """
    ensure_checkpoint_dir(products.sparkSession)
    w = tag_weights(products)
    # The per-product profile table feeds four branches below: a reliable
    # checkpoint (in spark.checkpoint.dir) computes it once and cuts the lineage.
    prof_of = (
        w.groupBy("productId")
        .agg(F.array_sort(F.collect_list(F.struct("tag", "w"))).alias("vec"))
        .withColumn("profile", F.sha2(F.to_json("vec"), 256))
        .checkpoint()
    )
    profiles = (
        prof_of.groupBy("profile")
        .agg(
            F.first("vec").alias("vec"),
            F.min("productId").alias("min_id"),
        )
        .where(F.aggregate(F.col("vec"), F.lit(0.0), lambda acc, e: acc + e["w"] * e["w"]) > 0)
        .checkpoint()
    )
    # A profile's smallest product id is its own and orders ties.
    vectors = profiles.select(
        F.col("min_id").alias("id"),
        F.transform("vec", lambda e: e["tag"]).alias("terms"),
        F.transform("vec", lambda e: e["w"]).alias("weights"),
    )
    name = lambda c: profiles.select(F.col("min_id").alias(f"{c}_id"), F.col("profile").alias(c))
    pairs = impact.top_k_sparse(vectors, k + 1).withColumnsRenamed({"a": "a_id", "b": "b_id"})
    pairs = pairs.join(name("a"), "a_id").join(name("b"), "b_id").select("a", "b", "sim")
    selfs = profiles.select(F.col("profile").alias("a"), F.col("profile").alias("b"), F.lit(1.0).alias("sim"))
    # Candidate profiles q of p: the first k+1 by (sim desc, min_id asc).
    qmin = profiles.select(F.col("profile").alias("b"), F.col("min_id").alias("b_min"))
    prof_pairs = pairs.unionByName(selfs).join(qmin, "b")
    top_q = top_k_per_group(
        prof_pairs, "a", k + 1, order=[rank_key("sim").desc(), F.col("b_min").asc()], rank_col="_qr"
    )
    # Products of each profile: its k+1 smallest ids.
    members = prof_of.select("profile", "productId")
    first_ids = top_k_per_group(
        members, "profile", k + 1, order=[F.col("productId").asc()], rank_col="_pr"
    ).select(F.col("profile").alias("b"), F.col("productId").alias("simId"))
    cand = top_q.join(first_ids, "b").select(F.col("a").alias("profile"), "simId", "sim")
    # A product's top k is its profile's top k+1 without itself, so each
    # profile's list is cut to k+1 before it meets the profile's products.
    order = [rank_key("sim").desc(), F.col("simId").asc()]
    cand = top_k_per_group(cand, "profile", k + 1, order=order, rank_col="_cr")
    entries = F.array_sort(F.collect_list(F.struct("_cr", "simId", "sim")))
    nearest = cand.groupBy("profile").agg(entries.alias("_near"))
    others = F.filter("_near", lambda e: e["simId"] != F.col("productId"))
    per_product = members.join(nearest, "profile").select("productId", F.posexplode(F.slice(others, 1, k)).alias("_at", "e"))
    return per_product.select("productId", (F.col("_at") + 1).alias("rank"), F.col("e.simId").alias("simId"), F.col("e.sim").alias("sim"))
