"""URL verdicts from fixed host and path rules and from mined token rules.

Fixed rules fit a host, its subdomains and the paths under a prefix; the longest
wins. URLs that none fits are judged by association rules: FP-growth mines
combinations of URL tokens (host labels, words of the host, path segments, query
names) that go with bad labels; rules of enough support and confidence stay,
less those that a part of them already implies. Tokens that are rules alone, and
all but one of tokens that always come together, are taken out before mining, so
that the sets mined do not double with every token of a URL. A rule blocks the URLs that have
all its tokens; they are found by an inverted index from each rule's rarest token.

Everything is DataFrame code. Tokens keep no numbers, so that many URLs share a
token set; matching works on distinct token sets.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import fresh

#: (verdict, host, path). Fixed values of the registered query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: A mined rule's tokens and label occur together in this share of the labelled
#: URLs, and in no fewer than LEAST of them; of the URLs with its tokens, at least
#: MIN_CONFIDENCE are bad.
MIN_SUPPORT = 0.001
LEAST = 5
MIN_CONFIDENCE = 0.7

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _rest(url: Column) -> Column:
    """What follows the first ://, null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host(url: Column) -> Column:
    """Host with A-Z lower-cased; empty for a null url or one without ://."""
    found = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    """Path as written, up to ?, # or the end; empty like the host."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, null if none does.
    `rules` is part of the plan, so it is for lists of at most some thousands."""
    case = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))
        case = F.when(fits, found) if case is None else case.when(fits, found)
    return F.lit(None).cast("struct<verdict:string,rule:string>") if case is None else case


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens of a URL; numbers become N."""

    def marked(mark: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(mark), v))

    plain = lambda c: F.regexp_replace(c, "[0-9]+", "N")
    labels = F.split(plain(host), r"\.")
    words = F.split(plain(host), r"[.\-_]")
    rest = F.coalesce(_rest(url), F.lit(""))
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda q: F.substring_index(q, "=", 1))
    both = F.concat(
        marked("host:", labels),
        marked("word:", words),
        marked("path:", F.split(plain(F.lower(path)), "/")),
        marked("query:", names),
    )
    return F.array_sort(F.array_distinct(both))


def mine(
    pages: DataFrame,
    labels: DataFrame,
    min_support: float = MIN_SUPPORT,
    least: int = LEAST,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """(anchor, antecedent, confidence) of the rules that block: every token that
    is a rule alone, and the minimal rules of several tokens, in which the first of
    tokens that always come together stands for them.

    pages: (page_id, url); labels: (doc_id, quality, toxic), whose doc_id is the
    page's id. A page is bad if any of its labels has quality 0 or toxic 1. Null
    ids and labels without a value are left out. Without labelled pages, or
    without bad ones, there is no rule."""
    spark = pages.sparkSession
    marks = (
        labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg(
            F.max(
                (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1),
            ).alias("bad")
        )
    )
    url = F.col("url")
    baskets = pages.join(marks, "page_id").select(tokens(url, host(url), path(url)).alias("items"), "bad")
    baskets = baskets.where(F.size("items") > 0).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    n, n_bad = baskets.agg(F.count("*"), F.count_if("bad")).first()
    empty = spark.createDataFrame([], "anchor string, antecedent array<string>, confidence double")
    if not n_bad:
        return empty
    support = max(math.ceil(min_support * n), least)
    # Token by token: how often, how often on bad pages, and a mark of its rows.
    marked = [F.bit_xor(F.xxhash64(F.lit(i), "row")).alias(f"rows{i}") for i in (0, 1)]
    counts = (
        baskets.select(F.explode("items").alias("token"), "bad", "row")
        .groupBy("token")
        .agg(F.count("*").alias("m"), F.count_if("bad").alias("m_bad"), *marked)
        .checkpoint()
    )
    frequent = counts.where(F.col("m_bad") >= support)
    confident = F.col("m_bad") >= min_confidence * F.col("m")
    single = frequent.where(confident).select(
        F.col("token").alias("anchor"), F.array("token").alias("antecedent"), (F.col("m_bad") / F.col("m")).alias("confidence")
    )
    # Longer rules are minimal only without these tokens; a token of every page
    # adds nothing, and of tokens that always come together one will do.
    rest = (
        frequent.where(~confident & (F.col("m") < n)).groupBy("m", "m_bad", "rows0", "rows1").agg(F.min("token").alias("token"))
    )
    kept = baskets.select("row", "bad", F.explode("items").alias("token")).join(rest.select("token"), "token")
    kept = kept.groupBy("row", "bad").agg(F.array_sort(F.collect_list("token")).alias("items")).checkpoint()
    longer = _longer(kept, rest, support, n_bad, min_confidence)
    return single.unionByName(longer).checkpoint()


def _longer(baskets: DataFrame, counts: DataFrame, support: int, n_bad: int, min_confidence: float) -> DataFrame:
    """Minimal rules of two tokens or more. FP-growth over the bad pages gives the
    token sets of enough support; they are counted over all pages through the
    index by rarest token."""
    bad = baskets.where("bad").select("items")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (support - 0.5) / n_bad)).fit(bad)
    sets = model.freqItemsets.where(F.size("items") > 1).select(F.array_sort("items").alias("antecedent"), F.col("freq").alias("m_bad"))
    anchors = (
        sets.select("antecedent", "m_bad", F.explode("antecedent").alias("token"))
        .join(counts.select("token", "m"), "token")
        .groupBy("antecedent", "m_bad")
        .agg(F.min_by("token", F.struct("m", "token")).alias("anchor"))
        .checkpoint()
    )
    shapes = baskets.groupBy("items").agg(F.count("*").alias("times"))
    met = shapes.select("items", "times", F.explode("items").alias("anchor")).join(anchors, "anchor")
    rules = (
        met.where(F.size(F.array_except("antecedent", "items")) == 0)
        .groupBy("anchor", "antecedent", "m_bad")
        .agg(F.sum("times").alias("m"))
        .withColumn("confidence", F.col("m_bad") / F.col("m"))
        .where(F.col("confidence") >= min_confidence)
        .select("anchor", "antecedent", "confidence")
        .checkpoint()
    )
    # A rule that contains another rule's tokens blocks nothing more.
    shorter = rules.select("anchor", F.col("antecedent").alias("part"))
    implied = (
        rules.select("antecedent", F.explode("antecedent").alias("anchor"))
        .join(shorter, "anchor")
        .where((F.size("part") < F.size("antecedent")) & (F.size(F.array_except("part", "antecedent")) == 0))
        .select("antecedent")
        .distinct()
    )
    return rules.join(implied, "antecedent", "left_anti").select("anchor", "antecedent", "confidence")


def matches(sets: DataFrame, mined: DataFrame) -> DataFrame:
    """(tokens, mined_rule) of the distinct token sets that a mined rule fits; of
    several the one of highest confidence, then the first in order."""
    return (
        sets.select("tokens", F.explode("tokens").alias("anchor"))
        .join(mined, "anchor")
        .where(F.size(F.array_except("antecedent", "tokens")) == 0)
        .groupBy("tokens")
        .agg(F.min_by("antecedent", F.struct(-F.col("confidence"), "antecedent")).alias("mined_rule"))
    )


def judge(pages: DataFrame, mined: DataFrame, rules=RULES) -> tuple[DataFrame, dict[str, str]]:
    """pages (with `url`) with five more columns: host, path, rule, verdict and
    mined_rule (its tokens joined by spaces, null without one), and the names
    they got where pages has such columns.

    Every row gives one row and keeps its other columns. Null urls and urls
    without :// have an empty host and path, fit no rule and are allowed."""
    names = dict(zip(("host", "path", "rule", "verdict", "mined_rule"), fresh(pages, "host", "path", "rule", "verdict", "mined_rule")))
    found, key, fixed = fresh(pages.withColumns({n: F.lit(0) for n in names.values()}), "tokens", "key", "fixed")
    url, h, p = F.col("url"), F.col(f"`{names['host']}`"), F.col(f"`{names['path']}`")
    rows = (
        pages.withColumn(names["host"], host(url))
        .withColumn(names["path"], path(url))
        .withColumn(fixed, fixed_rule(h, p, rules))
        .withColumn(found, tokens(url, h, p))
    )
    sets = rows.where(F.col(fixed).isNull()).select(F.col(found).alias("tokens")).distinct()
    hit = matches(sets, mined).select(F.col("tokens").alias(key), F.concat_ws(" ", "mined_rule").alias(names["mined_rule"]))
    rows = rows.join(hit, F.col(found) == F.col(key), "left")
    by_method = F.when(F.col(names["mined_rule"]).isNotNull(), "block").otherwise("allow")
    rows = rows.withColumn(names["rule"], F.col(f"{fixed}.rule"))
    rows = rows.withColumn(names["mined_rule"], F.when(F.col(fixed).isNull(), F.col(names["mined_rule"])))
    rows = rows.withColumn(names["verdict"], F.coalesce(F.col(f"{fixed}.verdict"), by_method))
    return rows.drop(fixed, found, key), names
