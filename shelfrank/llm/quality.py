"""Quality rules: an interpretable decision list learned from labelled statistics.

`with_stats` adds per-document statistics of the whole text (one pass, Arrow
batches). `learn` runs sequential covering on a bounded labelled sample: it
grows one conjunction of thresholds at a time to separate bad documents from
good ones (FOIL gain on two thirds of the sample), prunes it on the last third,
keeps it if it stays precise there, takes the bad documents it covers out and
goes on until no rule is left that pays for its conditions. `DecisionList.bad` is the list as one ordered Spark CASE expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import fresh, ship, slices, texts

ship(__name__)

#: Labelled documents used at most: those with the smallest hash of their id.
SAMPLE_DOCS = 10_000
#: A rule stays if at least this share of what it covers in the pruning sample is bad.
MIN_PRECISION = 0.97
#: Bad documents that a rule must cover in the growing sample.
MIN_COVER = 3
#: Thresholds tried per statistic.
CUTS = 32

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further statistics, all ratios between 0 and 1, except mean_word.
RATIOS = (
    "symbol_ratio",
    "repeat_ratio",
    "dup_line_ratio",
    "upper_ratio",
    "digit_ratio",
    "punct_ratio",
    "top_word_ratio",
    "distinct_ratio",
    "no_letter_word_ratio",
    "mean_word",
)
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(_SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_LOWER = np.zeros(256, bool)
_IS_LOWER[97:123] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_IS_PUNCT = np.zeros(256, bool)
_IS_PUNCT[33:127] = True
_IS_PUNCT &= ~(_IS_UPPER | _IS_LOWER | _IS_DIGIT)


def text_stats(raw: bytes | None) -> list[float]:
    """COUNTS then RATIOS of one text. Null and blank texts give zeros."""
    words = raw.split() if raw else []  # bytes.split cuts at [\x20\x09-\x0D] exactly
    n = len(words)
    if not n:
        b = np.frombuffer(raw or b"", np.uint8)
        return [0, 0, int(_IS_SYMBOL[b].sum()), 0, 0] + [0.0] * len(RATIOS)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    # Code points are the bytes that do not continue a UTF-8 sequence.
    word_chars = int(hist.sum() - hist[0x80:0xC0].sum() - hist[list(_SPACE)].sum())
    n_symbols = int(hist[_IS_SYMBOL].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    n_repeat = 0
    if n >= 3:
        pair = code[:-1] * len(number) + code[1:]
        _, pair = np.unique(pair, return_inverse=True)
        triple = pair[:-1] * len(number) + code[2:]
        _, back, times = np.unique(triple, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(times[back] > 1)
        mark = np.zeros(n, bool)
        for k in range(3):
            mark[twice + k] = True
        n_repeat = int(mark.sum())
    upper, lower = int(hist[_IS_UPPER].sum()), int(hist[_IS_LOWER].sum())
    no_letter = sum(not (w.upper() != w.lower() or max(w) > 127) for w in number) if len(number) < 4 * n else 0
    return [
        n,
        word_chars,
        n_symbols,
        n_dup,
        n_repeat,
        n_symbols / max(1, word_chars),
        n_repeat / n,
        n_dup / max(1, len(lines)),
        upper / max(1, upper + lower),
        int(hist[_IS_DIGIT].sum()) / max(1, word_chars),
        int(hist[_IS_PUNCT].sum()) / max(1, word_chars),
        int(np.bincount(code).max()) / n,
        len(number) / n,
        no_letter / len(number),
        word_chars / n,
    ]


def with_stats(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """docs with the statistics of each whole text as further columns, and the
    name that each statistic got (a clashing name gets underscores)."""
    stats = [*COUNTS, *RATIOS]
    names = fresh(docs, *stats)
    types = [T.LongType()] * len(COUNTS) + [T.DoubleType()] * len(RATIOS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, text):
                rows = [text_stats(raw) for raw in texts(part, text)]
                added = [
                    pa.array([r[i] for r in rows], pa.int64() if i < len(COUNTS) else pa.float64())
                    for i in range(len(stats))
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(names, types))])
    return docs.mapInArrow(run, schema), dict(zip(stats, names))


@dataclass(frozen=True)
class Condition:
    """stat >= cut (above) or stat < cut."""

    stat: str
    above: bool
    cut: float

    def holds(self, x: np.ndarray, at: dict[str, int]) -> np.ndarray:
        col = x[:, at[self.stat]]
        return col >= self.cut if self.above else col < self.cut

    def column(self, names: dict[str, str]) -> Column:
        col = F.col(f"`{names[self.stat]}`")
        return col >= F.lit(self.cut) if self.above else col < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.stat} {'>=' if self.above else '<'} {self.cut:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds decides, each for `bad`; else good."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def rule_number(self, names: dict[str, str]) -> Column:
        """1-based number of the first rule that holds, 0 if none does."""
        case = None
        for i, rule in enumerate(self.rules, 1):
            hit = F.lit(True)
            for c in rule:
                hit = hit & c.column(names)
            case = F.when(hit, F.lit(i)) if case is None else case.when(hit, F.lit(i))
        return F.lit(0) if case is None else case.otherwise(F.lit(0))

    def bad(self, names: dict[str, str]) -> Column:
        return self.rule_number(names) > 0

    def __str__(self) -> str:
        return "\n".join(f"bad if {' and '.join(map(str, r))}" for r in self.rules) or "good"


def _holds(rule: list[Condition], x: np.ndarray, at: dict[str, int]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x, at)
    return out


def _cuts(values: np.ndarray) -> np.ndarray:
    """Midpoints between neighbouring quantiles."""
    q = np.unique(np.quantile(values, np.linspace(0, 1, CUTS + 1)))
    return (q[:-1] + q[1:]) / 2


def _grow(x: np.ndarray, bad: np.ndarray, at: dict[str, int]) -> list[Condition]:
    """Add the condition of the largest FOIL gain until no good row is covered.
    The gain is the bits it saves in telling the bad rows covered; a condition that
    saves no more than it takes to name it, among all that were tried, is not added."""
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    named = np.log2(2 * CUTS * 2 * len(at))
    while (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), inside.sum()
        best, gain = None, named
        for stat, j in at.items():
            for cut in _cuts(x[bad & inside, j]).tolist() + _cuts(x[inside, j]).tolist():
                for above in (True, False):
                    hit = inside & ((x[:, j] >= cut) if above else (x[:, j] < cut))
                    p, n = (bad & hit).sum(), hit.sum()
                    if p < MIN_COVER or n == n0:
                        continue
                    g = p * (np.log2(p / n) - np.log2(p0 / n0))
                    if g > gain + 1e-9:
                        best, gain = Condition(stat, above, float(cut)), g
        if best is None:
            break
        best = _centred(best, x[inside, at[best.stat]], bad[inside])
        rule.append(best)
        inside &= best.holds(x, at)
    return rule


def _centred(c: Condition, values: np.ndarray, bad: np.ndarray) -> Condition:
    """The condition with its cut midway between the bad rows that it covers and
    the nearest row beyond them."""
    if c.above:
        edge = values[bad & (values >= c.cut)].min()
        return Condition(c.stat, True, float((edge + values[values < edge].max(initial=-np.inf)) / 2))
    edge = values[bad & (values < c.cut)].max()
    return Condition(c.stat, False, float((edge + values[values > edge].min(initial=np.inf)) / 2))


def _prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray, at: dict[str, int]) -> list[Condition]:
    """Drop final conditions while (bad - good) / covered does not fall."""

    def worth(r: list[Condition]) -> float:
        hit = _holds(r, x, at)
        return ((bad & hit).sum() - (~bad & hit).sum()) / max(1, hit.sum())

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn_rules(x: np.ndarray, bad: np.ndarray, stats: list[str]) -> DecisionList:
    """Sequential covering over rows x (statistics) with labels bad. Rows are
    dealt into the growing and the pruning sample by position, so callers pass
    them in a fixed order."""
    at = {s: i for i, s in enumerate(stats)}
    held = np.arange(len(x)) % 3 == 2
    gx, gb, px, pb = x[~held], bad[~held].astype(bool), x[held], bad[held].astype(bool)
    rules: list[tuple[Condition, ...]] = []
    while gb.sum() >= MIN_COVER:
        rule = _grow(gx, gb, at)
        if not rule:
            break
        rule = _prune(rule, px, pb, at)
        inside, outside = _holds(rule, gx, at), _holds(rule, px, at)
        covered, right = inside.sum() + outside.sum(), (gb & inside).sum() + (pb & outside).sum()
        if not (gb & inside).any() or right < MIN_PRECISION * covered:
            break
        rules.append(tuple(rule))
        gx, gb, px, pb = gx[~inside], gb[~inside], px[~outside], pb[~outside]
    return DecisionList(tuple(rules))


def _smallest_hashes(rows: DataFrame, n: int, k: int) -> DataFrame:
    """The k of n rows (doc_id, quality) with the smallest hash of their id. A cut
    that about k rows pass, and six deviations more, keeps the others from being
    sorted."""
    share = (k + 6 * k**0.5 + 36) / max(1, n)
    if share < 1:
        rows = rows.where(F.xxhash64("doc_id") < F.lit(int(-(2**63) + share * 2**64)))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(k)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> DecisionList:
    """Decision list from labels (doc_id, quality 0 or 1) of docs (doc_id, text).

    Labels of null id or quality are left out; a document labelled more than
    once counts as bad if any label says so. The sample holds at most `sample`
    documents, half of them bad where there are as many, so it may be broadcast. Without labels, or
    without bad ones, the list is empty: every document is good."""
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    sizes = dict(marked.groupBy("quality").count().where(F.col("quality").isin(0, 1)).collect())
    halves = [_smallest_hashes(marked.where(F.col("quality") == q), sizes.get(q, 0), sample // 2) for q in (0, 1)]
    chosen = halves[0].unionByName(halves[1])
    rows, names = with_stats(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    stats = [*COUNTS, *RATIOS]
    used = [s for s in stats if s not in ("n_words", "word_chars")]
    found = rows.select("doc_id", "quality", *(names[s] for s in used)).toPandas()
    if found.empty:
        return DecisionList()
    found = found.drop_duplicates("doc_id").sort_values("doc_id")
    found = found.iloc[np.random.default_rng(7).permutation(len(found))]
    x = found[[names[s] for s in used]].to_numpy(float)
    return learn_rules(x, found["quality"].to_numpy() == 0, used)


def base_failed(names: dict[str, str]) -> Column:
    """Too short, or more than half of the words in repeated 3-word windows."""
    n, repeated = F.col(f"`{names['n_words']}`"), F.col(f"`{names['n_repeat_words']}`")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)


def judge(docs: DataFrame, rules: DecisionList) -> tuple[DataFrame, dict[str, str]]:
    """docs with the statistics, `base_failed`, `rule` (number of the rule that
    decides, 0 for none) and `kept`, and the names they got. Every row gives one
    row; null and empty texts have no words and fail the base rules."""
    rows, names = with_stats(docs)
    base, rule, kept = fresh(rows, "base_failed", "rule", "kept")
    rows = rows.withColumn(base, base_failed(names)).withColumn(rule, rules.rule_number(names))
    rows = rows.withColumn(kept, ~F.col(base) & (F.col(rule) == 0))
    return rows, names | {"base_failed": base, "rule": rule, "kept": kept}
