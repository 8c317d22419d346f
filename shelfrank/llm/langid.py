"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order byte model: contexts of 0 to `MAX_ORDER`
bytes, symbol counts in each, and escape method C (a context with n symbols
seen, d of them different, gives count / (n + d) to a seen symbol and d / (n + d)
to the escape to the next shorter context; the empty context escapes to the
uniform distribution over 256 bytes). The statistics are frozen after training;
a text's code length in bits under each language is summed byte by byte, and
the language with the shortest code wins.

All languages share one tree of contexts. The tree is closed under dropping the
first or the last byte, so it is also an automaton: the longest context at a
position follows from the context before it and one byte. The state depends on
the last MAX_ORDER bytes alone, so texts are cut into chunks that warm up on the
bytes before them, and numpy advances all chunks of a slice in lockstep. The sum
over chunks is the code length of the whole text.

Training reads a bounded sample: at most `SAMPLE_DOCS` documents per language,
those with the smallest hash of their id. Counting is a Spark aggregation. A
language keeps the contexts that pay: that shorten the code of its own sample by a
fixed share (`SAVED_SHARE`) or more. So a language has as many contexts as its sample is
worth, whatever other languages there are, and its costs do not depend on theirs:
where another language alone has a context, it goes on from its own shorter one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.llm.common import fresh, ship, slices, texts

ship(__name__)

MAX_ORDER = 4
#: A context of a language stays if its counts shorten the code of the language's
#: sample, against the next shorter context, by this share of the sample's code
#: without contexts, and by LEAST_BITS.
SAVED_SHARE = 1e-5
LEAST_BITS = 16.0
SAMPLE_DOCS = 500
#: Rows of ids and languages that are broadcast at most.
BROADCAST_ROWS = 200_000
HELD_OUT_MOD = 5
UNDETERMINED = "und"
#: A text is foreign if its bits per byte exceed FAR x the worst of at least
#: LEAST_HELD_OUT held-out documents of its language, half as long or longer.
FAR = 1.5
LEAST_HELD_OUT = 20
#: Bytes that a chunk scores; its first MAX_ORDER steps only find its state.
CHUNK = 256

_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: str = "doc_id"):
    """True for documents that training never sees: crc32(id as text) mod 5 is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_MOD == 0


def _small(rows: DataFrame, n: int) -> DataFrame:
    """rows, n of them at most, to be broadcast unless that is too many."""
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows


def training_sample(docs: DataFrame, per_lang: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text) of at most per_lang training documents per language. Ids are
    chosen first, without texts; where they are few enough they are broadcast and
    fetch their texts where they lie. A cut of the hash that about per_lang ids of
    a language pass, and six deviations more, leaves few to rank."""
    usable = docs.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()
    )
    share = F.lit(per_lang + 6 * per_lang**0.5 + 36) / F.count("*")
    cuts = usable.groupBy("lang").agg(F.when(share < 1, share * 2.0**32).otherwise(2.0**32).alias("_cut")).checkpoint()
    n_langs = cuts.count()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    high = F.shiftright(F.xxhash64("doc_id"), 32) + F.lit(1 << 31)  # orders like the hash
    chosen = (
        usable.select("doc_id", "lang")
        .join(_small(cuts, n_langs), "lang")
        .where(high <= F.col("_cut"))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= per_lang)
        .select("doc_id", "lang")
        .distinct()
    )
    return usable.select("doc_id", "lang", "text").join(
        _small(chosen, n_langs * per_lang), ["doc_id", "lang"], "left_semi"
    ).drop("doc_id")


_COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("ctx_order", T.IntegerType()),
        T.StructField("ctx", T.LongType()),
        T.StructField("sym", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)


def _count_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of (context, next byte) for each order in each slice."""
    for whole in batches:
        for part in slices(whole, "text"):
            langs = part.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                codes: list[list[np.ndarray]] = [[] for _ in range(MAX_ORDER + 1)]
                for code_lang, raw in zip(langs, texts(part, "text")):
                    if code_lang != lang or not raw:
                        continue
                    b = np.frombuffer(raw, np.uint8).astype(np.int64)
                    code = b
                    codes[0].append(code)
                    for k in range(1, min(MAX_ORDER, len(b) - 1) + 1):
                        code = (code[:-1] << 8) | b[k:]
                        codes[k].append(code)
                for k, found in enumerate(codes):
                    if found:
                        value, n = np.unique(np.concatenate(found), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * len(value), pa.string()),
                                pa.array(np.full(len(value), k, np.int32)),
                                pa.array(value >> 8),
                                pa.array((value & 255).astype(np.int32)),
                                pa.array(n.astype(np.int64)),
                            ],
                            names=_COUNTS.fieldNames(),
                        )


class Model:
    """The frozen statistics of all languages: the automaton and, for each
    context and byte, its cost in bits in each language."""

    def __init__(self, langs: list[str], step: np.ndarray, cost: np.ndarray):
        self.langs, self.step, self.cost = langs, step, cost


def build_model(rows: pa.Table | list[tuple[str, int, int, int, int]]) -> Model | None:
    """Model from (lang, order, context, symbol, count) rows whose contexts form
    a closed tree; None without rows.

    The driver holds the rows, the model itself and the probabilities of a context
    and those it comes from, not all contexts' counts and probabilities at once."""
    if not len(rows):
        return None
    if not isinstance(rows, pa.Table):
        rows = pa.table([pa.array(c) for c in zip(*rows)], names=_COUNTS.fieldNames())
    lang = pc.dictionary_encode(rows.column("lang").combine_chunks())
    names = lang.dictionary.to_pylist()
    langs = sorted(names)
    where = np.array([langs.index(name) for name in names])[lang.indices.to_numpy()]
    order, ctx, sym, n = (rows.column(c).to_numpy() for c in ("ctx_order", "ctx", "sym", "n"))
    # One number per context, shorter ones first.
    mixed = (order.astype(np.int64) << 8 * MAX_ORDER) | ctx
    contexts = np.union1d(mixed, [0])
    orders, codes = contexts >> 8 * MAX_ORDER, contexts & ((1 << 8 * MAX_ORDER) - 1)
    cell = np.searchsorted(contexts, mixed)
    by_context = np.argsort(cell, kind="stable")
    edge = np.searchsorted(cell[by_context], np.arange(len(contexts) + 1))

    def number(orders: np.ndarray, codes: np.ndarray) -> np.ndarray:
        wanted = (orders << 8 * MAX_ORDER) | codes
        at = np.searchsorted(contexts, wanted)
        if not np.array_equal(contexts[at], wanted):
            raise ValueError("the contexts are not a closed tree")
        return at

    step = np.zeros((len(contexts), 256), np.int32)
    for k in range(MAX_ORDER + 1):
        at = np.flatnonzero(orders == k)
        if k:
            step[at] = step[number(orders[at] - 1, codes[at] & ((1 << 8 * (k - 1)) - 1))]
        longer = np.flatnonzero(orders == k + 1)
        step[number(orders[longer] - 1, codes[longer] >> 8), codes[longer] & 255] = longer
    cost = np.empty((len(contexts), 256, len(langs)), np.float32)
    # Contexts behind the one that lacks their first byte: by bytes, last one first.
    back = [bytes(int(codes[i]).to_bytes(MAX_ORDER, "little")[: orders[i]]) for i in range(len(contexts))]
    prob = np.empty((MAX_ORDER + 1, 256, len(langs)))
    for i in sorted(range(len(contexts)), key=back.__getitem__):
        mine = by_context[edge[i] : edge[i + 1]]
        counts = np.zeros((256, len(langs)))
        np.add.at(counts, (sym[mine], where[mine]), n[mine])
        lower = prob[orders[i] - 1] if orders[i] else np.full((256, len(langs)), 1 / 256)
        total, kinds = counts.sum(0), (counts > 0).sum(0)
        seen = np.where(total > 0, total + kinds, 1)
        escape = np.where(total > 0, kinds / seen, 1.0)
        prob[orders[i]] = np.where(counts > 0, counts / seen, escape * lower)
        cost[i] = -np.log2(prob[orders[i]])
    return Model(langs, step.reshape(-1), cost.reshape(-1, len(langs)))


def _paying(counts: DataFrame, share: float) -> DataFrame:
    """(lang, ctx_order, ctx) of the contexts that pay, and of all shorter ones
    that come from dropping their first or last bytes, so that they are a tree.
    counts: the rows of `_count_contexts`, added up."""
    sizes = counts.groupBy("lang", "ctx_order", "ctx").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    known = counts.join(sizes, ["lang", "ctx_order", "ctx"]).withColumn("bits", -F.log2(F.col("n") / (F.col("total") + F.col("kinds"))))
    # The same bytes' cost in the next shorter context, which has seen them all.
    shorter = known.select(
        "lang", (F.col("ctx_order") + 1).alias("ctx_order"), F.col("ctx").alias("_low"), "sym", F.col("bits").alias("_bits")
    )
    low = F.expr("ctx & (shiftleft(1L, 8 * (ctx_order - 1)) - 1)")
    worth = known.where("ctx_order > 0").withColumn("_low", low).join(shorter, ["lang", "ctx_order", "_low", "sym"])
    worth = worth.groupBy("lang", "ctx_order", "ctx").agg(F.sum(F.col("n") * (F.col("_bits") - F.col("bits"))).alias("saved"))
    plain = known.where("ctx_order = 0").groupBy("lang").agg(F.greatest(F.lit(LEAST_BITS), share * F.sum(F.col("n") * F.col("bits"))).alias("least"))
    kept = worth.join(plain, "lang").where(F.col("saved") >= F.col("least")).select("lang", "ctx_order", "ctx").checkpoint()
    # All runs of a context's bytes, itself included.
    runs = F.expr(
        "flatten(transform(sequence(1, ctx_order), k -> transform(sequence(0, ctx_order - k), i -> "
        "struct(k as ctx_order, shiftright(ctx, 8 * i) & (shiftleft(1L, 8 * k) - 1) as ctx))))"
    )
    closed = kept.select("lang", F.explode(runs).alias("run")).select("lang", "run.ctx_order", "run.ctx")
    roots = counts.select("lang").distinct().select("lang", F.lit(0).alias("ctx_order"), F.lit(0).cast("long").alias("ctx"))
    return closed.unionByName(roots).distinct()


def train(docs: DataFrame, per_lang: int = SAMPLE_DOCS, share: float = SAVED_SHARE) -> Model | None:
    """Fit on the training sample of docs (doc_id, text, lang); None when no
    document is labelled."""
    counts = (
        training_sample(docs, per_lang)
        .mapInArrow(_count_contexts, _COUNTS)
        .groupBy("lang", "ctx_order", "ctx", "sym")
        .agg(F.sum("n").alias("n"))
        .checkpoint()
    )
    rows = counts.join(_paying(counts, share), ["lang", "ctx_order", "ctx"]).select(*_COUNTS.fieldNames())
    return build_model(rows.toArrow())


def code_lengths(model: Model, docs: list[bytes]) -> np.ndarray:
    """Bits of each text under each language, shape (texts, languages)."""
    out = np.zeros((len(docs), len(model.langs)))
    size = np.array([len(d) for d in docs], np.int64)
    pieces = -(-size // CHUNK)
    owner = np.repeat(np.arange(len(docs)), pieces)
    if not len(owner):
        return out
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
    start = begin[owner] + (np.arange(len(owner)) - first[owner]) * CHUNK
    end = np.minimum(start + CHUNK, (begin + size)[owner])
    buffer = np.frombuffer(b"".join(docs), np.uint8).astype(np.int32)
    order = np.argsort(start - end, kind="stable")  # full chunks first, so active ones stay a prefix
    start, end, owner = start[order], end[order], owner[order]
    low = begin[owner]
    state = np.zeros(len(owner), np.int32)
    bits = np.zeros((len(owner), len(model.langs)))
    for back in range(MAX_ORDER, 0, -1):
        at = start - back
        inside = at >= low
        moved = model.step[(state << 8) + buffer[np.maximum(at, 0)]]
        state = np.where(inside, moved, 0).astype(np.int32)
    length = end - start
    for t in range(CHUNK):
        active = int(np.searchsorted(-length, -t, side="left"))  # chunks longer than t
        if not active:
            break
        cell = (state[:active] << 8) + buffer[start[:active] + t]
        bits[:active] += model.cost[cell]
        state[:active] = model.step[cell]
    for j in range(bits.shape[1]):
        out[:, j] = np.bincount(owner, bits[:, j], minlength=len(docs))
    return out


def decide(model: Model | None, docs: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits per byte of each text."""
    und = np.array([d is None or not _LETTER.search(d.decode("utf-8", "replace")) for d in docs], bool)
    names = [UNDETERMINED] * len(docs)
    score, rate = np.zeros(len(docs)), np.zeros(len(docs))
    live = np.flatnonzero(~und)
    if model is None or not len(live):
        return names, score, rate
    bits = code_lengths(model, [docs[i] for i in live])
    best = bits.argmin(1)  # the first of equal languages, in their sorted order
    gain = np.exp2(-np.minimum(bits - bits.min(1, keepdims=True), 1000.0))
    score[live] = 1.0 / gain.sum(1)
    rate[live] = bits.min(1) / np.array([len(docs[i]) for i in live])
    for i, j in zip(live, best):
        names[i] = model.langs[j]
    return names, score, rate


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> tuple[DataFrame, list[str]]:
    """docs with three more columns, whose names are returned: the language
    (`und` for a null text, one without a letter, or without a model), its
    posterior probability among the learned languages (0 for `und`), and the
    code length in bits per byte.

    Every row of docs gives one row and keeps its other columns. Repeated rows
    repeat; of languages with equal code lengths the alphabetically first wins.
    """
    names = fresh(docs, "lang_pred", "score", "bits_per_byte")
    shared = docs.sparkSession.sparkContext.broadcast(model and vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = Model(**shared.value) if shared.value else None
        for whole in batches:
            for part in slices(whole, text):
                langs, score, rate = decide(learned, texts(part, text))
                columns = [*part.columns, pa.array(langs, pa.string()), pa.array(score), pa.array(rate)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *names])

    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(names[0], T.StringType()),
            T.StructField(names[1], T.DoubleType()),
            T.StructField(names[2], T.DoubleType()),
        ]
    )
    return docs.mapInArrow(run, schema), names


def _length_class(text: str) -> Column:
    return F.floor(F.log2(F.greatest(F.octet_length(text), F.lit(1)).cast("double"))).cast("int")


def limits(docs: DataFrame, model: Model | None) -> dict[str, list[float]]:
    """For each language the bits per byte above which a text is in none, by
    length class (the binary logarithm of its bytes). They follow from the
    held-out documents of docs (doc_id, text, lang) that the model finds to be
    what their label says. A short text varies more, so a class counts all
    documents from the class below it up; where these are fewer than
    LEAST_HELD_OUT there is no limit."""
    held = docs.where(held_out() & F.col("lang").isNotNull()).select("text", "lang")
    rows, (lang, _, rate) = identify(held, model)
    worst = (
        rows.where(F.col(lang) == F.col("lang"))
        .groupBy(F.col("lang"), _length_class("text").alias("size"))
        .agg(F.count("*").alias("n"), F.max(rate).alias("worst"))
        .collect()
    )
    out = {}
    for name in {r["lang"] for r in worst}:
        own = {r["size"]: r for r in worst if r["lang"] == name}
        out[name] = []
        for size in range(32):
            at_least = [own[k] for k in own if k >= min(size - 1, max(own))]
            enough = sum(r["n"] for r in at_least) >= LEAST_HELD_OUT
            out[name].append(FAR * max(r["worst"] for r in at_least) if enough else math.inf)
        for size in range(1, 32):  # longer than enough of them: the last limit that there is
            if out[name][size] == math.inf:
                out[name][size] = out[name][size - 1]
    return out


def is_foreign(limit: dict[str, list[float]], lang: str, rate: str, text: str = "text") -> Column:
    """Whether a row of `identify` is in none of the languages, by `limits`."""
    if not limit:
        return F.lit(False)
    by_lang = F.create_map(*(c for k, v in sorted(limit.items()) for c in (F.lit(k), F.array(*map(F.lit, v)))))
    at = F.least(_length_class(text), F.lit(31)) + 1
    return F.coalesce(F.col(rate) > F.try_element_at(by_lang[F.col(lang)], at), F.lit(False))
