"""Streaming recommender: rating messages -> per-user recommendation lists.

    readStream (messages 'userId|productId|score|timestamp' + an ordering id)
      -> parse (bad messages go to a side table, by a query of their own)
      -> transformWithState by user: the newest ratings (ListState, the queue of
         the server) and the products rated (MapState), in RocksDB
      -> foreachBatch, for the users that the batch touched:
           1. their queue and rated products come out of the state; no history
              is kept or read
           2. score their latest events against the similarity table, of which
              only the buckets of the products in question are read
           3. replace their lists in the recs table, rewriting the user buckets
              that the batch touched (`PartitionedTable`)

State and offsets are versions of one checkpoint: a batch that is replayed after
a failure meets the state that it met before and gives the same lists, and the
table applies it once. The queue is ordered by (timestamp, event id) and the
rated set only grows, so the final table does not depend on how events are cut
into batches.

The similarity table is re-read in every batch, so a refreshed table is seen
without restarting the query.
"""

from __future__ import annotations

import heapq
import os
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shelfrank.operators import scoring, state
from shelfrank.operators.state import QUEUE_CAPACITY, RECENT_RATINGS
from shelfrank.schemas import RANKED_SIMS, USER_RECS
from shelfrank.sources.partitioned import PartitionedTable
from shelfrank.sources.tables import bucket
from shelfrank.sources.text import log_lines_to_messages, parse_event_messages

# The state processor runs in Python workers without this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the reference's micro-batch interval.
BATCH_INTERVAL = "5 seconds"

# Folders of the recs table. A batch rewrites those of the users it touched: with
# U users, n folders and T users touched, min(T, n) folders of U / n lists. Size
# it to the user base; the default suits small deployments and tests.
USER_BUCKETS = 8
# Folders of the similarity table (`tables.write_buckets` on productId).
SIM_BUCKETS = 32

MESSAGE_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("value", T.StringType())]
)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ENTRY = "timestamp long, event_id long, productId int, score double"
#: What the state gives for a touched user: queue rows (rank from 1, newest
#: first), then a row of rank 0 for each product rated.
_TOUCHED = "userId int, rank int, productId int, score double"
#: Rated products handed over at a time.
_PAGE = 10_000


def kafka_messages(records: DataFrame) -> DataFrame:
    """(event_id, value) of Kafka records. A partition's order is its offsets;
    record times need not rise. So the ordering id is the offset with the
    partition above it: ids rise within a partition and no two are equal, for
    fewer than 2^44 records a partition and 2^19 partitions."""
    number = F.col("partition").cast("long") * F.lit(1 << 44) + F.col("offset")
    return records.select(number.alias("event_id"), F.col("value").cast("string").alias("value"))


def kafka_options(topic: str, options: dict | None = None) -> dict:
    """Reader options for one topic; new queries start at the latest offsets."""
    return {"startingOffsets": "latest", **(options or {}), "subscribe": topic}


class RatingState(StatefulProcessor):
    """A user's queue of newest ratings and the products they rated."""

    def __init__(self, capacity: int, n_recent: int):
        self.capacity, self.n_recent = capacity, n_recent

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.queue = handle.getListState("queue", _ENTRY)
        self.rated = handle.getMapState("rated", "productId int", "known boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Push the user's new ratings; give the queue and the rated products.
        However many ratings come, `capacity` of them are held here."""
        newest = [tuple(e) for e in self.queue.get()]
        for frame in rows:
            entries = zip(*(frame[c].tolist() for c in ("timestamp", "event_id", "productId", "score")))
            # The order of state.newest_first.
            newest = heapq.nlargest(self.capacity, [*newest, *entries], key=lambda e: e[:2])
            for product in frame["productId"].unique().tolist():
                if not self.rated.containsKey((product,)):
                    self.rated.updateValue((product,), (True,))
        self.queue.put(newest)
        user = key[0]
        recent = newest[: max(1, self.n_recent)]
        yield self._frame(user, range(1, len(recent) + 1), [e[2] for e in recent], [e[3] for e in recent])
        page = []
        for (product,) in self.rated.keys():
            page.append(product)
            if len(page) == _PAGE:
                yield self._frame(user, [0] * len(page), page, [0.0] * len(page))
                page = []
        if page:
            yield self._frame(user, [0] * len(page), page, [0.0] * len(page))

    @staticmethod
    def _frame(user, ranks, products, scores) -> pd.DataFrame:
        return pd.DataFrame({"userId": [user] * len(products), "rank": list(ranks), "productId": products, "score": scores})

    def close(self) -> None:
        pass


class StreamingRecommender:
    def __init__(
        self,
        spark: SparkSession,
        state_dir: str,
        sims_path: str,
        k: int = scoring.MAX_SIM_PRODUCTS,
        n_recent: int = RECENT_RATINGS,
        threshold: float = scoring.SCORE_THRESHOLD,
        user_buckets: int = USER_BUCKETS,
        sim_buckets: int = SIM_BUCKETS,
        capacity: int = QUEUE_CAPACITY,
    ):
        if n_recent > capacity:
            raise ValueError(f"the queue holds {capacity} ratings, {n_recent} are asked for")
        self.spark = spark
        self.sim_buckets = sim_buckets
        self.state_dir = state_dir
        self.sims_path = sims_path
        self.k, self.n_recent, self.threshold, self.capacity = k, n_recent, threshold, capacity
        self.rejected_dir = os.path.join(state_dir, "rejected")
        self.checkpoint_dir = os.path.join(state_dir, "checkpoint")
        self.recs = PartitionedTable(
            spark, os.path.join(state_dir, "recs"), USER_RECS, "ub", T.IntegerType(), bucket("userId", user_buckets)
        )

    # ------------------------------------------------------------- batch step

    def process_batch(self, touched: DataFrame, batch_id: int) -> None:
        """Score the users of one batch of state rows and replace their lists."""
        touched = touched.persist()
        try:
            latest = touched.where("rank = 1").select("userId", "productId")
            recent = touched.where("rank > 0")
            rated = touched.where("rank = 0").select("userId", "productId")
            sims = self._sims(touched.sparkSession)
            cands = scoring.candidates(latest, self._slice(sims, latest), rated, self.k).persist()
            try:
                scored = scoring.score_candidates(cands, recent, self._slice(sims, cands), self.threshold)
                self.recs.update(scoring.lists(latest, scored), state.replace_by_key, f"batch-{batch_id}")
            finally:
                cands.unpersist()
        finally:
            touched.unpersist()

    def _sims(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(RANKED_SIMS).parquet(self.sims_path)

    def _slice(self, sims: DataFrame, keys: DataFrame) -> DataFrame:
        """The folders of the similarity table that hold the products of `keys`:
        at most `sim_buckets` numbers are collected."""
        found = keys.select(bucket("productId", self.sim_buckets).alias("pb")).distinct().collect()
        return sims.where(F.col("pb").isin([r["pb"] for r in found])).drop("pb")

    # ------------------------------------------------------------------ query

    def messages(
        self,
        source: str,
        source_format: str = "parquet",
        options: dict | None = None,
        max_files_per_trigger: int | None = None,
        log_lines: bool = False,
    ) -> DataFrame:
        """The message stream: (event_id, value).

        File formats (parquet, json, orc) read (event_id, value) records from
        the folder `source`. With source_format="kafka", `source` is the topic
        and `options` carry the Kafka settings (kafka.bootstrap.servers, ...);
        see `kafka_messages` for the order. It needs the Kafka connector on the
        classpath. log_lines=True takes server log lines and strips the rating
        prefix.
        """
        opts = dict(options or {})
        if source_format == "kafka":
            msgs = kafka_messages(self.spark.readStream.format("kafka").options(**kafka_options(source, opts)).load())
        else:
            reader = self.spark.readStream.schema(MESSAGE_SCHEMA).options(**opts)
            if max_files_per_trigger:
                reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
            msgs = reader.format(source_format).load(source)
        return log_lines_to_messages(msgs) if log_lines else msgs

    def touched_users(self, messages: DataFrame) -> DataFrame:
        """Queue and rated products of the users that messages touch, by state."""
        good, _ = parse_event_messages(messages)
        events = good.select("userId", "productId", "score", "timestamp", "event_id")
        processor = RatingState(self.capacity, self.n_recent)
        return events.groupBy("userId").transformWithStateInPandas(processor, _TOUCHED, "Update", "None")

    def start(
        self,
        source: str,
        available_now: bool = False,
        max_files_per_trigger: int | None = None,
        source_format: str = "parquet",
        options: dict | None = None,
        log_lines: bool = False,
    ) -> tuple[StreamingQuery, StreamingQuery]:
        """Start scoring, and the side table of rejected messages: two queries."""
        messages = self.messages(source, source_format, options, max_files_per_trigger, log_lines)
        when = {"availableNow": True} if available_now else {"processingTime": BATCH_INTERVAL}
        _, bad = parse_event_messages(messages)
        conf, before = self.spark.conf, self.spark.conf.get(_PROVIDER)
        conf.set(_PROVIDER, _ROCKSDB)  # a query keeps the settings that it starts with
        try:
            scored = (
                self.touched_users(messages)
                .writeStream.outputMode("update")
                .foreachBatch(self.process_batch)
                .option("checkpointLocation", self.checkpoint_dir)
                .trigger(**when)
                .start()
            )
        finally:
            conf.set(_PROVIDER, before)
        rejected = (
            bad.writeStream.format("parquet")
            .option("checkpointLocation", f"{self.checkpoint_dir}-rejected")
            .trigger(**when)
            .start(self.rejected_dir)
        )
        return scored, rejected

    def run_available(self, source: str, max_files_per_trigger: int | None = None, **kwargs) -> None:
        """Process everything available now in micro-batches, then stop."""
        for query in self.start(source, available_now=True, max_files_per_trigger=max_files_per_trigger, **kwargs):
            query.awaitTermination()
            if query.exception() is not None:
                raise RuntimeError(str(query.exception()))

    def current_recs(self) -> DataFrame:
        """Each user's list from the latest batch that touched them."""
        return self.recs.read()
