import os

import pytest
from conftest import SF_SMALL, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfrank.operators import scoring, similarity, topk
from shelfrank.session import scratch_path
from shelfrank.sources import adapters, tables
from shelfrank.streaming.recommender import SIM_BUCKETS, StreamingRecommender, kafka_messages, kafka_options

THRESHOLD = 0.2


@pytest.fixture(scope="module")
def setup(spark):
    sims = similarity.cosine_similarity(adapters.factors(spark, SF_SMALL), THRESHOLD)
    base = scratch_path(spark, "stream-test")
    tables.write_buckets(similarity.rank_similar(sims), f"{base}/sims", "productId", SIM_BUCKETS)
    expected = rows(topk.unnest(scoring.stream_recs(adapters.rating_events(spark, SF_SMALL), sims, threshold=THRESHOLD), "userId", outer=True))
    return base, expected


def _rounded(got):
    return [(u, r, p, round(s, 9) if s is not None else None) for u, r, p, s in got]


def _lists(rec):
    return _rounded(rows(topk.unnest(rec.current_recs(), "userId", outer=True)))


def _source(spark, path, files, messages=None):
    messages = messages if messages is not None else adapters.event_messages(spark, SF_SMALL)
    messages.repartitionByRange(files, "event_id").write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("files", [1, 3])
def test_stream_equals_batch(spark, setup, files):
    base, expected = setup
    rec = StreamingRecommender(spark, f"{base}/state-{files}", f"{base}/sims", threshold=THRESHOLD)
    rec.run_available(_source(spark, f"{base}/src-{files}", files), max_files_per_trigger=1)
    assert _lists(rec) == _rounded(expected)


def test_events_in_any_order(spark, setup):
    """Late events, in other batches than their neighbours in time, end in the same lists."""
    base, expected = setup
    messages = adapters.event_messages(spark, SF_SMALL)
    src = f"{base}/src-late"
    for part in range(3):
        messages.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(src)
    rec = StreamingRecommender(spark, f"{base}/state-late", f"{base}/sims", threshold=THRESHOLD)
    rec.run_available(src, max_files_per_trigger=1)
    assert _lists(rec) == _rounded(expected)


def test_restart_goes_on_from_state(spark, setup):
    """A new process meets the state of the one before; no history is kept."""
    base, expected = setup
    messages = adapters.event_messages(spark, SF_SMALL)
    cut = messages.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    src, state_dir = f"{base}/src-restart", f"{base}/state-restart"
    for part in (F.col("event_id") <= cut, F.col("event_id") > cut):
        _source(spark, src, 2, messages.where(part))
        StreamingRecommender(spark, state_dir, f"{base}/sims", threshold=THRESHOLD).run_available(src)
    rec = StreamingRecommender(spark, state_dir, f"{base}/sims", threshold=THRESHOLD)
    assert _lists(rec) == _rounded(expected)
    here = state_dir.removeprefix("file:")
    assert sorted(os.listdir(here)) == ["checkpoint", "checkpoint-rejected", "recs", "recs__redo", "rejected"]


@pytest.mark.parametrize("when", ["before", "between", "after"])
def test_replay_after_a_failure(spark, setup, monkeypatch, when):
    """A batch that fails before, in the middle of or after its write to the recs
    table is replayed, and applied once."""
    base, expected = setup
    src = _source(spark, f"{base}/src-replay-{when}", 3)
    rec = StreamingRecommender(spark, f"{base}/state-replay-{when}", f"{base}/sims", threshold=THRESHOLD)
    update = type(rec.recs).update

    def broken(table, changes, merge, token):
        if token == "batch-1":
            if when == "after":
                update(table, changes, merge, token)
            if when == "between":
                # What will be written is there; half of the folders were not reached.
                dealt = table._dealt(merge(table.read(table.touched(changes)), changes).withColumn("_token", F.lit(token)), "_token")
                dealt.write.mode("overwrite").partitionBy("_token", table.part).parquet(table.redo)
                table._dealt(dealt.drop(table.part, "_token").where("userId < 0")).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic"
                ).partitionBy(table.part).parquet(table.path)
            raise RuntimeError("lost")
        update(table, changes, merge, token)

    monkeypatch.setattr(type(rec.recs), "update", broken)
    with pytest.raises(Exception, match="lost"):
        rec.run_available(src, max_files_per_trigger=1)
    monkeypatch.undo()
    rec = StreamingRecommender(spark, f"{base}/state-replay-{when}", f"{base}/sims", threshold=THRESHOLD)
    rec.run_available(src, max_files_per_trigger=1)
    assert _lists(rec) == _rounded(expected)


def test_queue_keeps_the_newest(spark, setup):
    """More ratings than the queue holds, repeated products among them, over batches."""
    base, _ = setup
    sims = spark.createDataFrame([(p, q, 0.9, 1 + (q > p)) for p in range(4) for q in range(4) if p != q], "productId int, simId int, sim double, rank int")
    sims_path = f"{base}/sims-small"
    tables.write_buckets(sims, sims_path, "productId", 2)
    events = [(i, f"7|{i % 3}|{float(i % 5)}|{1000 + i // 2}") for i in range(60)]
    src = f"{base}/src-queue"
    for i in range(3):
        part = spark.createDataFrame(events[i::3], "event_id long, value string").coalesce(1)
        part.write.mode("append").parquet(src)
    rec = StreamingRecommender(spark, f"{base}/state-queue", sims_path, sim_buckets=2, capacity=5, n_recent=5)
    rec.run_available(src, max_files_per_trigger=1)
    history = spark.createDataFrame([(i, *v.split("|")) for i, v in events], "event_id long, u string, p string, s string, t string").selectExpr(
        "event_id", "int(u) userId", "int(p) productId", "double(s) score", "bigint(t) timestamp"
    )
    want = topk.unnest(scoring.stream_recs(history, sims, n_recent=5), "userId", outer=True)
    assert _lists(rec) == _rounded(rows(want))


def test_bad_messages_go_to_the_side_table(spark, setup):
    base, expected = setup
    src = f"{base}/src-bad"
    spark.createDataFrame([(1, "x|y"), (2, None), (3, "")], "event_id long, value string").coalesce(1).write.parquet(src)
    rec = StreamingRecommender(spark, f"{base}/state-bad", f"{base}/sims", threshold=THRESHOLD)
    rec.run_available(src)
    assert rec.current_recs().count() == 0
    _source(spark, src, 1)
    rec.run_available(src)
    assert _lists(rec) == _rounded(expected)
    assert spark.read.parquet(rec.rejected_dir).count() == 3


def test_sims_are_read_by_bucket(spark, setup):
    base, _ = setup
    rec = StreamingRecommender(spark, f"{base}/state-plan", f"{base}/sims")
    keys = spark.createDataFrame([(3,)], "productId int")
    sliced = rec._slice(rec._sims(spark), keys)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [pb" in plan or "PartitionFilters: [isnotnull(pb" in plan
    assert rows(sliced.where("productId = 3")) == rows(rec._sims(spark).where("productId = 3").drop("pb"))


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 2**43)), min_size=1, max_size=30, unique=True))
@settings(max_examples=8, deadline=None)
def test_kafka_ids_rise_within_a_partition(spark, offsets):
    """Whatever the record times are."""
    data = [(p, o, (o * 7919) % 5000, f"{p}:{o}") for p, o in offsets]
    records = spark.createDataFrame(data, "partition int, offset long, ms long, value string").select(
        "partition", "offset", F.timestamp_millis("ms").alias("timestamp"), F.encode("value", "utf-8").alias("value")
    )
    got = kafka_messages(records).orderBy("event_id").collect()
    assert [r.value for r in got] == [f"{p}:{o}" for p, o in sorted(offsets)]
    assert len({r.event_id for r in got}) == len(offsets)


def test_kafka_options():
    options = kafka_options("ratings", {"kafka.bootstrap.servers": "h:1", "startingOffsets": "earliest"})
    assert options == {"subscribe": "ratings", "kafka.bootstrap.servers": "h:1", "startingOffsets": "earliest"}


def test_stream_from_log_lines(spark, setup):
    base, expected = setup
    src = f"{base}/src-logs"
    adapters.log_lines(spark, SF_SMALL).repartitionByRange(2, "event_id").write.json(src)
    rec = StreamingRecommender(spark, f"{base}/state-logs", f"{base}/sims", threshold=THRESHOLD)
    rec.run_available(src, max_files_per_trigger=1, source_format="json", log_lines=True)
    got = rows(topk.unnest(rec.current_recs(), "userId", outer=True))
    assert [(u, r, p, round(s, 9) if s is not None else None) for u, r, p, s in got] == [
        (u, r, p, round(s, 9) if s is not None else None) for u, r, p, s in expected
    ]
