"""Documents dealt to partitions by ranges of doc_id, for work in id order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import ship

ship(__name__)

#: Null ids count as the smallest.
NULL_ID = int(np.iinfo(np.int64).min)


def bounds(docs: DataFrame, parts: int) -> list[int]:
    """At most parts - 1 ascending ids that cut the documents into ranges of
    about equal number; only the ids are read."""
    if parts < 2:
        return []
    cuts = F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * parts)
    return sorted(set(docs.agg(cuts.alias("c")).first()["c"] or []))


def part_of(doc_id: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """Number of the range that holds each id."""
    known = doc_id.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
    return np.searchsorted(cuts, known, side="right").astype(np.int32)


def default_parts(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
