"""Best-fit packing with conflicts.

Documents fill bins of CAPACITY words.  A bin never holds two documents of
one duplicate cluster (texts equal after lower-casing and joining words by
one space), nor more than PER_SOURCE of one source.  Bins are kept ordered
by residual capacity, each with bitmaps of its sources and clusters; a
document, longest first, goes to the successor of its length, and the search
walks on until the tightest bin without a conflict is found; otherwise a
bin is opened.

Documents longer than a bin are cut into full bins and one rest, so every
word is packed.  Spark deals the pieces to shards of about SHARD_PIECES by a
hash of the row, which also spreads sources and copies; a bin never spans
shards, so no conflict can.

Defined results: a null or empty text is one piece of 0 words; null is a
source of its own; repeated rows are copies, hence in different bins; an
empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm import textops as T
from demandlake.llm.tables import keep

CAPACITY = 2048
PER_SOURCE = 2
SHARD_PIECES = 8192
SEED = 11
#: Bytes of text handled at once.
CHUNK = 512 << 10


def _measure(batches):
    """(words, 64-bit cluster) of each text."""
    for rows, data, off in T.chunks(batches, limit=CHUNK):
        data = T.LOWER[data]
        start, end, woff = T.words(data, off)
        wh = T.span_hash(T.prefix_hash(data), start, end)
        place = np.arange(len(wh)) - np.repeat(woff[:-1], np.diff(woff))
        cluster = T.totals(T.mix(wh + T.mix(place.astype(np.uint64))), woff).view(np.int64)
        yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(np.diff(woff).astype(np.int64)), pa.array(cluster)], ["row", "size", "cluster"])


class Bins:
    """Bins ordered by residual; ``place`` finds the tightest compatible one."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # (residual, bin), ascending
        self.clusters: list[int] = []  # bitmap per bin
        self.sources: list[list[int]] = []  # per bin, bitmap of sources seen 1, 2, ... times
        self.fill: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset).  ``source`` and ``cluster`` are one-bit masks; a
        cluster of 0 conflicts with nothing."""
        at = bisect.bisect_left(self.order, (size, -1))
        while at < len(self.order):
            b = self.order[at][1]
            if not (self.clusters[b] & cluster or self.sources[b][-1] & source):
                break
            at += 1
        else:
            b = len(self.fill)
            self.fill.append(0)
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
            bisect.insort(self.order, (self.capacity, b))
            at = bisect.bisect_left(self.order, (self.capacity, b))
        residual, _ = self.order.pop(at)
        offset = self.fill[b]
        self.fill[b] += size
        self.clusters[b] |= cluster
        seen = self.sources[b]
        for k in range(self.per_source - 1, 0, -1):
            seen[k] |= seen[k - 1] & source
        seen[0] |= source
        bisect.insort(self.order, (residual - size, b))
        return b, offset


def _pack_shard(capacity: int, per_source: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "row", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        source = pd.factorize(pdf["source"], use_na_sentinel=False)[0]
        cluster = pd.factorize(pdf["cluster"])[0]
        several = np.bincount(cluster, minlength=1)[cluster] > 1
        bit: dict[int, int] = {}  # only clusters with several pieces here need a bit
        bins = Bins(capacity, per_source)
        got = []
        for size, s, c, many in zip(pdf["size"], source, cluster, several, strict=True):
            mask = 1 << bit.setdefault(int(c), len(bit)) if many else 0
            got.append(bins.place(int(size), 1 << int(s), mask))
        out = pdf[["row", "piece", "start", "size", "shard"]].copy()
        out["bin"] = [b for b, _ in got]
        out["offset"] = [o for _, o in got]
        out["bin_fill"] = [bins.fill[b] for b, _ in got]
        return out

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """doc_id, piece, start_word, n_words, bin_id, bin_offset, bin_fill: a row
    per piece; bin_id is ``shard:bin``, a full piece has a bin of its own."""
    named = docs.select("doc_id", "source", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    sized = named.select("row", "text").mapInArrow(_measure, "row long, size long, cluster long")
    # the names come from the same rows: one join on the row number, both sides small
    rows = keep(sized.join(named.select("row", "doc_id", "source"), "row"), "pack-sizes")
    total = rows.count()
    shards = max(1, math.ceil(total / shard_pieces))
    full = F.when(F.col("size") > capacity, F.floor(F.col("size") / capacity)).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("full", full).withColumn("rest", F.col("size") - F.col("full") * capacity)
    wholes = rows.where("full > 0").select("doc_id", "row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("piece"))
    wholes = wholes.select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("start_word"), F.lit(capacity).cast("long").alias("n_words"),
        F.concat(F.lit("w:"), F.col("row").cast("string"), F.lit(":"), F.col("piece").cast("string")).alias("bin_id"),
        F.lit(0).cast("long").alias("bin_offset"), F.lit(capacity).cast("long").alias("bin_fill"),
    )
    rest = rows.where("full = 0 OR rest > 0").select(
        "row", F.col("full").alias("piece"), (F.col("full") * capacity).alias("start"), F.col("rest").alias("size"), "source", "cluster",
        F.pmod(F.xxhash64(F.lit(SEED), "row"), F.lit(shards)).alias("shard"),
    )
    packed = rest.groupBy("shard").applyInPandas(
        _pack_shard(capacity, per_source), "row long, piece long, start long, size long, shard long, bin long, offset long, bin_fill long"
    )
    packed = packed.join(rows.select("row", "doc_id"), "row").select(
        "doc_id", "piece", F.col("start").alias("start_word"), F.col("size").alias("n_words"),
        F.concat(F.col("shard").cast("string"), F.lit(":"), F.col("bin").cast("string")).alias("bin_id"), F.col("offset").alias("bin_offset"), "bin_fill",
    )
    return packed.unionByName(wholes)
