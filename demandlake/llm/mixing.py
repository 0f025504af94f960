"""Mixing sources to target weights by subset-sum budget fitting.

Per source the mix takes as many whole passes as the target holds; what is
left is a word budget.  It is fitted on the counts of documents by exact
length: an equal share of every length first, then single steps from long
lengths, and a bounded-knapsack dynamic programme over the remaining words.
The fit says how many documents of each length to take; which ones is
decided by a seeded hash.  Ranks are found bucket by bucket, so a length
that a third of all rows share is never sorted in one task.

Defined results: null text has size 0 and is taken 0 words; null is a
source of its own, weighed last; a source without words has target 0; rows
repeated under one doc_id are separate rows of equal rank order; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.tables import keep, located, n_words, text_or_empty

WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.0
MAX_REPEATS = 3
SEED = 17
#: Words that the dynamic programme handles; beyond, whole documents are stepped first.
DP_WORDS = 1 << 16
BUCKETS = 256


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights by
    code-point order, null last; caps of MAX_REPEATS times the size with the
    excess reshared by weight, solved by its water level: sources in order of
    cap per weight stop one after another."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = sizes.withColumn("pos", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (F.col("pos") % len(WEIGHTS) + 1).cast("int"))
    w = w.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(MAX_REPEATS)))
    w = w.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", "pos")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") * BUDGET_SHARE - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    w = w.withColumn("total", F.sum("source_size").over(Window.partitionBy()).cast("double")).withColumn("level", level)
    w = w.withColumn("water", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(Window.partitionBy())["level"])
    return w.select("source", "source_size", F.least("cap", F.col("water") * F.col("weight")).alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as
    near to ``budget`` as the steps allow, never above it."""
    lengths, counts = lengths.astype(object), counts.astype(object)
    size = int((lengths * counts).sum())
    if budget >= size:
        return counts.astype(np.int64)
    take = np.array([int(n) * int(budget) // size for n in counts], dtype=object)
    rest = int(budget) - int((lengths * take).sum())
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if rest <= DP_WORDS:
            break
        step = min(counts[i] - take[i], (rest - DP_WORDS) // lengths[i] + 1, rest // lengths[i])
        take[i] += step
        rest -= step * lengths[i]
    cap = min(rest, DP_WORDS)
    pieces = []  # bounded counts in powers of two
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n, p = min(int(counts[i] - take[i]), cap // int(lengths[i])), 1
        while n > 0:
            q = min(p, n)
            pieces.append((i, q, q * int(lengths[i])))
            n -= q
            p *= 2
    reach = np.zeros(cap + 1, bool)
    reach[0] = True
    by = np.full(cap + 1, -1, np.int64)  # the piece that first reached a sum
    for k, (_, _, w) in enumerate(pieces):
        if w > cap:
            continue
        new = np.flatnonzero(reach[: cap + 1 - w] & ~reach[w:]) + w
        reach[new] = True
        by[new] = k
        if reach[cap]:
            break
    at = int(np.flatnonzero(reach)[-1])
    while at:
        i, q, w = pieces[by[at]]
        take[i] += q
        at -= w
    return take.astype(np.int64)


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    """(source, size, n, source_size, target) of one source, a row per length."""
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    words = int(round(target))
    whole = min(MAX_REPEATS, words // size) if size else 0
    budget = words - whole * size if whole < MAX_REPEATS else 0
    extra = fit_budget(pdf["size"].to_numpy(), pdf["n"].to_numpy(), budget) if budget > 0 else np.zeros(len(pdf), np.int64)
    return pd.DataFrame({"src": pdf["src"], "size": pdf["size"], "whole": np.int64(whole), "extra": extra})


def _bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` with src (the source, null or not), the hash h and its bucket."""
    rows = rows.withColumn("src", F.struct(F.col("source").isNotNull().alias("known"), F.coalesce("source", F.lit("")).alias("name")))
    return rows.withColumn("h", F.xxhash64(F.lit(SEED), "doc_id")).withColumn("bucket", F.pmod(F.shiftright("h", 32), F.lit(BUCKETS)))


def _cuts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For bucketed rows: (src, size, bucket, whole, room, in_bucket), where a
    row is taken ``whole`` times, and once more if it is among the first
    ``room`` of its bucket; and (src, source_size, target)."""
    per_bucket = rows.groupBy("src", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    per_length = per_bucket.groupBy("src", "size").agg(F.sum("n").alias("n"))
    src = per_length.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = targets(src.select("src", F.when(F.col("src.known"), F.col("src.name")).alias("source"), "source_size"))
    goal = goal.select(
        F.struct(F.col("source").isNotNull().alias("known"), F.coalesce("source", F.lit("")).alias("name")).alias("src"), "source_size", "target"
    )
    fitted = per_length.where("size > 0").join(goal, "src").groupBy("src").applyInPandas(
        _fit_source, "src struct<known: boolean, name: string>, size long, whole long, extra long"
    )
    ahead = Window.partitionBy("src", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = per_bucket.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).join(fitted, ["src", "size"])
    cut = cut.select("src", "size", "bucket", "whole", (F.col("extra") - F.col("ahead")).alias("room"), F.col("n").alias("in_bucket"))
    return cut, goal


def mix_rows(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, source, size, ...)`` (written, hence stable) with
    source_size, target and ``times``, how often the mix takes the row."""
    rows = _bucketed(rows)
    cut, goal = _cuts(rows)
    joined = rows.join(cut, ["src", "size", "bucket"], "left")
    inside = Window.partitionBy("src", "size", "bucket").orderBy("h", "doc_id")
    rank = F.row_number().over(inside)
    times = F.coalesce(F.col("whole"), F.lit(0)) + F.when(rank <= F.col("room"), 1).otherwise(0)
    return joined.withColumn("times", times.cast("long")).join(goal, "src").drop("src", "h", "bucket", "whole", "room", "in_bucket")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    rows = keep(docs.select("doc_id", "source", n_words(text_or_empty()).alias("size")), "mix-sizes")
    return mix_rows(rows).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with their own columns, repeated as taken.

    How often a row is taken follows from its source, size and bucket, but for
    the buckets that a cut goes through.  So a row per source and size is sent
    to the texts, with the locators of the rows taken in cut buckets; the texts
    themselves stay where they are."""
    names = docs.columns
    held = located(docs, "mix-input")
    key = lambda c: F.col(f"c{names.index(c)}")
    size = n_words(F.coalesce(key("text").cast("string"), F.lit(""))).alias("size")
    sized = _bucketed(keep(held.select(key("doc_id").alias("doc_id"), key("source").alias("source"), size, "row"), "mix-sizes"))
    cut = keep(_cuts(sized)[0], "mix-cuts")
    upto = F.max(F.when(F.col("room") >= F.col("in_bucket"), F.col("bucket")))  # buckets taken once more as a whole come first
    lengths = keep(cut.groupBy("src", "size").agg(F.max("whole").alias("whole"), F.coalesce(upto, F.lit(-1)).alias("upto")), "mix-lengths")
    through = sized.join(cut.where("room > 0 AND room < in_bucket"), ["src", "size", "bucket"])
    rank = F.row_number().over(Window.partitionBy("src", "size", "bucket").orderBy("h", "doc_id"))
    more = keep(through.withColumn("rank", rank).where("rank <= room").select("row", F.lit(1).alias("more")), "mix-more")
    own = _bucketed(held.select(*held.columns, key("doc_id").alias("doc_id"), key("source").alias("source"), size))
    own = own.join(lengths, ["src", "size"]).join(more, "row", "left")
    times = F.col("whole") + F.when(F.col("bucket") <= F.col("upto"), 1).otherwise(0) + F.coalesce("more", F.lit(0))
    out = own.withColumn("times", times.cast("int")).where("times > 0").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
