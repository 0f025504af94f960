"""A bagged regression forest whose model does not depend on the layout.

The forest is a function of its rows, the seed and the settings: neither the
number of partitions nor the order of rows or tasks enters it.

* Resampling: a row's weight in a tree is a Poisson(1) draw from a Murmur3
  hash of (row key, seed, tree).  Rows with equal keys get equal weights.
* Candidate cuts: left edges of occupied cells of a fine equal-width grid, one
  per reached quantile class, from exact counts (at most ``max_bins - 1`` a
  feature).
* Growth: all trees grow one level a pass.  Each task adds up weights and
  weighted labels by (tree, node, feature, bin) over its rows, batch by batch;
  Spark sums the tasks' arrays by (tree, node), where the best cut is found,
  and only the cuts come back to the driver (at most ``num_trees`` *
  2^level rows).  Sums of whole labels are exact, so any order gives the same
  numbers; equal gains go to the first feature and the lowest cut.

The forest is a table of nodes (tree, node, feature, cut, left, right, value,
weight), node 1 the root, ``left`` = 2 * node, ``right`` = 2 * node + 1; a row
goes right if its value is at least the cut.  It is saved, loaded and scored
as that table, whose size is bounded by the settings.

The binned training rows (one byte a feature) are written once to the shared
folder; every pass scans that table, so a lost executor costs re-reading.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.sources import io, storage
from demandlake.sources.shipping import ship

#: Cells of the fine grid from which the candidate cuts are taken.
GRID = 4096
#: A cut must gain more than this share of the node's own term.
LEAST_GAIN = 1e-9
#: Bytes of sums that a task holds in one pass; deeper levels take the trees in groups.
PASS_BYTES = 96 << 20
#: Rows that a task adds up at once (small enough for a core's cache, enough to outweigh the sums' own size).
CHUNK = 1 << 16
#: Levels at the top of a tree that are walked by comparing whole columns.
TOP = 4

NODES = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.LongType()), T.StructField("feature", T.StringType()),
    T.StructField("cut", T.DoubleType()), T.StructField("left", T.LongType()), T.StructField("right", T.LongType()),
    T.StructField("value", T.DoubleType()), T.StructField("weight", T.DoubleType()),
])


@dataclass(frozen=True)
class Settings:
    num_trees: int = 100
    max_depth: int = 10
    seed: int = 42
    max_bins: int = 32
    bootstrap: bool = True


def poisson_steps() -> list[int]:
    """32-bit thresholds of the Poisson(1) distribution function: a draw's
    weight is the number of thresholds not above it."""
    steps, p, below = [], math.exp(-1.0), 0.0
    for k in range(13):
        below += p
        steps.append(min(int(below * 2**32), 2**32))
        p /= k + 1
    return [s for s in steps if s < 2**32]


def tree_draw(row_hash: np.ndarray, tree: int) -> np.ndarray:
    """Murmur3 of the tree's number, seeded by the row's hash (both 32 bits):
    what Spark's ``hash`` gives with the tree as one more column."""
    k = (tree * 0xCC9E2D51) & 0xFFFFFFFF
    k = ((k << 15) | (k >> 17)) & 0xFFFFFFFF
    k = (k * 0x1B873593) & 0xFFFFFFFF
    h = row_hash.astype(np.uint32) ^ np.uint32(k)
    h = (h << np.uint32(13)) | (h >> np.uint32(19))
    h = h * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(4)
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def tree_weight(row_hash: np.ndarray, tree: int, bootstrap: bool = True) -> np.ndarray:
    if not bootstrap:
        return np.ones(len(row_hash))
    return _drawn(row_hash, tree).astype(float)


@functools.cache
def _weight_table() -> tuple[np.ndarray, np.ndarray]:
    """The thresholds, and a draw's weight by its upper 16 bits; 255 where
    these do not decide."""
    steps = np.array(poisson_steps(), np.uint64)
    first = np.arange(1 << 16, dtype=np.uint64) << np.uint64(16)
    low, high = (np.searchsorted(steps, x, side="right") for x in (first, first + np.uint64(0xFFFF)))
    return steps, np.where(low == high, low, 255).astype(np.uint8)


def _drawn(row_hash: np.ndarray, tree: int) -> np.ndarray:
    """Weights as bytes."""
    steps, table = _weight_table()
    draw = tree_draw(row_hash, tree)
    out = table.take((draw >> np.uint32(16)).astype(np.int64), mode="clip")
    left = np.flatnonzero(out == 255)
    out[left] = np.searchsorted(steps, draw[left].astype(np.uint64), side="right")
    return out


# ------------------------------------------------------------------ cuts

def cut_points(rows: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Ascending candidate cuts by feature, from two aggregate passes.  The
    grid counts are at most features x GRID rows, the cuts features x bins."""
    x = F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(len(features) - 1)).alias("f"), F.array(*[F.col(c) for c in features]).alias("x")))
    long = rows.select(x.alias("v")).select("v.f", "v.x")
    span = long.groupBy("f").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n"))
    span = span.where("hi > lo").withColumn("step", (F.col("hi") - F.col("lo")) / GRID)
    cell = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("step")), F.lit(GRID - 1)).alias("cell")
    counted = long.join(F.broadcast(span), "f").groupBy("f", "lo", "step", "n", cell).agg(F.count(F.lit(1)).alias("c"))  # a row per feature
    w = Window.partitionBy("f").orderBy("cell")
    before = F.sum("c").over(w) - F.col("c")
    ranked = counted.withColumn("q", F.floor(before * max_bins / F.col("n"))).withColumn("last", F.lag("q").over(w))
    chosen = ranked.where("q > last").select("f", (F.col("lo") + F.col("cell") * F.col("step")).alias("cut"))
    cuts: list[list[float]] = [[] for _ in features]
    for r in chosen.orderBy("f", "cut").collect():
        cuts[r["f"]].append(r["cut"])
    return cuts


def _bin(cuts: list[list[float]]):
    edges = [np.array(c) for c in cuts]

    def run(batches):
        for batch in batches:
            cells = [np.searchsorted(e, batch.column(f"x{f}").to_numpy(), side="right").astype(np.uint8) for f, e in enumerate(edges)]
            data = np.ascontiguousarray(np.stack(cells, axis=1))
            off = np.arange(len(data) + 1, dtype=np.int32) * len(edges)
            bins = pa.BinaryArray.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(off), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([bins, batch.column("y"), batch.column("h")], ["bins", "y", "h"])

    return run


# ---------------------------------------------------------------- growth

class _Tree:
    """Cuts of one growing tree by node; feature -1 marks a leaf."""

    def __init__(self, depth: int):
        self.feature = np.full(2 << depth, -1, np.int64)
        self.bin = np.zeros(2 << depth, np.int64)

    def _right(self, columns: np.ndarray, node: int, turns: list[np.ndarray]) -> np.ndarray:
        """Whether rows go right at the node below ``node`` to which their
        last ``turns`` have led."""
        if turns:
            left, right = (self._right(columns, 2 * node + side, turns[1:]) for side in (0, 1))
            return left ^ ((left ^ right) & turns[0])
        f = self.feature[node]
        return columns[f] > np.uint8(self.bin[node]) if f >= 0 else np.zeros(columns.shape[1], bool)

    def node_of(self, columns: np.ndarray, use: np.ndarray, levels: int) -> np.ndarray:
        """Node at depth ``levels`` of the rows ``use`` of (feature, row) bins.
        Rows whose leaf lies higher go on to its left, to nodes that are
        never open."""
        turns: list[np.ndarray] = []
        code = np.zeros(columns.shape[1], np.uint8)
        for _ in range(min(levels, TOP)):
            turns.append(self._right(columns, 1, turns))
            code += code
            code += turns[-1].view(np.uint8)
        node = code.take(use, mode="clip").astype(np.int64) + (1 << len(turns))
        if levels > TOP:
            n = columns.shape[1]
            cells, row_of = columns.reshape(-1), np.where(self.feature >= 0, self.feature, 0) * n
            last = np.where(self.feature >= 0, self.bin, 255).astype(np.uint8)
            for _ in range(levels - TOP):
                at = row_of.take(node, mode="clip")  # all are in bounds; this mode is the quickest
                at += use
                right = cells.take(at, mode="clip") > last.take(node, mode="clip")
                node += node
                node += right
        return node


def _chunks(batches, n_features: int):
    """Bins as (feature, row), labels and hashes of ``CHUNK`` rows or more."""
    parts, size = [], 0

    def joined():
        bins, y, h = zip(*parts, strict=True)
        return np.ascontiguousarray(np.concatenate(bins).T), np.concatenate(y), np.concatenate(h)

    for batch in batches:
        if not batch.num_rows:
            continue
        raw = batch.column("bins").cast(pa.binary())
        start = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset]
        bins = np.frombuffer(raw.buffers()[2], np.uint8)[start : start + batch.num_rows * n_features].reshape(-1, n_features)
        parts.append((bins, batch.column("y").to_numpy(), batch.column("h").to_numpy().view(np.uint32)))
        size += batch.num_rows
        if size >= CHUNK:
            yield joined()
            parts, size = [], 0
    if parts:
        yield joined()


#: Weights and weighted labels are added up as one number while both parts stay whole and below these.
_MOST_WEIGHT, _MOST_LABEL = 2.0**20, 2.0**32


def _add(total: np.ndarray, columns: np.ndarray, use: np.ndarray, slot: np.ndarray, w: np.ndarray, y: np.ndarray, whole: bool) -> None:
    """Add rows to (2, feature, node, bin) sums of weights and weighted labels."""
    if not len(use):
        return
    _, n_features, n_nodes, max_bins = total.shape
    wy = w * y
    first = slot * max_bins
    packed = whole and w.sum() < _MOST_WEIGHT and wy.sum() < _MOST_LABEL
    if packed:
        wy += w * _MOST_LABEL
    for f in range(n_features):
        at = first + columns[f].take(use, mode="clip")
        both = np.bincount(at, wy, n_nodes * max_bins).reshape(n_nodes, max_bins)
        if packed:
            weight = np.floor(both / _MOST_LABEL)
            both -= weight * _MOST_LABEL
        else:
            weight = np.bincount(at, w, n_nodes * max_bins).reshape(n_nodes, max_bins)
        total[0, f] += weight
        total[1, f] += both


def _sums(trees: dict[int, _Tree], active: dict[int, np.ndarray], level: int, n_features: int, max_bins: int, bootstrap: bool):
    """Task side of a pass: (tree, node, sums) with one array of weights and
    weighted labels by (feature, bin) for each open node."""

    def run(batches):
        total = {t: np.zeros((2, n_features, len(nodes), max_bins)) for t, nodes in active.items()}
        slot = {}
        for t, nodes in active.items():
            slot[t] = np.full(2 << level, -1, np.int64)
            slot[t][nodes] = np.arange(len(nodes))
        for columns, y, h in _chunks(batches, n_features):
            whole = bool((y >= 0).all() and (y == np.floor(y)).all())
            for t, nodes in active.items():
                w = _drawn(h, t) if bootstrap else np.ones(len(h), np.uint8)
                use = np.flatnonzero(w != 0)
                s = slot[t].take(trees[t].node_of(columns, use, level))
                if len(nodes) < 1 << level:
                    use, s = use[s >= 0], s[s >= 0]
                _add(total[t], columns, use, s, w.take(use).astype(float), y.take(use), whole)
        for t, nodes in active.items():
            seen = total[t][0, 0].any(axis=1)
            if seen.any():
                data = [np.ascontiguousarray(total[t][:, :, i]).tobytes() for i in np.flatnonzero(seen)]
                n = len(data)
                yield pa.RecordBatch.from_arrays([pa.array([t] * n, pa.int32()), pa.array(nodes[seen]), pa.array(data, pa.binary())], ["tree", "node", "sums"])

    return run


def best_cut(sums: np.ndarray) -> tuple[float, float, int, int, float, float]:
    """(weight, label sum, feature, last bin to the left, weight and label sum
    to the left) for (2, feature, bin) sums; feature -1 if nothing is gained."""
    w, s = np.cumsum(sums[0], axis=1), np.cumsum(sums[1], axis=1)
    all_w, all_s = float(w[0, -1]), float(s[0, -1])
    left_w, left_s = w[:, :-1], s[:, :-1]
    right_w, right_s = all_w - left_w, all_s - left_s
    ok = (left_w > 0) & (right_w > 0)
    own = all_s * all_s / all_w
    gain = left_s * left_s / np.where(ok, left_w, 1.0) + right_s * right_s / np.where(ok, right_w, 1.0) - own
    gain = np.where(ok, gain, -np.inf)
    at = int(np.argmax(gain)) if gain.size else 0
    if not gain.size or not gain.flat[at] > own * LEAST_GAIN or not gain.flat[at] > 0:
        return all_w, all_s, -1, 0, 0.0, 0.0
    f, b = divmod(at, gain.shape[1])
    return all_w, all_s, f, b, float(left_w[f, b]), float(left_s[f, b])


def _reduce(n_features: int, max_bins: int):
    """Sums of one (tree, node), which follow each other, to its best cut."""
    names = ["tree", "node", "w", "s", "f", "b", "lw", "ls"]

    def run(batches):
        key, total = None, None
        for batch in batches:
            out = []
            for t, n, data in zip(batch.column("tree").to_pylist(), batch.column("node").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                part = np.frombuffer(data).reshape(2, n_features, max_bins)
                if (t, n) == key:
                    total = total + part
                    continue
                if key is not None:
                    out.append((*key, *best_cut(total)))
                key, total = (t, n), part
            yield _cuts(out, names)
        if key is not None:
            yield _cuts([(*key, *best_cut(total))], names)

    return run


def _cuts(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def grow(rows: DataFrame, features: Sequence[str], label: str, key: Sequence[str], settings: Settings, partitions: int | None = None) -> "Forest":
    """Fit on complete rows.  ``partitions`` bounds the tasks of a pass (by
    default a few for each core); the model is the same for any number."""
    spark = rows.sparkSession
    ship(spark)
    if settings.max_bins > 256 or settings.max_bins < 2:
        raise ValueError("max_bins must be 2 to 256")
    data = rows.select(
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
        F.col(label).cast("double").alias("y"), F.hash(*[F.col(k) for k in key], F.lit(settings.seed)).alias("h"),
    )
    xs = [f"x{i}" for i in range(len(features))]
    cuts = cut_points(data, xs, settings.max_bins)
    binned = io.materialize(data.mapInArrow(_bin(cuts), "bins binary, y double, h int"), storage.scratch_path(spark, "forest_rows"))
    mean = binned.agg(F.sum("y").alias("s"), F.count("y").alias("n")).first()
    if not mean["n"]:
        raise RuntimeError("no complete row to fit a forest on")
    most = partitions or 4 * spark.sparkContext.defaultParallelism
    if binned.rdd.getNumPartitions() > most:
        binned = binned.coalesce(most)
    trees = {t: _Tree(settings.max_depth) for t in range(settings.num_trees)}
    nodes: dict[tuple[int, int], list] = {}  # (tree, node) -> [feature, cut, value, weight]
    active = {t: np.array([1]) for t in trees}
    width = 2 * len(features) * settings.max_bins * 8
    for level in range(settings.max_depth):
        cut_rows = []
        todo = [t for t in active if len(active[t])]
        while todo:
            group, size = [], 0
            while todo and (not group or size + len(active[todo[0]]) * width <= PASS_BYTES):
                size += len(active[todo[0]]) * width
                group.append(todo.pop(0))
            part = _sums({t: trees[t] for t in group}, {t: active[t] for t in group}, level, len(features), settings.max_bins, settings.bootstrap)
            with io.shuffles_go(spark):
                sums = binned.mapInArrow(part, "tree int, node long, sums binary")
                best = sums.repartition("tree", "node").sortWithinPartitions("tree", "node").mapInArrow(
                    _reduce(len(features), settings.max_bins), "tree int, node long, w double, s double, f int, b int, lw double, ls double"
                )
                cut_rows += best.collect()
        opened: dict[int, list[int]] = {t: [] for t in trees}
        for r in sorted(cut_rows, key=lambda r: (r["tree"], r["node"])):
            t, n = r["tree"], r["node"]
            if n == 1:
                nodes[t, 1] = [None, None, r["s"] / r["w"], r["w"]]
            if r["f"] < 0:
                continue
            trees[t].feature[n], trees[t].bin[n] = r["f"], r["b"]
            nodes[t, n][:2] = [features[r["f"]], cuts[r["f"]][r["b"]]]
            for child, w, s in ((2 * n, r["lw"], r["ls"]), (2 * n + 1, r["w"] - r["lw"], r["s"] - r["ls"])):
                nodes[t, child] = [None, None, s / w, w]
                opened[t].append(child)
        active = {t: np.array(v, np.int64) for t, v in opened.items()}
        if not any(len(v) for v in active.values()):
            break
    for t in trees:  # no row was drawn for this tree, or it has no level
        nodes.setdefault((t, 1), [None, None, mean["s"] / mean["n"], 0.0])
    table = [
        (t, n, f, c, 2 * n if f is not None else None, 2 * n + 1 if f is not None else None, v, w)
        for (t, n), (f, c, v, w) in sorted(nodes.items())
    ]
    return Forest(table, tuple(features))


# --------------------------------------------------------------- scoring

class Forest:
    """A fitted forest: rows of the node table, and the features' names."""

    def __init__(self, table: list[tuple], features: Sequence[str]):
        self.table, self.features = table, tuple(features)

    @property
    def num_trees(self) -> int:
        return len({r[0] for r in self.table})

    def nodes(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.table, NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        order = [(i, f) for i, f in enumerate(self.features)]
        spark.createDataFrame(order, "pos int, feature string").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Forest":
        """The saved table; its size was bounded when it was fitted."""
        features = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("pos").collect()]
        rows = spark.read.schema(NODES).parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        return Forest([tuple(r) for r in rows], features)

    def _arrays(self):
        """Node table as arrays by place: feature, number of the cut among the
        feature's, children (left at 2 * place, right after it); a leaf leads
        to itself."""
        place = {(r[0], r[1]): i for i, r in enumerate(self.table)}
        at = {f: i for i, f in enumerate(self.features)}
        feature = np.array([max(at.get(r[2], -1), 0) for r in self.table], np.int64)
        cuts = [np.unique([r[3] for r in self.table if r[2] == f]) for f in self.features]
        cut = np.array([np.searchsorted(cuts[at[r[2]]], r[3]) if r[2] in at else 0 for r in self.table], np.int64)
        inner = [r[2] in at for r in self.table]
        child = np.array([place[r[0], r[k]] if is_in else i for i, (r, is_in) in enumerate(zip(self.table, inner, strict=True)) for k in (4, 5)], np.int64)
        value = np.array([r[6] for r in self.table])
        roots = [i for i, r in enumerate(self.table) if r[1] == 1]
        depth = max(int(r[1]).bit_length() for r in self.table) - 1
        return feature, cuts, cut, child, value, roots, depth

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``, the mean over the trees of the value of
        the leaf that the row's features lead to."""
        ship(df.sparkSession)
        feature, cuts, cut, child, value, roots, depth = self._arrays()

        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            n = len(columns[0])
            passed = np.empty((len(columns), n), np.int64)  # cuts of the feature not above the row's value
            for f, c in enumerate(columns):
                x = c.to_numpy(float)
                passed[f] = np.where(np.isnan(x), 0, np.searchsorted(cuts[f], x, side="right"))
            cells, first, rows = passed.reshape(-1), feature * n, np.arange(n)
            total = np.zeros(n)
            for root in roots:
                node = np.full(n, root)
                for _ in range(depth):
                    at = first.take(node, mode="clip")
                    at += rows
                    right = cells.take(at, mode="clip") > cut.take(node, mode="clip")
                    node += node
                    node += right
                    node = child.take(node, mode="clip")
                total += value[node]
            return pd.Series(total / len(roots))

        return df.withColumn("prediction", predict(*[F.col(f).cast("double") for f in self.features]))
